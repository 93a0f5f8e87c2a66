"""Personal data by weak supervision, in DataFrame operations.

Candidates are the base spans and wider forms (spelled-out signs, other marks, no plus) beside them. Labelers of five kinds
vote on each: the strict form, the arithmetic (checksum, ranges, digits), gazetteers, cue words before, and what borders on
it. Votes of the whole corpus are counted by pattern, expectation-maximisation estimates from these counts how reliable
each labeler is, and a logistic span classifier is fitted to the resulting posteriors; it sees the votes by kind and also
the span itself and its surroundings (length, marks, neighbours). It then decides on the candidates that aren't base spans;
those always stay. No text is shuffled: one scan writes the candidates of every row, fit and decision read those.

Positions are code points, end exclusive. Defined results: a null text is empty and has no spans; repeated rows each get
their spans; with no candidates at all nothing is fitted and only base spans come out; other columns go along whatever
their names, but for base and spans, which are replaced. Time grows in proportion to the matches of a text.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayloom.llm.common import bound, scanned, written

KINDS = ("email", "ip", "card", "phone")
#: The base patterns. Runs are possessive and a match starts at a run's start or where the last match ended, which
#: changes no match but keeps a very long run linear.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Wider forms for candidates, from the start of a run on as well: spelled-out signs in addresses, spaced dots, other card marks, numbers without a plus.
WIDE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++ ?(?:@|\[at\]|\(at\)) ?[A-Za-z0-9-]++(?: ?(?:\.|\[dot\]|\(dot\)) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:(?:\.|\[\.\])[0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}([ ./-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])",
    "phone": r"(?<![0-9+(])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
}
#: What a text must hold for any match of BASE and WIDE: a cheap test that spares most texts the scan.
NEEDS = {
    "email": lambda t: t.contains("@") | t.contains("[at]") | t.contains("(at)"),
    "ip": lambda t: t.rlike(r"[0-9]\[?\.\]?[0-9]"),
    "card": lambda t: t.rlike(r"[0-9][ ./-]?[0-9]"),
    "phone": lambda t: t.contains("+") | t.rlike(r"[0-9]{4}"),
}
#: The strict form of each kind, for a labeler. Repeated groups are possessive: others go as deep as the span is long.
FORM = {
    "email": r"^[A-Za-z0-9_%+-]++(?:\.[A-Za-z0-9_%+-]++)*+(?:@| ?[\[(]at[\])] ?)(?:[A-Za-z0-9]++(?:-++[A-Za-z0-9]++)*+(?:\.| ?[\[(]dot[\])] ?))++[A-Za-z]{2,24}$",
    "ip": r"^(?:0|[1-9][0-9]{0,2})(?:\[?\.\]?(?:0|[1-9][0-9]{0,2})){3}$",
    "card": r"^(?:[0-9]{13,19}|[0-9]{4}([ ./-]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}|3[0-9]{3}[ -]?[0-9]{6}[ -]?[0-9]{5})$",
    "phone": r"^(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){1,4}$",
}
#: Gazetteers and cue words (fixed values). Two letters at the end of a domain are a country.
SUFFIXES = (
    "com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "name", "pro", "aero", "coop", "museum", "jobs", "mobi", "travel", "cat", "tel", "asia", "post",
    "xyz", "online", "site", "shop", "store", "app", "dev", "cloud", "blog", "tech", "email", "live", "news", "agency", "digital", "world", "life", "today", "space",
)
#: Card issuers: first four digits from and to, numbers of digits.
ISSUERS = (
    (4000, 4999, (13, 16, 19)), (5100, 5599, (16,)), (2221, 2720, (16,)), (3400, 3499, (15,)), (3700, 3799, (15,)), (6011, 6011, (16, 19)), (6440, 6599, (16, 19)),
    (3528, 3589, (16, 17, 18, 19)), (3000, 3059, (14, 16, 19)), (3600, 3699, (14, 16, 19)), (3800, 3999, (14, 16, 19)), (6200, 6299, (16, 17, 18, 19)), (5000, 5099, (12, 13, 14, 15, 16, 17, 18, 19)), (5600, 5899, (12, 13, 14, 15, 16, 17, 18, 19)),
)
#: Address blocks that name no host, and the calling codes of countries or an area code with its exchange.
RESERVED = r"^(?:0|127|255|2(?:2[4-9]|3[0-9]|4[0-9]|5[0-5]))\."
CALLING = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[1-689][0-9]|3[578][0-9]|42[013]|5[09][0-9]|6[789][0-9]|8[0578][0-9]|9[679][0-9])|^\(?[2-9][0-9]{2}\)?[ .-][2-9]"
CUES = {"email": r"(?:e-?mail|mail|contact|write|courriel|correo|to)", "ip": r"(?:\bip\b|address|host|server|from)", "card": r"(?:card|visa|karte|carte|tarjeta|pay)", "phone": r"(?:tel|phone|call|fax|mobile|handy|ring)"}
AGAINST = r"(?:order|version|isbn|invoice|serial|release|build|\bv|\bid\b|\bno\.?)"
LABELERS = ("form", "valid", "gazetteer", "cue", "border")
#: What the classifier sees of a span besides: length, marks, what stands before and after; four values each.
SEEN = ("length", "marks", "before", "after")
BEFORE = 24


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn sum."""
    return bound(F.reverse(number), lambda turned: luhn_turned(turned))


def luhn_turned(turned: Column) -> Column:
    doubled = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    digit = lambda i: F.substring(turned, i, F.lit(1)).cast("int")
    each = F.transform(F.sequence(F.lit(1), F.length(turned)), lambda i: F.when(i % 2 == 0, doubled(digit(i))).otherwise(digit(i)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def octets(s: Column) -> Column:
    """Whether all four parts are at most 255, leading zeros allowed."""
    return s.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.|$)){4}$")


def passes(kind: str, s: Column) -> Column:
    return {
        "email": lambda: F.lit(True),
        "ip": lambda: octets(s),
        "card": lambda: bound(digits(s), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(F.lit(False))),
        "phone": lambda: F.length(digits(s)).between(9, 15),
    }[kind]()


def passing(kind: str) -> Callable[[Column], Column]:
    return lambda x: passes(kind, x["s"])


SPAN = "struct<start:int,end:int,s:string>"


def matches(df: DataFrame, text: str, patterns: dict[str, str], prefix: str) -> DataFrame:
    """`df` with an array of SPAN for each pattern: leftmost, non-overlapping."""
    empty = F.array().cast("array<string>")
    found = df.withColumns({f"_m_{k}": F.when(NEEDS[k](F.col(text)), F.regexp_extract_all(text, F.lit(p), F.lit(0))).otherwise(empty) for k, p in patterns.items()})
    # what stands between the matches gives their places; texts without a match are not scanned again
    cut = found.withColumns({f"_g_{k}": F.when(F.size(f"_m_{k}") > 0, F.split(text, p, -1)) for k, p in patterns.items()})

    def placed(k: str) -> Column:
        steps = bound(F.col(f"_g_{k}"), lambda g: F.transform(f"_m_{k}", lambda x, i: F.struct(F.length(F.get(g, i)).alias("gap"), x.alias("s"))))
        start = lambda at, x: at + x["gap"]
        end = lambda at, x: at + x["gap"] + F.length(x["s"])
        span = lambda at, x: F.array(F.struct(start(at, x).alias("start"), end(at, x).alias("end"), x["s"].alias("s")))
        return scanned(steps, F.lit(0), end, span, f"array<{SPAN}>")

    out = cut.withColumns({f"{prefix}{k}": placed(k) for k in patterns})
    return out.drop(*[f"_{x}_{k}" for x in "mg" for k in patterns])


def base_spans(df: DataFrame, text: str = "_text") -> DataFrame:
    """`df` with base_<kind>: the spans of the base patterns that pass their test."""
    out = matches(df, text, BASE, "base_")
    return out.withColumns({f"base_{k}": F.filter(f"base_{k}", passing(k)) for k in KINDS if k != "email"})


def votes(kind: str, s: Column, before: Column, after: Column, suffixes: tuple[str, ...]) -> list[Column]:
    """Each labeler's vote, in the order of LABELERS: 1 for, -1 against, 0 none."""
    sign = lambda c: F.when(c, 1).otherwise(-1)
    clean = F.regexp_replace(s, r"[\[\]]", "")
    suffix = F.lower(F.regexp_extract(s, r"(?<![A-Za-z0-9-])([A-Za-z0-9-]++)$", 1))

    def issued(number: Column) -> Column:
        first = F.substring(number, 1, 4).cast("int")
        return reduce(lambda a, b: a | b, [first.between(low, high) & F.length(number).isin(*sizes) for low, high, sizes in ISSUERS])

    arithmetic = {
        "email": lambda: bound(suffix, lambda x: F.length(x).between(2, 24) & ~x.rlike("[0-9]")),
        "ip": lambda: octets(clean),
        "card": lambda: passes("card", s),
        "phone": lambda: passes("phone", s),
    }[kind]()
    listed = {
        "email": lambda: bound(suffix, lambda x: x.isin(*suffixes) | x.rlike("^[a-z]{2}$")),
        "ip": lambda: ~clean.rlike(RESERVED),
        "card": lambda: bound(digits(s), issued),
        "phone": lambda: s.rlike(CALLING),
    }[kind]()
    cue = F.when(before.rlike(f"(?i){CUES[kind]}[^A-Za-z0-9]*$"), 1).when(before.rlike(f"(?i){AGAINST}[^A-Za-z0-9]*$"), -1).otherwise(0)
    return [sign(s.rlike(FORM[kind])), sign(arithmetic), sign(listed), cue, sign(~before.rlike(r"[A-Za-z0-9]$") & ~after.rlike(r"^[A-Za-z0-9@]"))]


def looks(s: Column, before: Column, after: Column) -> list[Column]:
    """What SEEN names, each a number from 0 to 3."""
    n = F.length(s)
    side = lambda c: F.when(c.rlike(r"[A-Za-z]"), 1).when(c.rlike("[0-9]"), 2).when(c.rlike(r"[^\s]"), 3).otherwise(0)
    marks = F.when(s.rlike(r"[\[\]()]"), 3).when(s.contains(" "), 2).when(s.rlike("[./-]"), 1).otherwise(0)
    return [F.when(n < 12, 0).when(n < 16, 1).when(n < 20, 2).otherwise(3), marks, side(F.right(before, F.lit(1))), side(after)]


PLACED = "struct<start:int,wide:int,kind:int,end:int,s:string>"
CANDIDATE = "struct<kind:int,start:int,end:int,base:boolean,v:array<int>,x:array<int>>"


def candidates(df: DataFrame, text: str = "_text", suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """`df` with base_<kind> and cand (an array of CANDIDATE): base spans, and wider ones that meet none of them."""
    out = matches(base_spans(df, text), text, WIDE, "wide_")

    # in order of their starts, a wide span meets a base one if one before it ends later or one after it starts earlier
    def entry(number: int, wide: bool) -> Callable[[Column], Column]:
        return lambda x: F.struct(x["start"].alias("start"), F.lit(int(wide)).alias("wide"), F.lit(number).alias("kind"), x["end"].alias("end"), (x["s"] if wide else F.lit("")).alias("s"))

    wider, based = (F.concat(*[F.transform(f"{name}_{k}", entry(number, wide)) for number, k in enumerate(KINDS)]) for name, wide in (("wide", True), ("base", False)))
    base_of = lambda x, then, other: F.when(x["wide"] == 0, then).otherwise(other)
    after_base = scanned(F.array_sort(F.concat(based, wider)), F.lit(0), lambda end, x: base_of(x, F.greatest(end, x["end"]), end), lambda end, x: F.when((x["wide"] == 1) & (x["start"] < end), F.array().cast(f"array<{PLACED}>")).otherwise(F.array(x).cast(f"array<{PLACED}>")), f"array<{PLACED}>")
    far = F.lit((1 << 31) - 1)
    apart = scanned(F.reverse("_apart"), far, lambda start, x: base_of(x, F.least(start, x["start"]), start), lambda start, x: F.when((x["wide"] == 0) | (start < x["end"]), F.array().cast(f"array<{PLACED}>")).otherwise(F.array(x)), f"array<{PLACED}>")
    out = out.withColumn("_apart", F.when(F.size(wider) > 0, after_base).otherwise(F.array().cast(f"array<{PLACED}>")))
    out = out.withColumn("_apart", F.when(F.size("_apart") > 0, apart).otherwise(F.col("_apart")))

    def judged(number: int, kind: str, base: bool) -> Callable[[Column], Column]:
        def one(x: Column) -> Column:
            low = F.greatest(x["start"] - BEFORE, F.lit(0))
            window = F.substring(F.col(text), low + 1, x["end"] - low + 1)
            return bound(window, lambda w: told(x, F.substring(w, F.lit(1), x["start"] - low), F.substring(w, x["end"] - low + 1, F.lit(1))))

        def told(x: Column, before: Column, after: Column) -> Column:
            v, seen = votes(kind, x["s"], before, after, suffixes), looks(x["s"], before, after)
            return F.struct(F.lit(number).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), F.lit(base).alias("base"), F.array(*v).alias("v"), F.array(*seen).alias("x")).cast(CANDIDATE)

        return one

    def of(number: int) -> Callable[[Column], Column]:
        return lambda x: x["kind"] == number

    spans = []
    for number, k in enumerate(KINDS):
        spans += [F.transform(f"base_{k}", judged(number, k, True)), F.transform(F.filter("_apart", of(number)), judged(number, k, False))]
    return out.withColumn("cand", F.concat(*spans)).drop("_apart", *[f"wide_{k}" for k in KINDS])


def label(docs: DataFrame, text: str = "text", keep: list[str] | None = None, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """row (a struct of the columns in `keep`, or of all) and cand of every row, written, so that texts are scanned once."""
    rows = docs.select(F.struct(*(keep or docs.columns)).alias("row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    return written(candidates(rows, suffixes=suffixes).select("row", "cand"), "candidates")


def expectation_maximisation(counts: dict[tuple, int], rounds: int = 50) -> tuple[dict[tuple, float], dict]:
    """Posterior that a span is personal data for each (kind, votes), and the labelers' reliabilities.

    Two classes, votes independent given the class and the kind, add-one smoothing. The start is a majority vote.
    """
    post = {p: 1 / (1 + math.exp(-1.5 * sum(p[1]))) for p in counts}
    rates: dict = {}
    for _ in range(rounds if counts else 0):
        prior, rates = {}, {}
        for k in {p[0] for p in counts}:
            own = [(p, n) for p, n in counts.items() if p[0] == k]
            mass = [sum(n * (1 - post[p]) for p, n in own), sum(n * post[p] for p, n in own)]
            prior[k] = (mass[1] + 1) / (mass[0] + mass[1] + 2)
            for i in range(len(LABELERS)):
                for v in (-1, 0, 1):
                    for c in (0, 1):
                        hit = sum(n * (post[p] if c else 1 - post[p]) for p, n in own if p[1][i] == v)
                        rates[k, i, v, c] = (hit + (1.5 if (v > 0) == bool(c) and v else 0.5)) / (mass[c] + 2.5)
        for p in counts:
            odds = math.log(prior[p[0]] / (1 - prior[p[0]])) + sum(math.log(rates[p[0], i, v, 1] / rates[p[0], i, v, 0]) for i, v in enumerate(p[1]))
            post[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return post, rates


Pattern = tuple[int, tuple[int, ...], tuple[int, ...]]  # kind, votes, what is seen of the span


def places(p: Pattern) -> list[int]:
    """Which weights count for a pattern: its kind's own, one for each vote by kind, one for each thing seen."""
    k, v, x = p
    votes_at = len(KINDS)
    seen_at = votes_at + len(KINDS) * len(LABELERS) * 3
    return [k, *(votes_at + (k * len(LABELERS) + i) * 3 + s + 1 for i, s in enumerate(v)), *(seen_at + i * 4 + s for i, s in enumerate(x))]


WEIGHTS = len(KINDS) + len(KINDS) * len(LABELERS) * 3 + len(SEEN) * 4


def span_classifier(counts: dict[Pattern, int], post: dict[tuple, float], rounds: int = 400, penalty: float = 1e-3) -> list[float]:
    """Weights of a logistic model of the posteriors (by kind and votes), by gradient steps on the counted patterns."""
    if not counts:
        return [0.0] * WEIGHTS
    at = np.array([places(p) for p in counts])
    n = np.sqrt(np.array([*counts.values()], float))
    y = np.array([post[p[:2]] for p in counts])
    w = np.zeros(WEIGHTS)
    for _ in range(rounds):
        g = n / n.sum() * (1 / (1 + np.exp(-np.clip(w[at].sum(1), -30, 30))) - y)
        w -= 1.0 * (np.bincount(at.ravel(), np.repeat(g, at.shape[1]), WEIGHTS) + penalty * w)
    return w.tolist()


def fit(labelled: DataFrame) -> list[float]:
    """The span classifier's weights, from all candidates of `label` rows."""
    each = labelled.select(F.explode("cand").alias("c"))
    # at most 4 kinds, 3^5 votes and 4^4 looks
    counted = each.groupBy(F.col("c.kind").alias("kind"), F.col("c.v").alias("v"), F.col("c.x").alias("x")).count().collect()
    counts = {(r["kind"], tuple(r["v"]), tuple(r["x"])): r["count"] for r in sorted(counted)}
    patterns: dict[tuple, int] = {}
    for p, n in counts.items():
        patterns[p[:2]] = patterns.get(p[:2], 0) + n
    return span_classifier(counts, expectation_maximisation(patterns)[0])


def find(labelled: DataFrame, weights: list[float]) -> DataFrame:
    """The rows of `label` rows with base and spans: array<struct<start,kind,end>> in order, kind a number as in KINDS."""
    w = F.array(*map(F.lit, weights))

    def score(c: Column) -> Column:
        votes_at, seen_at = len(KINDS), len(KINDS) + len(KINDS) * len(LABELERS) * 3
        by_vote = [F.get(w, (c["kind"] * len(LABELERS) + i) * 3 + F.get(c["v"], F.lit(i)) + (votes_at + 1)) for i in range(len(LABELERS))]
        by_look = [F.get(w, F.get(c["x"], F.lit(i)) + (seen_at + i * 4)) for i in range(len(SEEN))]
        return reduce(lambda a, b: a + b, [F.get(w, c["kind"]), *by_vote, *by_look])

    plain = lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))
    kept = [F.col("row")[c].alias(c) for c in labelled.schema["row"].dataType.names if c not in ("base", "spans")]
    return labelled.select(
        *kept,
        F.sort_array(F.transform(F.filter("cand", lambda c: c["base"]), plain)).alias("base"),
        F.sort_array(F.transform(F.filter("cand", lambda c: c["base"] | (score(c) > 0)), plain)).alias("spans"),
    )


def spelled(spans: str) -> Column:
    """kind:start:end of all spans, joined by commas."""
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(name, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(text: Column, spans: str) -> Column:
    """The text with every span replaced by <KIND>; of spans that overlap, the earlier one stands for both."""
    name = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    none = F.array().cast("array<string>")
    parts = scanned(
        F.col(spans),
        F.lit(0),
        lambda at, x: F.greatest(at, x["end"]),
        lambda at, x: F.when(x["start"] < at, none).otherwise(F.array(F.substring(text, at + 1, x["start"] - at), F.get(name, x["kind"]))),
        "array<string>",
    )
    rest = F.substring(text, F.array_max(F.transform(spans, lambda x: x["end"])) + 1, F.length(text))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(parts, ""), rest)).otherwise(text)
