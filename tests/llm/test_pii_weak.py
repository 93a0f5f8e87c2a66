import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assayloom.llm import pii_weak as p
from assayloom.llm.common import sha256_hex

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
TEXTS = [
    None, "", "no one here", "a@b.c_d@e.f.", "x@y", "me@a.b.c, you@d-e.fr", "1.2.3.4.5.6.7.8 and 256.1.1.1 or 010.0.0.255", "4111 1111 1111 1111 and 4111-1111-1111-1112", "+1 (456) 555-2186 +33 1", "é@x.yz ü 4111111111111111",
    "+12345678901234567890", "5500005555555559 0000 0000 0000", "a" * 50_000, "1 " * 20_000, "a.a" * 20_000, "mail: jo [at] site [dot] com", "call 212-555-0187 now", "@" * 100, "1.1.1." * 3000, "+ 1 2", "x@1.2.3.4", "ssn 4111.1111.1111.1111",
]


def luhn(d):
    return sum((int(c) * 2 - 9 * (int(c) > 4) if i % 2 else int(c)) for i, c in enumerate(reversed(d))) % 10 == 0


def base(text):
    out = []
    for k, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if (k == 0, k == 1 and all(int(x) <= 255 for x in m[0].split(".")), k == 2 and 12 <= len(d) <= 19 and luhn(d), k == 3 and 9 <= len(d) <= 15)[k]:
                out.append((m.start(), k, m.end()))
    return ",".join(f"{p.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


def spans(spark, texts):
    names = ("cand", "base", "spans", "_text", "row", "base_ip", "wide_ip", "_m_ip")
    df = spark.createDataFrame([(i, t, *["x"] * len(names)) for i, t in enumerate(texts)], "doc_id long, text string, " + ", ".join(f"{c} string" for c in names))
    labelled = p.label(df)
    got = p.find(labelled, p.fit(labelled))
    assert sorted(got.columns) == sorted(["doc_id", "text", *names])
    kept = [c for c in names if c not in ("base", "spans")]
    assert {tuple(r) for r in got.select(*kept).distinct().collect()} == {("x",) * len(kept)}
    rows = got.select("doc_id", p.spelled("base").alias("b"), p.spelled("spans").alias("s"), sha256_hex(p.spelled("base")).alias("h")).collect()
    return {r["doc_id"]: r for r in rows}


def test_base_against_brute_force(spark):
    got = spans(spark, TEXTS)
    for i, t in enumerate(TEXTS):
        assert got[i]["b"] == base(t), t
        assert got[i]["h"] == hashlib.sha256(base(t).encode()).hexdigest()
        assert set(got[i]["b"].split(",")) <= set(got[i]["s"].split(",")) | {""}


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(alphabet="a1.5@+-() é", max_size=40), min_size=60, max_size=120))
def test_base_on_random_texts(spark, texts):
    got = spans(spark, texts)
    assert [got[i]["b"] for i in range(len(texts))] == [base(t) for t in texts]


def test_reliabilities_and_classifier():
    counts = {(0, (1, 1, 1, 1, 1)): 400, (0, (1, 1, 1, 0, 1)): 500, (0, (-1, 1, 1, 1, 1)): 60, (0, (-1, -1, -1, 0, -1)): 300, (0, (-1, -1, 1, 0, 1)): 80}
    post, rates = p.expectation_maximisation(counts)
    assert post[0, (1, 1, 1, 1, 1)] > 0.99 and post[0, (-1, -1, -1, 0, -1)] < 0.01
    assert rates[0, 1, 1, 1] > 0.9 > 0.1 > rates[0, 1, 1, 0]  # the second labeler is reliable
    weights = p.span_classifier({(*k, (1, 1, 0, 0)): n for k, n in counts.items()}, post)
    score = lambda v: sum(weights[i] for i in p.places((0, v, (1, 1, 0, 0))))
    assert score((1, 1, 1, 0, 1)) > 0 > score((-1, -1, -1, 0, -1))
    assert p.expectation_maximisation({}) == ({}, {})


def test_extra_spans_and_redaction(spark):
    texts = ["mail jo@site.com or call +1 212 555 0187"] * 40 + ["call 212-555-0187 now"] * 10
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labelled = p.label(df)
    got = p.find(labelled, p.fit(labelled)).select("doc_id", "text", "base", "spans", p.redact(F.col("text"), "spans").alias("r")).collect()
    assert {r["r"] for r in got if r["doc_id"] < 40} == {"mail <EMAIL> or call <PHONE>"}
    assert {r["r"] for r in got if r["doc_id"] >= 40} == {"call <PHONE> now"} and not any(r["base"] for r in got if r["doc_id"] >= 40)


@pytest.mark.parametrize("rows", [[], [(None, None)]])
def test_empty(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labelled = p.label(df)
    assert [r["spans"] for r in p.find(labelled, p.fit(labelled)).collect()] == [[]] * len(rows)


def test_added_spans_on_planted_data(spark):
    """Spans beside the base ones: obfuscated personal data is found, look-alikes are left alone."""
    r = random.Random(5)
    word = lambda: r.choice(["walk", "stone", "river", "green", "paper"])
    d = lambda n: "".join(r.choice("23456789") for _ in range(n))

    def card():
        x = "4" + d(14)
        return x + next(c for c in "0123456789" if luhn(x + c))

    rows, planted = [], {}
    for i in range(600):
        kind, c = i % 8, card()
        one, cue, real = [
            (f"{word()} [at] {word()}.com", "mail", True), (f"{word()}@{word()}.org", "write to", True), (f"({d(3)}) {d(3)}-{d(4)}", "call", True), (f"{c[:4]}.{c[4:8]}.{c[8:12]}.{c[12:]}", "card", True),
            (f"10[.]{r.randrange(9)}[.]{r.randrange(99)}[.]{r.randrange(1, 99)}", "host", True), (f"1{d(3)}.{d(4)}.{d(4)}.{d(4)}", "serial", False), (f"{r.randrange(300, 900)}[.]{d(2)}[.]1[.]2", "version", False), (f"{d(3)}.{d(3)}.{d(4)}x", "order", False),
        ][kind]
        if kind == 5 and luhn(re.sub("[^0-9]", "", one)):
            continue
        before = f"{word()} {word()} {cue} "
        rows.append((i, f"{before}{one} {word()}"))
        planted[i] = (len(before), len(before) + len(one), real)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labelled = p.label(df)
    got = {x["doc_id"]: [(s["start"], s["end"]) for s in x["spans"]] for x in p.find(labelled, p.fit(labelled)).collect()}
    true = [i for i, (_, _, real) in planted.items() if real]
    caught = sum((planted[i][0], planted[i][1]) in got[i] for i in true)
    wrong = sum(bool(got[i]) for i, (_, _, real) in planted.items() if not real)
    print(f"recall {caught / len(true):.3f}, precision {caught / (caught + wrong):.3f}")
    assert caught / len(true) >= 0.9 and caught / (caught + wrong) >= 0.9


def test_many_matches_in_one_text(spark):
    texts = ["1.2.3.4 " * 2_000]
    assert spans(spark, texts)[0]["b"] == base(texts[0])


def test_very_long_spans(spark):
    """Dots without number and runs of a million letters: in proportion to the text, without a stack that overflows."""
    import time

    dotted, letters = "a." * 500_000 + "a@b.com", "x" * 1_000_000 + " me@site.org"
    hosts, run = "q@" + "h-1." * 250_000 + "org", "b" * 1_000_000 + "@c.net"
    spans(spark, ["warm@up.com"])
    start = time.time()
    got = spans(spark, [dotted, letters, hosts, run])
    assert time.time() - start < 60
    assert [got[i]["b"] for i in range(4)] == [f"email:0:{len(dotted)}", f"email:1000001:{len(letters)}", f"email:0:{len(hosts)}", f"email:0:{len(run)}"]


def test_strict_form(spark):
    texts = ["a@b.com", "a.b@c-d.org", ".a@b.com", "a..b@c.com", "a@-b.com", "a@b-.com", "a@b--c.com", "a [at] b [dot] com", "a@b.c", "a@b.c1", "a_%+-@x.yz", "a@b.com.", "a@b..com", "a.@b.com"]
    want = [True, True, False, False, False, False, True, True, False, False, True, False, False, False]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("f", F.col("t").rlike(p.FORM["email"])).collect()
    assert [r["f"] for r in sorted(rows)] == want
