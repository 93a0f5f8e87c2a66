"""Alignment measures between batches (survey H30-H45, H49, H55, H56, H62, L1-L18)."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayloom.functions.blocks import Codes, LabelSums, Nearest, Products, block_pairs, distances, ranked_values
from assayloom.functions.stats import MAD_SCALE, avg_rank, benjamini_hochberg, center_and_mad, over, qnorm, with_scalars


def fixed_basis_policy(long: DataFrame, share: float = 0.001, least_rows: int = 200, least_features: int = 50) -> DataFrame:
    """The rows a fixed basis is fitted to: all, imputed, if at most `share` of the cells is missing; else complete samples
    if there are `least_rows`; else features without gaps if there are `least_features`."""
    grid = long.agg((F.countDistinct("sample") * F.countDistinct("feature")).alias("cells"), F.count("value").alias("known"), F.countDistinct("feature").alias("features"), F.countDistinct("sample").alias("samples")).head()
    if grid["known"] >= grid["cells"] * (1 - share):
        return long
    whole = long.groupBy("sample").agg(F.count("value").alias("n")).filter(F.col("n") == grid["features"]).select("sample")
    if whole.count() >= least_rows:
        return long.join(whole, "sample", "left_semi")
    kept = long.groupBy("feature").agg(F.count("value").alias("n")).filter(F.col("n") == grid["samples"]).select("feature")
    if (n := kept.count()) < least_features:
        raise ValueError(f"{n} features without gaps; {least_features} are needed")
    return long.join(kept, "feature", "left_semi")


def whitened_distance(pairs: DataFrame, reference: DataFrame) -> DataFrame:
    """person, distance: pairs (person, feature, x, y), every feature over the MAD of the reference (feature, value)."""
    return scaled_distance(pairs, mads(reference))


def mads(reference: DataFrame) -> DataFrame:
    """feature, mad of (feature, value), where it isn't 0."""
    return center_and_mad(reference, "value", "feature").filter("mad > 0").select("feature", "mad")


def scaled_distance(pairs: DataFrame, spread: DataFrame) -> DataFrame:
    """person, distance of pairs (person, feature, x, y) over a known spread (feature, mad)."""
    d = (F.col("x") - F.col("y")) / F.col("mad")
    return pairs.join(spread, "feature").groupBy("person").agg(F.sqrt(F.sum(d * d)).alias("distance"))


def noise_ratio(bridges: DataFrame, replicates: DataFrame) -> DataFrame:
    """bridge_median, noise_floor, ratio of two distance tables."""
    b, r = bridges.agg(F.median("distance").alias("bridge_median")), replicates.agg(F.median("distance").alias("noise_floor"))
    return with_scalars(b, r).withColumn("ratio", F.try_divide("bridge_median", "noise_floor"))


def normal_cdf(z: Column) -> Column:
    """The standard normal distribution function (fixed rational approximation, absolute error below 1.5e-7)."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    erf = 1 - reduce(lambda acc, c: acc * t + c, (-1.453152027, 1.421413741, -0.284496736, 0.254829592), F.lit(1.061405429)) * t * F.exp(-x * x)
    return F.when(z >= 0, (1 + erf) / 2).otherwise((1 - erf) / 2)


def normal_cdf_sql(z: str) -> str:
    """The same as DuckDB SQL; z is a column's name."""
    t, square = f"(1 / (1 + 0.3275911::DOUBLE * abs({z}) / sqrt(2)))", f"exp(-{z} * {z} / 2)"
    poly = reduce(lambda acc, c: f"({acc} * {t} + {c}::DOUBLE)", ("-1.453152027", "1.421413741", "-0.284496736", "0.254829592"), "1.061405429::DOUBLE")
    erf = f"(1 - {poly} * {t} * {square})"
    return f"CASE WHEN {z} >= 0 THEN (1 + {erf}) / 2 ELSE (1 - {erf}) / 2 END"


def neighbours(scores: DataFrame, columns: list[str], k: int) -> DataFrame:
    """s, t, d, rank: the k nearest samples of every sample by distance, ties by sample id. A block of samples goes through all
    others a chunk at a time and keeps its k nearest so far, so only those are stored; samples with a missing score have and
    are none."""
    kind = dict(scores.dtypes)["sample"]

    def nearest(a: pd.DataFrame, b: pd.DataFrame, before: Nearest | None) -> Nearest:
        own, names = a["sample"].to_numpy(), b["sample"].to_numpy()
        d = distances(a, b, columns)
        d[own[:, None] == names[None]] = np.inf
        found = Nearest(own, k) if before is None else before
        found.add(d, names)
        return found

    return block_pairs(scores.select("sample", *columns).dropna(), nearest, f"s {kind}, t {kind}, d double, rank int")


class Mixing:
    """What a block's samples need for their silhouettes and for the batches of their nearest samples."""

    def __init__(self, own: np.ndarray, k: int) -> None:
        self.own, self.codes, self.near, self.sums = own, Codes(), Nearest(own, k), LabelSums(len(own))

    def grids(self) -> tuple[np.ndarray, np.ndarray]:
        """Distances (infinite beyond those there are) and batches of the nearest samples, a row a sample."""
        row, d, _, mark, rank = self.near.settle()
        wide, marks = np.full((len(self.own), self.near.k), np.inf), np.full((len(self.own), self.near.k), -1)
        wide[row, rank], marks[row, rank] = d, mark
        return wide, marks


def inverse_simpson(d: np.ndarray, marks: np.ndarray, perplexity: float) -> np.ndarray:
    """Of each row of nearest distances (infinite: none), the inverse Simpson index of the marks (negative: none) under a
    Gaussian kernel of the given perplexity; NaN in rows without any."""
    n = np.isfinite(d).sum(1)
    out, rows = np.full(len(d), np.nan), np.flatnonzero(n)
    d, marks, n = d[rows] ** 2, marks[rows], n[rows]
    goal = np.log(np.minimum(perplexity, np.maximum(1.5, n / 3)))
    gap, there = np.where(np.isfinite(d), d - d.min(1, keepdims=True), 0.0), np.isfinite(d)
    low, high, beta = np.zeros(len(d)), np.full(len(d), np.inf), np.ones(len(d))
    weights, left = np.zeros_like(gap), np.arange(len(d))
    for _ in range(60):
        w = np.where(there[left], np.exp(-gap[left] * beta[left, None]), 0.0)
        w /= w.sum(1, keepdims=True)
        weights[left] = w
        over_goal = -(w * np.log(np.maximum(w, 1e-300))).sum(1) - goal[left]
        open_, up = np.abs(over_goal) >= 1e-5, over_goal > 0
        rise, fall, left = left[open_ & up], left[open_ & ~up], left[open_]
        low[rise] = beta[rise]
        high[fall] = beta[fall]
        beta[rise] = np.where(np.isinf(high[rise]), beta[rise] * 2, (beta[rise] + high[rise]) / 2)
        beta[fall] = (beta[fall] + low[fall]) / 2
        if not len(left):
            break
    squares = np.zeros(len(d))
    for code in range(int(marks.max(initial=-1)) + 1):
        squares += np.where(marks == code, weights, 0.0).sum(1) ** 2
    with np.errstate(divide="ignore"):
        out[rows] = 1 / squares
    return out


def mixing(scores: DataFrame, columns: list[str], batch: str, k: int = 25, alpha: float = 0.05, perplexity: float = 30.0) -> DataFrame:
    """One row silhouette, acceptance, median_lisi: the measures of `association.silhouette`, `kbet_acceptance` and `lisi`, all
    from one pass of blocks past all samples, whose distances are computed once. A block gives three numbers a sample."""
    kind = dict(scores.dtypes)["sample"]
    rows = scores.select("sample", F.col(batch).cast("string").alias("label"), *columns)
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}  # one row a batch
    every = sum(counts.values())
    shares = {b: n / every for b, n in counts.items() if b is not None}
    few, most = min(k, every // 10), int(3 * perplexity)
    limit = chi_squared_quantile(1 - alpha, len(shares) - 1)

    class Found(Mixing):
        def table(self) -> pd.DataFrame:
            d, marks = self.grids()
            out = pd.DataFrame({"s": self.own, "silhouette": self.sums.silhouettes(self.labels), "lisi": inverse_simpson(d[:, :most], marks[:, :most], perplexity)})
            near = marks[:, :few]
            size = (near >= 0).sum(1)
            chi = np.zeros(len(near))
            for b, share in shares.items():
                n = (near == self.codes.of.get(b, -2)).sum(1)
                with np.errstate(invalid="ignore", divide="ignore"):
                    chi += (n - size * share) ** 2 / (size * share)
            return out.assign(rejected=np.where(size > 0, (chi > limit).astype(float), np.nan))

    def work(a: pd.DataFrame, b: pd.DataFrame, before: Found | None) -> Found:
        found = before
        if found is None:
            found = Found(a["sample"].to_numpy(), max(few, most))
            found.labels = found.codes(a["label"])
            found.pairs = Products(found.own, a[columns].to_numpy(float), found.near, found.sums)
        found.pairs.add(b["sample"].to_numpy(), b[columns].to_numpy(float), found.codes(b["label"]))
        return found

    per = block_pairs(rows.dropna(subset=["sample", *columns]), work, f"s {kind}, silhouette double, lisi double, rejected double")
    known = lambda c: F.when(~F.isnan(c), F.col(c))
    return per.agg(F.avg(known("silhouette")).alias("silhouette"), (1 - F.avg(known("rejected"))).alias("acceptance"), F.median(known("lisi")).alias("median_lisi"))


def kbet_acceptance(scores: DataFrame, columns: list[str], batch: str, k: int = 25, alpha: float = 0.05) -> DataFrame:
    """acceptance over the k nearest samples, a tenth of them at most: 1 - share of samples whose neighbourhood's batch counts differ from the whole by a chi-squared test."""
    share = scores.groupBy(batch).agg(F.count("*").alias("n")).withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))
    near = neighbours(scores, columns, min(k, scores.count() // 10)).join(scores.select(F.col("sample").alias("t"), F.col(batch).alias("b")), "t")
    counts = near.groupBy("s").pivot("b", [r[0] for r in share.select(batch).orderBy(batch).collect()]).count().fillna(0)
    shares = {str(r[batch]): r["share"] for r in share.collect()}
    size = sum((F.col(f"`{b}`") for b in shares), F.lit(0))
    chi = sum(((F.col(f"`{b}`") - size * p) * (F.col(f"`{b}`") - size * p) / (size * p) for b, p in shares.items()), F.lit(0.0))
    limit = chi_squared_quantile(1 - alpha, len(shares) - 1)
    return counts.agg((1 - F.avg((chi > limit).cast("int"))).alias("acceptance"))


def chi_squared_quantile(p: float, df: int) -> float:
    """By bisection on the regularised incomplete gamma series."""
    if df < 1:
        return math.inf

    def cdf(x: float) -> float:
        a, half = df / 2, x / 2
        term = total = 1 / a
        n = 0
        while term > total * 1e-15 and n < 10_000:
            n += 1
            term *= half / (a + n)
            total += term
        return total * math.exp(-half + a * math.log(half) - math.lgamma(a)) if half > 0 else 0.0

    low, high = 0.0, 10.0 * df + 100
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if cdf(middle) < p else (low, middle)
    return high


def lisi(scores: DataFrame, columns: list[str], batch: str, perplexity: float = 30.0) -> DataFrame:
    """median_lisi: the median over samples of the inverse Simpson index of their neighbours' batches under a Gaussian
    kernel of the given perplexity over three times as many neighbours."""
    return mixing(scores, columns, batch, perplexity=perplexity).select("median_lisi")


def batch_auc(vectors: DataFrame, label: str, least: int = 100) -> DataFrame:
    """auc of an unpenalised logistic model of the batch on score vectors; null under `least` rows."""
    from pyspark.ml.classification import LogisticRegression

    from assayloom.operators.association import rank_sum
    from assayloom.operators.prediction import probability

    if vectors.limit(least).count() < least:
        return vectors.sparkSession.createDataFrame([(None,)], "auc double")
    fitted = LogisticRegression(labelCol=label, regParam=0.0).fit(vectors).transform(vectors)
    scored = fitted.select(probability("probability").alias("p"), (F.col(label) == 1).alias("y"))
    return rank_sum(scored, "p", "y").select("auc")


def variance_decomposition(long: DataFrame, first: str, second: str) -> DataFrame:
    """feature, share of the total sum of squares of `first`, then of `second` given the first (type I), and the rest.

    Both factors have two levels, so cell sums hold all that the two nested fits need.
    """
    y, a, b = F.col("value"), F.col(first).cast("double"), F.col(second).cast("double")
    whole = long.filter(y.isNotNull() & a.isNotNull() & b.isNotNull())
    m = whole.groupBy("feature").agg(F.count("*").alias("n"), F.var_pop(y).alias("vy"), F.var_pop(a).alias("va"), F.var_pop(b).alias("vb"), F.covar_pop(y, a).alias("ya"), F.covar_pop(y, b).alias("yb"), F.covar_pop(a, b).alias("ab"))
    ss1 = F.try_divide(F.col("ya") * F.col("ya"), F.col("va") * F.col("vy"))
    left = F.col("yb") - F.try_divide(F.col("ya") * F.col("ab"), F.col("va"))
    spread = F.col("vb") - F.try_divide(F.col("ab") * F.col("ab"), F.col("va"))
    ss2 = F.try_divide(left * left, spread * F.col("vy"))
    return m.select("feature", "n", ss1.alias("first_share"), ss2.alias("second_share"), (1 - F.coalesce(ss1, F.lit(0.0)) - F.coalesce(ss2, F.lit(0.0))).alias("residual_share"))


#: The measures of the KPI table in order, with their targets (fixed values).
TARGETS = (
    ("euclidean", "decrease"), ("mahalanobis", "decrease"), ("whitened", "decrease"), ("log_ratio", "negative"), ("log_ratio_low", "negative"), ("log_ratio_high", "<0"), ("excludes_zero", "1 (TRUE)"),
    ("noise_floor", "reference"), ("noise_ratio", "~1.0"), ("icc", ">0.9"), ("ccc", ">0.9"), ("rank1", ">0.9"), ("median_rank", "1"), ("silhouette", "decrease toward 0"), ("kbet", ">0.8"), ("lisi", "close to 2.0"),
    ("batch_auc", "toward 0.5"), ("label_accuracy", "stable"), ("batch_variance", "decrease"), ("label_variance", "stable (not drop >20%)"), ("flagged_bridges", "0 ideal"), ("poor_features", "0 ideal"), ("p", "<0.05"),
)
#: Measure -> side, bound for PASS, bound for WARN (none: FAIL beyond the first).
BANDS = {"noise_ratio": ("<", 2.0, 3.0), "icc": (">", 0.9, 0.7), "ccc": (">", 0.9, 0.7), "rank1": (">", 0.9, 0.7), "kbet": (">", 0.8, 0.5), "lisi": (">", 1.8, 1.5), "p": ("<", 0.05, None)}


def verdict(name: str, pre: Column, post: Column) -> Column:
    """PASS, WARN or FAIL of a measure; null where it has no rule, or where a comparison lacks a side."""
    if dict(TARGETS).get(name) == "decrease" and name != "batch_variance":
        return F.when(post < pre, "PASS").when(post >= pre, "FAIL")
    if name == "excludes_zero":
        return F.when(post == 1, "PASS").when(post.isNotNull(), "FAIL")
    if name not in BANDS:
        return F.lit(None).cast("string")
    side, good, fair = BANDS[name]
    within = lambda bound: F.coalesce(post < bound if side == "<" else post > bound, F.lit(False))
    out = F.when(within(good), "PASS")
    return (out if fair is None else out.when(within(fair), "WARN")).otherwise("FAIL")


def kpi_table(before: dict[str, float | None], after: dict[str, float | None], spark) -> DataFrame:  # noqa: ANN001
    """metric, pre, post, target, pass of all TARGETS in order, then of other names; scalars of other operators."""
    goals = dict(TARGETS)
    names = dict.fromkeys([*goals, *before, *after])
    as_double = lambda x: None if x is None else float(x)
    rows = spark.createDataFrame([(i, n, as_double(before.get(n)), as_double(after.get(n)), goals.get(n)) for i, n in enumerate(names)], "at int, metric string, pre double, post double, target string")
    judged = reduce(lambda acc, n: acc.when(F.col("metric") == n, verdict(n, F.col("pre"), F.col("post"))), names, F.when(F.lit(False), F.lit(None).cast("string")))
    return rows.withColumn("pass", judged).orderBy("at").drop("at")


def shapiro_w(rows: DataFrame, value: str, *by: str) -> DataFrame:
    """by, n, w, p: Royston's approximation of the Shapiro-Wilk test for 3 to 5000 values a group, else null, also for a
    constant group.

    Larger groups are counted and never sorted; the others, 5000 rows at most, are ranked, and a value's weight follows
    from its rank and the group's count (fixed coefficients of the published approximation).
    """
    known = rows.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_x"))
    sizes = rows.groupBy(*by).agg(F.count(value).alias("n"))
    facts = known.groupBy(*by).agg(F.count("*").alias("_n"), F.avg("_x").alias("_mean"), F.min("_x").alias("_min"), F.max("_x").alias("_max")).filter("_n BETWEEN 3 AND 5000 AND _max > _min")
    a, b = known.alias("a"), facts.alias("b")
    placed = a.join(b, reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by], F.lit(True))).select(*[F.col(f"a.{c}").alias(c) for c in by], "_x", "_n", "_mean")
    i, n = F.row_number().over(over(*by).orderBy("_x")), F.col("_n")
    scored = placed.withColumn("_i", i).withColumn("_m", qnorm((F.col("_i") - 0.375) / (n + 0.25)))
    every = over(*by)
    scored = scored.withColumns({"_mm": F.sum(F.col("_m") * F.col("_m")).over(every), "_m1": F.max("_m").over(every), "_m2": F.max(F.when(F.col("_i") == n - 1, F.col("_m"))).over(every)})
    u, norm = 1 / F.sqrt(n), F.sqrt("_mm")
    poly = lambda cs, last: reduce(lambda acc, c: acc * u + c, cs[1:], F.lit(cs[0])) * u + last
    top = F.when(n == 3, math.sqrt(0.5)).otherwise(poly((-2.706056, 4.434685, -2.071190, -0.147981, 0.221157), F.col("_m1") / norm))
    second = F.when(n > 5, poly((-3.582633, 5.682633, -1.752461, -0.293762, 0.042981), F.col("_m2") / norm))
    scored = scored.withColumns({"_top": top, "_second": second})
    square = lambda c: F.col(c) * F.col(c)
    few, many = (F.col("_mm") - 2 * square("_m1")) / (1 - 2 * square("_top")), (F.col("_mm") - 2 * square("_m1") - 2 * square("_m2")) / (1 - 2 * square("_top") - 2 * square("_second"))
    edge = F.least(F.col("_i"), n + 1 - F.col("_i"))
    inner = F.when(n == 3, 0.0).otherwise(F.col("_m") / F.sqrt(F.when(n > 5, many).otherwise(few)))
    weight = F.when(edge == 1, F.signum("_m") * F.col("_top")).when((edge == 2) & (n > 5), F.signum("_m") * F.col("_second")).otherwise(inner)
    sums = scored.withColumn("_a", weight).groupBy(*by).agg(F.sum(F.col("_a") * F.col("_x")).alias("_s"), F.sum((F.col("_x") - F.col("_mean")) * (F.col("_x") - F.col("_mean"))).alias("_ss"), F.first("_n").alias("_n"))
    w = sums.select(*by, "_n", F.least(F.col("_s") * F.col("_s") / F.col("_ss"), F.lit(1.0)).alias("w"))
    joined = sizes.alias("a").join(w.alias("b"), reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by], F.lit(True)), "left").select(*[F.col(f"a.{c}").alias(c) for c in by], "n", "w")
    return joined.withColumn("p", shapiro_p(F.col("w"), F.col("n")))


def shapiro_p(w: Column, n: Column) -> Column:
    """The p-value of W among n values (fixed coefficients of the published approximation)."""
    x, ln = F.log(1 - w), F.log(n.cast("double"))
    poly = lambda v, *cs: reduce(lambda acc, c: acc * v + c, cs[1:], F.lit(cs[0]))
    g = 0.459 * n - 2.273
    small = (-F.log(g - x) - poly(n, -0.0006714, 0.025054, -0.39978, 0.5440)) / F.exp(poly(n, -0.0020322, 0.062767, -0.77857, 1.3822))
    large = (x - poly(ln, 0.0038915, -0.083751, -0.31082, -1.5861)) / F.exp(poly(ln, 0.0030302, -0.082676, -0.4803))
    three = F.greatest(6 / math.pi * (F.asin(F.sqrt(w)) - math.asin(math.sqrt(0.75))), F.lit(0.0))
    return F.when(w.isNull(), None).when(n == 3, three).when((n <= 11) & (x >= g), 1e-99).otherwise(1 - normal_cdf(F.when(n <= 11, small).otherwise(large)))


def genetic_distance(scores: DataFrame, columns: list[str]) -> DataFrame:
    """sample, distance to the centre of medians; missing scores as the median."""
    mid = scores.agg(*[F.median(c).alias(f"_{c}") for c in columns])
    gaps = [F.coalesce(F.col(c), F.col(f"_{c}")) - F.col(f"_{c}") for c in columns]
    return with_scalars(scores, mid).select("sample", F.sqrt(reduce(lambda a, b: a + b, [g * g for g in gaps])).alias("distance"))


def genetic_pair_distance(scores: DataFrame, columns: list[str], pairs: DataFrame) -> DataFrame:
    """a, b, distance of the asked pairs (a, b) of samples; missing scores as the median. Only pairs that a caller suspects
    are measured, so nothing grows with the square of the samples; pairs of unknown samples are left out."""
    mid = scores.agg(*[F.median(c).alias(f"_{c}") for c in columns])
    filled = with_scalars(scores, mid).select("sample", F.array(*[F.coalesce(F.col(c), F.col(f"_{c}")) for c in columns]).alias("_p"))
    side = lambda name: filled.select(F.col("sample").alias(name), F.col("_p").alias(f"_{name}"))
    gap = F.aggregate(F.zip_with("_a", "_b", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    return pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", F.sqrt(gap).alias("distance"))


def far_candidates(distances: DataFrame, percentile: float = 0.9, least: int = 3, floor: float = 0.5) -> DataFrame:
    """Rows at or over a percentile of the distance, which comes down by a tenth, not under `floor`, while too few are."""
    steps = [percentile - 0.1 * i for i in range(10) if percentile - 0.1 * i >= floor - 1e-9]
    cuts = distances.agg(F.percentile("distance", F.array(*map(F.lit, steps))).alias("q"))
    counted = with_scalars(distances, cuts).agg(*[F.count_if(F.col("distance") >= F.get("q", F.lit(i))).alias(f"n{i}") for i in range(len(steps))], F.first("q").alias("q"))
    cut = F.get("q", F.lit(len(steps) - 1))
    for i in reversed(range(len(steps))):
        cut = F.when(F.col(f"n{i}") >= least, F.get("q", F.lit(i))).otherwise(cut)
    return with_scalars(distances, counted.select(cut.alias("_c"))).filter(F.col("distance") >= F.col("_c")).drop("_c")


def error_shift(rows: DataFrame, value: str, category: str) -> DataFrame:
    """category, n, z, p of a rank-sum test of each category's values against those of category 0."""
    rows = rows.filter(F.col(value).isNotNull())
    cats = [r[0] for r in rows.select(category).distinct().filter(F.col(category) != 0).orderBy(category).collect()]  # three by design
    sets = rows.withColumn("against", F.explode(F.when(F.col(category) == 0, F.array(*map(F.lit, cats))).otherwise(F.array(category))))
    ranked = sets.withColumn("r", avg_rank(value, "against"))
    s = ranked.groupBy("against").agg(F.count_if(F.col(category) != 0).alias("n"), F.count_if(F.col(category) == 0).alias("m"), F.sum(F.when(F.col(category) != 0, F.col("r"))).alias("s"))
    u, pairs = F.col("s") - F.col("n") * (F.col("n") + 1) / 2, F.col("n") * F.col("m")
    z = F.try_divide(u - pairs / 2, F.sqrt(pairs * (F.col("n") + F.col("m") + 1) / 12))
    return s.select(F.col("against").alias("category"), "n", z.alias("z")).withColumn("p", 2 * (1 - normal_cdf(F.abs("z"))))


def age_association(fits: DataFrame, alpha: float = 0.05) -> DataFrame:
    """`fits` (feature, group_id, p, r2, ...) with Bonferroni over non-null p, BH, significance, and the group's selected one."""
    from assayloom.operators.genetics import best_per_group

    n = F.count("p").over(Window.partitionBy())
    out = best_per_group(fits)
    return out.withColumns({"p_bonferroni": F.least(F.col("p") * n, F.lit(1.0)), "p_bh": benjamini_hochberg("p")}).withColumn("significant", F.col("p_bonferroni") < alpha)


def spearman(long: DataFrame) -> DataFrame:
    """f1 < f2, n, rho, p: Pearson correlations of average ranks, with their p-values by the t distribution."""
    from assayloom.operators.genetics import correlations

    ranked = long.filter("value IS NOT NULL").select("sample", "feature", avg_rank("value", "feature").alias("value"))
    return correlations(ranked).withColumnRenamed("r", "rho")


def qq_points(rows: DataFrame, value: str, *by: str) -> DataFrame:
    """by, i, theoretical, observed: normal quantiles at (i - 1/2) / n (3/8 and 1/4 shifted up to ten values)."""
    known = rows.filter(F.col(value).isNotNull())
    i = F.row_number().over(Window.partitionBy(*by).orderBy(value))
    n = F.count("*").over(over(*by))
    p = F.when(n > 10, (i - 0.5) / n).otherwise((i - 0.375) / (n + 0.25))
    return known.select(*by, i.alias("i"), qnorm(p).alias("theoretical"), F.col(value).alias("observed"))


def paired_shift(pairs: DataFrame) -> DataFrame:
    """n, mean_abs, median_abs, sd_abs, t of per-feature mean differences between x and y, and v, p of their signed ranks."""
    from assayloom.operators.robust import signed_rank

    means = pairs.groupBy("feature").agg(F.avg("x").alias("x"), F.avg("y").alias("y"))
    ranks = signed_rank(means, "y", "x", "two-sided").select("v", "p")
    per = means.select((F.col("x") - F.col("y")).alias("d"))
    return with_scalars(per.agg(F.count("d").alias("n"), F.avg(F.abs("d")).alias("mean_abs"), F.median(F.abs("d")).alias("median_abs"), F.stddev_samp(F.abs("d")).alias("sd_abs"), F.try_divide(F.avg("d") * F.sqrt(F.count("d")), F.stddev_samp("d")).alias("t")), ranks)


def kruskal(rows: DataFrame, value: str, group: str) -> DataFrame:
    """h, df: the rank test over groups, ties averaged (without a correction for them)."""
    cells = rows.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("value"), F.col(group).alias("group")).agg(F.count("*").alias("k"))
    known = rows.select(F.col(value).alias("value"))
    ranked = cells.join(ranked_values(known, "value").select("value", "rank"), "value")
    g = ranked.groupBy("group").agg(F.sum(F.col("rank") * F.col("k")).alias("s"), F.sum("k").alias("n"))
    total = F.sum("n")
    return g.agg((12 / (total * (total + 1)) * F.sum(F.col("s") * F.col("s") / F.col("n")) - 3 * (total + 1)).alias("h"), (F.count("*") - 1).alias("df"))


def scaled_mad(values: list[float]) -> float:
    """MAD of a few numbers on the driver, as the reports need it."""
    m = float(np.median(values))
    return MAD_SCALE * float(np.median(np.abs(np.asarray(values) - m)))
