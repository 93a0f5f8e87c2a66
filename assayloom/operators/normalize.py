"""Normalisation within and across batches (survey H10-H13, H19-H27, H47, D12). Long form: sample, feature, value."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayloom.functions.stats import avg_rank, over, with_scalars


def median_scale(long: DataFrame, low: float = 0.1, high: float = 10.0, by: str | None = None) -> DataFrame:
    """value times factor: median of the feature medians over the feature's median, 1 where undefined, clamped."""
    keys = [by] if by else []
    medians = long.groupBy(*keys, "feature").agg(F.median("value").alias("_med"))
    if by:
        factors = medians.withColumn("_all", F.median("_med").over(over(by)))
    else:
        factors = with_scalars(medians, medians.agg(F.median("_med").alias("_all")))
    factor = F.coalesce(F.try_divide("_all", "_med"), F.lit(1.0))
    factors = factors.select(*keys, "feature", F.least(F.greatest(factor, F.lit(low)), F.lit(high)).alias("factor"))
    return long.join(factors, [*keys, "feature"]).withColumn("value", F.col("value") * F.col("factor"))


def bridge_factors(reference: DataFrame, target: DataFrame, least: int = 10) -> DataFrame:
    """feature, factor: median of (reference - target) over people in both batches; 0 where there is none.

    Both sides have person, feature, value. Raises if fewer than `least` people are in both.
    """
    shared = reference.select("person").distinct().intersect(target.select("person").distinct())
    if (n := shared.count()) < least:
        raise ValueError(f"{n} people in both batches; {least} are needed")
    pairs = reference.select("person", "feature", F.col("value").alias("_r")).join(target.select("person", "feature", F.col("value").alias("_t")), ["person", "feature"])
    return pairs.groupBy("feature").agg(F.coalesce(F.median(F.col("_r") - F.col("_t")), F.lit(0.0)).alias("factor"))


def bridge_additive(target: DataFrame, factors: DataFrame) -> DataFrame:
    """The target batch moved onto the reference: value + factor."""
    return target.join(factors, "feature", "left").withColumn("value", F.col("value") + F.coalesce("factor", F.lit(0.0))).drop("factor")


def bridge_combined(both: DataFrame, bridges: DataFrame, clamp: float = 3.0) -> DataFrame:
    """both: batch, person, feature, value. Each batch loses its bridge median's distance to the mean of the batches' bridge
    medians, clamped to +-clamp."""
    medians = both.join(bridges.select("person"), "person", "left_semi").groupBy("batch", "feature").agg(F.median("value").alias("_med"))
    offset = F.col("_med") - F.avg("_med").over(over("feature"))
    offsets = medians.select("batch", "feature", F.least(F.greatest(offset, F.lit(-clamp)), F.lit(clamp)).alias("_off"))
    return both.join(offsets, ["batch", "feature"], "left").withColumn("value", F.col("value") - F.coalesce("_off", F.lit(0.0))).drop("_off")


def batch_median_shift(both: DataFrame, reference: object, clamp: float = 3.0) -> DataFrame:
    """Each batch loses its feature medians' distance to those of the reference batch, clamped."""
    medians = both.groupBy("batch", "feature").agg(F.median("value").alias("_med"))
    ref = medians.filter(F.col("batch") == reference).select("feature", F.col("_med").alias("_ref"))
    offset = F.least(F.greatest(F.col("_med") - F.col("_ref"), F.lit(-clamp)), F.lit(clamp))
    offsets = medians.join(ref, "feature").select("batch", "feature", offset.alias("_off"))
    return both.join(offsets, ["batch", "feature"], "left").withColumn("value", F.col("value") - F.coalesce("_off", F.lit(0.0))).drop("_off")


def bridge_quality(long: DataFrame, bridges: DataFrame, max_missing: float = 0.2) -> DataFrame:
    """sample, missing_rate, mean, sd, high_quality of the bridge samples in the matrix; absent cells count as missing."""
    features = long.agg(F.countDistinct("feature").alias("_all"))
    own = long.join(bridges.select("sample").distinct(), "sample", "left_semi")
    facts = own.groupBy("sample").agg(F.count("value").alias("_n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"))
    rate = 1 - F.col("_n") / F.col("_all")
    return with_scalars(facts, features).select("sample", rate.alias("missing_rate"), "mean", "sd", (rate < max_missing).alias("high_quality"))


def bridge_scale(long: DataFrame, bridges: DataFrame, method: str = "median", max_missing: float = 0.2, low: float = 0.1, high: float = 10.0, least: int = 10) -> DataFrame:
    """value times factor: the median (or mean) over features of the bridges' feature medians (means) over the feature's
    own, 1 where undefined, clamped. Raises under `least` bridge samples of enough quality."""
    good = bridge_quality(long, bridges, max_missing).filter("high_quality").select("sample")
    if (n := good.count()) < least:
        raise ValueError(f"{n} bridge samples of enough quality; {least} are needed")
    center = {"median": F.median, "mean": F.avg}[method]
    own = long.join(good, "sample", "left_semi").groupBy("feature").agg(center("value").alias("_own"))
    factor = F.coalesce(F.try_divide("_all", "_own"), F.lit(1.0))
    factors = with_scalars(own, own.agg(center("_own").alias("_all"))).select("feature", F.least(F.greatest(factor, F.lit(low)), F.lit(high)).alias("factor"))
    return long.join(factors, "feature", "left").withColumn("factor", F.coalesce("factor", F.lit(1.0))).withColumn("value", F.col("value") * F.col("factor"))


def quantile_normalize(long: DataFrame, points: int = 101, log2: bool = False) -> DataFrame:
    """Each value becomes the features' mean quantile at its rank / (n + 1), by linear interpolation on `points` points."""
    grid = [i / (points - 1) for i in range(points)]
    q = long.groupBy("feature").agg(F.percentile("value", F.array(*map(F.lit, grid))).alias("_q"))
    mean = q.select(F.posexplode("_q").alias("_i", "_v")).groupBy("_i").agg(F.avg("_v").alias("_v"))
    reference = mean.agg(F.transform(F.sort_array(F.collect_list(F.struct("_i", "_v"))), lambda x: x["_v"]).alias("_ref"))  # `points` numbers
    placed = long.withColumn("_p", avg_rank("value", "feature") / (F.count("value").over(over("feature")) + 1) * (points - 1))
    out = with_scalars(placed, reference)
    i = F.floor("_p").cast("int")
    low, high = F.get("_ref", i), F.get("_ref", F.least(i + 1, F.lit(points - 1)))
    value = low + (high - low) * (F.col("_p") - i)
    return out.withColumn("value", F.log2(value + 1) if log2 else value).drop("_p", "_ref")


def batch_residualise(long: DataFrame, batch: str = "batch", least: int = 50) -> DataFrame:
    """value - mean of its batch + mean of all, per feature with `least` values and two batches or more; r2 beside it."""
    w, b = over("feature"), over("feature", batch)
    n, batches = F.count("value").over(w), F.size(F.collect_set(batch).over(w))
    mean, own = F.avg("value").over(w), F.avg("value").over(b)
    total = F.sum((F.col("value") - F.col("_m")) * (F.col("value") - F.col("_m"))).over(w)
    between = F.sum((F.col("_o") - F.col("_m")) * (F.col("_o") - F.col("_m"))).over(w)
    out = long.withColumns({"_n": n, "_k": batches, "_m": mean, "_o": own})
    fits = (F.col("_n") >= least) & (F.col("_k") >= 2)
    return out.withColumn("r2", F.when(fits, F.try_divide(between, total))).withColumn("value", F.when(fits, F.col("value") - F.col("_o") + F.col("_m")).otherwise(F.col("value"))).drop("_n", "_k", "_m", "_o")


def covariate_residualise(long: DataFrame, covariate: str, least: int = 50) -> DataFrame:
    """Per feature: residual of value on one covariate plus the mean, on complete rows; other rows keep their value."""
    whole = F.col("value").isNotNull() & F.col(covariate).isNotNull()
    x, y = F.when(whole, F.col(covariate)), F.when(whole, F.col("value"))
    fit = long.groupBy("feature").agg(F.regr_slope(y, x).alias("_b"), F.avg(x).alias("_x"), F.count(y).alias("_n"))
    adjusted = F.col("value") - F.col("_b") * (F.col(covariate) - F.col("_x"))
    return long.join(fit, "feature").withColumn("value", F.when(whole & (F.col("_n") >= least) & F.col("_b").isNotNull(), adjusted).otherwise(F.col("value"))).drop("_b", "_x", "_n")


def covariates_residualise(long: DataFrame, covariates: list[str], least: int = 50, train: str | None = None) -> DataFrame:
    """The same for several covariates: X'X and X'y are Spark sums, a small system is solved per feature, and the
    coefficients join back. With `train`, a boolean column, the fit uses its rows alone and applies to all."""
    xs = [F.lit(1.0), *[F.col(c).cast("double") for c in covariates]]
    k = len(xs)
    whole = F.col("value").isNotNull()
    for c in covariates:
        whole = whole & F.col(c).isNotNull()
    used = whole & F.col(train) if train else whole
    sums = [F.sum(xs[i] * xs[j]).alias(f"x{i}_{j}") for i in range(k) for j in range(i, k)] + [F.sum(xs[i] * F.col("value")).alias(f"y{i}") for i in range(k)]
    moments = long.filter(used).groupBy("feature").agg(F.count("*").alias("n"), *sums)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            a = np.empty((len(b), k, k))
            for i in range(k):
                for j in range(i, k):
                    a[:, i, j] = a[:, j, i] = b[f"x{i}_{j}"]
            y = np.stack([b[f"y{i}"] for i in range(k)], -1)
            beta = np.einsum("nij,nj->ni", np.linalg.pinv(a, hermitian=True), y)
            yield pd.DataFrame({"feature": b["feature"], "_n": b["n"], "_beta": list(beta), "_mean": list(a[:, 0] / a[:, 0, :1])})

    kind = dict(long.dtypes)["feature"]
    fits = moments.mapInPandas(solve, f"feature {kind}, _n long, _beta array<double>, _mean array<double>")
    shift = sum((F.get("_beta", F.lit(i)) * (xs[i] - F.get("_mean", F.lit(i))) for i in range(1, k)), F.lit(0.0))
    return long.join(fits, "feature", "left").withColumn("value", F.when(whole & (F.col("_n") >= least), F.col("value") - shift).otherwise(F.col("value"))).drop("_n", "_beta", "_mean")


def combat(long: DataFrame, rounds: int = 100, tolerance: float = 1e-6, log2: bool = False) -> DataFrame:
    """Empirical-Bayes location and scale (batch, sample, feature, value): fill missing values with the feature's mean,
    standardise by the grand mean and pooled sd, shrink each batch's location and scale towards their common priors,
    transform back; `log2` gives log2(value + 1), null where that has no value.

    Means and variances are Spark aggregates; what a batch iterates over is one row a feature.
    """
    means = long.groupBy("feature").agg(F.avg("value").alias("_mean"))
    long = long.join(means, "feature").withColumn("value", F.coalesce("value", "_mean")).drop("_mean")
    cells = long.groupBy("batch", "feature").agg(F.count("value").alias("n"), F.avg("value").alias("m"), F.sum(F.col("value") * F.col("value")).alias("q"))
    w = over("feature")
    n = F.sum("n").over(w)
    grand = F.sum(F.col("m") * F.col("n")).over(w) / n
    pooled = F.sqrt(F.sum(F.col("q") - F.col("n") * F.col("m") * F.col("m")).over(w) / n)
    cells = cells.withColumns({"grand": grand, "pooled": pooled}).filter("pooled > 0")
    gamma = (F.col("m") - F.col("grand")) / F.col("pooled")
    delta = (F.col("q") - F.col("n") * F.col("m") * F.col("m")) / (F.col("n") - 1) / (F.col("pooled") * F.col("pooled"))
    kind, batch_kind = dict(long.dtypes)["feature"], dict(long.dtypes)["batch"]

    def shrink(b: pd.DataFrame) -> pd.DataFrame:
        g, d, size = (b[c].to_numpy(float) for c in ("gamma", "delta", "n"))
        mean, tau = g.mean(), g.var(ddof=1)
        m, s = d.mean(), d.var(ddof=1)
        a, scale = (2 * s + m * m) / s, (m * s + m**3) / s
        gs, ds = g.copy(), d.copy()
        for _ in range(rounds):
            new_g = (tau * size * g + ds * mean) / (tau * size + ds)
            new_d = (scale + 0.5 * ((size - 1) * d + size * (g - new_g) ** 2)) / (size / 2 + a - 1)
            moved = max(np.abs(new_g - gs).max(), np.abs(new_d - ds).max())
            gs, ds = new_g, new_d
            if moved < tolerance:
                break
        return pd.DataFrame({"batch": b["batch"], "feature": b["feature"], "_g": gs, "_d": ds, "_grand": b["grand"], "_pooled": b["pooled"]})

    priors = cells.select("batch", "feature", "n", gamma.alias("gamma"), delta.alias("delta"), "grand", "pooled")
    fits = priors.groupBy("batch").applyInPandas(shrink, f"batch {batch_kind}, feature {kind}, _g double, _d double, _grand double, _pooled double")
    z = (F.col("value") - F.col("_grand")) / F.col("_pooled")
    value = (z - F.col("_g")) / F.sqrt("_d") * F.col("_pooled") + F.col("_grand")
    value = F.coalesce(value, F.col("value"))
    return long.join(fits, ["batch", "feature"], "left").withColumn("value", F.when(value > -1, F.log2(value + 1)) if log2 else value).drop("_g", "_d", "_grand", "_pooled")


def spread_reduction(before: DataFrame, after: DataFrame) -> DataFrame:
    """metric, before, after, pct_reduction: means over features of SD, MAD and IQR."""
    def of(df: DataFrame, name: str) -> DataFrame:
        each = df.withColumn("_d", F.abs(F.col("value") - F.median("value").over(over("feature"))))
        per = each.groupBy("feature").agg(F.stddev_samp("value").alias("sd"), F.median("_d").alias("mad"), (F.percentile("value", F.lit(0.75)) - F.percentile("value", F.lit(0.25))).alias("iqr"))
        return per.agg(F.avg("sd").alias("sd"), F.avg("mad").alias("mad"), F.avg("iqr").alias("iqr")).unpivot([], ["sd", "mad", "iqr"], "metric", name)

    out = of(before, "before").join(of(after, "after"), "metric")
    return out.withColumn("pct_reduction", F.try_divide((F.col("before") - F.col("after")) * 100, "before"))


def median_gap(both: DataFrame) -> DataFrame:
    """gap: the mean over features of the distance between two batches' medians (batch, feature, value)."""
    medians = both.groupBy("feature", "batch").agg(F.median("value").alias("m"))
    per = medians.groupBy("feature").agg((F.max("m") - F.min("m")).alias("gap"), F.count("m").alias("n")).filter("n >= 2")
    return per.agg(F.avg("gap").alias("gap"))


def method_choice(before: DataFrame, after: dict[str, DataFrame], order: tuple[str, ...] = ("bridge", "median", "combat")) -> DataFrame:
    """method, gap_before, gap_after, pct_reduction, chosen: how much each method closes the gap between two batches' medians;
    the largest reduction is chosen, of equal ones the first in `order`."""
    spark, first = before.sparkSession, median_gap(before).head()["gap"]
    rows = [(m, first, median_gap(df).head()["gap"]) for m, df in after.items()]
    cut = {m: 100 * (a - b) / a if a and b is not None else 0.0 for m, a, b in rows}
    best = fallback(cut, order)
    return spark.createDataFrame([(m, a, b, cut[m], m == best) for m, a, b in rows], "method string, gap_before double, gap_after double, pct_reduction double, chosen boolean")


def fallback(results: dict[str, float], order: tuple[str, ...] = ("bridge", "combat", "median")) -> str:
    """The method with the largest reduction; ties and absences go by `order`."""
    return max((m for m in order if m in results), key=lambda m: (results[m], -order.index(m)))
