"""Measures that stand up to outliers and small samples: minimum covariance determinant, bootstrapped medians, exact
signed ranks (survey H32, H35, H36, L8)."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayloom.functions.blocks import ranked_values, running

#: The starts of the concentration are looked for among so many rows; all later steps take every row.
START_ROWS, STARTS, KEPT = 2000, 200, 5
#: Where a determinant is this much smaller than the product of its variances, the fit counts as singular.
SINGULAR = 1e-12


@dataclass
class Spread:
    """center and cov of points; how many of them it stands on; whether it is the classical one."""

    center: np.ndarray
    cov: np.ndarray
    n: int
    classical: bool


def points(scores: DataFrame) -> DataFrame:
    """sample, v: the scores of a sample in the order of pc; samples that lack one go."""
    rows = scores.groupBy("sample").agg(F.sort_array(F.collect_list(F.when(F.col("score").isNotNull(), F.struct("pc", "score")))).alias("v"))
    width = scores.select("pc").distinct().count()
    return rows.filter(F.size("v") == width).select("sample", F.transform("v", lambda x: x["score"]).alias("v"))


def as_matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy().reshape(n, -1) if n else np.zeros((0, 0))


def squared(x: np.ndarray, center: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    d = x - center
    return np.einsum("ij,ij->i", d @ inverse, d)


def quantiles_of_distance(rows: DataFrame, fits: list[Spread], share: float) -> list[float]:
    """For each fit, the squared distance that `share` of the points don't exceed (to one rank in 100,000)."""
    models = [(f.center, np.linalg.pinv(f.cov)) for f in fits]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = as_matrix(b.column(0))
                yield pa.RecordBatch.from_arrays([pa.array(squared(x, *m)) for m in models], names=[f"d{i}" for i in range(len(models))])

    d = rows.select("v").mapInArrow(measure, ", ".join(f"d{i} double" for i in range(len(models))))
    return list(d.agg(*[F.percentile_approx(f"d{i}", share, 100_000) for i in range(len(models))]).head())


def spreads(rows: DataFrame, width: int, fits: list[Spread] | None = None, cuts: list[float] | None = None) -> list[Spread]:
    """The covariance of the points within each fit's cut, all fits in one pass; without fits, of all points. A task sends
    the sums of its points."""
    models = [(f.center, np.linalg.pinv(f.cov), c) for f, c in zip(fits or [], cuts or [], strict=True)] or [None]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(models), 1 + width + width * width))
        for b in batches:
            if not b.num_rows:
                continue
            x = as_matrix(b.column(0))
            for t, m in zip(total, models, strict=True):
                own = x if m is None else x[squared(x, m[0], m[1]) <= m[2] * (1 + 1e-12)]
                t += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
        at = [pa.array(np.repeat(np.arange(len(models)), total.shape[1])), pa.array(np.tile(np.arange(total.shape[1]), len(models)))]
        yield pa.RecordBatch.from_arrays([*at, pa.array(total.ravel())], names=["fit", "at", "x"])

    sums = np.zeros((len(models), 1 + width + width * width))
    for r in rows.select("v").mapInArrow(add, "fit long, at long, x double").groupBy("fit", "at").agg(F.sum("x").alias("x")).collect():
        sums[r["fit"], r["at"]] = r["x"]
    out = []
    for s in sums:
        n, total, square = int(s[0]), s[1 : 1 + width], s[1 + width :].reshape(width, width)
        center = total / max(n, 1)
        out.append(Spread(center, (square - n * np.outer(center, center)) / max(n - 1, 1), n, fits is None))
    return out


def is_singular(cov: np.ndarray) -> bool:
    return not np.linalg.det(cov) > SINGULAR * np.prod(np.maximum(np.diag(cov), 0)) > 0


def good_starts(x: np.ndarray, share: float, seed: int) -> list[Spread]:
    """Of STARTS random sets of width + 1 of the points x, the KEPT that two concentration steps make smallest."""
    r, (n, width), found = np.random.default_rng(seed), x.shape, []
    h = max(width + 1, int(share * n))
    for _ in range(STARTS):
        own = x[r.permutation(n)[: width + 1]]
        for _ in range(2):
            cov = np.cov(own, rowvar=False).reshape(width, width)
            d = squared(x, own.mean(0), np.linalg.pinv(cov + 1e-9 * np.trace(cov) / width * np.eye(width)))
            own = x[np.argsort(d, kind="stable")[:h]]
        cov = np.cov(own, rowvar=False).reshape(width, width)
        found.append((np.linalg.det(cov), len(found), Spread(own.mean(0), cov, h, False)))
    return [s for _, _, s in sorted(found, key=lambda f: f[:2])[:KEPT]]


def robust_spread(scores: DataFrame, seed: int = 42, most_steps: int = 50) -> Spread:
    """Centre and covariance of scores (sample, pc, score) by the minimum covariance determinant.

    Starts come from random sets within a hashed sample of START_ROWS points; then concentration steps over all points: the
    half nearest to the last fit makes the next one, which never has a larger determinant, until none gets smaller. The
    best fit is reweighted: points within the 97.5 % chi-squared quantile, scaled to the half's distance, make the result.
    Where the half is singular, or there are too few points, the classical covariance is returned.
    """
    from assayloom.operators.genetics import settled
    from assayloom.operators.harmonisation import chi_squared_quantile

    rows = settled(points(scores))
    first = rows.head()
    width = len(first["v"]) if first else 0
    whole = spreads(rows, width)[0]
    if whole.n < 2 * (width + 1) or is_singular(whole.cov):
        return whole
    h = (whole.n + width + 1) // 2
    share = h / whole.n
    some = rows.orderBy(F.xxhash64("sample", F.lit(seed)), "sample").limit(START_ROWS).select("v").collect()
    fits = good_starts(np.array([r["v"] for r in some]), share, seed)
    best = [math.inf] * len(fits)
    for _ in range(most_steps):
        after = spreads(rows, width, fits, quantiles_of_distance(rows, fits, share))
        size = [float(np.linalg.det(f.cov)) for f in after]
        gains = any(s < b * (1 - 1e-9) for s, b in zip(size, best, strict=True))
        fits, best = after, size
        if not gains:
            break
    fit = fits[int(np.argmin(best))]
    if is_singular(fit.cov):
        return whole
    reach = quantiles_of_distance(rows, [fit], share)[0]
    cut = chi_squared_quantile(0.975, width) * reach / chi_squared_quantile(share, width)
    out = spreads(rows, width, [fit], [cut])[0]
    return whole if is_singular(out.cov) else out


def mahalanobis_distance(pairs: DataFrame, scores: DataFrame, ridge: float = 1e-6) -> DataFrame:
    """person, distance of pairs (person, pc, x, y) under the robust covariance of scores (sample, pc, score), with a ridge.
    The covariance is as wide as there are components; it is inverted here."""
    pcs = [r[0] for r in scores.select("pc").distinct().orderBy("pc").collect()]
    inverse = np.linalg.pinv(robust_spread(scores).cov + ridge * np.eye(len(pcs)))
    rows = [(pcs[i], pcs[j], float(inverse[i, j])) for i in range(len(pcs)) for j in range(len(pcs))]
    kind = dict(scores.dtypes)["pc"]
    weights = F.broadcast(pairs.sparkSession.createDataFrame(rows, f"pc {kind}, pc2 {kind}, w double"))
    d = pairs.select("person", "pc", (F.col("x") - F.col("y")).alias("d"))
    d2 = d.select("person", F.col("pc").alias("pc2"), F.col("d").alias("d2"))
    return d.join(weights, "pc").join(d2, ["person", "pc2"]).groupBy("person").agg(F.sqrt(F.sum(F.col("d") * F.col("w") * F.col("d2"))).alias("distance"))


def median_ranks(n: int, resamples: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of `resamples` draws of n out of n rows with replacement, the ranks (from 1) of the two rows whose mean is the
    draw's median; the same rank twice if n is odd.

    A draw is n uniform numbers, u standing for row ceil(n * u), so the row at the draw's place j is that of the j-th
    smallest number, which has a beta distribution; the next one is the least of the n - j above it. That is the bootstrap's
    own distribution, whatever n is, without drawing rows.
    """
    r = np.random.default_rng(seed)
    j = (n + 1) // 2
    u = r.beta(j, n - j + 1, resamples)
    v = u if n % 2 else u + (1 - u) * (1 - (1 - r.random(resamples)) ** (1 / (n - j)))
    rank = lambda x: np.clip(np.ceil(n * x), 1, n).astype(np.int64)
    return rank(u), rank(v)


def values_at(rows: DataFrame, value: str, ranks: np.ndarray) -> dict[int, float]:
    """The values at some ranks (from 1) among all non-null ones: ranges of values count their rows, and only the asked
    ranks come here."""
    wanted = np.unique(ranks)
    cells = rows.filter(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("x")).agg(F.count("*").alias("n"))

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            last = b["run_n"].to_numpy()
            low, high = np.searchsorted(wanted, last - b["n"].to_numpy(), "right"), np.searchsorted(wanted, last, "right")
            yield pd.DataFrame({"rank": np.concatenate([np.zeros(0, np.int64), *[wanted[i:j] for i, j in zip(low, high, strict=True)]]), "x": np.repeat(b["x"].to_numpy(), high - low)})

    return {r["rank"]: r["x"] for r in running(cells, "x", "n").select("x", "n", "run_n").mapInPandas(pick, "rank long, x double").collect()}


def bootstrap_median(rows: DataFrame, value: str, resamples: int = 10_000, seed: int = 42) -> DataFrame:
    """median, low, high: the 95 % percentile interval of the median over resamples of the rows, null without rows."""
    n = rows.select(F.count(value)).head()[0]
    out = (None, None, None)
    if n:
        a, b = median_ranks(n, resamples, seed)
        middle = np.array([(n + 1) // 2, n // 2 + 1])
        at = values_at(rows, value, np.concatenate([a, b, middle]))
        medians = [(at[i] + at[j]) / 2 for i, j in zip(a.tolist(), b.tolist(), strict=True)]
        out = (sum(at[i] for i in middle.tolist()) / 2, *map(float, np.quantile(medians, [0.025, 0.975])))
    return rows.sparkSession.createDataFrame([out], "median double, low double, high double")


def log_ratio_interval(pairs: DataFrame, before: str, after: str, resamples: int = 10_000, seed: int = 42) -> DataFrame:
    """median, low, high of the log ratio of after to before, with a bootstrapped interval, and whether it excludes zero."""
    ratio = pairs.select(F.log((F.col(after) + 1e-12) / (F.col(before) + 1e-12)).alias("log_ratio"))
    return bootstrap_median(ratio, "log_ratio", resamples, seed).withColumn("excludes_zero", (F.col("low") > 0) | (F.col("high") < 0))


def rank_sum_shares(n: int) -> np.ndarray:
    """P(V <= v) for v = 0, 1, ... of the signed-rank sum of n values without ties, by adding ranks one after another."""
    ways = np.zeros(n * (n + 1) // 2 + 1)
    ways[0] = 1.0
    for k in range(1, n + 1):
        ways[k:] = ways[k:] + ways[:-k]
    return np.cumsum(ways) / 2.0**n


def signed_rank(pairs: DataFrame, before: str, after: str, alternative: str = "less", exact_below: int = 50) -> DataFrame:
    """n, v, z, p of after against before ("less": after is less; or "two-sided"). Zeros are dropped. p is exact for under
    `exact_below` differences without ties or zeros, else normal with a continuity correction and the ties' variance."""
    d = pairs.select((F.col(after) - F.col(before)).alias("d")).filter("d IS NOT NULL")
    zeros = d.filter("d = 0").limit(1).count()
    ranked = ranked_values(d.filter("d <> 0").withColumn("a", F.abs("d")), "a", up=F.count_if(F.col("d") > 0))
    ties = F.sum(F.col("n") * F.col("n") * F.col("n") - F.col("n")).cast("double")
    r = ranked.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.col("up") * F.col("rank")), F.lit(0.0)).alias("v"), F.coalesce(ties, F.lit(0.0)).alias("ties")).head()
    n, v = r["n"], float(r["v"])
    z = p = None
    gap, var = v - n * (n + 1) / 4, n * (n + 1) * (2 * n + 1) / 24 - r["ties"] / 48
    if var > 0:
        z = (gap + 0.5 if alternative == "less" else gap - math.copysign(0.5, gap) * (gap != 0)) / math.sqrt(var)
        p = math.erfc(-z / math.sqrt(2)) / 2 if alternative == "less" else min(1.0, math.erfc(abs(z) / math.sqrt(2)))
        if n < exact_below and not r["ties"] and not zeros:
            share = rank_sum_shares(n)
            low, high = share[int(v)], 1 - (share[int(v) - 1] if v >= 1 else 0.0)
            p = float(low) if alternative == "less" else min(1.0, 2 * float(min(low, high)))
    return pairs.sparkSession.createDataFrame([(n, v, z, p)], "n long, v double, z double, p double")
