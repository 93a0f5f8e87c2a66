"""Association scans and agreement measures (survey H8, H13-H16, H28-H46, L)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayloom.functions.blocks import Codes, LabelSums, block_pairs, distances, fold_blocks, quantiles, ranked_values
from assayloom.functions.stats import benjamini_hochberg, over, welch_t, with_scalars


def t_two_sided(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Two-sided p-values of t statistics: the regularised incomplete beta function by Lentz's continued fraction."""
    t, df = np.asarray(t, float), np.asarray(df, float)
    x = df / (df + t * t)
    a, b = df / 2, np.full_like(df, 0.5)
    front = np.exp(np.vectorize(math.lgamma)(a + b) - np.vectorize(math.lgamma)(a) - np.vectorize(math.lgamma)(b) + a * np.log(np.maximum(x, 1e-300)) + b * np.log(np.maximum(1 - x, 1e-300)))
    swap = x > (a + 1) / (a + b + 2)
    p, q, y = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    tiny = 1e-300
    c, d = np.ones_like(y), 1 - (p + q) * y / (p + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 200):
        for step in (m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1))):
            d = 1 + step * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + step / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
    part = front * h / p
    return np.clip(np.where(swap, 1 - part, part), 0, 1)


def covariate_effects(long: DataFrame, numeric: str, flag: str, least: int = 10) -> DataFrame:
    """feature, r with a numeric covariate, Welch t by a flag (null under `least` rows in a group)."""
    yes = F.col(flag)
    enough = (F.count(F.when(yes, F.col("value"))) >= least) & (F.count(F.when(~yes, F.col("value"))) >= least)
    return long.groupBy("feature").agg(F.corr("value", numeric).alias("r"), F.when(enough, welch_t("value", yes)).alias("t"))


def simple_scan(long: DataFrame, outcome: str, least: int = 50) -> DataFrame:
    """feature, n, beta, se, t, r2 of outcome ~ value, in closed form."""
    y, x = F.col(outcome), F.col("value")
    agg = long.groupBy("feature").agg(F.regr_count(y, x).alias("n"), F.regr_slope(y, x).alias("beta"), F.regr_r2(y, x).alias("r2"), F.regr_syy(y, x).alias("syy"), F.regr_sxx(y, x).alias("sxx")).filter(F.col("n") >= least)
    se = F.sqrt(F.try_divide((1 - F.col("r2")) * F.col("syy"), (F.col("n") - 2) * F.col("sxx")))
    return agg.withColumn("se", se).withColumn("t", F.try_divide("beta", "se")).select("feature", "n", "beta", "se", "t", "r2")


def linear_scan(long: DataFrame, outcome: str, covariates: list[str], least: int = 50) -> DataFrame:
    """feature, n, beta, se, t, p, r2 of outcome ~ value + covariates: cross-products summed by Spark, solved a batch at a time."""
    xs = [F.lit(1.0), F.col("value"), *[F.col(c).cast("double") for c in covariates]]
    k, y = len(xs), F.col(outcome).cast("double")
    sums = [F.sum(xs[i] * xs[j]).alias(f"x{i}_{j}") for i in range(k) for j in range(i, k)] + [F.sum(x * y).alias(f"y{i}") for i, x in enumerate(xs)] + [F.sum(y * y).alias("yy")]
    moments = long.dropna(subset=["value", outcome, *covariates]).groupBy("feature").agg(F.count("*").alias("n"), *sums).filter(F.col("n") >= least)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            a = np.empty((len(b), k, k))
            for i in range(k):
                for j in range(i, k):
                    a[:, i, j] = a[:, j, i] = b[f"x{i}_{j}"]
            v, n = np.stack([b[f"y{i}"] for i in range(k)], -1), b["n"].to_numpy(float)
            inverse = np.linalg.pinv(a, hermitian=True)
            beta = np.einsum("nij,nj->ni", inverse, v)
            rss = np.maximum(b["yy"].to_numpy() - (beta * v).sum(1), 0)
            total = b["yy"].to_numpy() - v[:, 0] ** 2 / n
            se = np.sqrt(rss / (n - k) * inverse[:, 1, 1])
            t = beta[:, 1] / se
            yield pd.DataFrame({"feature": b["feature"], "n": b["n"], "beta": beta[:, 1], "se": se, "t": t, "p": t_two_sided(t, n - k), "r2": 1 - rss / total})

    return moments.mapInPandas(solve, f"feature {dict(long.dtypes)['feature']}, n long, beta double, se double, t double, p double, r2 double")


def logistic_scan(long: DataFrame, outcome: str, covariates: list[str], least: int = 30, bonferroni: int | None = None, most_rounds: int = 25) -> DataFrame:
    """Per feature outcome ~ value + covariates by iteratively reweighted least squares: beta, se, z, p, adjusted p, odds
    ratio and its 95% interval.

    All features take their steps together: a round is one aggregate of weighted cross-products by feature, whose small
    systems are solved a batch at a time. A feature that has settled drops out, and the rounds end when none is left.
    """
    from assayloom.operators.genetics import settled

    kind, columns = dict(long.dtypes)["feature"], ["value", *covariates]
    k = len(columns) + 1
    rows = long.select("feature", F.col(outcome).cast("double").alias("_y"), *[F.col(c).cast("double").alias(f"_c{i}") for i, c in enumerate(columns)]).dropna()
    facts = rows.groupBy("feature").agg(F.count("*").alias("n"), *[f(f"_c{i}").alias(f"_{m}{i}") for i in range(k - 1) for m, f in (("m", F.avg), ("s", F.stddev_pop))]).filter(F.col("n") >= least)
    unit = lambda i: (F.col(f"_c{i}") - F.col(f"_m{i}")) / F.when(F.col(f"_s{i}") > 0, F.col(f"_s{i}")).otherwise(1.0)
    x = settled(rows.join(facts, "feature").select("feature", "_y", *[unit(i).alias(f"_x{i + 1}") for i in range(k - 1)]))
    xs = [F.lit(1.0), *[F.col(f"_x{i}") for i in range(1, k)]]
    start = F.array(*[F.lit(0.0)] * k)
    state = facts.select("feature", "n", F.when(F.col("_s0") > 0, F.col("_s0")).otherwise(1.0).alias("scale"), start.alias("b"), F.lit(None).cast("double").alias("se"), F.lit(False).alias("done"))

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            h, g = np.empty((len(b), k, k)), np.stack([b[f"g{i}"] for i in range(k)], -1)
            for i in range(k):
                for j in range(i, k):
                    h[:, i, j] = h[:, j, i] = b[f"h{i}_{j}"]
            inverse = np.linalg.pinv(h, hermitian=True)
            move = np.einsum("nij,nj->ni", inverse, g)
            after = np.stack(b["b"].to_list()) + move
            yield pd.DataFrame({"feature": b["feature"], "n": b["n"], "scale": b["scale"], "b": list(after), "se": np.sqrt(np.maximum(inverse[:, 1, 1], 0)), "done": np.abs(move).max(1) < 1e-8})

    state, finished = settled(state), None
    for _ in range(most_rounds):
        eta = F.greatest(F.least(sum((F.get("b", F.lit(i)) * c for i, c in enumerate(xs)), F.lit(0.0)), F.lit(30.0)), F.lit(-30.0))
        p = 1 / (1 + F.exp(-F.col("_eta")))
        fitted = x.join(state.select("feature", "b"), "feature").withColumn("_eta", eta).withColumn("_p", p).withColumn("_w", F.greatest(F.col("_p") * (1 - F.col("_p")), F.lit(1e-10)))
        products = [F.sum(F.col("_w") * xs[i] * xs[j]).alias(f"h{i}_{j}") for i in range(k) for j in range(i, k)]
        sums = fitted.groupBy("feature").agg(*products, *[F.sum(c * (F.col("_y") - F.col("_p"))).alias(f"g{i}") for i, c in enumerate(xs)])
        stepped = sums.join(state.select("feature", "n", "scale", "b"), "feature")
        state = settled(stepped.mapInPandas(step, f"feature {kind}, n long, scale double, b array<double>, se double, done boolean"))
        ended = state.filter("done")
        finished = ended if finished is None else finished.unionByName(ended)
        state = state.filter("NOT done")
        if state.isEmpty():
            break
    every = finished.unionByName(state)  # what hasn't settled is given as it stands
    beta, se = F.get("b", F.lit(1)) / F.col("scale"), F.col("se") / F.col("scale")

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            z = np.where(b["se"] > 0, b["beta"] / b["se"].where(b["se"] > 0, 1.0), np.nan)
            yield b.assign(z=z, p=[math.erfc(abs(v) / math.sqrt(2)) for v in z])

    out = every.select("feature", "n", beta.alias("beta"), se.alias("se")).mapInPandas(judge, f"feature {kind}, n long, beta double, se double, z double, p double")
    m = F.lit(bonferroni) if bonferroni else F.count("p").over(Window.partitionBy())
    out = out.withColumns({"p_adj": benjamini_hochberg("p"), "bonf_sig": F.col("p") < 0.05 / m})
    bound = lambda s: F.exp(F.col("beta") + s * 1.96 * F.col("se"))
    return out.withColumns({"odds_ratio": F.exp("beta"), "ci_low": bound(-1), "ci_high": bound(1), "neg_log10_p": -F.log10(F.col("p") + 1e-300)})


def ks_alignment(rows: DataFrame, value: str, flag: str, *by: str) -> DataFrame:
    """by, n1, n2, d, p: two-sample Kolmogorov-Smirnov, from two running counts over the sorted values."""
    steps = rows.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count_if(F.col(flag)).alias("_a"), F.count_if(~F.col(flag)).alias("_b"))
    run = Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*by)
    gap = F.abs(F.sum("_a").over(run) / F.sum("_a").over(whole) - F.sum("_b").over(run) / F.sum("_b").over(whole))
    out = steps.withColumn("_gap", gap).groupBy(*by).agg(F.sum("_a").alias("n1"), F.sum("_b").alias("n2"), F.max("_gap").alias("d"))
    lam = F.col("d") * F.sqrt(F.col("n1") * F.col("n2") / (F.col("n1") + F.col("n2")))
    terms = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0), lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam * lam))
    return out.withColumn("p", F.when(lam < 0.2, 1.0).otherwise(F.least(F.greatest(2 * terms, F.lit(0.0)), F.lit(1.0))))


def rank_sum(rows: DataFrame, value: str, flag: str) -> DataFrame:
    """n1, n0, auc, z: rank-sum of the flagged rows against the others, ties averaged."""
    known = rows.filter(F.col(flag).isNotNull()).select(F.col(value).alias("value"), F.col(flag).alias("flag"))
    out = ranked_values(known, "value", yes=F.count_if("flag")).agg(
        F.coalesce(F.sum("yes"), F.lit(0)).alias("n1"), F.coalesce(F.sum(F.col("n") - F.col("yes")), F.lit(0)).alias("n0"), F.sum(F.col("yes") * F.col("rank")).alias("_s")
    )
    u = F.col("_s") - F.col("n1") * (F.col("n1") + 1) / 2
    pairs = F.col("n1") * F.col("n0")
    z = F.try_divide(u - pairs / 2, F.sqrt(pairs * (F.col("n1") + F.col("n0") + 1) / 12))
    return out.select("n1", "n0", F.try_divide(u, pairs).alias("auc"), z.alias("z"))


def pair_agreement(pairs: DataFrame, least: int = 25) -> DataFrame:
    """person, n, icc, ccc of paired measurements x, y over features: single consistency ICC of two raters and Lin's CCC."""
    both = pairs.filter(F.col("x").isNotNull() & F.col("y").isNotNull()).groupBy("person")
    agg = both.agg(F.count("*").alias("n"), F.covar_samp("x", "y").alias("_c"), F.var_samp("x").alias("_vx"), F.var_samp("y").alias("_vy"), F.covar_pop("x", "y").alias("_cp"), F.var_pop("x").alias("_px"), F.var_pop("y").alias("_py"), (F.avg("x") - F.avg("y")).alias("_d"))
    icc = F.try_divide(2 * F.col("_c"), F.col("_vx") + F.col("_vy"))
    ccc = F.try_divide(2 * F.col("_cp"), F.col("_px") + F.col("_py") + F.col("_d") * F.col("_d"))
    return agg.filter(F.col("n") >= least).select("person", "n", icc.alias("icc"), ccc.alias("ccc"))


def mean_correlation(before: DataFrame, after: DataFrame) -> DataFrame:
    """stage, n, r: the correlation over people of their mean values in the two batches, before and after; means over the
    features that both samples of a pair have."""
    def of(pairs: DataFrame, stage: str) -> DataFrame:
        means = pairs.filter("x IS NOT NULL AND y IS NOT NULL").groupBy("person").agg(F.avg("x").alias("x"), F.avg("y").alias("y"))
        return means.agg(F.count("*").alias("n"), F.corr("x", "y").alias("r")).select(F.lit(stage).alias("stage"), "n", "r")

    return of(before, "before").unionByName(of(after, "after"))


def pair_distance(pairs: DataFrame) -> DataFrame:
    """person, distance: Euclidean over features (x, y)."""
    return pairs.groupBy("person").agg(F.sqrt(F.sum((F.col("x") - F.col("y")) * (F.col("x") - F.col("y")))).alias("distance"))


def cross_distances(queries: DataFrame, references: DataFrame, *within: str) -> DataFrame:
    """query, reference, d2 of two long tables (person, feature, value): joined on the feature and summed, a block product.
    For the bridge people alone, a few tens to hundreds by design; `within` keeps pairs of one group. Ranks among many
    references come from `true_pair_rank`, which stores no pairs."""
    q = queries.select(F.col("person").alias("query"), *within, "feature", F.col("value").alias("_q"))
    r = references.select(F.col("person").alias("reference"), *within, "feature", F.col("value").alias("_r"))
    return q.join(r, [*within, "feature"]).groupBy("query", "reference").agg(F.sum((F.col("_q") - F.col("_r")) * (F.col("_q") - F.col("_r"))).alias("d2"))


def _packed(long: DataFrame, name: str) -> DataFrame:
    """name, features, values: the known cells of each person in the order of the features."""
    cells = long.filter("value IS NOT NULL").groupBy(F.col("person").alias(name)).agg(F.sort_array(F.collect_list(F.struct("feature", F.col("value").cast("double").alias("value")))).alias("c"))
    return cells.select(name, F.col("c.feature").alias("features"), F.col("c.value").alias("values"))


def _by_feature(*sides: tuple[pd.Series, pd.Series]) -> list[np.ndarray]:
    """For each (features, values) a table of all their features by rows, NaN where a row has none."""
    codes = pd.factorize(np.concatenate([f for features, _ in sides for f in features]), sort=True)
    wide, at = [], 0
    for features, values in sides:
        sizes = [len(f) for f in features]
        w = np.full((len(codes[1]), len(sizes)), np.nan)
        w[codes[0][at : (at := at + sum(sizes))], np.repeat(np.arange(len(sizes)), sizes)] = np.concatenate(list(values))
        wide.append(w)
    return wide


def true_pair_rank(queries: DataFrame, references: DataFrame) -> DataFrame:
    """query, rank of its own reference by distance, margin to the nearest other one, of two long tables (person, feature,
    value); distances are over the features that both have.

    A query's distance from its own reference comes first. Then blocks of queries go past all references and count those that
    are nearer: a block keeps a count and a least distance for each query, never the pairs.
    """
    kind = dict(queries.dtypes)["person"]
    q, r = _packed(queries, "query"), _packed(references, "reference")

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            if len(p):
                x, y = _by_feature((p["features"], p["values"]), (p["_f"], p["_v"]))
                d = np.zeros(len(p))
                for f in range(len(x)):  # in the order of the features, as below, so that copies tie
                    gap = x[f] - y[f]
                    d += np.where(np.isnan(gap), 0, gap * gap)
                yield p[["person", "features", "values"]].assign(own=np.where((~np.isnan(x - y)).any(0), d, np.nan))

    both = q.withColumnRenamed("query", "person").join(r.select(F.col("reference").alias("person"), F.col("features").alias("_f"), F.col("values").alias("_v")), "person")
    item = dict(q.dtypes)["features"]
    asked = both.mapInPandas(own, f"person {kind}, features {item}, values array<double>, own double").filter("NOT isnan(own)")
    known = r.select(F.col("reference").alias("person"), "features", "values", F.lit(None).cast("double").alias("own"))

    def nearer(a: pd.DataFrame, b: pd.DataFrame, before: pd.DataFrame | None) -> pd.DataFrame:
        x, y = _by_feature((a["features"], a["values"]), (b["features"], b["values"]))
        here, there = ~np.isnan(x), ~np.isnan(y)
        gaps = not (here.all() and there.all())
        place, limit = pd.Index(b["person"]).get_indexer(a["person"]), a["own"].to_numpy(float)  # a person has one row in each
        count, least = np.zeros(len(a), int), np.full(len(a), np.inf)
        for start in range(0, len(a), 250):  # so few that the tables of a step stay in the processor's cache
            rows = slice(start, start + 250)
            d, gap = np.zeros((len(limit[rows]), len(b))), np.empty((len(limit[rows]), len(b)))
            for f in range(len(x)):
                np.subtract(x[f, rows, None], y[f, None], out=gap)
                np.multiply(gap, gap, out=gap)
                d += np.nan_to_num(gap, copy=False, nan=0.0) if gaps else gap
            if gaps:
                d[here[:, rows].T.astype(float) @ there.astype(float) == 0] = np.inf
            own = np.flatnonzero(place[rows] >= 0)
            d[own, place[rows][own]] = np.inf
            count[rows], least[rows] = (d < limit[rows, None]).sum(1), d.min(1)
        if before is not None:
            count, least = count + before["nearer"].to_numpy(), np.minimum(least, before["other"].to_numpy())
        return pd.DataFrame({"query": a["person"], "own": a["own"], "nearer": count, "other": least})

    sizes = q.agg(F.count("*").alias("n"), F.max(F.size("features")).alias("f")).head()
    most = max(100, min(10_000, 1_000_000 // max(1, sizes["f"] or 1)))
    found = fold_blocks(asked, known, "person", nearer, f"query {kind}, own double, nearer long, other double", max(1, -(-sizes["n"] // most)), groups=16)
    out = found.groupBy("query").agg((F.sum("nearer") + 1).cast("int").alias("rank"), F.first("own").alias("_own"), F.min("other").alias("_other"))
    return out.select("query", "rank", (F.sqrt("_own") - F.sqrt(F.when(F.col("_other") < math.inf, F.col("_other")))).alias("margin"))


def concordance(pairs: DataFrame, least: int = 5) -> DataFrame:
    """feature, n, cor, mse, mae, r2 over pairs x, y; r2 is the share of y's variance that x itself, unfitted, explains."""
    d = F.col("x") - F.col("y")
    agg = pairs.filter(F.col("x").isNotNull() & F.col("y").isNotNull()).groupBy("feature").agg(F.count("*").alias("n"), F.corr("x", "y").alias("cor"), F.avg(d * d).alias("mse"), F.avg(F.abs(d)).alias("mae"), F.var_pop("y").alias("_vy"))
    return agg.filter(F.col("n") >= least).withColumn("r2", 1 - F.try_divide("mse", "_vy")).drop("_vy")


def concordance_change(before: DataFrame, after: DataFrame, least: int = 5, worst_r2: float = 0.5) -> DataFrame:
    """feature, cor, mse, mae and r2 before (_pre) and after (_post), mse_reduction, poorly_harmonised: the error grew or r2
    after is under `worst_r2`."""
    names = ("cor", "mse", "mae", "r2")
    side = lambda df, tail: concordance(df, least).select("feature", *[F.col(c).alias(f"{c}_{tail}") for c in names])
    out = side(before, "pre").join(side(after, "post"), "feature", "full")
    reduction = F.try_divide(F.col("mse_pre") - F.col("mse_post"), "mse_pre")
    poor = F.coalesce(reduction < 0, F.lit(False)) | F.coalesce(F.col("r2_post") < worst_r2, F.lit(False))
    return out.withColumns({"mse_reduction": reduction, "poorly_harmonised": poor})


def bridge_flags(pairs: DataFrame, distance: str = "distance", ratio: str = "ratio", k: float = 1.5, most: float = 3.0) -> DataFrame:
    """`pairs` with outlier_distance (over Q3 + k * IQR), outlier_noise (noise ratio over `most`) and outlier, either."""
    out = iqr_outliers(pairs, distance, k).withColumnRenamed("is_outlier", "outlier_distance").withColumn("outlier_noise", F.col(ratio) > most)
    return out.withColumn("outlier", F.coalesce("outlier_distance", F.lit(False)) | F.coalesce("outlier_noise", F.lit(False)))


def stage_summary(before: DataFrame, after: DataFrame, samples: int | None = None, seed: int = 42) -> DataFrame:
    """stage, mean, median, sd, iqr to two places before and after a step; with `samples`, over that many samples in a hash
    order of their ids, the same ones in both."""
    if samples is not None:
        chosen = before.select("sample").distinct().orderBy(F.xxhash64("sample", F.lit(seed)), "sample").limit(samples)
        before, after = (df.join(F.broadcast(chosen), "sample", "left_semi") for df in (before, after))
    # medians and quantiles by ranges of values: as plain aggregates each stage would be one task
    facts = {"mean": F.avg("value"), "sd": F.stddev_samp("value"), "_n": F.count("value")}

    def of(rows: DataFrame, stage: str) -> DataFrame:
        both = with_scalars(rows.agg(*[c.alias(n) for n, c in facts.items()]), quantiles(rows, "value", median=0.5, _q1=0.25, _q3=0.75))
        return both.withColumn("iqr", F.col("_q3") - F.col("_q1")).filter("_n > 0").select(F.lit(stage).alias("stage"), *[F.round(n, 2).alias(n) for n in ("mean", "median", "sd", "iqr")])

    return of(before, "Before").unionByName(of(after, "After"))


def effect_comparison(fits: DataFrame, weights: DataFrame, top: int = 50) -> DataFrame:
    """feature, beta, its 95% interval, and mean and 2.5/97.5% points over folds of another model's weight, for the `top`
    features by p. fits: feature, beta, se, p; weights: fold, feature, weight."""
    best = fits.orderBy("p", "feature").limit(top)
    folds = weights.join(F.broadcast(best.select("feature")), "feature", "left_semi").groupBy("feature").agg(F.avg("weight").alias("other_mean"), F.percentile("weight", F.lit(0.025)).alias("other_low"), F.percentile("weight", F.lit(0.975)).alias("other_high"))
    interval = {"beta_low": F.col("beta") - 1.96 * F.col("se"), "beta_high": F.col("beta") + 1.96 * F.col("se")}
    return best.withColumns(interval).select("feature", "beta", "beta_low", "beta_high").join(folds, "feature", "left")


def iqr_outliers(rows: DataFrame, value: str, k: float = 1.5) -> DataFrame:
    """Rows whose value is over Q3 + k * IQR."""
    q = rows.agg(F.percentile(value, F.lit(0.25)).alias("_q1"), F.percentile(value, F.lit(0.75)).alias("_q3"))
    return with_scalars(rows, q).withColumn("is_outlier", F.col(value) > F.col("_q3") + (F.col("_q3") - F.col("_q1")) * k).drop("_q1", "_q3")


def moments(rows: DataFrame, value: str, *by: str) -> DataFrame:
    """n, mean, sd, skew and kurt (with the sample sd), kurt_plain (population, not excess)."""
    n = F.count(value)
    shrink = F.pow((n - 1) / n, F.lit(1.5))
    return rows.groupBy(*by).agg(
        n.alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"), (F.skewness(value) * shrink).alias("skew"),
        ((F.kurtosis(value) + 3) * F.pow((n - 1) / n, F.lit(2.0)) - 3).alias("kurt"), (F.kurtosis(value) + 3).alias("kurt_plain"),
    )


def silhouette(scores: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Mean silhouette: each sample's mean distances to the labels' members, summed block by block; a sample alone in its
    label counts 0, one without a label or score isn't counted.

    Pairs are never kept: a task gives one number a sample. The score table is one row a sample.
    """
    kinds = dict(scores.dtypes)

    class Sums:
        def __init__(self, a: pd.DataFrame) -> None:
            self.own, self.codes, self.sums = a["sample"].to_numpy(), Codes(), LabelSums(len(a))
            self.labels = self.codes(a["label"])

        def table(self) -> pd.DataFrame:
            return pd.DataFrame({"s": self.own, "silhouette": self.sums.silhouettes(self.labels)})

    def work(a: pd.DataFrame, b: pd.DataFrame, before: Sums | None) -> Sums:
        found = Sums(a) if before is None else before
        same = found.own[:, None] == b["sample"].to_numpy()[None]
        found.sums.add(distances(a, b, columns), found.codes(b["label"]), same)
        return found

    rows = scores.select("sample", F.col(label).alias("label"), *columns).dropna()
    per = block_pairs(rows, work, f"s {kinds['sample']}, silhouette double")
    return per.agg(F.avg(F.when(~F.isnan("silhouette"), F.col("silhouette"))).alias("silhouette"))


def project(long: DataFrame, basis: DataFrame) -> DataFrame:
    """sample, pc, score: (value - center) / scale times the loading, summed. basis: feature, pc, center, scale, loading."""
    z = (F.col("value") - F.col("center")) / F.col("scale")
    return long.join(basis, "feature").groupBy("sample", "pc").agg(F.sum(z * F.col("loading")).alias("score"))


def cumulative_variance(variance: DataFrame, least: float = 0.95) -> DataFrame:
    """pc, share, cumulative, needed: whether the component is among the first that reach `least`."""
    total = F.sum("variance").over(Window.partitionBy())
    run = Window.orderBy("pc").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # one row a component
    out = variance.withColumn("share", F.col("variance") / total).withColumn("cumulative", F.sum("share").over(run))
    return out.withColumn("needed", F.col("cumulative") - F.col("share") < least)


def effect_interval(fits: DataFrame, sds: float = 3.0, p: Column | None = None) -> DataFrame:
    """Effects within `sds` of their mean, with a 95% interval and a Bonferroni flag over what is left."""
    limits = fits.agg(F.avg("beta").alias("_m"), F.stddev_samp("beta").alias("_s"))
    kept = with_scalars(fits, limits).filter(F.abs(F.col("beta") - F.col("_m")) <= F.col("_s") * sds).drop("_m", "_s")
    n = kept.agg(F.count("*").alias("_n"))
    return with_scalars(kept, n).withColumns({"ci_low": F.col("beta") - 1.96 * F.col("se"), "ci_high": F.col("beta") + 1.96 * F.col("se"), "bonferroni": F.lit(0.05) / F.col("_n")}).drop("_n")


def variation(long: DataFrame, *by: str, absolute: bool = True) -> DataFrame:
    """by, n, cv: sd over the (absolute) mean."""
    mean = F.avg("value")
    return long.groupBy(*by).agg(F.count("value").alias("n"), F.try_divide(F.stddev_samp("value"), F.abs(mean) if absolute else mean).alias("cv"))


def outliers_by_group(flagged: DataFrame, groups: DataFrame, top: int = 40) -> DataFrame:
    """feature, grp, n, pct: for the `top` features with most flagged cells (sample, feature), their samples' groups."""
    best = flagged.groupBy("feature").agg(F.count("*").alias("_t")).orderBy(F.desc("_t"), "feature").limit(top)
    rows = flagged.join(F.broadcast(best), "feature").join(groups, "sample", "left")
    return rows.groupBy("feature", "_t", "grp").agg(F.count("*").alias("n")).withColumn("pct", 100 * F.col("n") / F.col("_t")).drop("_t")


def effect_reduction(before: DataFrame, after: DataFrame, *columns: str) -> DataFrame:
    """effect, before, after, pct_reduction: mean absolute effects of two effect tables."""
    mean = lambda df, name: df.agg(*[F.avg(F.abs(c)).alias(c) for c in columns]).unpivot([], list(columns), "effect", name)
    out = mean(before, "before").join(mean(after, "after"), "effect")
    return out.withColumn("pct_reduction", F.try_divide((F.col("before") - F.col("after")) * 100, "before"))


def component_effects(long: DataFrame, scores: DataFrame) -> DataFrame:
    """pc, feature, r: every feature's correlation with every component (sample, pc, score)."""
    return long.join(scores, "sample").groupBy("pc", "feature").agg(F.corr("value", "score").alias("r"))


def correlation_test(long: DataFrame, covariate: str, top: int = 10) -> DataFrame:
    """feature, n, r, p, neg_log10_p, label (most positive or negative `top`), p from r by the t distribution."""
    agg = long.groupBy("feature").agg(F.count(F.when(F.col(covariate).isNotNull(), F.col("value"))).alias("n"), F.corr("value", covariate).alias("r"))

    def p_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            r, n = b["r"].to_numpy(float), b["n"].to_numpy(float)
            t = r * np.sqrt((n - 2) / np.maximum(1 - r * r, 1e-300))
            yield b.assign(p=t_two_sided(t, np.maximum(n - 2, 1)))

    out = agg.filter("r IS NOT NULL AND n > 2").mapInPandas(p_of, f"feature {dict(long.dtypes)['feature']}, n long, r double, p double")
    up, down = F.row_number().over(Window.orderBy(F.desc("r"))), F.row_number().over(Window.orderBy("r"))  # a row a feature
    return out.withColumn("neg_log10_p", -F.log10(F.col("p") + 1e-300)).withColumn("label", F.when((up <= top) & (F.col("r") > 0), "positive").when((down <= top) & (F.col("r") < 0), "negative"))


def value_on_z(rows: DataFrame, value: str, z: str) -> DataFrame:
    """n, slope, r2 of z on value."""
    return rows.agg(F.regr_count(z, value).alias("n"), F.regr_slope(z, value).alias("slope"), F.regr_r2(z, value).alias("r2"))
