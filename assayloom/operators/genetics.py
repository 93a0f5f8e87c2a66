"""Genotype consistency, relatedness and graph operators (survey D18, E3, E6-E8, H17, H18, H50-H59)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayloom.functions.stats import avg_rank, center_and_mad, over, with_scalars

#: Lower bounds of kinship for each class (fixed values).
CLASSES = ((0.354, "duplicate"), (0.177, "first"), (0.0884, "second"), (0.0442, "third"))


def maf_het(genotypes: DataFrame) -> DataFrame:
    """variant, n, maf, het of rows (iid, variant, dosage)."""
    af = F.avg("dosage") / 2
    return genotypes.filter("dosage IS NOT NULL").groupBy("variant").agg(F.count("*").alias("n"), F.least(af, 1 - af).alias("maf"), F.avg((F.col("dosage") == 1).cast("int")).alias("het"))


def composite_score(p: Column, beta: Column, maf: Column | None = None, het: Column | None = None) -> Column:
    """-log10(p) * |beta| (* maf / (het + 0.01)); a p of 0 counts as ten times the least double."""
    floor = 10 * 2.2250738585072014e-308
    base = -F.log10(F.greatest(p, F.lit(floor))) * F.abs(beta)
    if maf is not None:
        base = base * maf
    return base / (het + 0.01) if het is not None else base


def top_variant(variants: DataFrame) -> DataFrame:
    """One variant a trait: least p, then greatest cs_avg_r2, then the id."""
    order = Window.partitionBy("trait").orderBy(F.asc_nulls_last("p"), F.desc_nulls_last("cs_avg_r2"), F.asc("rsid"))
    return variants.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")


def genotype_z(rows: DataFrame, recode: bool = True) -> DataFrame:
    """rows (sample, variant, dosage, value, beta) -> z within (variant, dosage) and the standardised residual.

    Groups without spread have no z. The residual is value - (mean + beta * (dosage - mean dosage)) over its sd, for
    variants with a beta and more than three rows.
    """
    out = rows.filter("value IS NOT NULL AND dosage IS NOT NULL")
    if recode:
        out = out.withColumn("dosage", 2 - F.col("dosage"))
    cell, variant = over("variant", "dosage"), over("variant")
    sd = F.stddev_samp("value").over(cell)
    out = out.withColumn("z", F.when(sd > 0, (F.col("value") - F.avg("value").over(cell)) / sd))
    predicted = F.avg("value").over(variant) + F.col("beta") * (F.col("dosage") - F.avg("dosage").over(variant))
    out = out.withColumn("residual", F.when(F.count("*").over(variant) > 3, F.col("value") - predicted))
    return out.withColumn("std_residual", F.try_divide("residual", F.stddev_samp("residual").over(variant)))


def genotype_sample_stats(scored: DataFrame) -> DataFrame:
    """Per sample: mean, median and largest |z|, median |residual|, counts, |z| > 3."""
    z, r = F.abs("z"), F.abs("std_residual")
    return scored.groupBy("sample").agg(
        F.avg(z).alias("mean_abs_z"), F.median(z).alias("median_abs_z"), F.max(z).alias("max_abs_z"), F.median(r).alias("median_abs_residual"),
        F.count("z").alias("n_features"), F.count("std_residual").alias("n_residuals"), F.count_if(z > 3).alias("n_beyond_3"),
    )


def genotype_flags(stats: DataFrame, k: float = 4.0, least_residuals: int = 10, least: int = 5) -> DataFrame:
    """Flags over population cut-offs rounded to one decimal: mean + k sd, or median + k * 1.4826 * MAD. A measure that fewer
    than `least` samples have sets no cut-off and flags nobody."""
    mean = stats.agg(F.round(F.avg("mean_abs_z") + F.stddev_samp("mean_abs_z") * k, 1).alias("_mean"))
    median = center_and_mad(stats, "median_abs_z").select(F.round(F.col("median") + F.col("mad") * k, 1).alias("_median"))
    residual = center_and_mad(stats, "median_abs_residual").select(F.round(F.col("median") + F.col("mad") * k, 1).alias("_residual"))
    known = stats.agg(*[(F.count(c) >= least).alias(f"_k_{c}") for c in ("mean_abs_z", "median_abs_z", "median_abs_residual")])
    out = with_scalars(with_scalars(with_scalars(with_scalars(stats, mean), median), residual), known)
    over_mean = F.coalesce((F.col("mean_abs_z") > F.col("_mean")) & F.col("_k_mean_abs_z"), F.lit(False))
    over_median = F.coalesce((F.col("median_abs_z") > F.col("_median")) & F.col("_k_median_abs_z"), F.lit(False))
    over_residual = F.coalesce((F.col("median_abs_residual") > F.col("_residual")) & (F.col("n_residuals") >= least_residuals) & F.col("_k_median_abs_residual"), F.lit(False))
    flagged = out.withColumns({"outlier_mean": over_mean, "outlier_median": over_median, "outlier_residual": over_residual})
    return flagged.withColumn("is_outlier", over_mean | over_median | over_residual).drop("_mean", "_median", "_residual", "_k_mean_abs_z", "_k_median_abs_z", "_k_median_abs_residual")


def rank_percentile(value: str, *by: str) -> Column:
    """Average rank / (n + 1), nulls ranking as 0."""
    return avg_rank(value, *by) / (F.count(value).over(over(*by)) + 1)


def composite_tiers(stats: DataFrame, columns: list[str], cuts: tuple[float, float, float] = (0.92, 0.80, 0.65)) -> DataFrame:
    """sample, composite, tier (1 to 4), is_outlier: mean of the columns' rank percentiles, cut at three quantiles."""
    filled = stats.fillna(0.0, columns)
    composite = reduce(lambda a, b: a + b, [rank_percentile(c) for c in columns]) / len(columns)
    scored = filled.select("sample", composite.alias("composite"))
    limits = scored.agg(F.percentile("composite", F.array(*map(F.lit, cuts))).alias("_q"))
    out = with_scalars(scored, limits)
    tier = F.when(F.col("composite") >= F.get("_q", F.lit(0)), 1).when(F.col("composite") >= F.get("_q", F.lit(1)), 2).when(F.col("composite") >= F.get("_q", F.lit(2)), 3).otherwise(4)
    return out.select("sample", "composite", tier.alias("tier"), (tier <= 2).alias("is_outlier"))


def relationship(kinship: Column) -> Column:
    """The class of a kinship coefficient; null below the third degree."""
    out = F.lit(None).cast("string")
    for bound, name in reversed(CLASSES):
        out = F.when(kinship >= bound, name).otherwise(out)
    return out


def related_pairs(edges: DataFrame, least: float = 0.0884) -> DataFrame:
    """Edges of at least `least` with their class."""
    return edges.filter(F.col("kinship") >= least).withColumn("relationship", relationship(F.col("kinship")))


def relationship_summary(pairs: DataFrame) -> DataFrame:
    """relationship, n_pairs, n_individuals."""
    ends = pairs.select("relationship", F.col("id1").alias("id")).unionByName(pairs.select("relationship", F.col("id2").alias("id")))
    return pairs.groupBy("relationship").agg(F.count("*").alias("n_pairs")).join(ends.groupBy("relationship").agg(F.countDistinct("id").alias("n_individuals")), "relationship")


def component_labels(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """node, component: the least node reachable over edges (id1, id2). Labels spread along edges and jump along
    themselves, so rounds grow with the logarithm of a component's diameter; each round's labels are checkpointed."""
    both = edges.select("id1", "id2").unionByName(edges.select(F.col("id2").alias("id1"), F.col("id1").alias("id2"))).distinct()
    labels = both.groupBy("id1").agg(F.least(F.col("id1"), F.min("id2")).alias("label")).withColumnRenamed("id1", "node").cache()
    for _ in range(most_rounds):
        near = both.join(labels, both["id2"] == labels["node"]).groupBy("id1").agg(F.min("label").alias("near"))
        spread = labels.join(near, labels["node"] == near["id1"]).select("node", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        jump = spread.select(F.col("node").alias("via"), F.col("label").alias("far"))
        after = spread.join(jump, spread["label"] == jump["via"]).select("node", F.col("far").alias("label"), "old")
        new = settled(after)
        changed = not new.filter("label != old").isEmpty()
        labels = new.select("node", "label")
        if not changed:
            break
    else:
        raise RuntimeError(f"components are not stable after {most_rounds} rounds")
    return labels.withColumnRenamed("label", "component")


def settled(df: DataFrame) -> DataFrame:
    """A checkpoint in the folder the session names; where it names none, as in tests, the cache."""
    spark = df.sparkSession
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return df.checkpoint() if named else df.cache()


def greedy_unrelated(edges: DataFrame, missing: DataFrame, group_edges: int = 20_000, most_rounds: int = 10_000) -> DataFrame:
    """removed ids: the node with most relatives goes (ties: higher missing rate, then least ordinal, then least id) until no
    pair is left. missing: id, missing_rate, ordinal; an unknown rate comes after all others, an unknown ordinal too.

    A round takes out every node that outranks all its neighbours. Its neighbours only lose relatives until then and it
    keeps its own, so one after another they would go in the same way: the outcome is that of single removals. Components
    of up to `group_edges` edges are finished by single removals instead, each in a group of its own; larger ones go on in
    rounds until they have fallen apart.
    """
    spark, kind = edges.sparkSession, dict(edges.dtypes)["id1"]
    both = edges.select(F.col("id1").alias("a"), F.col("id2").alias("b")).filter("a <> b")
    both = settled(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    facts = settled(missing.groupBy(F.col("id").alias("a")).agg(F.max(F.coalesce(F.col("missing_rate").cast("double"), F.lit(-1.0))).alias("m"), F.min("ordinal").alias("o")))
    gone = spark.createDataFrame([], f"id {kind}")

    def prune(pdf: pd.DataFrame) -> pd.DataFrame:
        near: dict = {}
        known: dict = {}
        for a, b, m, o in pdf[["a", "b", "m", "o"]].itertuples(index=False):
            near.setdefault(a, set()).add(b)
            unknown = o is None or o != o
            known[a] = (1.0 if m is None or m != m else -m, unknown, 0 if unknown else o)
        out = []
        while any(near.values()):
            worst = min(near, key=lambda x: (-len(near[x]), *known[x], x))
            out.append(worst)
            for y in near.pop(worst):
                near[y].discard(worst)
        return pd.DataFrame({"id": out})

    for round_ in range(most_rounds):
        if both.isEmpty():
            return gone
        if round_ % 8 == 0:  # what has become small is finished here
            labels = settled(component_labels(both.select(F.col("a").alias("id1"), F.col("b").alias("id2"))))
            sizes = both.join(labels, both["a"] == labels["node"]).groupBy("component").count()
            few = settled(labels.join(sizes.filter(F.col("count") <= 2 * group_edges), "component").select(F.col("node").alias("a"), "component"))
            groups = both.join(few, "a").join(facts, "a", "left")
            gone = settled(gone.unionByName(groups.groupBy("component").applyInPandas(prune, f"id {kind}")))
            both = settled(both.join(few, "a", "left_anti"))
            continue
        high, low = F.struct("d", F.coalesce("m", F.lit(-1.0)).alias("m")), F.struct(F.col("o").isNull().alias("u"), "o", "a")
        rank = both.groupBy("a").agg(F.count("*").alias("d")).join(facts, "a", "left").select("a", high.alias("high"), low.alias("low"))
        sides = both.join(rank, "a").join(rank.select(F.col("a").alias("b"), F.col("high").alias("high_b"), F.col("low").alias("low_b")), "b")
        beaten = (F.col("high_b") > F.col("high")) | ((F.col("high_b") == F.col("high")) & (F.col("low_b") < F.col("low")))
        first = settled(sides.groupBy("a").agg(F.max(beaten).alias("beaten")).filter("NOT beaten").select(F.col("a").alias("id")))
        gone = settled(gone.unionByName(first))
        both = settled(both.join(first, both["a"] == first["id"], "left_anti").join(first, F.col("b") == first["id"], "left_anti"))
    raise RuntimeError(f"pairs are left after {most_rounds} rounds")


def correlations(long: DataFrame, block: int = 256, strip: int = 16_384) -> DataFrame:
    """f1 < f2, n, r, p: Pearson correlation of every pair of features over the samples that have both, and its two-sided
    p-value by the t distribution (null under three samples).

    A blocked matrix product: features are cut into blocks of about `block`, samples into strips of about `strip`; a task
    multiplies two blocks of one strip, values and marks of what is there, and the strips' sums meet by pair. A value is
    sent once a block, not once a feature, and no task holds more than a strip of two blocks.
    """
    from assayloom.operators.association import t_two_sided

    rows = long.filter("value IS NOT NULL").select("sample", "feature", F.col("value").cast("double").alias("value"))
    facts = rows.agg(F.count_distinct("feature").alias("features"), F.count_distinct("sample").alias("samples")).head()
    blocks, strips = max(1, -(-facts["features"] // block)), max(1, -(-facts["samples"] // strip))
    means = rows.groupBy("feature").agg(F.avg("value").alias("_mean"))  # sums of centred values keep their digits
    own = F.pmod(F.xxhash64("feature"), F.lit(blocks)).cast("int")
    placed = rows.join(means, "feature").select("sample", "feature", (F.col("value") - F.col("_mean")).alias("value"), own.alias("own"), F.pmod(F.xxhash64("sample"), F.lit(strips)).cast("int").alias("strip"))
    sent = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumns({"q": F.least("own", "other"), "r": F.greatest("own", "other")})
    kind = dict(long.dtypes)["feature"]

    def multiply(pdf: pd.DataFrame) -> pd.DataFrame:
        names, column = np.unique(pdf["feature"].to_numpy(), return_inverse=True)
        samples, row = np.unique(pdf["sample"].to_numpy(), return_inverse=True)
        x, there = np.zeros((len(samples), len(names))), np.zeros((len(samples), len(names)))
        x[row, column], there[row, column] = pdf["value"].to_numpy(), 1.0
        q, r = pdf["q"].iloc[0], pdf["r"].iloc[0]
        side = np.zeros(len(names), int)
        side[column] = pdf["own"].to_numpy()
        left, right = np.flatnonzero(side == q), np.flatnonzero(side == r)
        a, b, m, k = x[:, left], x[:, right], there[:, left], there[:, right]
        i, j = np.meshgrid(left, right, indexing="ij")
        # of two different blocks every pair, of a block with itself every pair once; the lesser name first
        keep = names[i] < names[j] if q == r else np.ones(i.shape, bool)
        swap = (names[i] > names[j])[keep]
        sums = [s[keep] for s in (m.T @ k, a.T @ k, m.T @ b, (a * a).T @ k, m.T @ (b * b), a.T @ b)]
        f, g = names[i][keep], names[j][keep]
        turn = lambda u, v: (np.where(swap, v, u), np.where(swap, u, v))
        (f1, f2), (x1, x2), (q1, q2) = turn(f, g), turn(sums[1], sums[2]), turn(sums[3], sums[4])
        return pd.DataFrame({"f1": f1, "f2": f2, "n": sums[0].astype(np.int64), "x1": x1, "x2": x2, "q1": q1, "q2": q2, "c": sums[5]})

    parts = sent.groupBy("strip", "q", "r").applyInPandas(multiply, f"f1 {kind}, f2 {kind}, n long, x1 double, x2 double, q1 double, q2 double, c double")
    s = parts.groupBy("f1", "f2").agg(*[F.sum(c).alias(c) for c in ("n", "x1", "x2", "q1", "q2", "c")]).filter("n > 0")
    n = F.col("n")
    spread = F.sqrt((F.col("q1") - F.col("x1") * F.col("x1") / n) * (F.col("q2") - F.col("x2") * F.col("x2") / n))
    r = F.when(spread > 1e-12 * F.sqrt(F.col("q1") * F.col("q2")), F.greatest(F.least((F.col("c") - F.col("x1") * F.col("x2") / n) / spread, F.lit(1.0)), F.lit(-1.0)))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            df, r = b["n"].to_numpy(float) - 2, b["r"].to_numpy(float)
            with np.errstate(divide="ignore", invalid="ignore"):
                t = r * np.sqrt(df / np.maximum(1 - r * r, 0))
                known = np.isfinite(r) & (df > 0)
                p = np.full(len(b), np.nan)
                sure = known & np.isinf(t)
                p[sure] = 0.0
                known &= ~sure
                if known.any():
                    p[known] = t_two_sided(t[known], df[known])
            yield b.assign(p=pd.Series(p, b.index).where(~np.isnan(p), None).astype(float))

    out = s.select("f1", "f2", "n", r.alias("r")).mapInPandas(judge, f"f1 {kind}, f2 {kind}, n long, r double, p double")
    return out.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in ("r", "p")})


def correlation_groups(long: DataFrame, least: float = 0.80) -> DataFrame:
    """feature, group_id: components of the graph of |r| > least; numbered by their first feature, singletons too."""
    edges = correlations(long).filter(F.abs("r") > least).select(F.col("f1").alias("id1"), F.col("f2").alias("id2"))
    labels = component_labels(edges)
    features = long.select("feature").distinct()
    out = features.join(labels, features["feature"] == labels["node"], "left").select("feature", F.coalesce("component", "feature").alias("component"))
    roots = out.select("component").distinct().withColumn("group_id", F.row_number().over(Window.orderBy("component")))  # a row a feature at most
    return out.join(roots, "component").select("feature", "group_id")


def best_per_group(fits: DataFrame) -> DataFrame:
    """`fits` (group_id, feature, p, r2) with selected: least p, then greatest r2, then feature."""
    order = Window.partitionBy("group_id").orderBy(F.asc_nulls_last("p"), F.desc_nulls_last("r2"), "feature")
    return fits.withColumn("selected", F.row_number().over(order) == 1)


def duplicate_check(pairs: DataFrame, missing: DataFrame, removed: DataFrame) -> DataFrame:
    """For duplicate pairs: the id that should stay (less missing, then the smaller id), whether it did, whether the other went."""
    facts = missing.select("id", "missing_rate")
    dup = pairs.filter("relationship = 'duplicate'")
    dup = dup.join(facts.select(F.col("id").alias("id1"), F.col("missing_rate").alias("m1")), "id1", "left").join(facts.select(F.col("id").alias("id2"), F.col("missing_rate").alias("m2")), "id2", "left")
    first = (F.col("m1") < F.col("m2")) | ((F.col("m1") == F.col("m2")) & (F.col("id1") < F.col("id2")))
    out = dup.select("id1", "id2", F.when(first, F.col("id1")).otherwise(F.col("id2")).alias("keep"), F.when(first, F.col("id2")).otherwise(F.col("id1")).alias("drop"))
    gone = removed.select(F.col("id"), F.lit(True).alias("_g")).distinct()
    out = out.join(gone.withColumnRenamed("id", "keep").withColumnRenamed("_g", "_k"), "keep", "left").join(gone.withColumnRenamed("id", "drop").withColumnRenamed("_g", "_d"), "drop", "left")
    return out.select("id1", "id2", "keep", F.coalesce(~F.col("_k"), F.lit(True)).alias("kept"), F.coalesce("_d", F.lit(False)).alias("other_removed"))
