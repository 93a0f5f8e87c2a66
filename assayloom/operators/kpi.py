"""The alignment report of two batches: every measure of the KPI table from the data, before and after (survey H30-H46)."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayloom.operators import association, genetics, prediction, robust
from assayloom.operators import harmonisation as h
from assayloom.operators.pca import pca


@dataclass
class Batches:
    """before, after: (batch, sample, feature, value) of both batches; bridges: (person, first, second), one person's samples in
    the two batches; replicates: (first, second) of one batch; labels: (sample, label 0/1)."""

    before: DataFrame
    after: DataFrame
    bridges: DataFrame
    replicates: DataFrame
    labels: DataFrame
    first: str
    second: str


def sides(cells: DataFrame, pairs: DataFrame, by: str, value: str) -> DataFrame:
    """person, by, x, y: the cells of both samples of pairs (person, first, second)."""
    side = lambda end, name: pairs.select("person", F.col(end).alias("sample")).join(cells.select("sample", by, F.col(value).alias(name)), "sample").drop("sample")
    return side("first", "x").join(side("second", "y"), ["person", by])


def packed(long: DataFrame) -> DataFrame:
    """batch, sample, features, values: a row a sample, stored; `cells` makes (batch, sample, feature, value) of it again. Each
    measure reads all cells, and a sample's are stored and read much faster together than one by one."""
    cell = F.collect_list(F.struct("feature", "value")).alias("c")
    rows = long.groupBy("batch", "sample").agg(cell)
    return genetics.settled(rows.select("batch", "sample", F.col("c.feature").alias("features"), F.col("c.value").alias("values")))


def cells(rows: DataFrame, *more: str) -> DataFrame:
    """sample, feature, value and `more` columns of packed rows."""
    each = rows.select("sample", *more, "features", F.posexplode("values").alias("_at", "value"))
    return each.select("sample", *more, F.get("features", F.col("_at")).alias("feature"), "value")


def few(df: DataFrame, most: int = 500_000) -> DataFrame:
    """A stored table of ids, to be sent to all tasks if it has at most so many rows; a larger one is joined in a shuffle."""
    return F.broadcast(df) if df.count() <= most else df


def vectors(scores: DataFrame, components: int) -> DataFrame:
    """sample and pc1, pc2, ... as columns."""
    return scores.groupBy("sample").agg(*[F.max(F.when(F.col("pc") == i, F.col("score"))).alias(f"pc{i}") for i in range(1, components + 1)])


def _one(df: DataFrame) -> float | None:
    row = df.head()
    return None if row is None or row[0] is None else float(row[0])


def _median(df: DataFrame, value: str) -> float | None:
    return _one(df.agg(F.median(value)))


def measure(b: Batches, stored: DataFrame, scores: DataFrame, spread: DataFrame, components: int, top: int) -> tuple[dict[str, float | None], DataFrame, DataFrame]:
    """The measures of one side (packed cells and their scores) that stand by themselves, person and whitened distance of the
    bridges, and the bridges' pairs of cells."""
    on_pcs = genetics.settled(sides(scores, b.bridges, "pc", "score"))
    as_features = on_pcs.withColumnRenamed("pc", "feature")
    whitened = genetics.settled(h.scaled_distance(as_features, spread))
    bridges = few(b.bridges)
    ends = bridges.select(F.explode(F.array("first", "second")).alias("sample"))
    on_features = genetics.settled(sides(cells(stored.join(ends, "sample", "left_semi")), bridges, "feature", "value"))
    agreed = association.pair_agreement(on_features).agg(F.median("icc"), F.median("ccc")).head()
    one, other = (as_features.select("person", "feature", F.col(c).alias("value")) for c in "xy")
    batch = genetics.settled(stored.select("sample", "batch").distinct())
    everyone = scores.join(batch.filter(F.col("batch") == b.second).select("sample").distinct(), "sample", "left_semi")
    own = b.bridges.select(F.col("second").alias("sample"), "person")
    strangers = everyone.join(own, "sample", "left").select(F.coalesce("person", F.concat(F.lit("sample "), F.col("sample").cast("string"))).alias("person"), F.col("pc").alias("feature"), F.col("score").alias("value"))
    ranks = association.true_pair_rank(one, strangers).agg(F.avg((F.col("rank") == 1).cast("int")), F.median("rank")).head()
    axes = [f"pc{i}" for i in range(1, components + 1)]
    wide = genetics.settled(vectors(scores, components).join(batch, "sample"))
    from pyspark.ml.functions import array_to_vector

    rows = wide.dropna().select(array_to_vector(F.array(*axes)).alias("features"), (F.col("batch") == b.second).cast("int").alias("_b"))
    mixed = h.mixing(wide, axes, "batch").head()
    people = batch.join(b.labels, "sample", "left").select("sample", "batch", "label")
    long = cells(stored)
    parts = cells(stored.join(few(b.labels), "sample"), "batch", "label").withColumn("_b", (F.col("batch") == b.second).cast("int"))
    gaps = parts.groupBy("feature").agg(F.abs(F.corr("value", F.col("label").cast("double"))).alias("r"))
    names = [r["feature"] for r in gaps.filter("r IS NOT NULL").orderBy(F.desc("r"), "feature").limit(top).collect()]
    shares = h.variance_decomposition(parts, "_b", "label").agg(F.avg("first_share"), F.avg("second_share")).head()
    return {
        "euclidean": _median(association.pair_distance(on_pcs), "distance"),
        "mahalanobis": _median(robust.mahalanobis_distance(on_pcs, scores), "distance"),
        "whitened": _median(whitened, "distance"),
        "icc": agreed[0], "ccc": agreed[1], "rank1": ranks[0], "median_rank": None if ranks[1] is None else float(ranks[1]),
        "silhouette": mixed["silhouette"],
        "kbet": mixed["acceptance"],
        "lisi": mixed["median_lisi"],
        "batch_auc": _one(h.batch_auc(rows, "_b")),
        "label_accuracy": _one(prediction.label_accuracy(long, people, "label", names)) if names else None,
        "batch_variance": shares[0], "label_variance": shares[1],
    }, whitened, on_features


def alignment_report(b: Batches, components: int = 10, top: int = 20) -> DataFrame:
    """metric, pre, post, target, pass of all measures, from the data alone.

    The basis and the spread of the components are those before, for both sides. Both sides' bridges are compared pair by
    pair: the log ratio of their whitened distances with its bootstrapped interval, and the one-sided signed ranks.
    """
    b = replace(b, **{n: genetics.settled(getattr(b, n)) for n in ("bridges", "replicates", "labels")})
    before, after = packed(b.before), packed(b.after)
    basis = pca(cells(before), components)
    basis.loadings = genetics.settled(basis.loadings)
    scores, moved = (genetics.settled(association.project(cells(side), basis.loadings)) for side in (before, after))
    spread = genetics.settled(h.mads(scores.select(F.col("pc").alias("feature"), F.col("score").alias("value"))))
    pre, far, on_before = measure(b, before, scores, spread, components, top)
    post, near, on_after = measure(b, after, moved, spread, components, top)
    twice = b.replicates.select(F.concat_ws(" ", "first", "second").alias("person"), "first", "second")
    noise = h.scaled_distance(sides(scores, twice, "pc", "score").withColumnRenamed("pc", "feature"), spread)
    floor = _median(noise, "distance")
    both = genetics.settled(far.withColumnRenamed("distance", "before").join(near.withColumnRenamed("distance", "after"), "person"))
    interval = robust.log_ratio_interval(both, "before", "after").head()
    ratio = (lambda x: None if x is None or not floor else x / floor)
    for side in (pre, post):
        side |= {"noise_floor": floor, "noise_ratio": ratio(side["whitened"])}
    flagged = association.bridge_flags(near.withColumn("ratio", F.lit(None).cast("double") if not floor else F.col("distance") / floor)).filter("outlier").count()
    poor = association.concordance_change(on_before, on_after).filter("poorly_harmonised").count()
    p = robust.signed_rank(both, "before", "after").head()["p"]
    excludes = None if interval["excludes_zero"] is None else float(interval["excludes_zero"])
    post |= {"log_ratio": interval["median"], "log_ratio_low": interval["low"], "log_ratio_high": interval["high"], "excludes_zero": excludes, "flagged_bridges": float(flagged), "poor_features": float(poor), "p": p}
    return h.kpi_table(pre, post, b.before.sparkSession)
