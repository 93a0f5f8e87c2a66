"""Principal components of a long matrix (survey H4, H9, H27, H30): impute, standardise, decompose, project."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Basis:
    """scores (sample, pc, score), loadings (feature, pc, center, scale, loading), variance (pc, variance)."""

    scores: DataFrame
    loadings: DataFrame
    variance: DataFrame


def imputed(long: DataFrame) -> DataFrame:
    """Missing values as the feature's exact median, 0 where it has none. Only features with a gap need theirs."""
    gaps = long.groupBy("feature").agg(F.count_if(F.col("value").isNull()).alias("_n")).filter("_n > 0").select("feature")
    medians = long.join(F.broadcast(gaps), "feature", "left_semi").groupBy("feature").agg(F.median("value").alias("_median"))
    return long.join(F.broadcast(medians), "feature", "left").withColumn("value", F.coalesce("value", "_median", F.lit(0.0))).drop("_median")


def pca(long: DataFrame, k: int) -> Basis:
    """The first k components. The feature-by-feature correlation is summed by Spark from one vector a sample; only that
    square matrix of features is decomposed here. A component's sign makes its largest loading positive."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Correlation

    spark = long.sparkSession
    filled, kind = imputed(long.select("sample", "feature", "value")), dict(long.dtypes)["feature"]
    # features without spread go
    known = filled.groupBy("feature").agg(F.avg("value").alias("center"), F.stddev_samp("value").alias("scale")).filter("scale > 0").collect()
    facts = {r["feature"]: (r["center"], r["scale"]) for r in known}
    units = spark.createDataFrame([tuple(r) for r in known], f"feature {kind}, center double, scale double")
    z = filled.join(F.broadcast(units), "feature").withColumn("z", (F.col("value") - F.col("center")) / F.col("scale"))
    features = sorted(facts)
    vectors = z.groupBy("sample").agg(F.transform(F.sort_array(F.collect_list(F.struct("feature", "z"))), lambda x: x["z"]).alias("v"))
    matrix = Correlation.corr(vectors.select(array_to_vector("v").alias("v")), "v").head()[0].toArray()
    values, axes = np.linalg.eigh(matrix)
    order = np.argsort(values)[::-1][:k]
    axes = axes[:, order] * np.sign(axes[np.abs(axes[:, order]).argmax(0), order])
    rows = [(f, pc + 1, *map(float, facts[f]), float(axes[i, pc])) for i, f in enumerate(features) for pc in range(len(order))]
    loadings = spark.createDataFrame(rows, f"feature {kind}, pc int, center double, scale double, loading double")
    variance = spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(values[order])], "pc int, variance double")
    scores = z.join(F.broadcast(loadings.select("feature", "pc", "loading")), "feature").groupBy("sample", "pc").agg(F.sum(F.col("z") * F.col("loading")).alias("score"))
    return Basis(scores, loadings, variance)


def complete_enough(long: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of samples that have more than a share `least` of all features."""
    features = long.select("feature").distinct().count()
    kept = long.groupBy("sample").agg(F.count("value").alias("_n")).filter(F.col("_n") > least * features).select("sample")
    return long.join(kept, "sample", "left_semi")


def batch_pca(both: DataFrame, bridges: DataFrame, k: int = 10, least: float = 0.5) -> tuple[DataFrame, Basis]:
    """(samples, basis) of two batches together (batch, sample, feature, value): components of the samples that are complete
    enough, missing values as medians; samples are rows sample, batch, sample_type, which is bridge_<batch> for those in
    `bridges` (sample) and regular for others."""
    kept = complete_enough(both, least)
    own = kept.select("sample", "batch").distinct().join(bridges.select("sample", F.lit(True).alias("_b")).distinct(), "sample", "left")
    kind = F.when(F.col("_b"), F.concat(F.lit("bridge_"), F.col("batch").cast("string"))).otherwise("regular")
    return own.select("sample", "batch", kind.alias("sample_type")), pca(kept.select("sample", "feature", "value"), k)
