"""Which variants tell swapped samples from others: cohorts of injected errors, a cross-validated lasso each, and the cut-offs
on what it chose (survey I6, I18, H60, D20)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayloom.operators import genetics, prediction
from assayloom.operators.netpath import one_error


def moved(long: DataFrame, errors: DataFrame) -> DataFrame:
    """Measurements under the samples that errors (sample, source) give them to."""
    to = errors.select(F.col("source").alias("sample"), F.col("sample").alias("_to"))
    return long.join(to, "sample").drop("sample").withColumnRenamed("_to", "sample")


def residual_vectors(scored: DataFrame, names: list, signed: bool = True) -> DataFrame:
    """sample, features: the mean standardised residual (or its size) of every variant in `names`, in their order, 0 where a
    sample has none."""
    from pyspark.ml.functions import array_to_vector

    r = F.col("std_residual") if signed else F.abs("std_residual")
    cells = scored.groupBy("sample", "variant").agg(F.avg(r).alias("r"))
    own = cells.groupBy("sample").agg(F.map_from_entries(F.collect_list(F.struct("variant", "r"))).alias("_m"))
    kind = dict(scored.dtypes)["variant"]
    every = scored.sparkSession.createDataFrame([([*names],)], f"_n array<{kind}>")
    filled = F.transform("_n", lambda n: F.coalesce(F.try_element_at("_m", n), F.lit(0.0)))
    return own.crossJoin(F.broadcast(every)).select("sample", array_to_vector(filled).alias("features"))


def cohort(long: DataFrame, genotypes: DataFrame, per_category: int, folds: int, seed: int, strengths: int, signed: bool) -> tuple[list, DataFrame | None]:
    """The variants that a lasso keeps when it tells samples with traded measurements from clean ones, and k, k_mad of the
    cut-offs on their mean |z| and median |residual|; no cut-offs where nothing was kept or a class is absent."""
    people = long.join(genotypes, ["sample", "feature"]).select("sample").distinct().withColumn("label", F.lit(0))
    errors = genetics.settled(prediction.inject_errors(people, per_category, seed).filter("category < 2"))
    scored = genetics.settled(genetics.genotype_z(moved(long, errors).join(genotypes, ["sample", "feature"])))
    labels = errors.select("sample", F.col("category").cast("int").alias("label"))
    spread = scored.groupBy("variant").agg(F.stddev_samp("std_residual").alias("sd")).filter("sd > 1e-6")
    names = [r[0] for r in spread.select("variant").orderBy("variant").collect()]
    wrong = labels.filter("label = 1").count()
    if len(names) < 2 or not wrong or wrong == labels.count():
        return [], None
    vectors = genetics.settled(residual_vectors(scored.join(F.broadcast(spread.select("variant")), "variant", "left_semi"), names, signed).join(labels, "sample"))
    _, weights, _ = one_error(vectors, "label", 1.0, strengths, max(2, min(folds, wrong)), seed, errors=0.0, balanced=False)
    kept = [n for n, w in zip(names, weights, strict=True) if w]
    if not kept:
        return [], None
    stats = genetics.genotype_sample_stats(scored.filter(F.col("variant").isin(kept))).filter("mean_abs_z IS NOT NULL AND median_abs_residual IS NOT NULL")
    stats = genetics.settled(stats.join(labels, "sample"))
    if stats.select("label").distinct().count() < 2:
        return kept, None
    by_z = prediction.trained_k(stats, "mean_abs_z", "label").select("k")
    by_residual = prediction.trained_k(stats, "median_abs_residual", "label").select("k_mad")
    return kept, by_z.crossJoin(by_residual)


def trained_variants(long: DataFrame, genotypes: DataFrame, per_category: int, cohorts: int = 5, folds: int = 5, least: float = 0.5, seed: int = 42, strengths: int = 30, signed: bool = True) -> tuple[DataFrame, DataFrame]:
    """(variants, cut-offs): variant, n, frequency of those that at least a share `least` of the cohorts chose, and one row k,
    k_mad, n_cohorts of the cohorts' mean cut-offs. genotypes: sample, feature, variant, dosage, beta. Both come from the same
    cohorts; a cohort without both classes or without a chosen variant counts for neither. `signed`: the lasso sees the
    residuals as they are, else their sizes, which a swap raises whichever way it goes."""
    spark, kind = long.sparkSession, dict(genotypes.dtypes)["variant"]
    chosen, cuts = [], []
    for c in range(cohorts):
        kept, cut = cohort(long, genotypes, per_category, folds, seed + c, strengths, signed)
        chosen += [(c, v) for v in kept]
        cuts += [] if cut is None else [tuple(cut.head())]
    done = max(1, len({c for c, _ in chosen}))
    frequency = prediction.selection_frequency(spark.createDataFrame(chosen, f"cohort int, feature {kind}"), done, least)
    mean = spark.createDataFrame(cuts, "k double, k_mad double").agg(F.avg("k").alias("k"), F.avg("k_mad").alias("k_mad"), F.count("*").alias("n_cohorts"))
    return frequency.withColumnRenamed("feature", "variant"), mean
