"""Outlier detectors and the tables that bring them together (survey D, H1-H9, J)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayloom.functions.stats import center_and_mad, with_scalars, zscore


def sample_missingness(long: DataFrame, most: float = 0.10) -> DataFrame:
    """sample, n_missing, n_measured, missing_rate, qc_pass. A cell that is absent counts as missing; the grid is never built."""
    features = long.agg(F.countDistinct("feature").alias("_f"))
    out = with_scalars(long.groupBy("sample").agg(F.count("value").alias("n_measured")), features)
    out = out.withColumn("n_missing", F.col("_f") - F.col("n_measured")).withColumn("missing_rate", F.col("n_missing") / F.col("_f"))
    return out.select("sample", "n_missing", "n_measured", "missing_rate", (F.col("missing_rate") <= most).alias("qc_pass"))


def plate_stats(rows: DataFrame, plate: str = "plate", k: float = 5.0) -> DataFrame:
    """Per plate: samples, mean, sd, median, missing rate, and whether its mean lies over k MADs from the plates' median.

    With a boolean column `failed` (the cell's sample failed QC) also qc_fail_rate, its share."""
    failed = [F.avg(F.coalesce(F.col("failed"), F.lit(False)).cast("int")).alias("qc_fail_rate")] if "failed" in rows.columns else []
    stats = rows.groupBy(plate).agg(
        F.countDistinct("sample").alias("n_samples"),
        F.avg("value").alias("mean_value"),
        F.stddev_samp("value").alias("sd_value"),
        F.median("value").alias("median_value"),
        F.avg(F.col("value").isNull().cast("int")).alias("missing_rate"),
        *failed,
    )
    return beyond_mad(stats, "mean_value", k, "outlier")


def beyond_mad(df: DataFrame, value: str, k: float, flag: str) -> DataFrame:
    """`df` with a flag for |value - median| > k * MAD over all rows."""
    limits = center_and_mad(df, value)
    return with_scalars(df, limits).withColumn(flag, F.abs(F.col(value) - F.col("median")) > F.col("mad") * k).drop("median", "mad")


def month_stats(rows: DataFrame, at: str, k: float = 5.0) -> DataFrame:
    """Per month of `at`: n, mean, sd and the MAD flag on the mean."""
    months = rows.groupBy(F.date_format(at, "yyyy-MM").alias("month")).agg(F.count("value").alias("n"), F.avg("value").alias("mean_value"), F.stddev_samp("value").alias("sd_value"))
    return beyond_mad(months, "mean_value", k, "outlier")


def processing_outliers(rows: DataFrame, start: str, end: str, most_hours: float, k: float = 5.0) -> DataFrame:
    """Rows with hours between two timestamps, kept in (0, most_hours), and the MAD flag."""
    hours = F.timestamp_diff("MICROSECOND", start, end) / 3.6e9
    kept = rows.withColumn("hours", hours).filter((F.col("hours") > 0) & (F.col("hours") < most_hours))
    return beyond_mad(kept, "hours", k, "outlier")


def sample_technical_stats(long: DataFrame, mean_mads: float = 5.0, sd_mads: float = 4.0, missing: float = 0.05, failing: float = 0.3) -> DataFrame:
    """Per sample: n, mean, sd, missing rate; flags for mean (both sides), sd (above) and missing values, and their union.

    With a boolean column `failed` (sample or assay failed QC in that cell) also qc_fail_rate, and qc_outlier where that is
    over `failing`; it is a fourth ground to be an outlier."""
    failed = [F.avg(F.coalesce(F.col("failed"), F.lit(False)).cast("int")).alias("qc_fail_rate")] if "failed" in long.columns else []
    features = long.agg(F.countDistinct("feature").alias("_f"))
    stats = long.groupBy("sample").agg(F.countDistinct(F.when(F.col("value").isNotNull(), F.col("feature"))).alias("n_features"), F.avg("value").alias("mean_value"), F.stddev_samp("value").alias("sd_value"), *failed)
    stats = with_scalars(stats, features).withColumn("missing_rate", 1 - F.col("n_features") / F.col("_f")).drop("_f")
    on_mean = center_and_mad(stats, "mean_value").select(F.col("median").alias("_m"), F.col("mad").alias("_mm"))
    on_sd = center_and_mad(stats, "sd_value").select(F.col("median").alias("_s"), F.col("mad").alias("_sm"))
    out = with_scalars(with_scalars(stats, on_mean), on_sd).withColumns(
        {
            "mean_outlier": F.coalesce(F.abs(F.col("mean_value") - F.col("_m")) > F.col("_mm") * mean_mads, F.lit(False)),
            "sd_outlier": F.coalesce(F.col("sd_value") > F.col("_s") + F.col("_sm") * sd_mads, F.lit(False)),
            "missing_outlier": F.col("missing_rate") > missing,
        }
    )
    flags = ["mean_outlier", "sd_outlier", "missing_outlier"]
    if failed:
        out, flags = out.withColumn("qc_outlier", F.col("qc_fail_rate") > failing), [*flags, "qc_outlier"]
    return out.withColumn("is_outlier", reduce(lambda a, b: a | b, map(F.col, flags))).drop("_m", "_mm", "_s", "_sm")


def zscore_outliers(long: DataFrame, z: float = 4.0, share: float = 0.10) -> DataFrame:
    """Per sample: features beyond |z|, their share of all features, the largest |z|, and the flag."""
    features = long.agg(F.countDistinct("feature").alias("_f"))
    scored = long.withColumn("_z", F.abs(zscore("value", "feature")))
    out = scored.groupBy("sample").agg(F.count_if(F.col("_z") > z).alias("n_outlier_features"), F.max("_z").alias("max_abs_z"))
    out = with_scalars(out, features).withColumn("pct_outlier", F.col("n_outlier_features") / F.col("_f"))
    return out.withColumn("is_outlier", F.col("pct_outlier") > share).drop("_f")


def zscore_iterative(long: DataFrame, z: float = 4.0, share: float = 0.10, rounds: int = 5) -> DataFrame:
    """sample, round: samples flagged round by round on what the rounds before left. A round costs one job; the flagged
    samples alone are kept between rounds."""
    left, flagged = long, None
    for number in range(1, rounds + 1):
        new = zscore_outliers(left, z, share).filter("is_outlier").select("sample", F.lit(number).alias("round")).cache()
        if new.isEmpty():
            break
        flagged = new if flagged is None else flagged.unionByName(new)
        left = left.join(new.select("sample"), "sample", "left_anti")
    return flagged if flagged is not None else long.sparkSession.createDataFrame([], "sample long, round int")


def outlier_cascade(scores: DataFrame, long: DataFrame, pcs: tuple[str, str, str, str], k: float = 5.0, both: bool = False) -> DataFrame:
    """sample and four flags: components 1 and 2, then 3 and 4, then row median, then row IQR, each outside mean +- k sd
    of the samples that all stages before left. `both` also marks stage-2 samples as median outliers, as an older release did."""
    rows = long.groupBy("sample").agg(F.median("value").alias("row_median"), (F.percentile("value", F.lit(0.75)) - F.percentile("value", F.lit(0.25))).alias("row_iqr"))
    left = scores.select("sample", *pcs).join(rows, "sample")
    stages = [("outlier_pc12", pcs[:2]), ("outlier_pc34", pcs[2:]), ("outlier_median", ("row_median",)), ("outlier_iqr", ("row_iqr",))]
    out = left
    alive = F.lit(True)
    for flag, columns in stages:
        kept = out.filter(alive)
        limits = kept.agg(*[f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_samp))])
        outside = reduce(lambda a, b: a | b, [F.abs(F.col(c) - F.col(f"_m_{c}")) > F.col(f"_s_{c}") * k for c in columns])
        out = with_scalars(out, limits).withColumn(flag, alive & F.coalesce(outside, F.lit(False))).drop(*limits.columns)
        alive = alive & ~F.col(flag)
    if both:
        out = out.withColumn("outlier_median", F.col("outlier_median") | F.col("outlier_pc34"))
    flags = [f for f, _ in stages]
    return out.select("sample", "row_median", "row_iqr", *flags, reduce(lambda a, b: a | b, map(F.col, flags)).alias("is_outlier"))


def spread_outliers(long: DataFrame, k: float = 5.0) -> DataFrame:
    """sample, iqr, is_outlier: samples whose interquartile range lies outside mean -+ k sd of all samples'."""
    rows = long.groupBy("sample").agg((F.percentile("value", F.lit(0.75)) - F.percentile("value", F.lit(0.25))).alias("iqr"))
    limits = rows.agg(F.avg("iqr").alias("_m"), F.stddev_samp("iqr").alias("_s"))
    outside = F.abs(F.col("iqr") - F.col("_m")) > F.col("_s") * k
    return with_scalars(rows, limits).select("sample", "iqr", F.coalesce(outside, F.lit(False)).alias("is_outlier"))


def generic_outliers(scores: DataFrame, columns: list[str], k: float = 3.0) -> DataFrame:
    """sample, outlier_score (columns outside mean +- k sd), is_outlier."""
    limits = scores.agg(*[f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_samp))])
    each = [F.coalesce((F.abs(F.col(c) - F.col(f"_m_{c}")) > F.col(f"_s_{c}") * k).cast("int"), F.lit(0)) for c in columns]
    total = reduce(lambda a, b: a + b, each)
    return with_scalars(scores, limits).select("sample", total.alias("outlier_score"), (total > 0).alias("is_outlier"))


def combined_flags(flags: dict[str, DataFrame]) -> DataFrame:
    """sample, an int flag for each detector, n_methods, detection_steps, of all samples that any detector names."""
    rows = reduce(lambda a, b: a.unionByName(b), [df.select("sample", F.lit(name).alias("method")) for name, df in flags.items()])
    marks = [F.max((F.col("method") == n).cast("int")).alias(n) for n in flags]
    out = rows.groupBy("sample").agg(*marks)
    return out.withColumns({"n_methods": reduce(lambda a, b: a + b, map(F.col, flags)), "detection_steps": F.concat_ws(",", *[F.when(F.col(n) == 1, F.lit(n)) for n in flags])})


def comprehensive_qc(samples: DataFrame, flags: dict[str, DataFrame], metrics: list[DataFrame] | None = None) -> DataFrame:
    """Every sample with all flags (0 where none), qc_flag, n_methods, detection_steps and the metrics of each step."""
    out = samples.select("sample").join(combined_flags(flags), "sample", "left")
    out = out.fillna(0, [*flags, "n_methods"]).fillna("", ["detection_steps"]).withColumn("qc_flag", (F.col("n_methods") > 0).cast("int"))
    for m in metrics or []:
        out = out.join(m, "sample", "left")
    return out


def overlap_patterns(qc: DataFrame, flags: list[str]) -> DataFrame:
    """detection_steps, n: how many samples each combination of detectors names."""
    return qc.filter("n_methods > 0").groupBy("detection_steps").agg(F.count("*").alias("n"))


def method_counts(qc: DataFrame, flags: list[str]) -> DataFrame:
    """method, n: samples each detector names; one pass over the table."""
    sums = qc.agg(*[F.sum(f).alias(f) for f in flags])
    return sums.unpivot([], flags, "method", "n")


def outlier_rate(rows: DataFrame, by: str, flag: str) -> DataFrame:
    """by, n, n_outlier, rate."""
    return rows.groupBy(by).agg(F.count("*").alias("n"), F.sum(F.col(flag).cast("int")).alias("n_outlier"), F.avg(F.col(flag).cast("int")).alias("rate"))


def best_sample_per_person(stats: DataFrame, person: str = "person") -> DataFrame:
    """One sample a person: least missing, most detected, least sd (null is worst), then the least id."""
    order = Window.partitionBy(person).orderBy(F.asc("missing_rate"), F.desc("n_detected"), F.coalesce("sd_value", F.lit(float("inf"))).asc(), F.asc("sample"))
    return stats.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")


def disease_group(meta: DataFrame, flags: list[str], key: str = "sample") -> DataFrame:
    """key, disease_group: None, the one true flag's name, or Multiple."""
    true = F.filter(F.array(*[F.when(truthy(F.col(f)), F.lit(f)) for f in flags]), lambda x: x.isNotNull())
    return meta.select(key, F.when(F.size(true) == 0, "None").when(F.size(true) == 1, F.element_at(true, 1)).otherwise("Multiple").alias("disease_group"))


def truthy(c: Column) -> Column:
    """Whether a flag of any spelling is set: true, t, yes, y or a number other than 0."""
    text = F.lower(F.trim(c.cast("string")))
    number = text.try_cast("double")
    return F.coalesce(text.isin("true", "t", "yes", "y") | F.coalesce(number != 0, F.lit(False)), F.lit(False))
