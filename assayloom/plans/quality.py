"""Queries of the outlier detectors over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayloom.operators import qc
from assayloom.plans.registry import M, matrix, query, rounded, table

EV = "e AS (SELECT user_id AS sample, event_type AS feature, CASE WHEN event_id % 13 <> 0 THEN value END AS value FROM events)"
CELLS = EV + ", c AS (SELECT sample, feature, avg(value) AS value FROM e GROUP BY ALL)"


def events_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users by event type, duplicates averaged, every thirteenth event missing."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("sample"), F.col("event_type").alias("feature"), F.when(F.col("event_id") % 13 != 0, F.col("value")).alias("value"))
    return e.groupBy("sample", "feature").agg(F.avg("value").alias("value"))


TECHNICAL = f"""WITH {CELLS}, f AS (SELECT count(DISTINCT feature) AS f FROM c),
    s AS (SELECT sample, count(DISTINCT feature) FILTER (value IS NOT NULL) AS n_features, avg(value) AS mean_value, stddev_samp(value) AS sd_value FROM c GROUP BY sample),
    m AS (SELECT median(mean_value) AS mm, median(sd_value) AS sm FROM s),
    d AS (SELECT 1.4826::DOUBLE * median(abs(mean_value - mm)) AS md, 1.4826::DOUBLE * median(abs(sd_value - sm)) AS sd FROM s, m),
    o AS (SELECT s.*, 1 - n_features::DOUBLE / f AS missing_rate, coalesce(abs(mean_value - mm) > 5 * md, false) AS mean_outlier,
                 coalesce(sd_value > sm + 4 * d.sd, false) AS sd_outlier, 1 - n_features::DOUBLE / f > 0.05 AS missing_outlier FROM s, m, d, f)
    SELECT sample, n_features, round(mean_value, 6) AS mean_value, round(sd_value, 6) AS sd_value, round(missing_rate, 6) AS missing_rate,
           mean_outlier, sd_outlier, missing_outlier, mean_outlier OR sd_outlier OR missing_outlier AS is_outlier FROM o"""


@query(TECHNICAL)
def sample_technical_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(qc.sample_technical_stats(events_long(spark, sf_dir)), "mean_value", "sd_value", "missing_rate")


@query(f"""WITH {CELLS}, f AS (SELECT count(DISTINCT feature) AS f FROM c)
    SELECT sample, f - count(value) AS n_missing, count(value) AS n_measured, round((f - count(value))::DOUBLE / f, 6) AS missing_rate,
           (f - count(value))::DOUBLE / f <= 0.10 AS qc_pass FROM c, f GROUP BY sample, f""")
def sample_missingness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(qc.sample_missingness(events_long(spark, sf_dir)), "missing_rate")


PLATE = f"""WITH {M}, p AS (SELECT grp AS plate, count(DISTINCT sample) AS n_samples, avg(value) AS mean_value, stddev_samp(value) AS sd_value, median(value) AS median_value,
        avg((value IS NULL)::INT) AS missing_rate FROM m GROUP BY grp),
    a AS (SELECT median(mean_value) AS mm FROM p), d AS (SELECT 1.4826::DOUBLE * median(abs(mean_value - mm)) AS md FROM p, a)
    SELECT plate, n_samples, round(mean_value, 6) AS mean_value, round(sd_value, 6) AS sd_value, round(median_value, 6) AS median_value, missing_rate,
           abs(mean_value - mm) > 5 * md AS outlier FROM p, a, d"""


@query(PLATE)
def plate_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = matrix(spark, sf_dir).withColumnRenamed("grp", "plate")
    return rounded(qc.plate_stats(rows), "mean_value", "sd_value", "median_value")


@query("""WITH p AS (SELECT strftime(l_shipdate, '%Y-%m') AS month, count(l_extendedprice) AS n, avg(l_extendedprice) AS mean_value, stddev_samp(l_extendedprice) AS sd_value FROM lineitem GROUP BY 1),
    a AS (SELECT median(mean_value) AS mm FROM p), d AS (SELECT 1.4826::DOUBLE * median(abs(mean_value - mm)) AS md FROM p, a)
    SELECT month, n, round(mean_value, 4) AS mean_value, round(sd_value, 4) AS sd_value, abs(mean_value - mm) > 3 * md AS outlier FROM p, a, d""")
def month_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumn("value", F.col("l_extendedprice"))
    return rounded(qc.month_stats(rows, "l_shipdate", k=3.0), "mean_value", "sd_value", digits=4)


@query("""WITH h AS (SELECT l_orderkey, l_linenumber, epoch_us(l_shipdate) - epoch_us(o_orderdate) AS us FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    k AS (SELECT l_orderkey, l_linenumber, us / 3.6e9::DOUBLE AS hours FROM h WHERE us > 0 AND us < 3.6e9 * 24 * 60),
    a AS (SELECT median(hours) AS mm FROM k), d AS (SELECT 1.4826::DOUBLE * median(abs(hours - mm)) AS md FROM k, a)
    SELECT l_orderkey, l_linenumber, round(hours, 6) AS hours, abs(hours - mm) > 1.5::DOUBLE * md AS outlier FROM k, a, d""")
def processing_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_linenumber", "o_orderdate", "l_shipdate")
    out = qc.processing_outliers(rows, "o_orderdate", "l_shipdate", most_hours=24.0 * 60, k=1.5)
    return rounded(out.select("l_orderkey", "l_linenumber", "hours", "outlier"), "hours")


ZS = f"""{M}, z AS (SELECT sample, feature, CASE WHEN count(value) OVER w < 3 OR value IS NULL THEN NULL WHEN stddev_samp(value) OVER w > 0
        THEN (value - avg(value) OVER w) / stddev_samp(value) OVER w ELSE 0 END AS z FROM m WINDOW w AS (PARTITION BY feature))"""


@query(f"WITH {ZS} SELECT sample, feature, round(z, 6) AS z FROM z")
def zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assayloom.functions.stats import zscore as z

    return rounded(matrix(spark, sf_dir).select("sample", "feature", z("value", "feature").alias("z")), "z")


@query(f"""WITH {ZS}, f AS (SELECT count(DISTINCT feature) AS f FROM m)
    SELECT sample, count(*) FILTER (abs(z) > 2) AS n_outlier_features, round(max(abs(z)), 6) AS max_abs_z, count(*) FILTER (abs(z) > 2) / f::DOUBLE AS pct_outlier,
           count(*) FILTER (abs(z) > 2) / f::DOUBLE > 0.1 AS is_outlier FROM z, f GROUP BY sample, f""")
def zscore_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(qc.zscore_outliers(matrix(spark, sf_dir), z=2.0), "max_abs_z")


def _round_sql(n: int) -> str:
    before = "m" if n == 1 else f"m{n - 1}"
    return f"""z{n} AS (SELECT sample, (value - avg(value) OVER w) / nullif(stddev_samp(value) OVER w, 0) AS z FROM {before} WINDOW w AS (PARTITION BY feature)),
        g{n} AS (SELECT sample FROM z{n} GROUP BY sample HAVING count(*) FILTER (abs(z) > 2) / 64.0 > 0.1), m{n} AS (SELECT * FROM {before} WHERE sample NOT IN (SELECT sample FROM g{n}))"""


@query(f"WITH {M}, {_round_sql(1)}, {_round_sql(2)}, {_round_sql(3)} SELECT sample, 1 AS round FROM g1 UNION ALL SELECT sample, 2 FROM g2 UNION ALL SELECT sample, 3 FROM g3")
def zscore_iterative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.zscore_iterative(matrix(spark, sf_dir), z=2.0, rounds=3)


CASCADE = f"""WITH {M}, s AS (SELECT sample, max(value) FILTER (feature = 0) AS a, max(value) FILTER (feature = 1) AS b, max(value) FILTER (feature = 2) AS c, max(value) FILTER (feature = 3) AS d,
        median(value) AS row_median, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS row_iqr FROM m GROUP BY sample),
    s1 AS (SELECT s.*, abs(a - (SELECT avg(a) FROM s)) > 2 * (SELECT stddev_samp(a) FROM s) OR abs(b - (SELECT avg(b) FROM s)) > 2 * (SELECT stddev_samp(b) FROM s) AS f1 FROM s),
    k1 AS (SELECT * FROM s1 WHERE NOT f1),
    s2 AS (SELECT s1.*, NOT f1 AND (abs(c - (SELECT avg(c) FROM k1)) > 2 * (SELECT stddev_samp(c) FROM k1) OR abs(d - (SELECT avg(d) FROM k1)) > 2 * (SELECT stddev_samp(d) FROM k1)) AS f2 FROM s1),
    k2 AS (SELECT * FROM s2 WHERE NOT f1 AND NOT f2),
    s3 AS (SELECT s2.*, NOT f1 AND NOT f2 AND abs(row_median - (SELECT avg(row_median) FROM k2)) > 2 * (SELECT stddev_samp(row_median) FROM k2) AS f3 FROM s2),
    k3 AS (SELECT * FROM s3 WHERE NOT f1 AND NOT f2 AND NOT f3),
    s4 AS (SELECT s3.*, NOT f1 AND NOT f2 AND NOT f3 AND abs(row_iqr - (SELECT avg(row_iqr) FROM k3)) > 2 * (SELECT stddev_samp(row_iqr) FROM k3) AS f4 FROM s3)
    SELECT sample, round(row_median, 6) AS row_median, round(row_iqr, 6) AS row_iqr, f1 AS outlier_pc12, f2 AS outlier_pc34, f3 AS outlier_median, f4 AS outlier_iqr, f1 OR f2 OR f3 OR f4 AS is_outlier FROM s4"""


def raw_scores(long: DataFrame) -> DataFrame:
    """The first four features as scores: what the cascade does doesn't depend on where its scores come from."""
    return long.groupBy("sample").agg(*[F.max(F.when(F.col("feature") == i, F.col("value"))).alias(c) for i, c in enumerate("abcd")])


@query(CASCADE)
def outlier_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = matrix(spark, sf_dir)
    return rounded(qc.outlier_cascade(raw_scores(long), long, ("a", "b", "c", "d"), k=2.0), "row_median", "row_iqr")


@query(f"""WITH {M}, s AS (SELECT sample, max(value) FILTER (feature = 0) AS a, max(value) FILTER (feature = 1) AS b, max(value) FILTER (feature = 2) AS c FROM m GROUP BY sample),
    l AS (SELECT avg(a) AS ma, stddev_samp(a) AS sa, avg(b) AS mb, stddev_samp(b) AS sb, avg(c) AS mc, stddev_samp(c) AS sc FROM s)
    SELECT sample, (abs(a - ma) > 2 * sa)::INT + (abs(b - mb) > 2 * sb)::INT + (abs(c - mc) > 2 * sc)::INT AS outlier_score,
           (abs(a - ma) > 2 * sa) OR (abs(b - mb) > 2 * sb) OR (abs(c - mc) > 2 * sc) AS is_outlier FROM s, l""")
def generic_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.generic_outliers(raw_scores(matrix(spark, sf_dir)), ["a", "b", "c"], k=2.0)


FLAGS = f"""{M}, s AS (SELECT sample, avg(value) AS m, stddev_samp(value) AS sd, max(abs(value)) AS top FROM m GROUP BY sample),
    q AS (SELECT sample, (m > 0.02)::INT AS high_mean, (sd > 0.13)::INT AS high_sd, (top > 0.4)::INT AS extreme FROM s)"""
UNION = f"""{FLAGS}, u AS (SELECT sample, high_mean, high_sd, extreme, high_mean + high_sd + extreme AS n_methods,
        concat_ws(',', CASE WHEN high_mean = 1 THEN 'high_mean' END, CASE WHEN high_sd = 1 THEN 'high_sd' END, CASE WHEN extreme = 1 THEN 'extreme' END) AS detection_steps FROM q)"""


def qc_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = matrix(spark, sf_dir).groupBy("sample").agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("sd"), F.max(F.abs("value")).alias("top"))
    flags = {"high_mean": s.filter("m > 0.02"), "high_sd": s.filter("sd > 0.13"), "extreme": s.filter("top > 0.4")}
    return qc.comprehensive_qc(s, flags, [s.select("sample", F.round("m", 6).alias("mean_value"))])


@query(f"WITH {UNION} SELECT u.*, (n_methods > 0)::INT AS qc_flag, round(m, 6) AS mean_value FROM u JOIN s USING (sample)")
def qc_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc_table(spark, sf_dir)


@query(f"WITH {UNION} SELECT detection_steps, count(*) AS n FROM u WHERE n_methods > 0 GROUP BY 1")
def qc_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.overlap_patterns(qc_table(spark, sf_dir), ["high_mean", "high_sd", "extreme"])


@query(f"WITH {UNION} SELECT 'high_mean' AS method, sum(high_mean)::BIGINT AS n FROM u UNION ALL SELECT 'high_sd', sum(high_sd)::BIGINT FROM u UNION ALL SELECT 'extreme', sum(extreme)::BIGINT FROM u")
def qc_method_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.method_counts(qc_table(spark, sf_dir), ["high_mean", "high_sd", "extreme"])


@query("SELECT l_returnflag, count(*) AS n, sum((l_quantity > 45)::INT)::BIGINT AS n_outlier, round(avg((l_quantity > 45)::INT), 6) AS rate FROM lineitem GROUP BY 1")
def outlier_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", (F.col("l_quantity") > 45).alias("flag"))
    return rounded(qc.outlier_rate(rows, "l_returnflag", "flag"), "rate")


@query("""WITH d AS (SELECT doc_id AS sample, lang = 'en' AS english, source = 'src1' AS first, n_chars > 2000 AS long FROM documents)
    SELECT sample, CASE english::INT + first::INT + long::INT WHEN 0 THEN 'None' WHEN 1 THEN CASE WHEN english THEN 'english' WHEN first THEN 'first' ELSE 'long' END ELSE 'Multiple' END AS disease_group FROM d""")
def disease_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    flags = d.select(F.col("doc_id").alias("sample"), (F.col("lang") == "en").alias("english"), (F.col("source") == "src1").alias("first"), (F.col("n_chars") > 2000).alias("long"))
    return qc.disease_group(flags, ["english", "first", "long"])


@query("""WITH s AS (SELECT o_custkey AS person, o_orderkey AS sample, (o_orderkey % 5) / 10.0::DOUBLE AS missing_rate, o_orderkey % 7 AS n_detected, CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice END AS sd_value FROM orders)
    SELECT * EXCLUDE r FROM (SELECT *, row_number() OVER (PARTITION BY person ORDER BY missing_rate, n_detected DESC, coalesce(sd_value, 'inf'::DOUBLE), sample) AS r FROM s) WHERE r = 1""")
def best_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    s = o.select(F.col("o_custkey").alias("person"), F.col("o_orderkey").alias("sample"), (F.col("o_orderkey") % 5 / 10.0).alias("missing_rate"), (F.col("o_orderkey") % 7).alias("n_detected"), F.when(F.col("o_orderkey") % 3 > 0, F.col("o_totalprice")).alias("sd_value"))
    return qc.best_sample_per_person(s)
