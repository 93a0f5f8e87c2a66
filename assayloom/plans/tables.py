"""Queries of the tables behind reports, and of the training steps that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayloom.functions.stats import zscore
from assayloom.operators import association, prediction
from assayloom.plans.harmony import COV, with_covariates
from assayloom.plans.quality import ZS
from assayloom.plans.registry import M, correlation_p_sql, matrix, projections, projections_sql, query, rounded, table

GAPS = f"{M}, g AS (SELECT sample, feature, CASE WHEN (sample + feature) % 17 > 0 THEN value END AS value FROM m)"


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = matrix(spark, sf_dir)
    return m.select("sample", "feature", F.when((F.col("sample") + F.col("feature")) % 17 > 0, F.col("value")).alias("value"))


@query(f"WITH {GAPS}, t AS (SELECT feature, avg(value) AS mu FROM g WHERE sample % 5 > 0 GROUP BY 1) SELECT sample, feature, round(coalesce(value, mu, 0), 6) AS value FROM g LEFT JOIN t USING (feature) WHERE sample % 5 = 0")
def mean_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = gaps(spark, sf_dir)
    return rounded(prediction.mean_imputed(g.filter("sample % 5 > 0"), g.filter("sample % 5 = 0")).select("sample", "feature", "value"), "value")


@query(f"WITH {GAPS}, t AS (SELECT feature, avg(value) AS mu, stddev_samp(value) AS s FROM g WHERE sample % 5 > 0 GROUP BY 1) SELECT sample, feature, round((value - mu) / CASE WHEN s > 0 THEN s ELSE 1 END, 6) AS value FROM g JOIN t USING (feature) WHERE sample % 5 = 0")
def standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = gaps(spark, sf_dir)
    return rounded(prediction.standardised(g.filter("sample % 5 > 0"), g.filter("sample % 5 = 0")).select("sample", "feature", "value"), "value")


@query("""WITH c AS (SELECT DISTINCT l_returnflag AS cohort, l_partkey AS feature FROM lineitem WHERE l_quantity > 40) SELECT feature, count(*) AS n, round(count(*) / 3.0::DOUBLE, 6) AS frequency FROM c GROUP BY 1 HAVING count(*) / 3.0 >= 0.5""")
def selection_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = table(spark, sf_dir, "lineitem").filter("l_quantity > 40").select(F.col("l_returnflag").alias("cohort"), F.col("l_partkey").alias("feature"))
    return rounded(prediction.selection_frequency(chosen, 3), "frequency")


@query("SELECT event_type, count(value) AS n, round(stddev_samp(value) / abs(avg(value)), 6) AS cv FROM events GROUP BY 1")
def variation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(association.variation(table(spark, sf_dir, "events"), "event_type"), "cv")


@query(f"""WITH {ZS}, f AS (SELECT sample, feature FROM z WHERE abs(z) > 2.5), t AS (SELECT feature, count(*) AS t FROM f GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10), g AS (SELECT vec_id AS sample, label % 3 AS grp FROM embeddings)
    SELECT feature, grp, count(*) AS n, round(100.0::DOUBLE * count(*) / t, 6) AS pct FROM f JOIN t USING (feature) LEFT JOIN g USING (sample) GROUP BY feature, t, grp""")
def outliers_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = matrix(spark, sf_dir)
    flagged = m.select("sample", "feature", zscore("value", "feature").alias("z")).filter(F.abs("z") > 2.5).select("sample", "feature")
    groups = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("sample"), (F.col("label") % 3).alias("grp"))
    return rounded(association.outliers_by_group(flagged, groups, 10), "pct")


@query(f"""WITH {M}, k AS (SELECT sample, {projections_sql("abc")} FROM m GROUP BY 1), s AS (SELECT sample, 1 AS pc, a AS score FROM k UNION ALL SELECT sample, 2, b FROM k UNION ALL SELECT sample, 3, c FROM k)
    SELECT pc, m.feature, round(corr(value, score), 6) AS r FROM m JOIN s USING (sample) GROUP BY ALL""")
def component_effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against three scores of the whole matrix."""
    m = matrix(spark, sf_dir)
    scores = projections(m, "abc").unpivot("sample", ["a", "b", "c"], "_c", "score").select("sample", (F.ascii("_c") - 96).alias("pc"), "score")
    return rounded(association.component_effects(m, scores), "r")


@query(f"""WITH {COV}, c AS (SELECT feature, count(value) FILTER (age IS NOT NULL) AS n, corr(value, age) AS r FROM x GROUP BY 1) SELECT feature, n, round(r, 6) AS r, round({correlation_p_sql("r", "n")}, 6) AS p FROM c""")
def correlation_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(association.correlation_test(with_covariates(spark, sf_dir), "age").select("feature", "n", "r", "p"), "r", "p")


@query(f"WITH {ZS}, j AS (SELECT value, z FROM m JOIN z USING (sample, feature)) SELECT regr_count(z, value)::BIGINT AS n, round(regr_slope(z, value), 6) AS slope, round(regr_r2(z, value), 6) AS r2 FROM j")
def value_on_z(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = matrix(spark, sf_dir).withColumn("z", zscore("value", "feature"))
    return rounded(association.value_on_z(m, "value", "z"), "slope", "r2")


@query(f"""WITH {COV}, a AS (SELECT feature, regr_slope(value, age) AS b, avg(age) FILTER (value IS NOT NULL) AS mx FROM x WHERE age IS NOT NULL GROUP BY 1), y AS (SELECT x.*, CASE WHEN age IS NULL THEN value ELSE value - b * (age - mx) END AS w FROM x JOIN a USING (feature)),
    e AS (SELECT feature, corr(value, sample) AS r0, corr(w, sample) AS r1 FROM y GROUP BY 1) SELECT 'r' AS effect, round(avg(abs(r0)), 6) AS before, round(avg(abs(r1)), 6) AS after, round((avg(abs(r0)) - avg(abs(r1))) * 100 / avg(abs(r0)), 3) AS pct_reduction FROM e""")
def effect_reduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assayloom.operators.normalize import covariate_residualise

    x = with_covariates(spark, sf_dir)
    effect = lambda df: association.component_effects(df.select("sample", "feature", "value"), x.select("sample", F.lit(1).alias("pc"), F.col("sample").cast("double").alias("score")).distinct())
    out = association.effect_reduction(effect(x), effect(covariate_residualise(x, "age")), "r")
    return rounded(rounded(out, "before", "after"), "pct_reduction", digits=3)


@query(None)
def trained_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assayloom.plans.relations import scored

    return prediction.trained_k(scored(spark, sf_dir), "score", "label")
