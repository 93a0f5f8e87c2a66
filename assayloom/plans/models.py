"""Queries of models and of the whole study over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayloom.functions.blocks import normal_ranks
from assayloom.functions.stats import qnorm_sql
from assayloom.operators import harmonisation as h
from assayloom.operators import association, netpath, normalize, prediction, qc
from assayloom.plans.alignment import AXES, _scores
from assayloom.plans.harmony import COV, PAIRS, pairs, with_covariates
from assayloom.plans.registry import M, matrix, query, rounded
from assayloom.plans.relations import ALPHAS, SCORED, scored
from assayloom.plans.study import StudyPlan


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sample, label, features: the vectors of the matrix."""
    v = prediction.wide_vectors(matrix(spark, sf_dir), "grp")
    return v.select("sample", (F.col("grp") < 5).cast("int").alias("label"), "features")


@query(f"""WITH {COV}, f AS (SELECT feature, regr_slope(value, age) AS b, avg(age) AS mx FROM x WHERE age IS NOT NULL GROUP BY 1), a AS (SELECT sample, feature, CASE WHEN age IS NULL THEN value ELSE value - b * (age - mx) END AS value FROM x JOIN f USING (feature)),
    r AS (SELECT sample, feature, (rank() OVER (PARTITION BY feature ORDER BY value) + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0::DOUBLE - 0.5::DOUBLE) / count(*) OVER (PARTITION BY feature) AS p FROM a) SELECT sample, feature, round({qnorm_sql("p")}, 6) AS value FROM r""")
def residual_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values without the covariate's part, ranked anew."""
    left = normalize.covariate_residualise(with_covariates(spark, sf_dir), "age")
    return rounded(normal_ranks(left.select("sample", "feature", "value"), "value", "feature"), "value")


@query(None)
def lasso_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features that a cross-validated lasso keeps, one standard error from its best."""
    strength, weights, _ = netpath.one_error(labelled(spark, sf_dir), "label", 1.0)
    return spark.createDataFrame([(i, float(w), strength) for i, w in enumerate(weights) if w], "feature int, weight double, strength double")


@query(None)
def net_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features of the largest mean weights over the outer folds' elastic nets."""
    weights = prediction.elastic_net_folds(labelled(spark, sf_dir), "label", ALPHAS)[1]
    return prediction.importance(weights.groupBy(F.col("at").alias("feature")).agg(F.avg("weight").alias("weight")))


@query(None)
def forest_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features that a forest of all rows splits on most."""
    return prediction.model_importance(labelled(spark, sf_dir), "label", "forest")


@query(f"""WITH {SCORED}, m AS (SELECT 'plain' AS model, score AS s, label FROM s UNION ALL SELECT 'turned', 1 - score, label FROM s UNION ALL SELECT 'coarse', floor(score * 4), label FROM s),
    r AS (SELECT model, label, rank() OVER (PARTITION BY model ORDER BY s) + (count(*) OVER (PARTITION BY model, s) - 1) / 2.0::DOUBLE AS r FROM m),
    a AS (SELECT model, (sum(r) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2) / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)) AS auc FROM r GROUP BY 1)
    SELECT model FROM a ORDER BY auc DESC LIMIT 1""")
def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored(spark, sf_dir)
    kinds = {"plain": F.col("score"), "turned": 1 - F.col("score"), "coarse": F.floor(F.col("score") * 4).cast("double")}
    every = None
    for name, c in kinds.items():
        one = s.select(F.lit(name).alias("model"), "label", c.alias("score"))
        every = one if every is None else every.unionByName(one)
    return spark.createDataFrame([(prediction.best_model(every, "plain"),)], "model string")


@query(None)
def platt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(prediction.platt(scored(spark, sf_dir)).select("doc_id", "calibrated"), "calibrated")


@query(None)
def batch_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    rows = _scores(spark, sf_dir).select(array_to_vector(F.array(*AXES)).alias("features"), F.col("batch").cast("int").alias("batch"))
    return rounded(h.batch_auc(rows, "batch"), "auc")


#: The first four axes of the features' correlation, as rows (k, v): the matrix is squared until one axis is left of it (gaps of
#: one in 10^8 between eigenvalues are told apart), that axis is taken out, and so on.
AXES_SQL = """y AS (SELECT sample, feature, (x - avg(x) OVER w) / stddev_samp(x) OVER w AS z FROM (SELECT sample, feature, coalesce(value, median(value) OVER (PARTITION BY feature), 0) AS x FROM l) WINDOW w AS (PARTITION BY feature) QUALIFY stddev_samp(x) OVER w > 0),
    yp AS (SELECT sample, z, dense_rank() OVER (ORDER BY feature) AS i FROM y),
    cc AS (SELECT a.i, b.i AS j, sum(a.z * b.z) / (count(*) - 1) AS x FROM yp a JOIN yp b USING (sample) GROUP BY ALL),
    c0 AS (SELECT list(r ORDER BY i) AS c FROM (SELECT i, list(x ORDER BY j) AS r FROM cc GROUP BY i)),
    e AS (SELECT 1 AS k, 0 AS step, c, c AS s, NULL::DOUBLE[] AS v FROM c0
        UNION ALL SELECT CASE WHEN step < 32 THEN k ELSE k + 1 END, CASE WHEN step < 32 THEN step + 1 ELSE 0 END, c2, CASE WHEN step < 32 THEN list_transform(s, lambda a: list_transform(s, lambda b: list_dot_product(a, b) / (t * t))) ELSE c2 END, CASE WHEN step = 32 THEN u END
        FROM (SELECT *, CASE WHEN step < 32 THEN c ELSE list_transform(range(1, len(c) + 1), lambda i: list_transform(range(1, len(c) + 1), lambda j: c[i][j] - root * u[i] * u[j])) END AS c2
            FROM (SELECT *, list_dot_product(u, list_transform(c, lambda r: list_dot_product(r, u))) AS root
                FROM (SELECT *, list_transform(top, lambda x: x / sqrt(list_dot_product(top, top))) AS u
                    FROM (SELECT *, list_sum(diag) AS t, s[list_position(diag, list_max(diag))] AS top FROM (SELECT *, list_transform(range(1, len(s) + 1), lambda i: s[i][i]) AS diag FROM e WHERE k <= 4))))))"""


@query(f"""WITH RECURSIVE {M}, w AS (SELECT count(DISTINCT feature) AS w FROM m),
    l AS (SELECT m.* FROM m SEMI JOIN (SELECT sample FROM m, w GROUP BY sample, w HAVING (w - count(value)) / w <= 0.1::DOUBLE) USING (sample)), lw AS (SELECT count(DISTINCT feature) AS w FROM l),
    {AXES_SQL},
    g AS (SELECT sample, sum(z * v[i]) FILTER (k = 1) AS p1, sum(z * v[i]) FILTER (k = 2) AS p2, sum(z * v[i]) FILTER (k = 3) AS p3, sum(z * v[i]) FILTER (k = 4) AS p4 FROM yp, (SELECT k - 1 AS k, v FROM e WHERE v IS NOT NULL) GROUP BY sample),
    r AS (SELECT sample, median(value) AS med, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr, avg(value) AS mean, stddev_samp(value) AS sd, count(value) AS n FROM l GROUP BY sample),
    k0 AS (SELECT * FROM g JOIN r USING (sample)),
    k1 AS (SELECT * FROM k0, (SELECT avg(p1) AS m1, stddev_samp(p1) AS s1, avg(p2) AS m2, stddev_samp(p2) AS s2 FROM k0) WHERE NOT coalesce(abs(p1 - m1) > 5 * s1 OR abs(p2 - m2) > 5 * s2, false)),
    k2 AS (SELECT * FROM k1, (SELECT avg(p3) AS m3, stddev_samp(p3) AS s3, avg(p4) AS m4, stddev_samp(p4) AS s4 FROM k1) WHERE NOT coalesce(abs(p3 - m3) > 5 * s3 OR abs(p4 - m4) > 5 * s4, false)),
    k3 AS (SELECT * FROM k2, (SELECT avg(med) AS mm, stddev_samp(med) AS sm FROM k2) WHERE NOT coalesce(abs(med - mm) > 5 * sm, false)),
    k4 AS (SELECT * FROM k3, (SELECT avg(iqr) AS mi, stddev_samp(iqr) AS si FROM k3) WHERE NOT coalesce(abs(iqr - mi) > 5 * si, false)),
    tc AS (SELECT median(mean) AS cm, median(sd) AS cs FROM r), td AS (SELECT median(abs(mean - cm)) * 1.4826::DOUBLE AS dm, median(abs(sd - cs)) * 1.4826::DOUBLE AS ds FROM r, tc),
    tech AS (SELECT sample FROM r, tc, td, lw WHERE coalesce(abs(mean - cm) > dm * 5, false) OR coalesce(sd > cs + ds * 4, false) OR 1 - n / w > 0.05::DOUBLE),
    ext AS (SELECT sample FROM (SELECT sample, CASE WHEN count(value) OVER f >= 3 AND stddev_samp(value) OVER f > 0 THEN abs(value - avg(value) OVER f) / stddev_samp(value) OVER f ELSE 0 END AS z FROM l WINDOW f AS (PARTITION BY feature)), lw GROUP BY sample, w HAVING count(*) FILTER (z > 4) / w > 0.1::DOUBLE),
    gone AS (SELECT sample FROM k0 ANTI JOIN k4 USING (sample) UNION SELECT sample FROM tech UNION SELECT sample FROM ext),
    clean AS (SELECT * FROM l ANTI JOIN gone USING (sample)),
    fm AS (SELECT feature, median(value) AS f FROM clean GROUP BY 1), fa AS (SELECT median(f) AS a FROM fm),
    nv AS (SELECT feature, value * least(greatest(coalesce(a / nullif(f, 0), 1), 0.1::DOUBLE), 10) AS value FROM clean JOIN fm USING (feature), fa),
    rk AS (SELECT feature, value, count(value) OVER (PARTITION BY feature) AS n, (rank() OVER (PARTITION BY feature ORDER BY value) + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0::DOUBLE - 0.5::DOUBLE) / count(value) OVER (PARTITION BY feature) AS p FROM nv WHERE value IS NOT NULL)
    SELECT feature, count(*) AS n, round(avg(CASE WHEN n < 3 THEN value ELSE {qnorm_sql("p")} END), 4) + 0.0::DOUBLE AS mean_value FROM rk GROUP BY 1""")
def study(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The study's steps from measurements to ranks for the matrix; the ranks are balanced over all samples that stay: those
    that no step flags for missing values, their mean or sd, extreme values, or the components and row spreads."""
    m = matrix(spark, sf_dir).select(F.col("sample").cast("string").alias("sample"), F.col("feature").cast("string").alias("feature"), "value")
    made = StudyPlan().run({"measurements": m, "mapping": m.select("sample").distinct().withColumn("person", F.concat(F.lit("p"), "sample"))})
    out = made["ranked"].groupBy("feature").agg(F.count("value").alias("n"), F.avg("value").alias("mean_value"))
    return rounded(out.select(F.col("feature").cast("int").alias("feature"), "n", "mean_value"), "mean_value", digits=4)


TWO = f"{M}, w AS (SELECT sample, feature, sample % 2 AS batch, CASE WHEN (sample * 7 + feature * 5) % 64 < 40 OR sample % 9 > 0 THEN value + sample % 2 * 0.05::DOUBLE * (feature % 4) END AS value FROM m)"


def two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even and odd vectors as two batches, the odd ones shifted by feature; every ninth sample has gaps."""
    f, s = F.col("feature"), F.col("sample")
    value = F.when((((s * 7 + f * 5) % 64) < 40) | (s % 9 > 0), F.col("value") + (s % 2) * 0.05 * (f % 4))
    return matrix(spark, sf_dir).select("sample", "feature", (s % 2).alias("batch"), value.alias("value"))


@query(f"""WITH {TWO}, k AS (SELECT sample, any_value(batch) AS batch FROM w GROUP BY sample HAVING count(value) > 0.65 * 64) SELECT sample, batch, CASE WHEN sample % 20 < 2 THEN 'bridge_' || batch ELSE 'regular' END AS sample_type FROM k""")
def batch_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The samples that the components of both batches stand on."""
    from assayloom.operators.pca import batch_pca

    both = two_batches(spark, sf_dir)
    return batch_pca(both, both.filter("sample % 20 < 2").select("sample").distinct(), 4, 0.65)[0]


@query(None)
def batch_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assayloom.operators.pca import batch_pca

    both = two_batches(spark, sf_dir)
    samples, basis = batch_pca(both, both.filter("sample % 20 < 2").select("sample").distinct(), 4)
    return rounded(basis.scores.join(samples, "sample"), "score")


GAP = lambda t: f"(SELECT avg(g) AS g FROM (SELECT feature, max(v) - min(v) AS g FROM (SELECT feature, batch, median(value) AS v FROM {t} GROUP BY ALL) GROUP BY 1))"


@query(f"""WITH {TWO}, c AS (SELECT feature, median(value) FILTER (batch = 1) - median(value) FILTER (batch = 0) AS d FROM w WHERE sample % 20 < 2 GROUP BY 1), o AS (SELECT feature, median(value) FILTER (batch = 1) - median(value) FILTER (batch = 0) AS d FROM w GROUP BY 1),
    e AS (SELECT feature, batch, avg(value) AS b FROM w GROUP BY ALL), h AS (SELECT feature, avg(value) AS a FROM w GROUP BY 1),
    x AS (SELECT feature, batch, CASE WHEN batch = 1 THEN value - d ELSE value END AS value FROM w JOIN c USING (feature)), y AS (SELECT feature, batch, CASE WHEN batch = 1 THEN value - d ELSE value END AS value FROM w JOIN o USING (feature)), z AS (SELECT w.feature, w.batch, value - b + a AS value FROM w JOIN e ON e.feature = w.feature AND e.batch = w.batch JOIN h ON h.feature = w.feature),
    r AS (SELECT 'bridge' AS method, {GAP("w")} AS p, {GAP("x")} AS q UNION ALL SELECT 'median', {GAP("w")}, {GAP("y")} UNION ALL SELECT 'mean', {GAP("w")}, {GAP("z")})
    SELECT method, round(p, 6) AS gap_before, round(q, 6) AS gap_after, round(100 * (p - q) / p, 4) AS pct_reduction, method = 'median' AS chosen FROM r""")
def method_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shifts by the bridges' medians, by all samples' medians, and by batch means."""
    both = two_batches(spark, sf_dir)
    some = both.filter("sample % 20 < 2")
    gaps = some.groupBy("feature").agg((F.median(F.when(F.col("batch") == 1, F.col("value"))) - F.median(F.when(F.col("batch") == 0, F.col("value")))).alias("_d"))
    bridge = both.join(gaps, "feature").withColumn("value", F.when(F.col("batch") == 1, F.col("value") - F.col("_d")).otherwise(F.col("value"))).drop("_d")
    out = normalize.method_choice(both, {"bridge": bridge, "median": normalize.batch_median_shift(both, 0), "mean": normalize.batch_residualise(both)}, ("bridge", "median", "mean"))
    return rounded(rounded(out, "gap_before", "gap_after"), "pct_reduction", digits=4)


@query(f"""WITH {M}, r AS (SELECT sample, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr FROM m GROUP BY 1), l AS (SELECT avg(iqr) AS m, stddev_samp(iqr) AS s FROM r) SELECT sample, round(iqr, 6) AS iqr, abs(iqr - m) > 2 * s AS is_outlier FROM r, l""")
def spread_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(qc.spread_outliers(matrix(spark, sf_dir), 2.0), "iqr")


@query(f"""WITH {PAIRS}, g AS (SELECT feature, median(x - y) AS g FROM p GROUP BY 1), q AS (SELECT person, x, y, y + g AS z FROM p JOIN g USING (feature)), k AS (SELECT person, avg(x) AS x, avg(y) AS y, avg(z) AS z FROM q GROUP BY 1)
    SELECT 'before' AS stage, count(*) AS n, round(corr(x, y), 6) AS r FROM k UNION ALL SELECT 'after', count(*), round(corr(x, z), 6) FROM k""")
def mean_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assayloom.plans.alignment import _moved

    p = pairs(spark, sf_dir)
    return rounded(association.mean_correlation(p, _moved(p)), "r")
