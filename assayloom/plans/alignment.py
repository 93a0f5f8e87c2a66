"""Queries of the alignment measures over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayloom.functions.stats import qnorm_sql
from assayloom.operators import association, robust
from assayloom.operators import harmonisation as h
from assayloom.operators.pca import pca
from assayloom.plans.harmony import COV, PAIRS, SCAN, pairs, with_covariates
from assayloom.plans.registry import M, correlation_p_sql, matrix, projections, projections_sql, query, rounded, table


@query(f"""WITH {PAIRS}, r AS (SELECT feature, median(value) AS med FROM m GROUP BY 1), s AS (SELECT feature, 1.4826::DOUBLE * median(abs(value - med)) AS mad FROM m JOIN r USING (feature) GROUP BY 1)
    SELECT person, round(sqrt(sum(((x - y) / mad) * ((x - y) / mad))), 6) AS distance FROM p JOIN s USING (feature) WHERE mad > 0 GROUP BY 1""")
def whitened_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(h.whitened_distance(pairs(spark, sf_dir), matrix(spark, sf_dir)), "distance")


@query(f"""WITH {PAIRS}, d AS (SELECT person, sqrt(sum((x - y) * (x - y))) AS distance FROM p GROUP BY 1), b AS (SELECT median(distance) AS bridge_median FROM d WHERE person % 20 = 0), r AS (SELECT median(distance) AS noise_floor FROM d WHERE person % 20 > 0)
    SELECT round(bridge_median, 6) AS bridge_median, round(noise_floor, 6) AS noise_floor, round(bridge_median / noise_floor, 6) AS ratio FROM b, r""")
def noise_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = association.pair_distance(pairs(spark, sf_dir))
    return rounded(h.noise_ratio(d.filter("person % 20 = 0"), d.filter("person % 20 > 0")), "bridge_median", "noise_floor", "ratio")


@query(f"""WITH {PAIRS}, d AS (SELECT avg(y) - avg(x) AS d FROM p GROUP BY person), k AS (SELECT d, rank() OVER (ORDER BY abs(d)) + (count(*) OVER (PARTITION BY abs(d)) - 1) / 2.0::DOUBLE AS r FROM d WHERE d <> 0),
    s AS (SELECT count(*) AS n, coalesce(sum(r) FILTER (d > 0), 0) AS v FROM k), t AS (SELECT n, v, (v - n * (n + 1) / 4 + 0.5) / sqrt(n * (n + 1) * (2 * n + 1) / 24) AS z FROM s)
    SELECT n, v, round(z, 6) AS z, round({h.normal_cdf_sql("z")}, 5) AS p FROM t""")
def signed_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = pairs(spark, sf_dir).groupBy("person").agg(F.avg("x").alias("b"), F.avg("y").alias("a"))
    return rounded(rounded(robust.signed_rank(means, "b", "a", exact_below=0), "z"), "p", digits=5)


@query(f"""WITH {COV}, k AS (SELECT feature, value AS y, flag::INT::DOUBLE AS a, (sample % 3 = 0)::INT::DOUBLE AS b FROM x),
    c AS (SELECT feature, count(*) AS n, var_pop(y) AS vy, var_pop(a) AS va, var_pop(b) AS vb, covar_pop(y, a) AS ya, covar_pop(y, b) AS yb, covar_pop(a, b) AS ab FROM k GROUP BY 1),
    s AS (SELECT feature, n, ya * ya / (va * vy) AS s1, (yb - ya * ab / va) * (yb - ya * ab / va) / ((vb - ab * ab / va) * vy) AS s2 FROM c)
    SELECT feature, n, round(s1, 6) AS first_share, round(s2, 6) AS second_share, round(1 - s1 - s2, 6) AS residual_share FROM s""")
def variance_decomposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_covariates(spark, sf_dir).withColumns({"a": F.col("flag").cast("int"), "b": (F.col("sample") % 3 == 0).cast("int")})
    return rounded(h.variance_decomposition(rows, "a", "b"), "first_share", "second_share", "residual_share")


@query(f"""WITH {M}, s AS (SELECT sample, {projections_sql("ab")} FROM m GROUP BY 1), c AS (SELECT median(a) AS ma, median(b) AS mb FROM s)
    SELECT sample, round(sqrt((a - ma) * (a - ma) + (b - mb) * (b - mb)), 6) AS distance FROM s, c""")
def genetic_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(h.genetic_distance(projections(matrix(spark, sf_dir), "ab"), ["a", "b"]), "distance")


@query(f"""WITH {M}, r AS (SELECT sample, feature, rank() OVER (PARTITION BY feature ORDER BY value) + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0::DOUBLE AS r FROM m),
    c AS (SELECT a.feature AS f1, b.feature AS f2, count(*) AS n, corr(a.r, b.r) AS rho FROM r a JOIN r b USING (sample) WHERE a.feature < b.feature GROUP BY ALL) SELECT f1, f2, n, round(rho, 6) AS rho, round({correlation_p_sql("rho", "n")}, 6) AS p FROM c""")
def spearman(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(h.spearman(matrix(spark, sf_dir)), "rho", "p")


@query(f"""WITH {PAIRS}, d AS (SELECT avg(x) - avg(y) AS d FROM p GROUP BY feature), k AS (SELECT d, rank() OVER (ORDER BY abs(d)) AS r FROM d WHERE d <> 0), s AS (SELECT count(*) AS n, sum(r) FILTER (d > 0)::DOUBLE AS v FROM k),
    z AS (SELECT v, (v - n * (n + 1) / 4 - 0.5 * sign(v - n * (n + 1) / 4)) / sqrt(n * (n + 1) * (2 * n + 1) / 24) AS z FROM s), w AS (SELECT v, -abs(z) AS z FROM z)
    SELECT count(d) AS n, round(avg(abs(d)), 6) AS mean_abs, round(median(abs(d)), 6) AS median_abs, round(stddev_samp(abs(d)), 6) AS sd_abs, round(avg(d) * sqrt(count(d)) / stddev_samp(d), 5) AS t,
           any_value(v) AS v, round(any_value(2 * {h.normal_cdf_sql("z")}), 5) AS p FROM d, w""")
def paired_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rounded(h.paired_shift(pairs(spark, sf_dir)), "mean_abs", "median_abs", "sd_abs"), "t", "p", digits=5)


@query("""WITH r AS (SELECT p_brand, rank() OVER (ORDER BY p_retailprice) + (count(*) OVER (PARTITION BY p_retailprice) - 1) / 2.0::DOUBLE AS r FROM part), g AS (SELECT p_brand, sum(r) AS s, count(*) AS n FROM r GROUP BY 1)
    SELECT round(12 / (sum(n) * (sum(n) + 1)) * sum(s * s / n) - 3 * (sum(n) + 1), 4) AS h, count(*) - 1 AS df FROM g""")
def kruskal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(h.kruskal(table(spark, sf_dir, "part"), "p_retailprice", "p_brand"), "h", digits=4)


@query(f"""WITH {SCAN}, k AS (SELECT feature, feature % 6 AS group_id, exp(-abs(beta / se)) AS p, r2 FROM t), r AS (SELECT *, row_number() OVER (ORDER BY p) AS i, count(*) OVER () AS m FROM k)
    SELECT feature, group_id, round(p, 6) AS p, round(r2, 6) AS r2, row_number() OVER (PARTITION BY group_id ORDER BY p, r2 DESC, feature) = 1 AS selected, round(least(p * m, 1), 6) AS p_bonferroni,
           round(least(min(p * m / i) OVER (ORDER BY p DESC RANGE UNBOUNDED PRECEDING), 1), 6) AS p_bh, least(p * m, 1) < 0.05 AS significant FROM r""")
def age_association(spark: SparkSession, sf_dir: str) -> DataFrame:
    fits = association.simple_scan(with_covariates(spark, sf_dir), "age").select("feature", (F.col("feature") % 6).alias("group_id"), F.exp(-F.abs("t")).alias("p"), "r2")
    return rounded(h.age_association(fits), "p", "r2", "p_bonferroni", "p_bh")


AXES = ["pc1", "pc2", "pc3", "pc4"]


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sample, batch and the scores of the whole matrix on its first components."""
    m = matrix(spark, sf_dir)
    wide = pca(m, len(AXES)).scores.groupBy("sample").agg(*[F.max(F.when(F.col("pc") == i, F.col("score"))).alias(c) for i, c in enumerate(AXES, 1)])
    return wide.join(table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("sample"), (F.col("label") % 2).alias("batch")), "sample")


@query(None)
def kbet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return h.kbet_acceptance(_scores(spark, sf_dir), AXES, "batch")


@query(None)
def lisi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return h.lisi(_scores(spark, sf_dir), AXES, "batch")


def _moved(p: DataFrame) -> DataFrame:
    """The pairs once y has been brought to x by the median gap of each feature."""
    gaps = p.groupBy("feature").agg(F.median(F.col("x") - F.col("y")).alias("_gap"))
    return p.join(gaps, "feature").withColumn("y", F.col("y") + F.col("_gap")).drop("_gap")


@query(None)
def bootstrap_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs' distances after the median gaps are taken out, against those before."""
    p = pairs(spark, sf_dir)
    both = association.pair_distance(p).withColumnRenamed("distance", "before").join(association.pair_distance(_moved(p)).withColumnRenamed("distance", "after"), "person")
    return robust.log_ratio_interval(both, "before", "after")


def _on_components(basis, p: DataFrame) -> DataFrame:  # noqa: ANN001
    """person, pc, x, y: both sides of pairs on a basis."""
    side = lambda c: association.project(p.select(F.col("person").alias("sample"), "feature", F.col(c).alias("value")), basis.loadings).select(F.col("sample").alias("person"), "pc", F.col("score").alias(c))
    return side("x").join(side("y"), ["person", "pc"])


@query(None)
def mahalanobis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs on the components of the whole matrix, under the robust covariance of all samples' scores."""
    basis = pca(matrix(spark, sf_dir), 10)
    return robust.mahalanobis_distance(_on_components(basis, pairs(spark, sf_dir)), basis.scores)


POLY = lambda cs, last: f"((((({cs[0]} * u + {cs[1]}) * u + {cs[2]}) * u + {cs[3]}) * u + {cs[4]}) * u + {last})"


#: The rule of `harmonisation.shapiro_w`: no W beyond 3 to 5000 values or for a constant feature; up to 5 values only the ends
#: have weights of their own, and up to 11 (and for 3) p has formulas of its own.
SHAPIRO = f"""WITH {M}, i AS (SELECT feature, value AS x, row_number() OVER (PARTITION BY feature ORDER BY value) AS i, count(*) OVER (PARTITION BY feature) AS n FROM m WHERE value IS NOT NULL), q AS (SELECT *, (i - 0.375::DOUBLE) / (n + 0.25::DOUBLE) AS q FROM i),
    k AS (SELECT feature, x, i, n, {qnorm_sql("q")} AS m FROM q), s AS (SELECT feature, any_value(n) AS n, avg(x) AS mean, sum(m * m) AS mm, max(m) AS m1, max(m) FILTER (i = n - 1) AS m2, 1 / sqrt(any_value(n)) AS u FROM k GROUP BY 1 HAVING any_value(n) BETWEEN 3 AND 5000 AND max(x) > min(x)),
    e AS (SELECT *, CASE WHEN n = 3 THEN sqrt(0.5::DOUBLE) ELSE {POLY(("-2.706056::DOUBLE", "4.434685::DOUBLE", "-2.071190::DOUBLE", "-0.147981::DOUBLE", "0.221157::DOUBLE"), "m1 / sqrt(mm)")} END AS a1, {POLY(("-3.582633::DOUBLE", "5.682633::DOUBLE", "-1.752461::DOUBLE", "-0.293762::DOUBLE", "0.042981::DOUBLE"), "m2 / sqrt(mm)")} AS a2 FROM s),
    f AS (SELECT *, CASE WHEN n > 5 THEN sqrt((mm - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * a1 * a1 - 2 * a2 * a2)) WHEN n > 3 THEN sqrt((mm - 2 * m1 * m1) / (1 - 2 * a1 * a1)) END AS phi FROM e),
    w AS (SELECT feature, sum(x * CASE WHEN i = 1 THEN -a1 WHEN i = f.n THEN a1 WHEN i = 2 AND f.n > 5 THEN -a2 WHEN i = f.n - 1 AND f.n > 5 THEN a2 WHEN f.n = 3 THEN 0 ELSE m / phi END) AS s, sum((x - mean) * (x - mean)) AS ss FROM k JOIN f USING (feature) GROUP BY 1),
    v AS (SELECT feature, n, CASE WHEN s IS NOT NULL THEN least(s * s / ss, 1) END AS w, ln(n) AS l FROM (SELECT feature, count(value) AS n FROM m GROUP BY 1) LEFT JOIN w USING (feature)), y AS (SELECT *, CASE WHEN w < 1 THEN ln(1 - w) ELSE '-inf'::DOUBLE END AS y, 0.459::DOUBLE * n - 2.273::DOUBLE AS g FROM v),
    z AS (SELECT *, CASE WHEN w IS NULL OR n = 3 OR (n <= 11 AND y >= g) THEN NULL WHEN n <= 11 THEN (-ln(g - y) - (((-0.0006714::DOUBLE * n + 0.025054::DOUBLE) * n - 0.39978::DOUBLE) * n + 0.5440::DOUBLE)) / exp(((-0.0020322::DOUBLE * n + 0.062767::DOUBLE) * n - 0.77857::DOUBLE) * n + 1.3822::DOUBLE)
        ELSE (y - (((0.0038915::DOUBLE * l - 0.083751::DOUBLE) * l - 0.31082::DOUBLE) * l - 1.5861::DOUBLE)) / exp((0.0030302::DOUBLE * l - 0.082676::DOUBLE) * l - 0.4803::DOUBLE) END AS z FROM y)
    SELECT feature, n, round(w, 6) AS w, round(CASE WHEN w IS NULL THEN NULL WHEN n = 3 THEN greatest(6 / pi() * (asin(sqrt(w)) - asin(sqrt(0.75::DOUBLE))), 0) WHEN n <= 11 AND y >= g THEN 1e-99 ELSE 1 - ({h.normal_cdf_sql("z")}) END, 5) AS p FROM z"""


@query(SHAPIRO)
def shapiro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rounded(h.shapiro_w(matrix(spark, sf_dir), "value", "feature"), "w"), "p", digits=5)


@query(f"""WITH r AS (SELECT c_custkey % 4 AS category, c_acctbal AS v FROM customer), k AS (SELECT unnest([1, 2, 3])::BIGINT AS a),
    x AS (SELECT a, category, rank() OVER (PARTITION BY a ORDER BY v) + (count(*) OVER (PARTITION BY a, v) - 1) / 2.0::DOUBLE AS rk FROM k JOIN r ON category = 0 OR category = a),
    s AS (SELECT a, count(*) FILTER (category <> 0)::DOUBLE AS n, count(*) FILTER (category = 0)::DOUBLE AS m, sum(rk) FILTER (category <> 0) AS s FROM x GROUP BY a), z AS (SELECT a, n, (s - n * (n + 1) / 2 - n * m / 2) / sqrt(n * m * (n + m + 1) / 12) AS z FROM s), w AS (SELECT *, abs(z) AS az FROM z)
    SELECT a AS category, n::BIGINT AS n, round(z, 6) AS z, round(2 * (1 - ({h.normal_cdf_sql("az")})), 5) AS p FROM w""")
def error_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 4).alias("category"), "c_acctbal")
    return rounded(rounded(h.error_shift(c, "c_acctbal", "category"), "z"), "p", digits=5)


@query(f"""WITH {M}, s AS (SELECT sample, count(*) FILTER (abs(value) > 0.25) AS hits, max(abs(value)) AS top FROM m GROUP BY 1)
    SELECT sample, hits, round(top, 6) AS top FROM s ORDER BY hits DESC, sample LIMIT 20""")
def top_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = matrix(spark, sf_dir).groupBy("sample").agg(F.count_if(F.abs("value") > 0.25).alias("hits"), F.max(F.abs("value")).alias("top"))
    return rounded(s.orderBy(F.desc("hits"), "sample").limit(20), "top")


@query("""WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority AS segment, count(*) AS n FROM orders GROUP BY ALL) SELECT month, segment, n, sum(n) OVER (PARTITION BY segment ORDER BY month)::BIGINT AS running FROM m""")
def cohort_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    m = table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("o_orderpriority").alias("segment")).agg(F.count("*").alias("n"))
    return m.withColumn("running", F.sum("n").over(Window.partitionBy("segment").orderBy("month")))




def halves(spark: SparkSession, sf_dir: str):  # noqa: ANN201
    """The matrix as two batches of one population: even vectors in A, odd ones in B shifted and stretched by feature; every
    tenth vector of A has a noisy copy in B (its bridge), and every tenth from the fifth on one in A (its replicate)."""
    from assayloom.operators.kpi import Batches

    m = matrix(spark, sf_dir).select("sample", "feature", "value", F.when(F.col("grp") < 5, 1).otherwise(0).alias("label"))
    wobble = lambda seed: (F.pmod(F.xxhash64("sample", "feature", F.lit(seed)), F.lit(2001)) / 1000.0 - 1.0) * 0.02
    copy = lambda at, batch, seed: m.filter(f"sample % 20 = {at}").select(F.lit(batch).alias("batch"), (F.col("sample") + 10_000_000 * (seed + 1)).alias("sample"), "feature", (F.col("value") + wobble(seed)).alias("value"), "label")
    own = m.select(F.when(F.col("sample") % 2 == 0, "A").otherwise("B").alias("batch"), "sample", "feature", "value", "label")
    rows = own.unionByName(copy(0, "B", 0)).unionByName(copy(10, "A", 1))
    shift = F.when(F.col("batch") == "B", F.col("value") * (1 + F.col("feature") % 3 * 0.1) + 0.05 * (F.col("feature") % 5 - 1)).otherwise(F.col("value"))
    before = rows.withColumn("value", shift).drop("label")
    # the bridges' median gap of each feature is taken out of B
    bridges = m.filter("sample % 20 = 0").select("sample").distinct().select(F.col("sample").cast("string").alias("person"), F.col("sample").alias("first"), (F.col("sample") + 10_000_000).alias("second"))
    from assayloom.operators.kpi import sides

    ends = bridges.select(F.explode(F.array("first", "second")).alias("sample"))
    linked = before.join(F.broadcast(ends), "sample", "left_semi")
    gaps = sides(linked, bridges, "feature", "value").groupBy("feature").agg(F.median(F.col("x") - F.col("y")).alias("_gap"))
    after = before.join(F.broadcast(gaps), "feature").withColumn("value", F.when(F.col("batch") == "B", F.col("value") + F.col("_gap")).otherwise(F.col("value"))).drop("_gap")
    replicates = m.filter("sample % 20 = 10").select("sample").distinct().select(F.col("sample").alias("first"), (F.col("sample") + 20_000_000).alias("second"))
    return Batches(before, after, bridges, replicates, rows.select("sample", "label").distinct(), "A", "B")


@query(None)
def alignment_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All measures of the KPI table, none given."""
    from assayloom.operators import kpi

    return rounded(kpi.alignment_report(halves(spark, sf_dir)), "pre", "post")
