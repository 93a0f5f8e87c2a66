"""Queries of normalisation, harmonisation and association over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayloom.functions.blocks import normal_ranks
from assayloom.functions.stats import benjamini_hochberg, qnorm_sql, r_squared_by
from assayloom.operators import association as a
from assayloom.operators import normalize as n
from assayloom.plans.registry import M, matrix, projections, projections_sql, query, rounded, table

#: Two batches of users by event type: even users are in the first half of time alone, odd ones in the second, every fifth in both.
BATCH = """b AS (SELECT CASE WHEN event_id < (SELECT max(event_id) FROM events) / 2 THEN 1 ELSE 2 END AS batch, user_id AS person, event_type AS feature, value FROM events),
    c AS (SELECT batch, person, feature, avg(value) AS value FROM b WHERE person % 5 = 0 OR person % 2 + 1 = batch GROUP BY ALL)"""


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    half = e.agg(F.max("event_id").alias("_max"))
    b = e.crossJoin(F.broadcast(half)).select(F.when(F.col("event_id") < F.col("_max") / 2, 1).otherwise(2).alias("batch"), F.col("user_id").alias("person"), F.col("event_type").alias("feature"), "value")
    return b.filter((F.col("person") % 5 == 0) | (F.col("person") % 2 + 1 == F.col("batch"))).groupBy("batch", "person", "feature").agg(F.avg("value").alias("value"))


def _sides(both: DataFrame) -> tuple[DataFrame, DataFrame]:
    return both.filter("batch = 1").drop("batch"), both.filter("batch = 2").drop("batch")


@query(f"""WITH {M}, f AS (SELECT feature, median(value) AS med FROM m GROUP BY feature), g AS (SELECT median(med) AS g FROM f),
    k AS (SELECT feature, least(greatest(coalesce(g / nullif(med, 0), 1), 0.1::DOUBLE), 10::DOUBLE) AS factor FROM f, g)
    SELECT sample, feature, grp, round(factor, 6) AS factor, round(value * factor, 6) AS value FROM m JOIN k USING (feature)""")
def median_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(n.median_scale(matrix(spark, sf_dir)), "value", "factor")


FACTORS = f"""{BATCH}, k AS (SELECT r.feature, median(r.value - t.value) AS factor FROM c r JOIN c t USING (person, feature) WHERE r.batch = 1 AND t.batch = 2 GROUP BY 1)"""


@query(f"WITH {FACTORS} SELECT person, feature, round(value + coalesce(factor, 0), 9) AS value FROM c LEFT JOIN k USING (feature) WHERE batch = 2")
def bridge_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _sides(batches(spark, sf_dir))
    return rounded(n.bridge_additive(second, n.bridge_factors(first, second, least=1)), "value", digits=9).select("person", "feature", "value")


@query(f"""WITH {BATCH}, p AS (SELECT person FROM c GROUP BY 1 HAVING count(DISTINCT batch) = 2), k AS (SELECT batch, feature, median(value) AS med FROM c WHERE person IN (SELECT person FROM p) GROUP BY ALL),
    o AS (SELECT batch, feature, least(greatest(med - avg(med) OVER (PARTITION BY feature), -3), 3) AS off FROM k)
    SELECT batch, person, feature, round(value - coalesce(off, 0), 9) AS value FROM c LEFT JOIN o USING (batch, feature)""")
def bridge_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = batches(spark, sf_dir)
    shared = both.groupBy("person").agg(F.countDistinct("batch").alias("n")).filter("n = 2")
    return rounded(n.bridge_combined(both, shared), "value", digits=9).select("batch", "person", "feature", "value")


@query(f"""WITH {BATCH}, k AS (SELECT batch, feature, median(value) AS med FROM c GROUP BY ALL), o AS (SELECT k.batch, k.feature, least(greatest(k.med - r.med, -3), 3) AS off FROM k JOIN k r ON r.feature = k.feature AND r.batch = 1)
    SELECT batch, person, feature, round(value - coalesce(off, 0), 9) AS value FROM c LEFT JOIN o USING (batch, feature)""")
def batch_median_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(n.batch_median_shift(batches(spark, sf_dir), 1), "value", digits=9).select("batch", "person", "feature", "value")


@query(f"""WITH {M}, g AS (SELECT unnest(range(0, 101)) AS i), q AS (SELECT feature, unnest(range(0, 101)) AS i, unnest(quantile_cont(value, [x / 100.0 FOR x IN range(0, 101)])) AS v FROM m GROUP BY feature),
    r AS (SELECT i, avg(v) AS v FROM q GROUP BY i),
    p AS (SELECT sample, feature, (rank() OVER (PARTITION BY feature ORDER BY value) + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0::DOUBLE) / (count(*) OVER (PARTITION BY feature) + 1) * 100 AS p FROM m)
    SELECT sample, feature, round(lo.v + (hi.v - lo.v) * (p - floor(p)), 6) AS value FROM p JOIN r lo ON lo.i = floor(p)::INT JOIN r hi ON hi.i = least(floor(p)::INT + 1, 100)""")
def bridge_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(n.quantile_normalize(matrix(spark, sf_dir)), "value").select("sample", "feature", "value")


@query(f"""WITH {M}, x AS (SELECT *, sample % 2 AS batch FROM m), w AS (SELECT *, avg(value) OVER (PARTITION BY feature) AS mu, avg(value) OVER (PARTITION BY feature, batch) AS o FROM x)
    SELECT sample, feature, round(value - o + mu, 6) AS value, round(sum((o - mu) * (o - mu)) OVER (PARTITION BY feature) / sum((value - mu) * (value - mu)) OVER (PARTITION BY feature), 6) AS r2 FROM w""")
def batch_residualise(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = matrix(spark, sf_dir).withColumn("batch", F.col("sample") % 2)
    return rounded(n.batch_residualise(rows), "value", "r2").select("sample", "feature", "value", "r2")


COV = f"{M}, x AS (SELECT *, CASE WHEN sample % 11 > 0 THEN (20 + sample % 60)::DOUBLE END AS age, sample % 2 = 0 AS flag FROM m)"


def with_covariates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix(spark, sf_dir).withColumns({"age": F.when(F.col("sample") % 11 > 0, (20 + F.col("sample") % 60).cast("double")), "flag": F.col("sample") % 2 == 0})


@query(f"""WITH {COV}, f AS (SELECT feature, regr_slope(value, age) AS b, avg(age) FILTER (value IS NOT NULL) AS mx FROM x WHERE age IS NOT NULL GROUP BY 1)
    SELECT sample, feature, round(CASE WHEN age IS NULL THEN value ELSE value - b * (age - mx) END, 6) AS value FROM x JOIN f USING (feature)""")
def covariate_residualise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(n.covariate_residualise(with_covariates(spark, sf_dir), "age"), "value").select("sample", "feature", "value")


@query(f"""WITH {COV}, f AS (SELECT feature, regr_slope(value, age) AS b, avg(age) AS mx FROM x WHERE age IS NOT NULL GROUP BY 1)
    SELECT sample, feature, round(CASE WHEN age IS NULL THEN value ELSE value - b * (age - mx) END, 6) AS value FROM x JOIN f USING (feature)""")
def covariates_residualise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(n.covariates_residualise(with_covariates(spark, sf_dir), ["age"]), "value").select("sample", "feature", "value")


@query(f"""WITH {COV} SELECT feature, round(corr(value, age), 6) AS r, round((avg(value) FILTER (flag) - avg(value) FILTER (NOT flag)) / sqrt(var_samp(value) FILTER (flag) / count(value) FILTER (flag)
    + var_samp(value) FILTER (NOT flag) / count(value) FILTER (NOT flag)), 6) AS t FROM x GROUP BY 1""")
def covariate_effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(a.covariate_effects(with_covariates(spark, sf_dir), "age", "flag"), "r", "t")


SCAN = f"""{COV}, s AS (SELECT feature, regr_count(age, value)::BIGINT AS n, regr_slope(age, value) AS beta, regr_r2(age, value) AS r2, regr_syy(age, value) AS syy, regr_sxx(age, value) AS sxx FROM x GROUP BY 1),
    t AS (SELECT feature, n, beta, sqrt((1 - r2) * syy / ((n - 2) * sxx)) AS se, r2 FROM s)"""


@query(f"WITH {SCAN} SELECT feature, n, round(beta, 5) AS beta, round(se, 5) AS se, round(beta / se, 5) AS t, round(r2, 6) AS r2 FROM t")
def linear_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rounded(a.simple_scan(with_covariates(spark, sf_dir), "age"), "beta", "se", "t", digits=5), "r2")


@query(f"WITH {SCAN} SELECT feature, n, round(beta, 4) AS beta, round(se, 4) AS se, round(beta / se, 4) AS t, round(r2, 6) AS r2 FROM t")
def linear_scan_general(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = a.linear_scan(with_covariates(spark, sf_dir), "age", []).drop("p")
    return rounded(rounded(out, "beta", "se", "t", digits=4), "r2")


@query(None)
def logistic_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_covariates(spark, sf_dir).withColumn("y", F.col("flag").cast("int"))
    return rounded(a.logistic_scan(rows, "y", ["age"]), "beta", "se", "z", "p", "p_adj", "odds_ratio", "ci_low", "ci_high", "neg_log10_p")


@query("""WITH p AS (SELECT p_partkey, ((p_partkey * 7919) % 10007) / 10007.0::DOUBLE AS p FROM part), r AS (SELECT *, row_number() OVER (ORDER BY p) AS k, count(*) OVER () AS m FROM p)
    SELECT p_partkey, round(p, 9) AS p, round(least(min(p * m / k) OVER (ORDER BY p DESC RANGE UNBOUNDED PRECEDING), 1), 9) AS p_adj FROM r""")
def bh_adjust(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") * 7919 % 10007 / F.lit(10007.0)).alias("p"))
    return rounded(p.withColumn("p_adj", benjamini_hochberg("p")), "p", "p_adj", digits=9)


IRN = f"""{M}, r AS (SELECT sample, feature, (rank() OVER (PARTITION BY feature ORDER BY value) + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0::DOUBLE - 0.5::DOUBLE) / count(*) OVER (PARTITION BY feature) AS p FROM m)"""


@query(f"WITH {IRN} SELECT sample, feature, round({qnorm_sql('p')}, 6) AS value FROM r")
def irn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(normal_ranks(matrix(spark, sf_dir).select("sample", "feature", "value"), "value", "feature"), "value")


@query(f"""WITH {IRN}, v AS (SELECT sample, feature, round({qnorm_sql('p')}, 6) AS value FROM r)
    SELECT sample AS "FID", sample AS "IID", {', '.join(f'coalesce(max(value) FILTER (feature = {i} AND (sample + feature) % 17 > 0), -9) AS "{i}"' for i in range(64))} FROM v GROUP BY sample""")
def plink_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assayloom.sources.tables import plink_table

    rows = irn(spark, sf_dir).withColumn("value", F.when((F.col("sample") + F.col("feature")) % 17 > 0, F.col("value")))
    return plink_table(rows, features=list(range(64)))


def _spread(name: str) -> str:
    return f"""(SELECT avg(sd) AS sd, avg(mad) AS mad, avg(iqr) AS iqr FROM (SELECT feature, stddev_samp(value) AS sd, median(abs(value - med)) AS mad, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr
        FROM (SELECT *, median(value) OVER (PARTITION BY feature) AS med FROM {name}) GROUP BY feature))"""


@query(f"""WITH {M}, x AS (SELECT *, sample % 2 AS batch FROM m), y AS (SELECT sample, feature, value - avg(value) OVER (PARTITION BY feature, batch) + avg(value) OVER (PARTITION BY feature) AS value FROM x),
    a AS {_spread('m')}, b AS {_spread('y')}, u AS (SELECT 'sd' AS metric, a.sd AS before, b.sd AS after FROM a, b UNION ALL SELECT 'mad', a.mad, b.mad FROM a, b UNION ALL SELECT 'iqr', a.iqr, b.iqr FROM a, b)
    SELECT metric, round(before, 6) AS before, round(after, 6) AS after, round((before - after) * 100 / nullif(before, 0), 4) AS pct_reduction FROM u""")
def norm_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = matrix(spark, sf_dir)
    after = n.batch_residualise(before.withColumn("batch", F.col("sample") % 2))
    return rounded(rounded(n.spread_reduction(before, after), "before", "after"), "pct_reduction", digits=4)


@query(None)
def combat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = matrix(spark, sf_dir).withColumn("batch", F.col("sample") % 2).withColumn("value", F.col("value") * (1 + F.col("batch")) + F.col("batch") * 0.1)
    return rounded(n.combat(rows), "value")


@query(f"""WITH {M}, k AS (SELECT feature, grp, count(value) AS c, sum(value) AS s, sum(value * value) AS q FROM m GROUP BY ALL)
    SELECT feature, round((sum(s * s / c) - sum(s) * sum(s) / sum(c)) / (sum(q) - sum(s) * sum(s) / sum(c)), 6) AS r2, sum(c)::BIGINT AS n FROM k GROUP BY 1""")
def pc_assoc_r2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(r_squared_by(matrix(spark, sf_dir), "value", "grp", "feature"), "r2")


PAIRS = f"{M}, p AS (SELECT x.sample AS person, x.grp, x.feature, x.value AS x, y.value AS y FROM m x JOIN m y ON y.feature = x.feature AND y.sample = x.sample + 1)"


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sample beside the next one: stand-ins for people measured in two batches."""
    m = matrix(spark, sf_dir)
    y = m.select((F.col("sample") - 1).alias("person"), "feature", F.col("value").alias("y"))
    return m.select(F.col("sample").alias("person"), "grp", "feature", F.col("value").alias("x")).join(y, ["person", "feature"])


@query(f"""WITH {PAIRS} SELECT person, count(*) AS n, round(2 * covar_samp(x, y) / (var_samp(x) + var_samp(y)), 6) AS icc,
    round(2 * covar_pop(x, y) / (var_pop(x) + var_pop(y) + (avg(x) - avg(y)) * (avg(x) - avg(y))), 6) AS ccc FROM p GROUP BY 1""")
def pair_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(a.pair_agreement(pairs(spark, sf_dir)), "icc", "ccc")


@query(f"WITH {PAIRS} SELECT person, round(sqrt(sum((x - y) * (x - y))), 6) AS distance FROM p GROUP BY 1")
def pair_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(a.pair_distance(pairs(spark, sf_dir)), "distance")


@query(f"""WITH {PAIRS}, d AS (SELECT q.person AS query, r.person AS reference, sum((q.x - r.y) * (q.x - r.y)) AS d2 FROM p q JOIN p r ON q.feature = r.feature WHERE q.person % 20 = 0 GROUP BY ALL),
    k AS (SELECT *, rank() OVER (PARTITION BY query ORDER BY d2)::INT AS rank, min(sqrt(d2)) FILTER (query <> reference) OVER (PARTITION BY query) AS other FROM d)
    SELECT query, rank, round(sqrt(d2) - other, 6) AS margin FROM k WHERE query = reference""")
def true_pair_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The people whose id is divisible by 20, each ranked against all references."""
    p = pairs(spark, sf_dir)
    asked, references = p.filter("person % 20 = 0").select("person", "feature", F.col("x").alias("value")), p.select("person", "feature", F.col("y").alias("value"))
    return rounded(a.true_pair_rank(asked, references), "margin")


@query(f"WITH {PAIRS} SELECT feature, count(*) AS n, round(corr(x, y), 6) AS cor, round(avg((x - y) * (x - y)), 6) AS mse, round(avg(abs(x - y)), 6) AS mae, round(1 - avg((x - y) * (x - y)) / var_pop(y), 6) AS r2 FROM p GROUP BY 1 HAVING count(*) >= 5")
def protein_concordance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(a.concordance(pairs(spark, sf_dir)), "cor", "mse", "mae", "r2")


@query(f"""WITH {PAIRS}, d AS (SELECT person, sqrt(sum((x - y) * (x - y))) AS distance FROM p GROUP BY 1), q AS (SELECT quantile_cont(distance, 0.25) AS a, quantile_cont(distance, 0.75) AS b FROM d)
    SELECT person, round(distance, 6) AS distance, distance > b + (b - a) * 0.5 AS is_outlier FROM d, q""")
def bridge_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(a.iqr_outliers(a.pair_distance(pairs(spark, sf_dir)), "distance", k=0.5), "distance")


@query(f"""WITH {COV}, s AS (SELECT feature, value, count(*) FILTER (flag) AS a, count(*) FILTER (NOT flag) AS b FROM x GROUP BY ALL),
    r AS (SELECT feature, a, b, sum(a) OVER w / sum(a) OVER (PARTITION BY feature) - sum(b) OVER w / sum(b) OVER (PARTITION BY feature) AS gap FROM s WINDOW w AS (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING))
    SELECT feature, sum(a)::BIGINT AS n1, sum(b)::BIGINT AS n2, round(max(abs(gap)), 6) AS d FROM r GROUP BY 1""")
def ks_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(a.ks_alignment(with_covariates(spark, sf_dir), "value", "flag", "feature").drop("p"), "d")


@query(f"""WITH {M}, s AS (SELECT feature, count(value) AS n, avg(value) AS mean, stddev_samp(value) AS sd FROM m GROUP BY 1),
    c AS (SELECT feature, n, mean, sd, sum((value - mean) ** 3) / n AS m3, sum((value - mean) ** 4) / n AS m4 FROM m JOIN s USING (feature) GROUP BY feature, n, mean, sd)
    SELECT feature, n, round(mean, 6) AS mean, round(sd, 6) AS sd, round(m3 / sd ** 3, 6) AS skew, round(m4 / sd ** 4 - 3, 6) AS kurt, round(m4 / (sd * sd * (n - 1) / n) ** 2, 6) AS kurt_plain FROM c""")
def distribution_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(a.moments(matrix(spark, sf_dir), "value", "feature"), "mean", "sd", "skew", "kurt", "kurt_plain")


@query(f"""WITH {M}, s AS (SELECT sample, any_value(grp) % 2 AS g, {projections_sql("ab")} FROM m GROUP BY sample),
    d AS (SELECT p.sample AS s, p.g AS own, q.g AS other, avg(sqrt((p.a - q.a) * (p.a - q.a) + (p.b - q.b) * (p.b - q.b))) AS d FROM s p JOIN s q ON p.sample <> q.sample GROUP BY ALL),
    k AS (SELECT s, max(d) FILTER (own = other) AS a, min(d) FILTER (own <> other) AS b FROM d GROUP BY 1)
    SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM k""")
def silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On two scores of the whole matrix."""
    m = matrix(spark, sf_dir)
    s = projections(m, "ab").join(m.select("sample", (F.col("grp") % 2).alias("g")).distinct(), "sample")
    return rounded(a.silhouette(s, ["a", "b"], "g"), "silhouette")


@query(f"""WITH {M}, b AS (SELECT feature, k AS pc, 0.01::DOUBLE * feature AS center, 1 + 0.1::DOUBLE * feature AS scale, cos(feature * k::DOUBLE) AS loading FROM (SELECT DISTINCT feature FROM m), (SELECT unnest([1, 2, 3]) AS k))
    SELECT sample, pc, round(sum((value - center) / scale * loading), 6) AS score FROM m JOIN b USING (feature) GROUP BY ALL""")
def project_basis(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = matrix(spark, sf_dir)
    f = F.col("feature")
    basis = m.select("feature").distinct().select("feature", F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("pc")).select("feature", "pc", (f * 0.01).alias("center"), (f * 0.1 + 1).alias("scale"), F.cos(f * F.col("pc").cast("double")).alias("loading"))
    return rounded(a.project(m, basis), "score")


@query(f"""WITH {SCAN}, l AS (SELECT avg(beta) AS m, stddev_samp(beta) AS s FROM t), k AS (SELECT t.* FROM t, l WHERE abs(beta - m) <= 1.5 * s), c AS (SELECT count(*) AS c FROM k)
    SELECT feature, n, round(beta, 5) AS beta, round(se, 5) AS se, round(beta / se, 5) AS t, round(r2, 6) AS r2, round(beta - 1.96::DOUBLE * se, 5) AS ci_low, round(beta + 1.96::DOUBLE * se, 5) AS ci_high, round(0.05::DOUBLE / c, 9) AS bonferroni FROM k, c""")
def effect_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = a.effect_interval(a.simple_scan(with_covariates(spark, sf_dir), "age"), sds=1.5)
    return rounded(rounded(rounded(out, "beta", "se", "t", "ci_low", "ci_high", digits=5), "r2"), "bonferroni", digits=9)
