"""Queries of comparisons before and after a step, of bridge scaling and of label predictors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayloom.operators import association, harmonisation, identity, normalize, prediction
from assayloom.plans.harmony import COV, PAIRS, SCAN, pairs, with_covariates
from assayloom.plans.registry import M, matrix, projections, projections_sql, query, rounded, table
from assayloom.plans.relations import SCORED, scored
from assayloom.plans.tables import GAPS, gaps

BRIDGES = f"""{GAPS}, b AS (SELECT sample, 1 - count(value) / 64.0::DOUBLE AS missing_rate, avg(value) AS mean, stddev_samp(value) AS sd FROM g WHERE sample % 7 = 0 GROUP BY 1)"""


@query(f"WITH {BRIDGES} SELECT sample, round(missing_rate, 6) AS missing_rate, round(mean, 6) AS mean, round(sd, 6) AS sd, missing_rate < 0.2 AS high_quality FROM b")
def bridge_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = gaps(spark, sf_dir)
    return rounded(normalize.bridge_quality(g, g.filter("sample % 7 = 0")), "missing_rate", "mean", "sd")


@query(f"""WITH {BRIDGES}, k AS (SELECT feature, median(value) AS own FROM g JOIN b USING (sample) WHERE missing_rate < 0.2 GROUP BY 1),
    f AS (SELECT feature, least(greatest(coalesce((SELECT median(own) FROM k) / nullif(own, 0), 1), 0.1), 10) AS factor FROM k)
    SELECT sample, feature, round(factor, 6) AS factor, round(value * factor, 6) AS value FROM g JOIN f USING (feature)""")
def bridge_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = gaps(spark, sf_dir)
    return rounded(normalize.bridge_scale(g, g.filter("sample % 7 = 0")).select("sample", "feature", "factor", "value"), "factor", "value")


def _side(name: str, y: str) -> str:
    return f"""{name} AS (SELECT feature, corr(x, {y}) AS cor, avg((x - {y}) * (x - {y})) AS mse, avg(abs(x - {y})) AS mae, 1 - avg((x - {y}) * (x - {y})) / var_pop({y}) AS r2 FROM p GROUP BY 1 HAVING count(*) >= 5)"""


@query(f"""WITH {PAIRS}, {_side("a", "y")}, {_side("b", "((x + y) / 2)")}, j AS (SELECT feature, a.cor AS c0, b.cor AS c1, a.mse AS m0, b.mse AS m1, a.mae AS e0, b.mae AS e1, a.r2 AS r0, b.r2 AS r1 FROM a FULL JOIN b USING (feature))
    SELECT feature, round(c0, 6) AS cor_pre, round(m0, 6) AS mse_pre, round(e0, 6) AS mae_pre, round(r0, 6) AS r2_pre, round(c1, 6) AS cor_post, round(m1, 6) AS mse_post, round(e1, 6) AS mae_post, round(r1, 6) AS r2_post,
           round((m0 - m1) / m0, 6) AS mse_reduction, (m0 - m1) / m0 < 0 OR r1 < 0.5 AS poorly_harmonised FROM j""")
def concordance_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pairs(spark, sf_dir)
    out = association.concordance_change(p, p.withColumn("y", (F.col("x") + F.col("y")) / 2))
    return rounded(out, *[f"{c}_{t}" for t in ("pre", "post") for c in ("cor", "mse", "mae", "r2")], "mse_reduction")


@query(f"""WITH {PAIRS}, d AS (SELECT person, sqrt(sum((x - y) * (x - y))) AS distance FROM p GROUP BY 1), f AS (SELECT median(distance) AS floor FROM d WHERE person % 20 > 0),
    q AS (SELECT quantile_cont(distance, 0.25) AS a, quantile_cont(distance, 0.75) AS b FROM d), o AS (SELECT person, distance, distance / floor AS ratio, distance > b + (b - a) * 1.5 AS outlier_distance FROM d, q, f)
    SELECT person, round(distance, 6) AS distance, round(ratio, 6) AS ratio, outlier_distance, ratio > 3 AS outlier_noise, outlier_distance OR ratio > 3 AS outlier FROM o""")
def bridge_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assayloom.functions.stats import with_scalars

    d = association.pair_distance(pairs(spark, sf_dir))
    floor = d.filter("person % 20 > 0").agg(F.median("distance").alias("floor"))
    rows = with_scalars(d, floor).select("person", "distance", (F.col("distance") / F.col("floor")).alias("ratio"))
    return rounded(association.bridge_flags(rows), "distance", "ratio")


def _stage(name: str, value: str) -> str:
    return f"SELECT '{name}' AS stage, round(avg({value}), 2) AS mean, round(median({value}), 2) AS median, round(stddev_samp({value}), 2) AS sd, round(quantile_cont({value}, 0.75) - quantile_cont({value}, 0.25), 2) AS iqr FROM s"""


@query(f"""WITH {M}, s AS (SELECT value AS v, (value - avg(value) OVER (PARTITION BY feature)) * 10 AS w FROM m) {_stage("Before", "v")} UNION ALL {_stage("After", "w")}""")
def stage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = matrix(spark, sf_dir)
    means = m.groupBy("feature").agg(F.avg("value").alias("mean"))
    after = m.join(means, "feature").select("sample", "feature", ((F.col("value") - F.col("mean")) * 10).alias("value"))
    return rounded(association.stage_summary(m, after), "mean", "median", "sd", "iqr", digits=2)


@query(f"""WITH {SCAN}, b AS (SELECT feature, beta, se FROM t ORDER BY exp(-abs(beta / se)), feature LIMIT 50),
    w AS (SELECT k AS fold, feature, regr_slope(age, value) AS weight FROM x, (SELECT unnest([0, 1, 2, 3, 4]) AS k) WHERE sample % 5 <> k GROUP BY ALL),
    f AS (SELECT feature, avg(weight) AS m, quantile_cont(weight, 0.025) AS l, quantile_cont(weight, 0.975) AS h FROM w GROUP BY 1)
    SELECT feature, round(beta, 5) AS beta, round(beta - 1.96 * se, 5) AS beta_low, round(beta + 1.96 * se, 5) AS beta_high, round(m, 5) AS other_mean, round(l, 5) AS other_low, round(h, 5) AS other_high FROM b LEFT JOIN f USING (feature)""")
def effect_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = with_covariates(spark, sf_dir)
    fits = association.simple_scan(x, "age").withColumn("p", F.exp(-F.abs("t")))
    folds = x.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(4)))).filter("sample % 5 <> fold")
    weights = folds.groupBy("fold", "feature").agg(F.regr_slope("age", "value").alias("weight"))
    out = association.effect_comparison(fits, weights)
    return rounded(out, "beta", "beta_low", "beta_high", "other_mean", "other_low", "other_high", digits=5)


@query("""WITH o AS (SELECT o_custkey AS person, min(o_orderkey) AS sample, arg_min(o_orderpriority, o_orderkey) AS grp, max((o_totalprice > 200000)::INT) AS bad FROM orders GROUP BY 1)
    SELECT c_custkey AS person, c_acctbal AS pc1, sample, grp, coalesce(bad, 0) = 1 AS is_outlier FROM customer LEFT JOIN o ON person = c_custkey""")
def person_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("person"), F.col("o_orderkey").alias("sample"), F.col("o_orderpriority").alias("grp"), "o_totalprice")
    scores = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("person"), F.col("c_acctbal").alias("pc1"))
    return identity.person_components(scores, o.drop("o_totalprice"), o.filter("o_totalprice > 200000"))


@query(f"""WITH {M}, k AS (SELECT sample, {projections_sql("abcd")} FROM m GROUP BY 1), g AS (SELECT sample, CASE WHEN sample % 17 > 0 THEN a END AS a, b, c, d FROM k), e AS (SELECT median(a) AS ma FROM g), s AS (SELECT sample, coalesce(a, ma) AS a, b, c, d FROM g, e)
    SELECT x.sample AS a, y.sample AS b, round(sqrt((x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b) + (x.c - y.c) * (x.c - y.c) + (x.d - y.d) * (x.d - y.d)), 6) AS distance FROM s x JOIN s y ON y.sample = x.sample + 1""")
def genetic_pair_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On four scores of the whole matrix, of which one has gaps."""
    s = projections(matrix(spark, sf_dir), "abcd").withColumn("a", F.when(F.col("sample") % 17 > 0, F.col("a"))).withColumnsRenamed({c: f"pc_{c}" for c in "abcd"})
    asked = s.select(F.col("sample").alias("a"), (F.col("sample") + 1).alias("b"))
    return rounded(harmonisation.genetic_pair_distance(s, [f"pc_{c}" for c in "abcd"], asked), "distance")


@query(f"""WITH {SCORED}, c AS (SELECT score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label <> 1) AS n FROM s GROUP BY 1),
    r AS (SELECT score, sum(p) OVER (ORDER BY score DESC)::DOUBLE AS tp, sum(n) OVER (ORDER BY score DESC)::DOUBLE AS fp, (sum(p) OVER ())::DOUBLE AS a FROM c),
    l AS (SELECT *, coalesce(lag(tp) OVER (ORDER BY score DESC), 0) AS t, coalesce(lag(fp) OVER (ORDER BY score DESC), 0) AS f FROM r),
    k AS (SELECT *, (fp - f) / (tp - t) AS s FROM l WHERE tp > t)
    SELECT round(sum((tp - t) / (1 + s) - CASE WHEN t + f > 0 THEN (f - s * t) / ((1 + s) * (1 + s)) * ln((tp + fp) / (t + f)) ELSE 0 END) / max(a), 6) AS pr_auc FROM k""")
def pr_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(prediction.pr_auc(scored(spark, sf_dir)), "pr_auc")


@query(None)
def top_predictor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a sample's mean is over 0, from the features most associated with that, and its age."""
    m = matrix(spark, sf_dir)
    people = with_covariates(spark, sf_dir).groupBy("sample").agg((F.avg("value") > 0).cast("int").alias("label"), F.first("age").alias("age"))
    fits = association.linear_scan(m.join(people, "sample"), "label", []).withColumn("significant", F.col("p") < 0.05)
    return prediction.top_predictor(m, people, "label", prediction.top_features(fits), ("age",))


@query(None)
def label_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = matrix(spark, sf_dir)
    people = m.select("sample", (F.col("sample") % 2).alias("batch"), (F.col("grp") < 5).cast("int").alias("label")).distinct()
    fits = association.linear_scan(m.join(people, "sample"), "label", []).withColumn("significant", F.col("p").isNotNull())
    return prediction.label_accuracy(m, people, "label", prediction.top_features(fits))
