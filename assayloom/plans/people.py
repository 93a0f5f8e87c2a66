"""Queries of identity, covariates, sources and the KPI table over the stand-in tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayloom.operators import association, genetics, harmonisation, identity, prediction, qc
from assayloom.plans.harmony import PAIRS, pairs
from assayloom.plans.registry import M, matrix, query, rounded, table
from assayloom.sources import tables


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder of spark.checkpoint.dir; only a local session without one gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.gettempdir() + "/assayloom-shared"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def pick(k: str, *values: str | None):  # noqa: ANN201
    return F.get(F.array(*[F.lit(v) for v in values]), (F.col(k) % len(values)).cast("int"))


@query("""SELECT c_custkey AS id, CASE c_custkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 2 END AS code FROM customer""")
def sex_recode(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = pick("c_custkey", "0", " Male", "FEMALE ", "f", "x")
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), identity.sex_code(raw).alias("code"))


@query("""SELECT c_custkey AS id, CASE c_custkey % 6 WHEN 5 THEN NULL ELSE c_custkey % 6 IN (0, 1, 3, 4) END AS flag FROM customer""")
def bool_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = pick("c_custkey", "TRUE", "t", "false", "1", " Yes", None)
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), tables.to_bool(raw).alias("flag"))


@query("""SELECT c_custkey AS id, coalesce(CASE WHEN c_acctbal >= 0 THEN c_acctbal END, s_acctbal) AS balance FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey""")
def coalesce_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"))
    return identity.coalesce_update(own, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance")), "id", ["balance"])


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix(spark, sf_dir).select("sample").distinct().select("sample", F.when(F.col("sample") % 3 != 0, F.col("sample") * 10).alias("person"))


@query(f"WITH {M} SELECT sample * 10 AS person, feature, round(value, 6) AS value FROM m WHERE sample % 3 <> 0 AND sample % 7 <> 0")
def rekey(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = matrix(spark, sf_dir)
    return rounded(identity.rekey(m, mapping(spark, sf_dir), m.filter("sample % 7 = 0").select("sample")), "value")


@query(f"WITH {M} SELECT sample, feature, CASE WHEN sample % 3 <> 0 THEN sample * 10 END AS person FROM m")
def add_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.add_person(matrix(spark, sf_dir).select("sample", "feature"), mapping(spark, sf_dir))


@query(f"WITH {M} SELECT DISTINCT sample, sample % 5 = 0 AND sample % 2 = 1 AS mismatch FROM m WHERE sample % 4 < 2")
def cross_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = matrix(spark, sf_dir).select("sample").distinct()
    told = s.filter("sample % 5 = 0").select("sample", F.when(F.col("sample") % 2 == 1, "TRUE").otherwise("FALSE").alias("mismatch"))
    return identity.cross_reference(s.filter("sample % 4 < 2"), told)


@query("""WITH k AS (SELECT c_custkey AS person, DATE '2020-01-01' + (c_custkey % 300)::INT AS collected, CASE WHEN c_custkey % 5 > 0 THEN DATE '1960-01-01' + ((c_custkey * 37) % 20000)::INT END AS birth, c_custkey % 3 AS s, (c_custkey % 80)::DOUBLE AS base FROM customer),
    a AS (SELECT person, CASE WHEN person % 7 > 0 THEN coalesce((collected - birth) / 365.25::DOUBLE, base) WHEN person % 2 = 0 THEN 18 END AS age, CASE WHEN person % 7 > 0 THEN CASE s WHEN 0 THEN 1 WHEN 1 THEN 2 END WHEN person % 2 = 0 THEN 2 END AS sex FROM k)
    SELECT person, round(age, 6) AS age, sex, age IS NOT NULL AND sex IS NOT NULL AS complete, coalesce(age <= 20, false) AS young FROM a""")
def covariates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh person is absent from the main table; half of those are in the supplement."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        k.alias("person"), F.date_add(F.lit("2020-01-01").cast("date"), (k % 300).cast("int")).alias("collected"),
        F.when(k % 5 > 0, F.date_add(F.lit("1960-01-01").cast("date"), ((k * 37) % 20000).cast("int"))).alias("birth"), pick("c_custkey", "0", "female", None).alias("sex"), (k % 80).cast("double").alias("baseline_age"),
    )
    extra = rows.filter("person % 14 = 0").withColumns({"birth": F.lit(None).cast("date"), "sex": F.lit("F"), "baseline_age": F.lit(18.0)})
    out = identity.covariates(rows.select("person", "collected"), rows.filter("person % 7 > 0"), rows.filter("person % 7 = 1").unionByName(extra))
    return rounded(out.select("person", "age", "sex", "complete", "young"), "age")


@query("WITH q AS (SELECT quantile_cont(p_retailprice, 0.9) AS c FROM part) SELECT p_partkey AS sample, p_retailprice AS distance FROM part, q WHERE p_retailprice >= c")
def far_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harmonisation.far_candidates(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("sample"), F.col("p_retailprice").alias("distance")))


@query("""WITH p AS (SELECT c_custkey AS id1, c_custkey + 1 AS id2 FROM customer WHERE c_custkey % 4 = 1), f AS (SELECT *, (id1 * 7 % 5) / 10.0::DOUBLE AS m1, (id2 * 7 % 5) / 10.0::DOUBLE AS m2 FROM p),
    k AS (SELECT id1, id2, CASE WHEN m1 < m2 OR (m1 = m2 AND id1 < id2) THEN id1 ELSE id2 END AS keep FROM f)
    SELECT id1, id2, keep, keep % 3 <> 0 AS kept, (id1 + id2 - keep) % 3 = 0 AS other_removed FROM k""")
def duplicate_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    both = c.unionByName(c.select((F.col("id") + 1).alias("id"))).distinct()
    dup = c.filter("id % 4 = 1").select(F.col("id").alias("id1"), (F.col("id") + 1).alias("id2"), F.lit("duplicate").alias("relationship"))
    return genetics.duplicate_check(dup, both.select("id", (F.col("id") * 7 % 5 / 10.0).alias("missing_rate")), both.filter("id % 3 = 0"))


@query("SELECT doc_id, round(abs(score - 0.5) * 2, 6) AS sure, abs(score - 0.5) * 2 > 0.95 AS high FROM (SELECT doc_id, (doc_id * 7919 % 10007) / 10007.0::DOUBLE AS score FROM labels)")
def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    sure, high = prediction.evidence(F.col("doc_id") * 7919 % 10007 / 10007.0)
    return rounded(table(spark, sf_dir, "labels").select("doc_id", sure.alias("sure"), high.alias("high")), "sure")


@query("""WITH v AS (SELECT n_nationkey + 1 AS pc, 1.0::DOUBLE / (n_nationkey + 1) AS variance FROM nation), s AS (SELECT pc, variance, variance / sum(variance) OVER () AS share FROM v), c AS (SELECT *, sum(share) OVER (ORDER BY pc) AS cumulative FROM s)
    SELECT pc, round(share, 6) AS share, round(cumulative, 6) AS cumulative, cumulative - share < 0.95 AS needed FROM c""")
def cumulative_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "nation").select((F.col("n_nationkey") + 1).alias("pc"), (F.lit(1.0) / (F.col("n_nationkey") + 1)).alias("variance"))
    return rounded(association.cumulative_variance(v), "share", "cumulative").drop("variance")


@query("SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer")
def tsv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as TSV with gaps as NA and read by the scan that finds the separator."""
    path = scratch(spark, "tsv") + ".tsv"
    tables.write_tsv(table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal")), path)
    return tables.scan(spark, path, T.StructType.fromDDL("c_custkey long, c_name string, c_acctbal double"))


@query("SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier")
def gzip_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "csv")
    table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal").write.option("header", True).option("compression", "gzip").csv(path + ".csv.gz")
    return tables.scan(spark, path + ".csv.gz", T.StructType.fromDDL("s_suppkey long, s_nationkey int, s_acctbal double"))


@query("SELECT user_id::VARCHAR AS sample, event_type AS feature, round(avg(value), 6) AS value FROM events GROUP BY ALL")
def long_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long measurement table as Parquet, repeated cells averaged."""
    path = scratch(spark, "long") + ".parquet"
    tables.write_table(table(spark, sf_dir, "events").select(F.col("user_id").alias("SampleID"), F.col("event_type").alias("Assay"), F.col("value").alias("NPX")), path)
    return rounded(tables.to_long(tables.scan(spark, path)), "value")


@query("SELECT c_custkey::VARCHAR AS id1, (c_custkey + 1)::VARCHAR AS id2, round(c_nationkey / 50.0::DOUBLE, 6) AS kinship FROM customer WHERE c_custkey % 3 = 0")
def kinship_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "kinship") + ".tsv"
    edges = table(spark, sf_dir, "customer").filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("ID1"), (F.col("c_custkey") + 1).alias("ID2"), F.round(F.col("c_nationkey") / 50.0, 6).alias("Kinship"))
    tables.write_tsv(edges, path)
    return tables.kinship_edges(spark, path).select(F.col("id1").cast("string").alias("id1"), F.col("id2").cast("string").alias("id2"), "kinship")


@query("""SELECT iid, variant, dosage FROM (SELECT c_custkey AS iid, 'chr1_5_A_G' AS variant, (c_custkey % 3)::INT AS dosage FROM customer UNION ALL SELECT c_custkey, 'chr2_7_C_T', CASE WHEN c_custkey % 11 > 0 THEN (c_custkey * 7 % 3)::INT END FROM customer)
    WHERE variant = 'chr2_7_C_T' AND iid % 2 = 0""")
def selected_genotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    raw = table(spark, sf_dir, "customer").select(k.alias("FID"), k.alias("IID"), (k % 3).alias("chr1_5_A_G_G"), F.when(k % 11 > 0, k * 7 % 3).alias("chr2_7_C_T_T"))
    wanted = spark.createDataFrame([("chr2_7_C_T",), ("chr9_1_A_C",)], "variant string")
    return tables.select_variants(tables.genotypes_long(raw), wanted, raw.filter("IID % 2 = 0").select(F.col("IID").alias("iid")))


@query("SELECT s_suppkey::VARCHAR AS s_suppkey, NULL::DOUBLE AS absent, s_name FROM supplier")
def conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.conform(table(spark, sf_dir, "supplier"), T.StructType.fromDDL("s_suppkey string, absent double, s_name string"))


def with_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix with a cell's QC: of every tenth sample half of the features fail, of all others one."""
    return matrix(spark, sf_dir).withColumn("failed", F.when(F.col("sample") % 10 == 0, F.col("feature") % 2 == 0).otherwise(F.col("feature") == 3))


FAILED = f"{M}, q AS (SELECT *, CASE WHEN sample % 10 = 0 THEN feature % 2 = 0 ELSE feature = 3 END AS failed FROM m)"


@query(f"""WITH {FAILED}, s AS (SELECT sample, avg(value) AS mean, stddev_samp(value) AS sd, sum(failed::INT)::DOUBLE / count(*) AS rate, sum((value IS NULL)::INT)::DOUBLE / count(*) AS missing FROM q GROUP BY 1),
    c AS (SELECT median(mean) AS cm, median(sd) AS cs FROM s), d AS (SELECT 1.4826::DOUBLE * median(abs(mean - cm)) AS dm, 1.4826::DOUBLE * median(abs(sd - cs)) AS ds FROM s, c)
    SELECT sample, round(rate, 6) AS qc_fail_rate, rate > 0.3 AS qc_outlier, abs(mean - cm) > 5 * dm OR sd > cs + 4 * ds OR missing > 0.05 OR rate > 0.3 AS is_outlier FROM s, c, d""")
def technical_qc_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(qc.sample_technical_stats(with_failures(spark, sf_dir)).select("sample", "qc_fail_rate", "qc_outlier", "is_outlier"), "qc_fail_rate")


@query(f"WITH {FAILED} SELECT grp AS plate, count(DISTINCT sample) AS n_samples, round(sum(failed::INT)::DOUBLE / count(*), 6) AS qc_fail_rate FROM q GROUP BY 1")
def plate_qc_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_failures(spark, sf_dir).withColumnRenamed("grp", "plate")
    return rounded(qc.plate_stats(rows).select("plate", "n_samples", "qc_fail_rate"), "qc_fail_rate")


AGREE = "SELECT median(icc) AS icc, median(ccc) AS ccc FROM (SELECT 2 * covar_samp(x, y) / (var_samp(x) + var_samp(y)) AS icc, 2 * covar_pop(x, y) / (var_pop(x) + var_pop(y) + (avg(x) - avg(y)) * (avg(x) - avg(y))) AS ccc FROM {0} GROUP BY person)"


@query(f"""WITH {PAIRS}, h AS (SELECT person, feature, x, 0.9 * x + 0.1 * y AS y FROM p), a AS ({AGREE.format("p")}), b AS ({AGREE.format("h")}),
    d AS (SELECT (SELECT median(d) FROM (SELECT sqrt(sum((x - y) * (x - y))) AS d FROM p GROUP BY person)) AS pre, (SELECT median(d) FROM (SELECT sqrt(sum((x - y) * (x - y))) AS d FROM h GROUP BY person)) AS post),
    t AS (SELECT unnest([{", ".join(f"'{n}'" for n, _ in harmonisation.TARGETS)}]) AS metric, unnest([{", ".join(f"'{t}'" for _, t in harmonisation.TARGETS)}]) AS target),
    v AS (SELECT metric, target, CASE metric WHEN 'euclidean' THEN d.pre WHEN 'icc' THEN a.icc WHEN 'ccc' THEN a.ccc END AS pre,
          CASE metric WHEN 'euclidean' THEN d.post WHEN 'icc' THEN b.icc WHEN 'ccc' THEN b.ccc WHEN 'noise_ratio' THEN 2.5 WHEN 'kbet' THEN 0.4 WHEN 'lisi' THEN 1.6 WHEN 'p' THEN 0.01 WHEN 'excludes_zero' THEN 0 END::DOUBLE AS post FROM t, a, b, d)
    SELECT metric, target, round(pre, 6) AS pre, round(post, 6) AS post,
           CASE WHEN metric = 'euclidean' THEN CASE WHEN post < pre THEN 'PASS' ELSE 'FAIL' END WHEN metric IN ('icc', 'ccc') THEN CASE WHEN post > 0.9 THEN 'PASS' WHEN post > 0.7 THEN 'WARN' ELSE 'FAIL' END
                WHEN metric = 'noise_ratio' OR metric = 'lisi' THEN 'WARN' WHEN metric IN ('kbet', 'rank1', 'excludes_zero') THEN 'FAIL' WHEN metric = 'p' THEN 'PASS' END AS pass FROM v""")
def kpi_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances and agreement before and after a shrinkage of the pairs; the other measures are given."""
    p = pairs(spark, sf_dir)
    drawn = p.withColumn("y", F.col("x") * 0.9 + F.col("y") * 0.1)
    measured = []
    for rows in (p, drawn):
        agreed = association.pair_agreement(rows).agg(F.median("icc").alias("icc"), F.median("ccc").alias("ccc")).head()
        measured.append({"icc": agreed["icc"], "ccc": agreed["ccc"], "euclidean": association.pair_distance(rows).agg(F.median("distance")).head()[0]})
    return rounded(harmonisation.kpi_table(measured[0], measured[1] | {"noise_ratio": 2.5, "kbet": 0.4, "lisi": 1.6, "p": 0.01, "excludes_zero": 0.0}, spark), "pre", "post")
