"""Queries of what comes in and goes out: metadata, bridging lists, id maps, file lists, settings, views, plates as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayloom.functions.stats import qnorm_sql
from assayloom.operators import harmonisation as h
from assayloom.operators import qc
from assayloom.plans.people import scratch
from assayloom.plans.registry import M, matrix, query, rounded, table
from assayloom.sources import tables
from assayloom.streaming import plates


@query("SELECT c_custkey::BIGINT AS sample, c_mktsegment AS segment, CASE WHEN c_custkey % 9 > 0 THEN c_nationkey END AS nation FROM customer")
def metadata_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a metadata file with a sample column of another name."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("SAMPLE_ID"), F.col("c_mktsegment").alias("segment"), F.when(F.col("c_custkey") % 9 > 0, F.col("c_nationkey")).alias("nation"))
    tables.write_tsv(c, path := scratch(spark, "metadata"))
    return tables.metadata(spark, path).select(F.col("sample").cast("long").alias("sample"), "segment", F.col("nation").cast("int").alias("nation"))


@query("SELECT 'P' || c_custkey AS person, c_custkey % 2 = 0 AS in_1, CASE WHEN c_custkey % 5 > 0 THEN c_custkey % 3 = 0 END AS in_2 FROM customer WHERE c_custkey % 4 > 0")
def bridging_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    person = F.concat(F.when(key % 4 > 0, "P").otherwise("X"), key.cast("string"))
    rows = table(spark, sf_dir, "customer").select(person.alias("person_code"), F.when(key % 2 == 0, "T").otherwise("FALSE").alias("in_1"), F.when(key % 5 > 0, F.when(key % 3 == 0, "yes").otherwise("no")).alias("in_2"), F.lit("x").alias("other"))
    tables.write_tsv(rows, path := scratch(spark, "bridging"))
    return tables.bridging(spark, path, "person_code", "^P")


@query("SELECT 'T' || o_orderkey AS sample, 'P' || o_custkey AS person FROM orders WHERE o_orderkey % 7 > 0 AND o_orderkey % 3 > 0")
def id_map_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    person = F.when(key % 7 > 0, F.concat(F.when(key % 3 > 0, "P").otherwise("Q"), F.col("o_custkey").cast("string")))
    rows = table(spark, sf_dir, "orders").select(F.concat(F.lit("T"), key.cast("string")).alias("Tube_ID"), person.alias("PSEUDO_ID"))
    tables.write_tsv(rows, path := scratch(spark, "id-map"))
    return tables.id_map(spark, path, ("TubeId", "Tube_ID"), ("FGID", "PSEUDO_ID"), "^P")


@query("SELECT o_orderpriority AS batch FROM orders GROUP BY 1")
def batch_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches told from the files that they were written to."""
    tables.write_table(table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("batch")), path := scratch(spark, "batches"), "batch")
    files = tables.list_files(spark, path, "*.parquet").filter("length > 0")
    return files.select(F.url_decode(F.regexp_extract("path", "batch=([^/]+)/", 1)).alias("batch")).distinct()


@query("SELECT count(DISTINCT o_custkey) AS n, true AS same, false AS same_without_one FROM orders")
def content_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of a list of ids doesn't turn on its order or repeats, but on every id."""
    ids = table(spark, sf_dir, "orders").select("o_custkey")
    least = ids.agg(F.min("o_custkey").alias("_least"))
    keys = [tables.content_key(df, "o_custkey").withColumnRenamed("key", k) for k, df in (("a", ids), ("b", ids.distinct().orderBy(F.desc("o_custkey"))), ("c", ids.crossJoin(F.broadcast(least)).filter("o_custkey > _least").select("o_custkey")))]
    n = ids.agg(F.count_distinct("o_custkey").alias("n"))
    return n.crossJoin(keys[0]).crossJoin(keys[1]).crossJoin(keys[2]).select("n", (F.col("a") == F.col("b")).alias("same"), (F.col("a") == F.col("c")).alias("same_without_one"))


@query("SELECT * FROM (SELECT 'z' AS name, round(avg(p_size), 6) AS value FROM part UNION ALL SELECT 'kinship', round(avg(p_retailprice) / 10000, 6) FROM part UNION ALL SELECT 'max_missing', 0.1::DOUBLE)")
def settings_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings that were learnt, written as a table and read again over the defaults."""
    r = table(spark, sf_dir, "part").agg(F.avg("p_size").alias("z"), (F.avg("p_retailprice") / 10_000).alias("kinship")).head()
    learnt = tables.Settings.of({"z": round(r["z"], 6), "kinship": round(r["kinship"], 6)})
    names = ("z", "kinship", "max_missing")
    tables.write_table(spark.createDataFrame([(n, float(learnt.items()[n])) for n in names], "name string, value double"), path := scratch(spark, "settings"))
    again = tables.Settings.of({r["name"]: r["value"] for r in spark.read.parquet(path).collect()})
    return spark.createDataFrame([(n, float(again.items()[n])) for n in names], "name string, value double")


@query("SELECT s_suppkey AS id, s_name AS name, NULL::DOUBLE AS score, NULL::BOOLEAN AS flag FROM supplier")
def typed_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table without rows still gives its columns and types to a union."""
    none = tables.empty_like(spark, "id long, name string, score double, flag boolean")
    return none.unionByName(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), allowMissingColumns=True)


@query(f"WITH {M} SELECT grp, count(DISTINCT sample) AS n, round(avg(value), 6) AS mean_value FROM m GROUP BY 1")
def sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results are views for SQL text as they are."""
    m = matrix(spark, sf_dir)
    return rounded(spark.sql("SELECT grp, count(DISTINCT m.sample) AS n, avg(value) AS mean_value FROM {m} m JOIN {q} q ON m.sample = q.sample WHERE qc_pass GROUP BY grp", m=m, q=qc.sample_missingness(m)), "mean_value")


@query(f"WITH {M}, g AS (SELECT DISTINCT sample FROM m WHERE (sample * 7 + feature) % 211 = 0) SELECT sample, feature, round(value, 6) AS value FROM m WHERE sample NOT IN (SELECT sample FROM g)")
def fixed_basis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a matrix with gaps, the complete samples stand for the basis, as there are enough of them."""
    m = matrix(spark, sf_dir).withColumn("value", F.when((F.col("sample") * 7 + F.col("feature")) % 211 != 0, F.col("value")))
    return rounded(h.fixed_basis_policy(m).select("sample", "feature", "value"), "value")


@query(f"""WITH {M}, k AS (SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) AS i, count(*) OVER (PARTITION BY feature) AS n FROM m), q AS (SELECT *, (i - 0.5::DOUBLE) / n AS p FROM k)
    SELECT feature, i::INT AS i, round({qnorm_sql("p")}, 6) AS theoretical, round(value, 6) AS observed FROM q""")
def qq_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(h.qq_points(matrix(spark, sf_dir), "value", "feature"), "theoretical", "observed")


HOURS = "e AS (SELECT event_type AS plate, time_bucket(INTERVAL 1 HOUR, ts) AS start, count(value) AS n, avg(value) AS mean_value FROM events GROUP BY ALL), c AS (SELECT median(mean_value) AS med FROM e), l AS (SELECT any_value(med) AS med, 1.4826::DOUBLE * median(abs(mean_value - med)) AS mad FROM e, c)"


@query(f"""WITH {HOURS} SELECT plate, start, n, round(mean_value, 6) AS mean_value, mean_value < med - 5 * mad OR mean_value > med + 5 * mad AS outlier FROM e, l
    WHERE start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""")
def plate_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly means of event types as a stream: the windows that the watermark has closed once all rows have come."""
    events = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("plate"), "value")
    hours = events.groupBy(F.window("ts", "1 hour"), "plate").agg(F.avg("value").alias("mean_value"))
    limits = plates.frozen_limits(hours)
    events.write.parquet(source := scratch(spark, "plates-in"))
    stream = spark.readStream.schema(events.schema).parquet(source)
    target = scratch(spark, "plates-out")
    follow = plates.follow(plates.plate_windows(stream, limits), target, scratch(spark, "plates-checkpoint"))
    follow.awaitTermination()
    if follow.exception() is not None:
        raise follow.exception()
    out = spark.read.parquet(target)
    return rounded(out.select("plate", F.col("start").cast("timestamp_ntz").alias("start"), "n", "mean_value", "outlier"), "mean_value")
