"""Queries whose SQL and plan could part on ties and on sizes that the smallest tables don't have."""

import pytest

from assayloom.plans import alignment, harmony, registry, relations  # noqa: F401


def run_both(spark, tmp_path, name, **given):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t, df in given.items():
        df.write.mode("overwrite").parquet(f"{tmp_path}/{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    df = registry.QUERIES[name](spark, str(tmp_path))
    rel = con.execute(registry.SQL[name])
    names = [d[0] for d in rel.description]
    plain = lambda v: round(v, 6) + 0.0 if isinstance(v, float) else v
    want = sorted(repr([plain(r[names.index(c)]) for c in df.columns]) for r in rel.fetchall())
    assert sorted(repr([plain(v) for v in r]) for r in df.collect()) == want
    return want


def test_equal_p_values_are_adjusted_alike(spark, tmp_path):
    n = 3 * 10007
    rows = run_both(spark, tmp_path, "bh_adjust", part=spark.range(1, n + 1, numPartitions=7).withColumnRenamed("id", "p_partkey"))
    assert len(rows) == n
    by_p = {}
    for r in registry.QUERIES["bh_adjust"](spark, str(tmp_path)).collect():
        by_p.setdefault(r["p"], set()).add(r["p_adj"])
    assert all(len(v) == 1 for v in by_p.values())


@pytest.mark.parametrize("n", [2, 3, 4, 5, 6, 11, 12, 5000, 5001])
def test_shapiro_of_few_and_of_many(spark, tmp_path, n):
    vectors = spark.range(n).selectExpr("id AS vec_id", "concat(array(1.0f), transform(sequence(1, 63), k -> cast(sin(id * 1.37 + k) as float))) AS embedding", "cast(id % 3 as int) AS label")
    rows = run_both(spark, tmp_path, "shapiro", embeddings=vectors)
    known = sum("None" not in r for r in rows)
    assert known == (63 if 3 <= n <= 5000 else 0)


def test_pairs_of_keys_on_both_sides(spark, tmp_path):
    c = spark.range(50).selectExpr("id AS c_custkey", "cast(nullif(id % 5, 4) as int) AS c_nationkey")
    s = spark.range(20).selectExpr("id AS s_suppkey", "cast(nullif(id % 6, 5) as int) AS s_nationkey")
    assert len(run_both(spark, tmp_path, "many_to_many", customer=c, supplier=s)) == 4
    plan = registry.QUERIES["many_to_many"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")  # counted before they meet
