import numpy as np
import pytest
from pyspark.sql import functions as F

from assayloom.operators import harmonisation as h
from assayloom.operators.prediction import complete_vectors
from assayloom.plans.study import StudyPlan, save, several
from assayloom.sources.tables import Settings
from assayloom.streaming.plates import frozen_limits, plate_windows


def batch(spark, prefix, shift=0.0, n=30):
    r = np.random.default_rng(len(prefix))
    rows = [(f"{prefix}{i}", f"f{k}", float(r.normal(10 + shift)) + (50 if i == 0 else 0)) for i in range(n) for k in range(12)]
    rows += [(f"{prefix}gap", "f0", 1.0), (f"{prefix}1", "Extension control 2", 3.0)]
    m = spark.createDataFrame([(f"{prefix}{i}", f"p{i if i % 2 else prefix + str(i)}") for i in range(n)], "sample string, person string")
    return {"measurements": spark.createDataFrame(rows, "sample string, feature string, value double"), "mapping": m}


def test_one_batch_and_steps(spark, tmp_path):
    plan = StudyPlan(Settings.of({"z": 3.0}))
    t = plan.run(batch(spark, "a"))
    f = {r["sample"]: r for r in t["flags"].collect()}
    assert f["agap"]["initial"] == 1 and f["a0"]["technical"] == 1 and f["a5"]["qc_flag"] == 0
    clean = {r["sample"] for r in t["clean"].select("sample").distinct().collect()}
    assert not {"agap", "a0"} & clean and t["ranked"].filter("feature LIKE '%control%'").count() == 0
    assert plan.chosen(first="flags", last="scale") == ["flags", "scale"] and plan.chosen(only="load") == ["load"]
    with pytest.raises(ValueError, match="needs the table"):
        plan.run({}, only="flags")
    with pytest.raises(ValueError, match="no step"):
        plan.chosen(only="nothing")
    paths = save(spark, {"a": t}, str(tmp_path))
    assert [spark.read.parquet(p).count() > 0 for p in paths] == [True, True]


def test_several_batches(spark):
    with pytest.warns(UserWarning, match="broken is left out"):
        made = several(StudyPlan(), {"one": batch(spark, "a"), "two": batch(spark, "b", 2.0), "broken": {}}, "one", least_features=5)
    assert made.keys() == {"one", "two", "all"}
    people = [r["person"] for r in made["all"]["persons"].select("person").distinct().collect()]
    assert len(people) == len(set(people)) and "p1" in people
    two = {(r["person"], r["feature"]): r["value"] for r in made["two"]["persons"].collect()}
    assert all(abs(two[r["person"], r["feature"]] - r["value"]) < 1e-12 for r in made["all"]["persons"].filter("person = 'p1'").collect())


def test_all_steps(spark):
    """From raw tables to ranks: dosages, covariates, relatives and a shifted second batch."""
    r = np.random.default_rng(7)

    def one(prefix, shift):
        n, rows, geno = 24, [], []
        for i in range(n):
            for k in range(12):
                dosage = (i * 5 + k) % 3
                rows.append((f"{prefix}{i}", f"f{k}", float(r.normal(10 + shift + 3 * (i % 2) * (k < 3), 0.5) + dosage)))
                geno.append((f"{prefix}{i}", f"f{k}", f"v{k}", dosage, 1.0))
        make = spark.createDataFrame
        return {
            "measurements": make(rows, "sample string, feature string, value double"),
            "mapping": make([(f"{prefix}{i}", f"p{i}") for i in range(n)], "sample string, person string"),
            "genotypes": make(geno, "sample string, feature string, variant string, dosage int, beta double"),
            "covariates": make([(f"{prefix}{i}", float(20 + i % 7)) for i in range(n)], "sample string, age double"),
            "edges": make([("p2", "p4", 0.25), ("p2", "p6", 0.25), ("p10", "p12", 0.01)], "id1 string, id2 string, kinship double"),
        }

    plan = StudyPlan(Settings.of({"alphas": (0.5,), "strengths": (0.1,), "folds": 2, "inner_folds": 2, "injected": 3, "cohorts": 2}))
    given = one("a", 0.0)
    labels = spark.createDataFrame([(f"a{i}", i % 2 if i != 9 else 0) for i in range(23)] + [("a23", None), ("gone", 1)], "sample string, label int")
    t = plan.run(given | {"labels": labels, "training": given["genotypes"]}, last="flags")
    assert [x["sample"] for x in t["label_stats"].filter("strict_mismatch").collect()] == ["a9"] and t["label_stats"].count() == 23
    assert {x["sample"] for x in t["flags"].filter("label = 1").collect()} >= {"a9"} and t["trained"].count() == 1
    found = {x["category"]: (x["n"], x["detected"]) for x in t["provenance"].collect()}
    assert {c: n for c, (n, _) in found.items()} == {0: 5, 1: 6, 2: 6, 3: 6} and found[2][1] >= 5 and found[3][1] >= 5

    made = several(StudyPlan(), {"one": given, "two": one("b", 2.0)}, "one", least_features=5, bridged=True)
    first, second = made["one"], made["two"]
    assert "agreement" not in first
    assert first["genotype_stats"].count() == 24 and first["components"].count() == 24
    assert [x["id"] for x in first["related"].collect()] == ["p2"]
    people = {x["person"] for x in first["persons"].select("person").distinct().collect()}
    assert "p2" not in people and {"p4", "p6", "p10", "p12"} <= people
    change = second["feature_agreement"].collect()
    assert len(change) == 12 and all(x["mse_post"] < x["mse_pre"] for x in change)
    ranked = first["ranked"].groupBy("feature").avg("value").collect()
    assert len(ranked) == 12 and all(abs(x[1]) < 1e-6 for x in ranked)


def test_vectors_fill_gaps_and_absent_rows(spark):
    rows = [("a", "f1", 1.0), ("a", "f2", 4.0), ("b", "f1", 3.0), ("c", "f2", None), ("c", "f3", None)]
    got = {r["sample"]: list(r["features"]) for r in complete_vectors(spark.createDataFrame(rows, "sample string, feature string, value double")).collect()}
    assert got == {"a": [1.0, 4.0, 0.0], "b": [3.0, 4.0, 0.0], "c": [2.0, 4.0, 0.0]}


def test_stream_of_plates(spark, tmp_path):
    plates = spark.createDataFrame([(float(x),) for x in (9, 10, 11, 10, 9.5)], "mean_value double")
    limits = frozen_limits(plates)
    rows = [(f"2024-01-01 0{hr}:{m:02d}:00", p, v) for hr in range(1, 6) for m in (5, 40) for p, v in (("p1", 10.0), ("p2", 30.0))]
    df = spark.createDataFrame(rows, "t string, plate string, value double").select(F.to_timestamp("t").alias("ts"), "plate", "value")
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    q = plate_windows(stream, limits, late="10 minutes").writeStream.format("memory").queryName("plates_out").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    out = spark.sql("SELECT * FROM plates_out").collect()
    assert {r["plate"]: r["outlier"] for r in out} == {"p1": False, "p2": True} and len(out) == 8 and all(r["n"] == 2 for r in out)


def test_normal_cdf_and_chi_squared(spark):
    got = spark.range(1).select(h.normal_cdf(F.lit(1.96)).alias("a"), h.normal_cdf(F.lit(-0.5)).alias("b")).head()
    assert abs(got["a"] - 0.9750021) < 2e-7 and abs(got["b"] - 0.3085375) < 2e-7
    assert abs(h.chi_squared_quantile(0.95, 1) - 3.841459) < 1e-5 and abs(h.chi_squared_quantile(0.95, 7) - 14.06714) < 1e-4


def test_mixed_batches_score_well(spark):
    r = np.random.default_rng(9)
    rows = [(i, i % 2, float(r.normal()), float(r.normal())) for i in range(300)]
    mixed = spark.createDataFrame(rows, "sample int, batch int, a double, b double")
    apart = mixed.withColumn("a", F.col("a") + F.col("batch") * 50)
    assert h.kbet_acceptance(mixed, ["a", "b"], "batch").head()[0] > 0.85 and h.kbet_acceptance(apart, ["a", "b"], "batch").head()[0] < 0.05
    assert h.lisi(mixed, ["a", "b"], "batch", 10.0).head()[0] > 1.7 and h.lisi(apart, ["a", "b"], "batch", 10.0).head()[0] < 1.05


def test_kbet_takes_a_tenth_of_few_samples(spark, monkeypatch):
    asked, near = [], h.neighbours
    monkeypatch.setattr(h, "neighbours", lambda scores, columns, k: asked.append(k) or near(scores, columns, k))
    rows = spark.createDataFrame([(i, i % 2, float(i), 0.0) for i in range(60)], "sample int, batch int, a double, b double")
    assert h.kbet_acceptance(rows, ["a", "b"], "batch").head()[0] is not None and asked == [6]


def test_alignment_queries_keep_the_defaults(monkeypatch):
    from assayloom.plans import alignment

    monkeypatch.setattr(alignment, "_scores", lambda *a: None)
    for name, operator in (("lisi", "lisi"), ("kbet", "kbet_acceptance")):
        monkeypatch.setattr(h, operator, lambda *a, **k: k)
        assert getattr(alignment, name)(None, "") == {}


def test_shapiro_and_bootstrap(spark):
    x = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]  # W = 0.79 in the literature
    w = h.shapiro_w(spark.createDataFrame([("g", float(v)) for v in x], "g string, v double"), "v", "g").head()["w"]
    assert abs(w - 0.7888) < 2e-3
    from assayloom.operators import robust

    b = robust.bootstrap_median(spark.createDataFrame([(float(v),) for v in x], "v double"), "v", 2000).head()
    assert b["median"] == 162 and 154 <= b["low"] < 162 < b["high"] <= 195


def test_far_candidates_and_kpi(spark):
    d = spark.createDataFrame([(i, float(i)) for i in range(10)], "sample int, distance double")
    assert sorted(r["sample"] for r in h.far_candidates(d).collect()) == [7, 8, 9]
    kpi = {r["metric"]: r["pass"] for r in h.kpi_table({"icc": 0.5, "noise_ratio": 3.0, "other": 1.0}, {"icc": 0.95, "noise_ratio": 2.5, "other": 2.0, "lisi": 1.0}, spark).collect()}
    assert list(kpi)[:2] == ["euclidean", "mahalanobis"] and len(kpi) == len(h.TARGETS) + 1
    assert {n: kpi[n] for n in ("icc", "noise_ratio", "other", "lisi", "p", "euclidean")} == {"icc": "PASS", "noise_ratio": "WARN", "other": None, "lisi": "FAIL", "p": "FAIL", "euclidean": None}


def test_study_agrees_with_its_sql_where_samples_go(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    from assayloom.plans import models, registry

    r = np.random.default_rng(31)
    x = r.normal(size=(150, 64)) * 0.1 + r.normal(size=(150, 1)) * 0.05
    x[7] += 2 * np.sign(r.normal(size=64))  # far out on a component
    x[20] += 1.5  # a mean far off
    rows = [(i, v.astype(np.float32).tolist(), i % 10) for i, v in enumerate(x)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted(tuple(q) for q in models.study(spark, str(tmp_path)).select("feature", "n", "mean_value").collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = sorted(con.execute(registry.SQL["study"]).fetchall())
    assert got == want and len(got) == 64 and {n for _, n, _ in got} < {*range(140, 149)}
