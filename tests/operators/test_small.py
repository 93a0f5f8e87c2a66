"""Operators on rows small enough to check by hand."""

import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayloom.functions import stats
from assayloom.operators import association, genetics, identity, normalize, pca, prediction, qc
from assayloom.sources import tables


def long(spark, rows):
    return spark.createDataFrame(rows, "sample string, feature string, value double")


def test_qnorm(spark):
    ps = [1e-9, 0.001, 0.02, 0.02425, 0.3, 0.5, 0.7, 0.98, 0.999999]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in [*ps, 0.0, 1.0]], "p double").select(stats.qnorm(F.col("p"))).collect()]
    assert got[-2:] == [None, None]
    assert all(abs(a - statistics.NormalDist().inv_cdf(p)) < 1e-7 for a, p in zip(got, ps, strict=False))


def test_average_rank_and_inverse_normal(spark):
    rows = [("a", "f", 3.0), ("b", "f", 1.0), ("c", "f", 3.0), ("d", "f", None), ("e", "f", 4.0), ("a", "g", 1.0), ("b", "g", 2.0)]
    out = {(r["sample"], r["feature"]): r for r in long(spark, rows).select("sample", "feature", stats.avg_rank("value", "feature").alias("r"), stats.inverse_normal("value", "feature").alias("v")).collect()}
    assert [out[s, "f"]["r"] for s in "abcde"] == [2.5, 1, 2.5, None, 4]
    assert abs(out["e", "f"]["v"] - statistics.NormalDist().inv_cdf(3.5 / 4)) < 1e-7
    assert out["a", "g"]["v"] == 1.0  # too few to transform


def test_zscore_of_constant_short_and_missing(spark):
    rows = [(s, "c", 2.0) for s in "abc"] + [("a", "s", 1.0), ("b", "s", 2.0)] + [("a", "n", None), ("b", "n", 1.0), ("c", "n", 2.0), ("d", "n", 3.0)]
    out = {(r["sample"], r["feature"]): r["z"] for r in long(spark, rows).select("sample", "feature", stats.zscore("value", "feature").alias("z")).collect()}
    assert out["a", "c"] == 0 and out["a", "s"] is None and out["a", "n"] is None and out["d", "n"] == 1


def test_mad_and_benjamini_hochberg(spark):
    df = spark.createDataFrame([(1.0, 0.01), (2.0, 0.04), (4.0, 0.03), (100.0, None)], "x double, p double")
    assert stats.center_and_mad(df, "x").collect()[0].asDict() == {"median": 3.0, "mad": 1.4826 * 1.5}
    assert [r[0] for r in df.select(stats.benjamini_hochberg("p")).collect()].count(None) == 1
    assert sorted(round(r[0], 6) for r in df.select(stats.benjamini_hochberg("p")).collect() if r[0] is not None) == [0.03, 0.04, 0.04]


def test_t_distribution():
    p = association.t_two_sided(np.array([0.0, 2.0, 12.706, -2.228, 50.0]), np.array([5.0, 10.0, 1.0, 10.0, 30.0]))
    assert np.allclose(p[:4], [1, 0.07338803, 0.05, 0.05], atol=2e-5) and p[4] < 1e-20


def test_cascade_recomputes_on_survivors(spark):
    values = [0.0, 0.1, -0.1, 0.05, -0.05, 0.02, -0.02, 0.08, -0.08, 0.0, 100.0, 3.0]
    scores = spark.createDataFrame([(str(i), v, 0.0, v, 0.0) for i, v in enumerate(values)], "sample string, a double, b double, c double, d double")
    rows = long(spark, [(str(i), f, float(k)) for i in range(12) for k, f in enumerate("xyz")])
    out = {r["sample"]: r for r in qc.outlier_cascade(scores, rows, ("a", "b", "c", "d"), k=3.0).collect()}
    assert out["10"]["outlier_pc12"] and not out["10"]["outlier_pc34"]
    assert not out["11"]["outlier_pc12"] and out["11"]["outlier_pc34"]  # hidden by the first one before
    scaled = scores.withColumns({c: F.col(c) * 7 for c in "abcd"})
    assert {r["sample"]: r["is_outlier"] for r in qc.outlier_cascade(scaled, rows, ("a", "b", "c", "d"), k=3.0).collect()} == {k: v["is_outlier"] for k, v in out.items()}


def test_flags_of_all_samples(spark):
    s = spark.createDataFrame([(x,) for x in "abc"], "sample string")
    out = {r["sample"]: (r["n_methods"], r["detection_steps"], r["qc_flag"]) for r in qc.comprehensive_qc(s, {"one": s.filter("sample = 'a'"), "two": s.filter("sample <> 'c'")}).collect()}
    assert out == {"a": (2, "one,two", 1), "b": (1, "two", 1), "c": (0, "", 0)}


def test_median_scale_edges(spark):
    rows = [("a", "zero", 0.0), ("b", "zero", 0.0), ("a", "tiny", 0.001), ("b", "tiny", 0.001), ("a", "one", 1.0), ("b", "one", 1.0)]
    f = {r["feature"]: r["factor"] for r in normalize.median_scale(long(spark, rows)).collect()}
    assert f == {"zero": 1.0, "tiny": 1.0, "one": 0.1}


def test_bridge_needs_people(spark):
    a = spark.createDataFrame([("p", "f", 1.0)], "person string, feature string, value double")
    with pytest.raises(ValueError, match="1 people"):
        normalize.bridge_factors(a, a)


def test_two_covariates_leave_no_correlation(spark):
    r = np.random.default_rng(0)
    x, y = r.normal(size=200), r.normal(size=200)
    v = 2 * x - 3 * y + r.normal(size=200)
    df = spark.createDataFrame([(str(i), "f", float(v[i]), float(x[i]), None if i == 0 else float(y[i])) for i in range(200)], "sample string, feature string, value double, x double, y double")
    out = {r_["sample"]: r_["value"] for r_ in normalize.covariates_residualise(df, ["x", "y"]).collect()}
    res = np.array([out[str(i)] for i in range(200)])
    assert res[0] == v[0]
    assert abs(np.corrcoef(res[1:], x[1:])[0, 1]) < 1e-9 and abs(np.corrcoef(res[1:], y[1:])[0, 1]) < 1e-9
    assert abs(res[1:].mean() - v[1:].mean()) < 1e-9


def test_combat_brings_batches_together(spark):
    r = np.random.default_rng(1)
    rows = [(b, f"{b}{s}", f"f{k}", float(r.normal(k + 2 * b, 1 + b))) for b in (0, 1) for s in range(40) for k in range(12)]
    df = spark.createDataFrame(rows, "batch int, sample string, feature string, value double")
    m = normalize.combat(df).groupBy("batch", "feature").agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("s")).toPandas().pivot(index="feature", columns="batch", values=["m", "s"])
    assert (m["m"][0] - m["m"][1]).abs().max() < 0.5 and (m["s"][0] / m["s"][1]).between(0.6, 1.6).all()


def test_greedy_pruning(spark):
    edges = spark.createDataFrame([(1, i, 0.2) for i in range(2, 6)] + [(10, 11, 0.2), (11, 12, 0.2), (12, 13, 0.2), (20, 21, 0.2), (20, 20, 0.9)], "id1 long, id2 long, kinship double")
    missing = spark.createDataFrame([(i, 0.5 if i == 21 else 0.1, i) for i in range(30)], "id long, missing_rate double, ordinal long")
    gone = sorted(r["id"] for r in genetics.greedy_unrelated(edges, missing).collect())
    assert gone == [1, 11, 12, 21]  # the hub; one then the other inside the chain; the pair's worse sample
    labels = {r["node"]: r["component"] for r in genetics.component_labels(edges).collect()}
    assert labels[13] == 10 and labels[5] == 1 and labels[20] == 20


def test_correlation_groups_and_pairs(spark):
    r = np.random.default_rng(2)
    a, b = r.normal(size=60), r.normal(size=60)
    cols = {"a1": a, "a2": a * 2 + 0.01 * r.normal(size=60), "b": b, "a3": -a + 0.01 * r.normal(size=60)}
    df = long(spark, [(str(i), k, float(v[i])) for k, v in cols.items() for i in range(60)])
    g = {x["feature"]: x["group_id"] for x in genetics.correlation_groups(df).collect()}
    assert g["a1"] == g["a2"] == g["a3"] != g["b"]
    assert genetics.correlations(df).count() == 6


def test_pca_against_numpy(spark):
    r = np.random.default_rng(3)
    m = r.normal(size=(50, 6)) @ np.diag([5, 3, 1, 1, 1, 1])
    df = spark.createDataFrame([(i, k, None if (i, k) == (0, 0) else float(m[i, k])) for i in range(50) for k in range(6)], "sample int, feature int, value double")
    basis = pca.pca(df, 2)
    m[0, 0] = np.median(m[1:, 0])
    z = (m - m.mean(0)) / m.std(0, ddof=1)
    s = np.linalg.svd(z, full_matrices=False)[1]
    got = {(x["sample"], x["pc"]): x["score"] for x in basis.scores.collect()}
    for pc in (1, 2):
        assert abs(sum(got[i, pc] ** 2 for i in range(50)) - s[pc - 1] ** 2) < 1e-6
    again = {(x["sample"], x["pc"]): x["score"] for x in association.project(pca.imputed(df), basis.loadings).collect()}
    assert all(abs(again[k] - got[k]) < 1e-9 for k in got)


def test_injected_errors(spark):
    people = spark.createDataFrame([(f"s{i}", i % 2) for i in range(100)], "sample string, label int")
    truth = {r["sample"]: r for r in prediction.inject_errors(people, 4).collect()}
    label = {f"s{i}": i % 2 for i in range(100)}
    by = lambda c: [r for r in truth.values() if r["category"] == c]
    assert [len(by(c)) for c in range(4)] == [76, 8, 8, 8]
    assert all(r["source"] != r["sample"] and label[r["source"]] == label[r["sample"]] for r in by(1))
    assert all(r["new_label"] == 1 - label[r["sample"]] and r["source"] == r["sample"] for r in by(2))
    assert all(label[r["source"]] != label[r["sample"]] for r in by(3))
    assert sorted(r["source"] for r in by(1) + by(3)) == sorted(r["sample"] for r in by(1) + by(3))


def test_youden_and_platt(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0), (0.35, 1), (0.4, 0), (0.8, 1), (0.9, 1)], "score double, label int")
    best = prediction.youden(df).collect()[0]
    assert (best["j"], round(best["threshold"], 2)) == (0.666666666667, 0.21)
    assert prediction.platt(df).columns[-1] == "calibrated"


def test_identity(spark):
    m = spark.createDataFrame([("s1", "p1"), ("s2", "p1"), ("s3", None), ("s4", "p2")], "sample string, person string")
    assert [tuple(r) for r in identity.replicate_pairs(m).collect()] == [("p1", "s1", "s2")]
    df = spark.createDataFrame([("male",), ("1",), ("F",), ("x",), (None,)], "s string")
    assert [r[0] for r in df.select(identity.sex_code(F.col("s"))).collect()] == [1, 2, 2, None, None]
    with pytest.raises(ValueError, match="common features"):
        identity.batch_union(*[spark.createDataFrame([("p", "f", 1.0)], "person string, feature string, value double")] * 2)


def test_sources_round_trip(spark, tmp_path):
    wide = spark.createDataFrame([("a", 1.0, float("nan")), ("b", None, 2.0)], "SampleID string, f1 double, `Incubation control 1` double")
    tables.write_tsv(wide, f"{tmp_path}/wide.tsv")
    back = tables.drop_controls(tables.to_long(tables.scan(spark, f"{tmp_path}/wide.tsv")))
    assert sorted((r["sample"], r["value"]) for r in back.collect()) == [("a", 1.0), ("b", None)]
    rows = spark.createDataFrame([("a", "f", 1.0), ("a", "f", 3.0)], "SAMPLE_ID string, Assay string, NPX double")
    assert [tuple(r) for r in tables.to_long(rows).collect()] == [("a", "f", 2.0)]
    (tmp_path / "k.csv").write_text("ID1;ID2;Kinship\nx;y;0.2\n")
    assert [tuple(r) for r in tables.kinship_edges(spark, f"{tmp_path}/k.csv").collect()] == [("x", "y", 0.2)]
    (tmp_path / "b.tsv").write_text("PERSON\tin_Batch_00\tin_Batch_01\nP1\tT\tFALSE\nX1\tT\tT\n")
    assert [tuple(r) for r in tables.bridging(spark, f"{tmp_path}/b.tsv", "PERSON", "^P").collect()] == [("P1", True, False)]
    raw = spark.createDataFrame([("1", "1", 0, 2)], "FID string, IID string, chr1_5_A_G_G int, chr2_7_C_T_T int")
    assert sorted((r["variant"], r["dosage"]) for r in tables.genotypes_long(raw).collect()) == [("chr1_5_A_G", 0), ("chr2_7_C_T", 2)]
    plink = tables.plink_table(long(spark, [("a", "f", 1.0), ("b", "f", None)]), ["f"])
    assert sorted(tuple(r) for r in plink.collect()) == [("a", "a", 1.0), ("b", "b", -9.0)]
    ids = spark.createDataFrame([("x",), ("y",)], "id string")
    assert tables.content_key(ids, "id").collect() == tables.content_key(ids.union(ids).orderBy(F.desc("id")), "id").collect()
    assert tables.artifact("/b/", 5, "flags", "batch_01") == "/b/05_flags/batch_id=batch_01"
    assert tables.Settings.of({"z": 3.0, "other": 1}).z == 3.0 and math.isclose(tables.Settings.of(None).max_missing, 0.1)
