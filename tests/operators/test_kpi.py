"""The alignment report on two batches of which one was shifted and moved back."""

import numpy as np

from assayloom.operators import kpi
from assayloom.operators.kpi import Batches, alignment_report
from assayloom.operators.harmonisation import TARGETS


def test_every_measure_from_data(spark):
    r = np.random.default_rng(21)
    n, width = 110, 6
    label = r.integers(0, 2, n)
    people = r.normal(size=(n, width)) + label[:, None] * np.array([2.0, 0, 0, 0, 0, 0])
    second = people[:40] + r.normal(size=(40, width)) * 0.1  # forty people stand in both batches
    others = r.normal(size=(n - 40, width)) + (fresh := r.integers(0, 2, n - 40))[:, None] * np.array([2.0, 0, 0, 0, 0, 0])
    replicates = people[50:70] + r.normal(size=(20, width)) * 0.1
    rows = [("A", f"a{i}", people[i], label[i]) for i in range(n)] + [("B", f"b{i}", second[i], label[i]) for i in range(40)]
    rows += [("B", f"x{i}", others[i], fresh[i]) for i in range(n - 40)] + [("A", f"r{i}", replicates[i], label[50 + i]) for i in range(20)]
    shift = np.linspace(1, 3, width)
    cells = lambda off: [(b, s, f"f{j}", float(v[j] + off[j] * (b == "B"))) for b, s, v, _ in rows for j in range(width)]
    make = lambda data, schema: spark.createDataFrame(data, schema).repartition(3).cache()
    before, after = (make(cells(o), "batch string, sample string, feature string, value double") for o in (shift, shift * 0))
    b = Batches(
        before, after, make([(f"p{i}", f"a{i}", f"b{i}") for i in range(40)], "person string, first string, second string"), make([(f"a{50 + i}", f"r{i}") for i in range(20)], "first string, second string"),
        make([(s, int(y)) for _, s, _, y in rows], "sample string, label int"), "A", "B",
    )
    got = {x["metric"]: x for x in alignment_report(b, components=4, top=5).collect()}
    assert list(got) == [m for m, _ in TARGETS] and {m for m, x in got.items() if x["post"] is None} == {"icc", "ccc"}  # six features are too few for those
    for m in ("euclidean", "mahalanobis", "whitened"):
        assert got[m]["post"] < got[m]["pre"] and got[m]["pass"] == "PASS"
    assert got["log_ratio_high"]["post"] < 0 and got["excludes_zero"]["post"] == 1 and got["p"]["post"] < 1e-6
    assert got["noise_ratio"]["post"] < 2 < got["noise_ratio"]["pre"]
    assert got["rank1"]["post"] > 0.95 > got["rank1"]["pre"] and got["median_rank"]["post"] == 1
    assert got["silhouette"]["post"] < got["silhouette"]["pre"] and got["batch_auc"]["post"] < got["batch_auc"]["pre"]
    assert got["kbet"]["post"] > got["kbet"]["pre"] and got["lisi"]["post"] > got["lisi"]["pre"]
    assert got["batch_variance"]["post"] < 0.05 < got["batch_variance"]["pre"] and got["label_accuracy"]["post"] > 0.7


def test_cells_are_stored_by_sample(spark):
    rows = [("A", "s1", "f1", 1.0), ("A", "s1", "f2", None), ("B", "s2", "f2", 3.0)]
    stored = kpi.packed(spark.createDataFrame(rows, "batch string, sample string, feature string, value double").repartition(3))
    assert stored.count() == 2
    assert sorted(map(tuple, kpi.cells(stored, "batch").select("batch", "sample", "feature", "value").collect())) == rows
    assert kpi.few(stored, 1) is stored and kpi.few(stored, 2) is not stored


def test_each_side_is_read_once_for_its_scores_and_bridges(spark, monkeypatch):
    r = np.random.default_rng(5)
    cells = [(b, f"{b}{i}", f"f{j}", float(r.normal())) for b in "AB" for i in range(60) for j in range(5)]
    long = spark.createDataFrame(cells, "batch string, sample string, feature string, value double").cache()
    pairs = spark.createDataFrame([(f"p{i}", f"A{i}", f"B{i}") for i in range(20)], "person string, first string, second string")
    twice = spark.createDataFrame([(f"A{i}", f"A{i + 1}") for i in range(30, 40, 2)], "first string, second string")
    labels = spark.createDataFrame([(f"{b}{i}", i % 2) for b in "AB" for i in range(60)], "sample string, label int")
    calls = []
    for module, name in ((kpi.association, "project"), (kpi, "sides"), (kpi.h, "mads")):
        f = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, f=f, name=name: calls.append(name) or f(*a))
    got = {x["metric"]: x for x in kpi.alignment_report(Batches(long, long, pairs, twice, labels, "A", "B"), components=3, top=3).collect()}
    assert all(got[m]["pre"] == got[m]["post"] for m in ("euclidean", "rank1", "silhouette", "kbet", "lisi"))
    assert (calls.count("project"), calls.count("sides"), calls.count("mads")) == (2, 5, 1)
