import numpy as np
import pytest

from assayloom.operators import association, identity, normalize, prediction


def logistic(x, y):
    x = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ b))
        b += np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]), x.T @ (y - p))
    return 1 / (1 + np.exp(-x @ b))


@pytest.fixture(scope="module")
def cohort(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(160, 6))
    y = (x[:, 0] + r.normal(size=160) > 0).astype(int)
    age = r.normal(50, 5, 160)
    long = spark.createDataFrame([(i, f"f{k}", float(x[i, k])) for i in range(160) for k in range(6)], "sample int, feature string, value double")
    people = spark.createDataFrame([(i, i % 2, int(y[i]), float(age[i])) for i in range(160)], "sample int, batch int, label int, age double")
    return x, y, age, long, people


def test_predictor_equals_newton(spark, cohort):
    x, y, age, long, people = cohort
    names = [f"f{k}" for k in range(6)]
    got = {r["sample"]: r for r in prediction.top_predictor(long, people, "label", names, ("age",)).collect()}
    want = logistic(np.column_stack([x, age]), y)
    assert max(abs(got[i]["probability"] - want[i]) for i in range(160)) < 1e-4
    assert all(got[i]["mismatch"] == ((want[i] >= 0.5) != y[i]) for i in range(160) if abs(want[i] - 0.5) > 1e-3)
    gap = prediction.top_predictor(long.filter("sample > 0 OR feature <> 'f1'"), people, "label", names, ("age",)).filter("sample = 0").head()
    assert gap["probability"] is None and gap["mismatch"] is False


def test_accuracy_and_its_limits(spark, cohort):
    x, y, _, long, people = cohort
    names = [f"f{k}" for k in range(6)]
    want = ((logistic(x, y) >= 0.5) == y).mean()
    assert abs(prediction.label_accuracy(long, people, "label", names).head()[0] - want) < 0.02
    assert prediction.label_accuracy(long, people.filter("sample < 60"), "label", names).head()[0] is None
    assert prediction.label_accuracy(long, people.filter("batch = 0 OR label = 1"), "label", names, least_batch=10).head()[0] is None


def test_top_features(spark):
    fits = spark.createDataFrame([(f"f{i}", i / 100, i < 8) for i in range(12)], "feature string, p double, significant boolean")
    assert prediction.top_features(fits, 6) == [f"f{i}" for i in range(6)] and prediction.top_features(fits, 6, least=9) == []


def test_pr_auc_of_perfect_and_constant_scores(spark):
    rows = lambda s: spark.createDataFrame([(float(s(i)), int(i < 3)) for i in range(12)], "score double, label int")
    assert abs(prediction.pr_auc(rows(lambda i: -i)).head()[0] - 1) < 1e-12
    assert abs(prediction.pr_auc(rows(lambda i: 1)).head()[0] - 0.25) < 1e-12


def test_bridge_scale_needs_bridges(spark, cohort):
    long = cohort[3]
    with pytest.raises(ValueError, match="10 are needed"):
        normalize.bridge_scale(long, long.filter("sample < 9"))
    out = normalize.bridge_scale(long, long.filter("sample < 20"), "mean").select("factor").distinct().collect()
    assert all(0.1 <= r["factor"] <= 10 for r in out)


def test_stage_summary_of_some_samples(spark, cohort):
    long = cohort[3]
    whole, some = (association.stage_summary(long, long, n).orderBy("stage").collect() for n in (None, 20))
    assert [r["stage"] for r in some] == ["After", "Before"] and some[0][1:] == some[1][1:] and some[0] != whole[0]
    assert association.stage_summary(long, long, 20).orderBy("stage").collect() == some


def test_combat_fills_and_logs(spark):
    rows = [(b, b * 100 + i, f"f{k}", None if (i, k) == (0, 0) else float(10 + 3 * b + k + (i * 7 + k * 3) % 5)) for b in (0, 1) for i in range(12) for k in range(5)]
    long = spark.createDataFrame(rows, "batch int, sample int, feature string, value double")
    plain, logged = normalize.combat(long), normalize.combat(long, log2=True)
    assert plain.filter("value IS NULL").count() == 0 and plain.count() == len(rows)
    means = [r[0] for r in plain.groupBy("batch").avg("value").select("avg(value)").collect()]
    assert abs(means[0] - means[1]) < 0.5
    both = plain.join(logged.withColumnRenamed("value", "log"), ["batch", "sample", "feature"]).collect()
    assert all(abs(np.log2(r["value"] + 1) - r["log"]) < 1e-9 for r in both)


def test_person_components(spark):
    scores = spark.createDataFrame([("p", 1.0), ("q", 2.0), ("none", 3.0)], "person string, pc1 double")
    people = spark.createDataFrame([("p", 2, "x"), ("p", 1, "y"), ("q", 3, "x")], "person string, sample int, grp string")
    got = {r["person"]: r for r in identity.person_components(scores, people, spark.createDataFrame([(2,)], "sample int")).collect()}
    assert got["p"]["sample"] == 1 and got["p"]["grp"] == "y" and got["p"]["is_outlier"] and not got["q"]["is_outlier"] and got["none"]["sample"] is None
