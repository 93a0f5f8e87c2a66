"""Robust and exact measures against dense or exhaustive versions."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayloom.operators import genetics, netpath, robust
from assayloom.operators import harmonisation as h
from assayloom.operators import prediction as pr
from assayloom.operators.association import logistic_scan


def as_scores(spark, x):
    return spark.createDataFrame([(i, j + 1, float(v)) for i, row in enumerate(x) for j, v in enumerate(row)], "sample int, pc int, score double").repartition(3)


def test_planted_outliers_leave_the_covariance(spark):
    r = np.random.default_rng(4)
    clean = r.normal(size=(400, 3)) @ np.array([[2, 0.5, 0], [0, 1, 0.3], [0, 0, 0.5]])
    far = r.normal(size=(100, 3)) * 0.2 + [30, -40, 25]  # a fifth of all points, close together
    fit = robust.robust_spread(as_scores(spark, np.vstack([clean, far])))
    want = np.cov(clean, rowvar=False)
    assert not fit.classical and fit.n <= 400
    assert np.abs(fit.center - clean.mean(0)).max() < 0.3
    assert np.abs(np.linalg.inv(fit.cov) @ want - np.eye(3)).max() < 0.3
    pairs = spark.createDataFrame([("p", j + 1, float(v), 0.0) for j, v in enumerate([1, 1, 1])], "person string, pc int, x double, y double")
    d = robust.mahalanobis_distance(pairs, as_scores(spark, np.vstack([clean, far]))).head()["distance"]
    true = math.sqrt(np.ones(3) @ np.linalg.inv(want) @ np.ones(3))
    assert abs(d / true - 1) < 0.15


def test_concentration_never_gets_worse_and_is_the_best_half(spark):
    """One dimension, where the half of least variance is known: a run of sorted values."""
    x = np.sort(np.concatenate([np.random.default_rng(1).normal(size=60), [50.0, 51.0, 52.0, -70.0]]))
    n, hh = len(x), (len(x) + 2) // 2
    best = min((x[i : i + hh].var(ddof=1), i) for i in range(n - hh + 1))
    rows = robust.points(as_scores(spark, x[:, None])).cache()
    fits = robust.good_starts(x[:, None], hh / n, 42)
    for _ in range(10):
        fits = robust.spreads(rows, 1, fits, robust.quantiles_of_distance(rows, fits, hh / n))
    assert min(f.cov[0, 0] for f in fits) == pytest.approx(best[0], rel=1e-9)


def test_singular_scores_take_the_classical_form(spark):
    x = np.random.default_rng(2).normal(size=(80, 2))
    flat = np.column_stack([x[:, 0], np.where(np.arange(80) < 70, 0.0, x[:, 1])])  # most points on a line
    fit = robust.robust_spread(as_scores(spark, flat))
    assert fit.classical and np.allclose(fit.cov, np.cov(flat, rowvar=False))
    few = robust.robust_spread(as_scores(spark, x[:4]))
    assert few.classical and few.n == 4


def test_signed_rank_is_exact_for_few(spark):
    for seed, n in ((0, 5), (1, 8), (2, 12)):
        d = np.round(np.random.default_rng(seed).normal(0.3, 1, n), 6)
        rank = np.argsort(np.argsort(np.abs(d))) + 1
        v = rank[d > 0].sum()
        sums = [sum(s) for s in itertools.product(*[(0, k) for k in range(1, n + 1)])]
        low, high = np.mean([s <= v for s in sums]), np.mean([s >= v for s in sums])
        df = spark.createDataFrame([(0.0, float(x)) for x in d] + [(None, 1.0)], "b double, a double")
        one, two = robust.signed_rank(df, "b", "a").head(), robust.signed_rank(df, "b", "a", "two-sided").head()
        assert (one["n"], one["v"]) == (n, v)
        assert one["p"] == pytest.approx(low, abs=1e-12) and two["p"] == pytest.approx(min(1, 2 * min(low, high)), abs=1e-12)
    tied = robust.signed_rank(spark.createDataFrame([(0.0, x) for x in (1.0, 1.0, -1.0, 2.0)], "b double, a double"), "b", "a").head()
    assert tied["p"] == pytest.approx(0.5 * math.erfc(-(8.0 - 5 + 0.5) / math.sqrt(7.5 - 24 / 48) / math.sqrt(2)))
    none = robust.signed_rank(spark.createDataFrame([(1.0, 1.0)], "b double, a double"), "b", "a").head()
    assert (none["n"], none["v"], none["p"]) == (0, 0.0, None)


def test_bootstrapped_medians_follow_the_draws(spark):
    for n in (3, 4):  # every draw of three or four rows
        ranks = [sorted(d) for d in itertools.product(range(1, n + 1), repeat=n)]
        want = np.array([(d[(n - 1) // 2] + d[n // 2]) / 2 for d in ranks])
        a, b = robust.median_ranks(n, 200_000, 7)
        got = (a + b) / 2
        for v in np.unique(want):
            assert abs((got == v).mean() - (want == v).mean()) < 0.005
    x = np.random.default_rng(8).normal(size=301)
    x[5:9] = x[4]
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "v double").repartition(3)
    got = robust.bootstrap_median(df, "v").head()
    r = np.random.default_rng(1)
    drawn = np.median(x[r.integers(0, 301, (10_000, 301))], axis=1)
    assert got["median"] == np.median(x)
    assert np.abs(np.array([got["low"], got["high"]]) - np.quantile(drawn, [0.025, 0.975])).max() < 0.02
    assert list(robust.bootstrap_median(df.limit(0), "v").head()) == [None] * 3
    half = spark.createDataFrame([(i, 2.0 + i % 5, 1.0 + (i % 5) / 2) for i in range(40)], "p int, b double, a double")
    row = robust.log_ratio_interval(half, "b", "a").head()
    assert row["excludes_zero"] and row["median"] == pytest.approx(math.log(0.5)) and row["low"] <= row["median"] <= row["high"] < 0


def one_by_one(edges, facts):
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    gone = []
    while any(near.values()):
        worst = min(near, key=lambda x: (-len(near[x]), -facts.get(x, (-1.0, math.inf))[0], facts.get(x, (-1.0, math.inf))[1], x))
        gone.append(worst)
        for y in near.pop(worst):
            near[y].discard(worst)
    return sorted(gone)


@pytest.mark.parametrize("group_edges", [0, 4, 20_000])
def test_rounds_remove_what_single_steps_remove(spark, group_edges):
    r = np.random.default_rng(11)
    edges = [(int(a), int(b)) for a, b in r.integers(0, 60, (90, 2))] + [(100, k) for k in range(101, 110)] + [(200, 201), (201, 202), (5, 5)]
    facts = {i: (float(r.integers(0, 3)) / 10, int(r.integers(0, 30))) for i in range(110)}
    df = spark.createDataFrame(edges, "id1 long, id2 long")
    missing = spark.createDataFrame([(i, *f) for i, f in facts.items()], "id long, missing_rate double, ordinal long")
    assert sorted(x["id"] for x in genetics.greedy_unrelated(df, missing, group_edges).collect()) == one_by_one(edges, facts)


def test_blocked_correlations_with_gaps(spark):
    r = np.random.default_rng(6)
    x = r.normal(size=(90, 7)) + 1e4
    x[:, 3], x[:, 4] = x[:, 0] * -2, 5.0
    there = r.random((90, 7)) > 0.2
    there[:, 6] = np.arange(90) < 2
    rows = [(f"s{i}", f"f{j}", float(x[i, j]) if there[i, j] else None) for i in range(90) for j in range(7)]
    df = spark.createDataFrame(rows, "sample string, feature string, value double").repartition(3)
    got = {(v["f1"], v["f2"]): v for v in genetics.correlations(df, block=2, strip=20).collect()}
    for i, j in itertools.combinations(range(7), 2):
        both = there[:, i] & there[:, j]
        if not both.any():
            continue
        v = got.pop((f"f{i}", f"f{j}"))
        assert v["n"] == both.sum()
        if 4 in (i, j) or both.sum() < 2:
            assert v["r"] is None and v["p"] is None
        else:
            rho = np.corrcoef(x[both, i], x[both, j])[0, 1]
            assert v["r"] == pytest.approx(rho, abs=1e-7)
            if both.sum() < 3:
                assert v["p"] is None
            elif (i, j) == (0, 3):
                assert v["p"] < 1e-12
    assert not got


def test_logistic_steps_together(spark):
    r = np.random.default_rng(3)
    n = 200
    age, rows, want = r.normal(50, 9, n), [], {}
    y = (age + r.normal(size=n) * 9 > 50).astype(int)
    for f in range(5):
        v = r.normal(size=n) * 10.0**f + y * (f == 2) * 50
        rows += [(f, i, float(v[i]), float(age[i]), int(y[i])) for i in range(n) if (i + f) % 9]
        keep = [i for i in range(n) if (i + f) % 9]
        x = np.column_stack([np.ones(len(keep)), v[keep] / 10.0**f, age[keep]])
        b = np.zeros(3)
        for _ in range(60):
            p = 1 / (1 + np.exp(-x @ b))
            b = b + np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]), x.T @ (y[keep] - p))
        se = math.sqrt(np.linalg.inv(x.T @ (x * (p * (1 - p))[:, None]))[1, 1])
        want[f] = (len(keep), b[1] / 10.0**f, se / 10.0**f)
    rows += [(9, i, 1.0 * i, 40.0, i % 2) for i in range(10)]  # too few rows
    df = spark.createDataFrame(rows, "feature int, sample int, value double, age double, y int").repartition(4)
    got = {v["feature"]: v for v in logistic_scan(df, "y", ["age"]).collect()}
    assert got.keys() == want.keys()
    for f, (m, beta, se) in want.items():
        assert got[f]["n"] == m and got[f]["beta"] == pytest.approx(beta, rel=1e-6) and got[f]["se"] == pytest.approx(se, rel=1e-5)
        assert got[f]["p"] == pytest.approx(math.erfc(abs(beta / se) / math.sqrt(2)), rel=1e-4, abs=1e-300)


def test_shapiro_groups(spark):
    rows = [("a", 148.0), ("a", 154.0), ("a", 158.0), ("a", 160.0), ("a", 161.0), ("a", 162.0), ("a", 166.0), ("a", 170.0), ("a", 182.0), ("a", 195.0), ("a", 236.0)]
    rows += [("two", 1.0), ("two", 2.0), ("flat", 1.0), ("flat", 1.0), ("flat", 1.0), ("three", 1.0), ("three", 2.0), ("three", 4.0), (None, 1.0), (None, None), (None, 5.0), (None, 2.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").unionByName(spark.range(5001).select(F.lit("many").alias("g"), F.col("id").cast("double").alias("v")))
    got = {r["g"]: r for r in h.shapiro_w(df, "v", "g").collect()}
    assert got["a"]["w"] == pytest.approx(0.7888, abs=1e-3) and got["a"]["p"] == pytest.approx(0.0067, abs=5e-4)  # the published example
    assert [got[g]["w"] for g in ("two", "flat", "many", "none")] == [None] * 4 and got["many"]["n"] == 5001 and got["none"]["n"] == 0
    assert got["three"]["w"] == pytest.approx(27 / 28, abs=1e-9) and got["three"]["p"] == pytest.approx(6 / math.pi * (math.asin(math.sqrt(27 / 28)) - math.asin(math.sqrt(0.75))))
    assert got[None]["n"] == 3 and got[None]["w"] is not None


def labelled(spark, n=200, width=8, seed=0):
    from pyspark.ml.linalg import Vectors

    r = np.random.default_rng(seed)
    x = r.normal(size=(n, width)) * np.linspace(0.5, 3, width) + 2
    y = ((x[:, 0] - 2) * 4 - (x[:, 3] - 2) * 0.5 + r.normal(size=n) > 0).astype(int)
    return x, y, spark.createDataFrame([(i, int(y[i]), Vectors.dense(x[i].tolist())) for i in range(n)], ["sample", "label", "features"]).repartition(3)


def test_net_against_a_dense_solver(spark):
    x, y, v = labelled(spark)
    n, width = x.shape
    s = netpath.packed(v, "label", 0, 3, 42)
    z = np.hstack([np.ones((n, 1)), (x - x.mean(0)) / x.std(0, ddof=1)])
    c = np.where(y == 1, 0.5 * n / y.sum(), 0.5 * n / (n - y.sum()))
    for a, lam in ((0.5, 0.03), (1.0, 0.08)):
        b, top = np.zeros(width + 1), np.linalg.eigvalsh((z.T * (c / c.sum())) @ z / 4).max() + lam
        for _ in range(20_000):
            p = 1 / (1 + np.exp(-z @ b))
            g = z.T @ (c * (p - y)) / c.sum()
            g[1:] += lam * (1 - a) * b[1:]
            b = b - g / top
            b[1:] = np.sign(b[1:]) * np.maximum(np.abs(b[1:]) - lam * a / top, 0)
        got = netpath.settled_models(s, np.array([a]), np.array([lam]), np.zeros((1, width + 1)))[0]
        assert np.abs(got - b).max() < 1e-7


def test_nested_folds_score_held_out_rows(spark):
    x, y, v = labelled(spark)
    scores, weights, chosen = netpath.nested(v, "label", [0.5, 1.0], 8, folds=3, inner=3)
    rows = scores.collect()
    assert sorted(r["sample"] for r in rows) == [*range(200)] and weights.count() == 3 * 8 and chosen.count() == 3
    p, label = np.array([r["score"] for r in rows]), np.array([r["label"] for r in rows])
    assert (p[label == 1][:, None] > p[label == 0][None]).mean() > 0.9
    w = {(r["fold"], r["at"]): r["weight"] for r in weights.collect()}
    for r in rows[:20]:  # a row's score comes from the model of its own fold, which didn't see it
        eta = sum(w[r["fold"], j] * x[r["sample"], j] for j in range(8))
        others = [q for q in rows if q["fold"] == r["fold"]][0]
        gap = sum(w[r["fold"], j] * x[others["sample"], j] for j in range(8))
        logit = lambda q: math.log(q / (1 - q))
        assert eta - gap == pytest.approx(logit(r["score"]) - logit(others["score"]), abs=1e-6)
    strength, own, _ = netpath.one_error(v, "label", 1.0, 10, 3)
    assert strength > 0 and own[0] > 0 and (own != 0).sum() < 8


def test_areas_from_bins():
    bins = np.zeros((2, netpath.BINS))
    bins[0, [1, 5, 9]], bins[1, [5, 7]] = [2, 1, 1], [1, 3]
    want = np.mean([(1.0 if a > b else 0.5 if a == b else 0.0) for a in [5, 7, 7, 7] for b in [1, 1, 5, 9]])
    assert netpath.auc_of(bins) == pytest.approx(want) and netpath.auc_of(np.zeros((2, 4))) == 0.5


def test_zoo_is_out_of_fold(spark):
    from pyspark.ml.linalg import Vectors

    r = np.random.default_rng(5)
    rows = [(i, int(r.integers(0, 2)), Vectors.dense(r.normal(size=30).tolist())) for i in range(80)]  # labels by chance
    out = pr.model_zoo(spark.createDataFrame(rows, ["sample", "label", "features"]), "label", folds=2, trees=20, boosts=10, layers=(8,)).toPandas()
    assert set(out["model"]) == {"enet", "ridge", "lasso", "forest", "boost", "mlp", "ensemble"} and len(out) == 7 * 80
    for _, g in out.groupby("model"):  # a model that has seen its rows would tell these apart
        p, y = g["score"].to_numpy(), g["label"].to_numpy()
        assert (p[y == 1][:, None] > p[y == 0][None]).mean() < 0.75
    mean = out[out["model"] != "ensemble"].groupby("sample")["score"].mean()
    assert np.allclose(out[out["model"] == "ensemble"].set_index("sample")["score"].sort_index(), mean.sort_index())


def test_folds_by_parts(spark):
    rows = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 3 == 0).alias("y")).unionByName(spark.createDataFrame([(1, None), (2, None)], "k long, y boolean"))
    out = pr.stratified_folds(rows, "k", "y", 5).toPandas()
    assert len(out) == 1002 and out.groupby(["y", "fold"]).size().groupby("y").agg(lambda s: s.max() - s.min()).max() <= 1
    order = pr.hash_ranked(rows, "k", "y", 42, "place").withColumn("h", F.xxhash64("k", F.lit(42))).toPandas()
    for _, g in order.groupby("y"):
        g = g.sort_values("place")
        assert g["h"].is_monotonic_increasing and g["place"].tolist() == [*range(len(g))]


def test_areas_are_made_in_tasks(spark):
    x, y, v = labelled(spark)
    held, b = np.array([1, 2]), np.random.default_rng(1).normal(size=(2, 9, 2))
    s = netpath.packed(v, "label", 2, 2, 42)
    got = []
    for n in (1, 7):
        s.rows = s.rows.repartition(n)
        g, auc = netpath.one_pass(s, b, held, judged=True)
        got.append((g, auc))
        assert g.shape == (2, 9, 2) and auc.shape == (2, 2)  # bins of scores stay in the tasks
        assert netpath.one_pass(s, b, held)[1] is None
    assert np.allclose(got[0][0], got[1][0]) and (got[0][1] == got[1][1]).all()
    assert 0 <= got[0][1].min() <= got[0][1].max() <= 1
