"""Running sums, ranks over all rows and blocks of samples against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from assayloom.functions import blocks
from assayloom.operators import association as a
from assayloom.operators import harmonisation as h
from assayloom.operators import prediction as p


@pytest.mark.parametrize("n, parts", [(0, 64), (1, 64), (7, 3), (300, 8)])
def test_running_sums_both_ways(spark, n, parts):
    values = [None if i == 3 else float((i * 37) % n) for i in range(n)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v double, c long")
    for down in (False, True):
        got = {r["v"]: r["run_c"] for r in blocks.running(df, "v", "c", descending=down, parts=parts).collect()}
        # nulls first going up, last going down
        order = sorted(range(n), key=lambda i: (values[i] is not None, values[i] or 0.0), reverse=down)
        want, total = {}, 0
        for i in order:
            total += i
            want[values[i]] = total
        assert got == want


def test_ranks_share_ties(spark):
    x = np.random.default_rng(1).integers(0, 40, 500)
    got = {r["v"]: r["rank"] for r in blocks.ranked_values(spark.createDataFrame([(int(v),) for v in x] + [(None,)], "v int"), "v").collect()}
    assert got == dict(zip(x.tolist(), pd.Series(x).rank().tolist(), strict=True))


def test_rank_sum_of_nothing(spark):
    r = a.rank_sum(spark.createDataFrame([], "v double, y boolean"), "v", "y").head()
    assert (r["n1"], r["n0"], r["auc"]) == (0, 0, None)


def test_curve_and_area(spark):
    rows = [(0.9, 1), (0.9, 0), (0.7, 1), (0.4, 0), (0.4, 0), (0.1, 1)]
    df = spark.createDataFrame(rows, "score double, label int")
    got = {r["threshold"]: (r["tp"], r["fp"], r["fn"], r["tn"]) for r in p.confusion_curve(df).collect()}
    assert got == {t: tuple(sum(1 for s, y in rows if (s >= t) == up and y == one) for up, one in ((True, 1), (True, 0), (False, 1), (False, 0))) for t in (0.9, 0.7, 0.4, 0.1)}


def test_neighbours_and_silhouette_in_blocks(spark, monkeypatch):
    r = np.random.default_rng(2)
    x = r.integers(0, 6, (60, 2)).astype(float)  # many equal distances
    label = r.integers(0, 3, 60)
    df = spark.createDataFrame([(i, int(label[i]), float(x[i, 0]), float(x[i, 1])) for i in range(60)] + [(60, 0, None, 1.0)], "sample int, g int, a double, b double")
    many = blocks.block_pairs
    small = lambda rows, work, schema: many(rows, work, schema, most=13)
    monkeypatch.setattr(h, "block_pairs", small)
    monkeypatch.setattr(a, "block_pairs", small)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    want = {(i, k): sorted((d[i, j], j) for j in range(60) if j != i)[k - 1][1] for i in range(60) for k in range(1, 6)}
    assert {(q["s"], q["rank"]): q["t"] for q in h.neighbours(df, ["a", "b"], 5).collect()} == want
    score = []
    for i in range(60):
        mean = {g: np.mean([d[i, j] for j in range(60) if j != i and label[j] == g]) for g in range(3)}
        own, other = mean.pop(label[i]), min(mean.values())
        score.append((other - own) / max(own, other))
    assert abs(a.silhouette(df, ["a", "b"], "g").head()[0] - np.mean(score)) < 1e-9
    assert a.silhouette(df.limit(0), ["a", "b"], "g").head()[0] is None


def test_kruskal_and_signed_rank_with_ties(spark):
    r = np.random.default_rng(3)
    rows = [(float(v), int(g)) for v, g in zip(r.integers(0, 9, 90), r.integers(0, 3, 90), strict=True)]
    rank = pd.Series([v for v, _ in rows]).rank()
    g = pd.Series([g for _, g in rows])
    want = 12 / (90 * 91) * sum(rank[g == k].sum() ** 2 / (g == k).sum() for k in range(3)) - 3 * 91
    assert abs(h.kruskal(spark.createDataFrame(rows, "v double, g int"), "v", "g").head()["h"] - want) < 1e-9
    d = pd.Series([v - 4 for v, _ in rows])
    d = d[d != 0]
    from assayloom.operators import robust

    got = robust.signed_rank(spark.createDataFrame(rows, "v double, g int").withColumn("z", F.lit(4.0)), "z", "v").head()
    assert (got["n"], got["v"]) == (len(d), d.abs().rank()[d > 0].sum())


def test_blocks_of_a_table_joined_with_itself(spark):
    m = spark.range(40).select(F.col("id").alias("sample"), (F.col("id") * 7 % 40).cast("double").alias("v"), (F.col("id") % 2).alias("g"))
    scores = m.groupBy("sample").agg(F.sum("v").alias("a")).join(m.select("sample", "g").distinct(), "sample")
    place = {i: i * 7 % 40 for i in range(40)}
    got = {r["s"]: r["t"] for r in h.neighbours(scores, ["a"], 1).collect()}
    assert got == {i: min((j for j in place if j != i), key=lambda j: (abs(place[i] - place[j]), j)) for i in place}
    assert a.silhouette(scores, ["a"], "g").head()[0] is not None
    assert 0 <= h.kbet_acceptance(scores, ["a"], "g").head()[0] <= 1
    assert 1 <= h.lisi(scores, ["a"], "g").head()[0] <= 2


def test_pair_ranks_with_gaps_and_copies(spark, monkeypatch):
    r = np.random.default_rng(4)
    x, y = r.integers(0, 3, (2, 40, 5)).astype(float)
    y[7] = y[8]  # a copy ties
    x[r.random((40, 5)) < 0.2] = np.nan
    y[r.random((40, 5)) < 0.2] = np.nan
    y[5] = np.nan
    many = a.fold_blocks
    monkeypatch.setattr(a, "fold_blocks", lambda *args, groups: many(*args[:-1], 3, groups=2, chunk=7))
    long = lambda t, people: spark.createDataFrame([(f"p{i}", f"f{j}", float(t[i, j])) for i in people for j in range(5)], "person string, feature string, value double").replace(float("nan"), None)
    got = {q["query"]: (q["rank"], q["margin"]) for q in a.true_pair_rank(long(x, range(0, 40, 2)), long(y, range(40))).collect()}
    gap = x[:, None] - y[None]
    d = np.where((~np.isnan(gap)).any(2), np.nansum(gap * gap, 2), np.inf)
    want = {f"p{i}": (1 + (d[i] < d[i, i]).sum(), np.sqrt(d[i, i]) - np.sqrt(np.delete(d[i], i).min())) for i in range(0, 40, 2) if np.isfinite(d[i, i])}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(abs(got[k][1] - want[k][1]) < 1e-12 for k in want)


@pytest.mark.parametrize("n", [0, 1, 2, 9, 300])
def test_quantiles_and_normal_ranks_by_ranges(spark, n):
    from assayloom.functions.stats import inverse_normal

    r = np.random.default_rng(n)
    x = r.integers(0, 25, n) / 4
    df = spark.createDataFrame([(i, i % 2, float(v) if i % 11 else None) for i, v in enumerate(x)], "i int, g int, v double")
    known = [v for i, v in enumerate(x) if i % 11]
    got = blocks.quantiles(df, "v", low=0.1, mid=0.5).head()
    assert (got["low"], got["mid"]) == (pytest.approx(tuple(np.quantile(known, [0.1, 0.5]))) if known else (None, None))
    want = {q["i"]: q["w"] for q in df.select("i", inverse_normal("v", "g").alias("w")).collect()}
    assert {q["i"]: q["v"] for q in blocks.normal_ranks(df, "v", "g", parts=4).collect()} == want


def test_all_measures_of_mixing_from_one_pass(spark, monkeypatch):
    r = np.random.default_rng(8)
    x = r.integers(0, 7, (140, 2)).astype(float)  # copies and equal distances
    batch = r.integers(0, 3, 140)
    df = spark.createDataFrame([(f"s{i:03}", f"b{batch[i]}", float(x[i, 0]), float(x[i, 1])) for i in range(140)] + [("gap", "b0", None, 1.0)], "sample string, g string, a double, b double")
    many, passes = blocks.block_pairs, []
    monkeypatch.setattr(h, "block_pairs", lambda rows, work, schema: passes.append(schema) or many(rows, work, schema, most=23))
    got = h.mixing(df, ["a", "b"], "g").head()
    assert len(passes) == 1 and "t " not in passes[0]  # one pass, and no neighbours stored
    assert got["silhouette"] == pytest.approx(a.silhouette(df, ["a", "b"], "g").head()[0], abs=1e-12)
    assert got["acceptance"] == pytest.approx(h.kbet_acceptance(df, ["a", "b"], "g").head()[0], abs=1e-12)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    index = []
    for i in range(140):
        near = sorted((d[i, j], j) for j in range(140) if j != i)[:90]
        q, low, high, beta = np.array([e for e, _ in near]) ** 2, 0.0, np.inf, 1.0
        for _ in range(60):
            w = np.exp(-(q - q.min()) * beta)
            w /= w.sum()
            over = -(w * np.log(np.maximum(w, 1e-300))).sum() - np.log(30)
            if abs(over) < 1e-5:
                break
            low, high = (beta, high) if over > 0 else (low, beta)
            beta = beta * 2 if over > 0 and high == np.inf else (low + high) / 2
        index.append(1 / (pd.Series(w).groupby(batch[[j for _, j in near]]).sum() ** 2).sum())
    assert got["median_lisi"] == pytest.approx(np.median(index), abs=1e-9)
    assert h.mixing(df.limit(0), ["a", "b"], "g").head().asDict() == {"silhouette": None, "acceptance": None, "median_lisi": None}


@pytest.mark.parametrize("kind, k", [("normal", 12), ("grid", 12), ("grid", 500), ("far", 12), ("copies", 12), ("normal", 0)])
def test_products_give_the_distances(kind, k):
    r = np.random.default_rng(11)
    n = 420
    x = {"grid": r.integers(0, 5, (n, 3)).astype(float), "far": r.normal(size=(n, 3)) * 1e-3 + 1e6}.get(kind, r.normal(size=(n, 3)))
    if kind == "copies":
        x[::2] = x[0]
    own = r.permutation(n)
    own = np.array([f"s{v:03}" for v in own], object) if kind == "copies" else own
    codes = r.integers(-1, 3, n)  # some without a label
    block = slice(0, 150)
    near, sums = blocks.Nearest(own[block], k), blocks.LabelSums(150)
    products, taken = blocks.Products(own[block], x[block], near, sums), []
    take = near.take
    near.take = lambda row, *more: taken.append(len(row)) or take(row, *more)
    for start in range(0, n, 70):
        chunk = slice(start, start + 70)
        products.add(own[chunk], x[chunk], codes[chunk], tile=1000)
    d = blocks.distances(pd.DataFrame(x[block], columns=list("abc")), pd.DataFrame(x, columns=list("abc")), list("abc"))
    same = own[block][:, None] == own[None]
    want = blocks.LabelSums(150)
    want.add(d.copy(), codes, same)
    assert (sums.n == want.n).all() and np.allclose(sums.d, want.d, rtol=1e-12, atol=0)
    row, far, name, mark, rank = near.settle()
    best = [sorted((d[i, j], own[j], codes[j]) for j in range(n) if not same[i, j])[:k] for i in range(150)]
    assert list(zip(far, name, mark, strict=True)) == [t for b in best for t in b]  # to the last bit, ties by id
    assert list(zip(row, rank, strict=True)) == [(i, j) for i in range(150) for j in range(len(best[i]))]
    assert k > n or kind != "normal" or sum(taken) < 150 * n / 4  # all others are decided by products
