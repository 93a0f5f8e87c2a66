import collections
import random

import pytest

from assayloom.llm import jaccard_join as j
from assayloom.llm.components import components
from assayloom.llm.jaccard_join import groups


def brute(rows, words, percent):
    """(doc_id, set size, least doc_id of the component, links) of each row, sorted; a row is its place in `rows`."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))) if w else frozenset())
    lists = collections.defaultdict(list)
    up, linked = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, s in enumerate(sets):
        for j, o in collections.Counter(j for g in s for j in lists[g]).items():
            if 100 * o >= percent * (len(s) + len(sets[j]) - o):
                linked[i] += 1
                linked[j] += 1
                up[find(i)] = find(j)
        for g in s:
            lists[g].append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None and sets[i]:
            least[find(i)] = min(d, least.get(find(i), d))
    out = [(d, len(sets[i]), least.get(find(i)) if sets[i] else d, linked[i]) for i, (d, _) in enumerate(rows)]
    return sorted(out, key=str)


def found(df, words, percent, **k):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in groups(df, words, percent, **k).collect()), key=str)


@pytest.mark.parametrize("words,percent,k", [(4, 85, {}), (5, 80, {}), (4, 85, {"block_size": 200}), (4, 85, {"broadcast": 0}), (5, 80, {"giant": 0}), (4, 85, {"giant": 100, "block_size": 100})])
def test_against_brute_force(docs, plain, words, percent, k):
    assert found(docs, words, percent, **k) == brute(plain, words, percent)


@pytest.mark.parametrize("hot,rows", [(0, 500_000), (2, 0), (200, 0)])
def test_joins_of_frequent_shingles(docs, plain, monkeypatch, hot, rows):
    monkeypatch.setattr(j, "HOT", hot)
    monkeypatch.setattr(j, "BROADCAST_ROWS", rows)
    assert found(docs, 4, 85) == brute(plain, 4, 85)


@pytest.fixture(scope="module")
def clusters(spark):
    """Groups of near copies of 2 to 300 texts, tied together by shared lines, with repeated rows and ids and null ids."""
    r = random.Random(9)
    rows, say = [], lambda n, voc: " ".join(f"{voc}{r.randrange(400)}" for _ in range(n))
    line = say(12, "line")
    for g, size in enumerate([2, 3, 4, 6, 9, 14, 20, 33, 60, 120, 300]):
        w = say(r.choice([30, 60, 90]), f"g{g}x").split(" ")
        for _ in range(size):
            own = list(w)
            for _ in range(r.choice([0, 1, 1, 2, 3])):
                own[r.randrange(len(own))] = f"edit{r.randrange(90)}"
            if r.random() < 0.3:
                own = own[: -r.randrange(1, 6)]
            rows.append((r.choice([None, len(rows), r.randrange(50)]), " ".join(own) + (f" {line}" if g % 2 else "")))
    return spark.createDataFrame([(*x, 5, "x") for x in rows], "doc_id long, text string, node long, h string").repartition(4), rows


@pytest.mark.parametrize("words,percent,k", [(4, 85, {}), (5, 80, {"block_size": 900}), (4, 85, {"block_size": 100}), (3, 60, {"giant": 500}), (4, 85, {"giant": 50, "block_size": 700})])
def test_hot_groups_of_many_sizes(clusters, words, percent, k):
    df, rows = clusters
    assert found(df, words, percent, **k) == brute(rows, words, percent)


@pytest.mark.parametrize("k", [{}, {"block_size": 60}, {"block_size": 20}])
def test_counts_every_link(spark, k):
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(w if i else f"z{j}" for i, w in enumerate(base)) for j in range(6)]  # a clique of different near copies
    texts += [texts[0], texts[0].upper(), "alone in its words here", " ".join(base[:30])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["component_id"], r["n_links"]) for r in groups(df, 4, 85, **k).collect()}
    assert got == {i: (0, 7) for i in range(8)} | {8: (8, 0), 9: (9, 0)}


def test_ids_that_mean_nothing(spark):
    """The least id there is, a null one and 0 with one text; two texts of one id."""
    rows = [(-(1 << 63), "a b c d e f"), (None, "a b c d e f"), (0, "a b c d e f"), (7, "q r s t u v"), (7, "a b c d e f"), (9, "q r s t u v"), (None, "only here without any id")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, 4, 85) == brute(rows, 4, 85)


def test_every_row_comes_back(docs, none, nulls):
    assert groups(docs).count() == docs.count()
    assert groups(none).count() == 0
    assert [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in groups(nulls).collect()] == [(None, 0, None)] * 3


def test_components(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(r.randrange(200, 300), r.randrange(200, 300)) for _ in range(70)] + [(5, 5)]
    up = {x: x for e in edges for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert got == {x: find(x) for x in up if find(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
