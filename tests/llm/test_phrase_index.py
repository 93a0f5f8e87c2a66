import hashlib
import random
import re

import pytest

from assayloom.llm import phrase_index as p

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(LOW))


def brute(rows, items, n=10):
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - n + 1)) if w else ():
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = []
    for d, t in rows:
        w, hit, found = words(t), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if x := windows.get(tuple(w[k : k + size])):
                    found |= x
                    hit.update(range(k, k + size))
        joined = ",".join(sorted(map(str, found)))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(joined.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def tables(spark):
    r = random.Random(11)
    voc = [f"w{i}" for i in range(30)] + ["é", "ß9", "日本"]
    say = lambda n: " ".join(r.choice(voc) for _ in range(n))
    items = [(i, say(r.choice([1, 3, 9, 10, 11, 25, 70]))) for i in range(25)] + [(2, "second text of one item id " * 3), (90, None), (91, " .,; "), (92, "unseen " * 12), (93, "w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1")]
    items[5] = (5, items[4][1])  # two items with one text
    rows = [(i, say(r.randrange(120))) for i in range(80)]
    for i in range(80, 140):
        a, b = r.choice(items)[1] or "", say(r.randrange(50))
        w = a.split(" ")
        cut = r.randrange(len(w))
        rows.append((i, r.choice([f"{b}, {a.upper()}! {b}", f"{a}\n{a} {a}", " ".join(w[cut:]), f"{' '.join(w[:cut])} oops {' '.join(w[cut:])}"])))
    rows += [(200, None), (201, ""), (202, "w1 " * 3000)] + rows[80:83]
    # null ids, ids of several texts, texts of several ids
    rows += [(None, t) for _, t in rows[78:100:3]] + [(7, t) for _, t in rows[75:100:4]] + [(500 + i, rows[81][1]) for i in range(30)] + [(-(1 << 63), rows[82][1])]
    docs = spark.createDataFrame([(*x, "t", 1, 5, ["x"]) for x in rows], "doc_id long, text string, term string, n long, mark long, words array<string>")
    return docs, spark.createDataFrame(items, "item_id long, text string"), rows, items


@pytest.mark.parametrize("limit", [500_000, 0])
def test_against_brute_force(tables, monkeypatch, limit):
    docs, items, rows, plain = tables
    monkeypatch.setattr(p, "BROADCAST_IDS", limit)
    monkeypatch.setattr(p, "BROADCAST_TERMS", limit)
    got = p.contamination(docs, items)
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got.collect()), key=str) == brute(rows, plain)


def test_proximity(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    texts = [(1, item), (2, "one two three four five six extra words seven eight nine ten eleven twelve"), (3, "twelve eleven ten nine eight seven six five four three two one"), (4, "one " + "x " * 90 + "two three")]
    docs, items = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r["doc_id"]: (r["contaminated"], r["n_near"]) for r in p.contamination(docs, items).collect()}
    assert got == {1: (True, 1), 2: (False, 1), 3: (False, 0), 4: (False, 0)}


@pytest.mark.parametrize("limit", [500_000, 0])
def test_proximity_counts_places_once(spark, monkeypatch, limit):
    monkeypatch.setattr(p, "BROADCAST_IDS", limit)
    item = "aa bb cc"  # three looked-up places, all needed
    texts = [(1, item), (2, "aa bb extra cc"), (3, "aa x bb y cc"), (4, "aa bb x aa bb"), (5, "aa bb" + " x" * 30 + " cc"), (6, "cc bb"), (7, "cc bb aa")]
    texts += [(10 + k, "x " * k + "aa bb extra cc") for k in range(9)]  # also across the lanes' bounds
    docs, items = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r["doc_id"]: r["n_near"] for r in p.contamination(docs, items).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 0, 5: 0, 6: 0, 7: 0} | {10 + k: 1 for k in range(9)}


def test_decontaminated_and_empty(tables, spark):
    docs, items, rows, plain = tables
    kept = p.decontaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((x[0] for x in brute(rows, plain) if not x[5]), key=str)
    assert {(r["term"], r["n"], r["mark"], r["words"][0]) for r in kept.collect()} == {("t", 1, 5, "x")}
    assert p.contamination(docs.filter("false"), items).count() == 0
    assert {r["n_hit"] for r in p.contamination(docs, items.filter("false")).collect()} == {0}
    item = "one two three four five six seven eight nine ten eleven"
    mixed = spark.createDataFrame([(None, item), (7, item), (7, "clean text of four")], "doc_id long, text string")
    one = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"]) for r in p.contamination(mixed, one).collect()), key=str) == [(7, 11, 11), (7, 4, 0), (None, 11, 11)]
    assert [tuple(r) for r in p.decontaminated(mixed, one).collect()] == [(7, "clean text of four")]
    lost = p.contamination(spark.createDataFrame([(None, None), (None, "w1 w2")], docs.select("doc_id", "text").schema), items).collect()
    assert sorted(r["n_words"] for r in lost) == [0, 2]
