"""The whole operator against a plain Python version, the automaton against the zlib CRC of every word run."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from assayloom.llm import resampling
from assayloom.llm.resampling import blocks, drawn, resampled

GAP = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def runs(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(GAP, low)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def bucket(feature, buckets):
    return zlib.crc32(feature.encode()) % buckets


def plain_version(rows, target, buckets, percent, least, seed=7):
    s, t = Counter(), Counter()
    for _, x in rows:
        s.update(bucket(f, buckets) for f in runs(x)[1])
    for x in target:
        t.update(bucket(f, buckets) for f in runs(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for d, x in rows:
        words, features = runs(x)
        weight = sum(gain(bucket(f, buckets)) for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words) >= least])
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0]))
    most = percent * len(able) // 100
    ranks = Counter((r[0], n, r[2], r[3], i + 1) for i, r in enumerate(able[:most]) for n in [r[1]])
    return out, most, ranks


def check(df, items, rows, target, **kw):
    got = df.collect()
    out, most, ranks = plain_version(rows, target, **kw)
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in got), key=key) == sorted((tuple(r[:4]) for r in out), key=key)
    found = Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in got if r["rank"] is not None)
    assert sorted(r[4] for r in found.elements()) == [*range(1, most + 1)]
    assert found == ranks


def test_all_columns(spark, docs, plain):
    items = [plain[i][1] for i in (20, 30, 61)] + [None, "Only ONE", "ré été"]
    target = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    assert [*resampled(docs, target).columns] == ["doc_id", "n_features", "weight", "score", "rank"]
    check(resampled(docs, target), target, plain, items, buckets=10_000, percent=25, least=20)
    check(resampled(docs, target, buckets=37, percent=100, least_words=0), target, plain, items, buckets=37, percent=100, least=0)


def test_ties_nulls_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(25))
    rows = [(5, text)] * 40 + [(None, text)] * 7 + [(i, text + f" {i % 3}") for i in range(50)] + [(9, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([("w1 w2",)], "text string")
    check(resampled(docs, target, percent=60), target, rows, ["w1 w2"], buckets=10_000, percent=60, least=20)


def test_order_of_equal_scores(spark):
    rows = [(d, s, c) for d in (3, 1, 2, None) for s in (10, 20) for c in (True, True, False)]
    got = drawn(spark.createDataFrame(rows, "doc_id long, score long, can boolean"), 50).collect()
    assert sorted((r["rank"], r["score"], r["doc_id"] if r["doc_id"] is not None else 99) for r in got if r["rank"]) == [(i + 1, 20, d) for i, d in enumerate([1, 1, 2, 2, 3, 3, 99, 99])]


def test_empty(spark, none, nulls):
    items = spark.createDataFrame([], "item_id long, text string")
    assert resampled(none, items).count() == 0
    assert [tuple(r)[1:3] + (r["rank"],) for r in resampled(nulls, items).collect()] == [(0, 0, None)] * 3


def test_automaton(monkeypatch):
    r = random.Random(5)
    pieces = ["a", "Bc", "é", "日本", " ", "  ", "-", "\n", "0", "zZ" * 40, "\x7f", "`", "ÄÖ", "x" * 900]
    texts = ["".join(r.choice(pieces) for _ in range(r.randrange(40))) for _ in range(200)] + ["", "", "q" * 50_000, "last"]
    for block in (1, 300, 4 << 20):
        monkeypatch.setattr(resampling, "BLOCK", block)
        column = pa.array(["skipped one", *texts])[1:]
        found = [x for part in blocks(column, 1 << 20) for x in [part]]
        words = np.concatenate([w for w, _, _ in found])
        assert words.tolist() == [len(runs(t)[0]) for t in texts]
        at, got = 0, Counter()
        for w, text, hashed in found:
            got.update(zip((text + at).tolist(), hashed.tolist(), strict=True))
            at += len(w)
        assert got == Counter((i, bucket(f, 1 << 20)) for i, t in enumerate(texts) for f in runs(t)[1])
