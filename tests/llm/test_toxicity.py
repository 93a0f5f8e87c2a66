import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayloom.llm import toxicity as t


@pytest.fixture(scope="module")
def corpus(spark):
    r = np.random.default_rng(5)
    words = ["river", "stone", "walk", "green", "letter", "morning", "paper", "quiet", "apple", "window"]
    bad = ["grumble", "snarl", "spite"]
    rows, labels = [], []
    for i in range(600):
        w = list(r.choice(words, 20))
        toxic = int(i % 4 == 0)
        if toxic:
            for b in r.choice(bad, 2):
                w[int(r.integers(20))] = str(b)
        rows.append((i, " ".join(w), 9.0))
        labels.append((i, 1, toxic))
    rows += [(1000, "gr5mble", 0.0), (1001, "you 5p1te gr|umble s.n.a.r.l", 0.0), (1002, "s n a r l and walk", 0.0), (1003, "spiiiite", 0.0), (1004, None, 0.0), (1005, "", 0.0), (1006, "r1ver st0ne", 0.0), (1007, "* " * 5000 + "a " * 5000, 0.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, score double"), spark.createDataFrame([*labels, (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_obfuscation(corpus):
    docs, labels = corpus
    got = {r["doc_id"]: r["score"] for r in t.toxicity(docs, labels).collect()}
    assert len(got) == 608
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((got[i] >= 0.5) == (i % 4 == 0) for i in held) / len(held) > 0.97
    assert all(got[i] >= 0.5 for i in (1001, 1002, 1003))
    assert got[1004] == got[1005] < 0.5 and got[1006] < 0.5 and 0 <= got[1007] <= 1


def test_decoder(corpus):
    docs, _ = corpus
    d = t.Decoder(t.log_model(t.model_counts(docs)))
    for token, word in [("5p1te", "spite"), ("sn@rl", "snarl"), ("spiiite", "spite"), ("r-i-v-e-r", "river"), ("$pite", "spite"), ("qu*et", "quiet")]:
        assert word in d.features(token), token
    assert d.token("river") == ("river",) and d.token("letter,") == ("letter",) and d.token("1234") == ()


def test_no_labels_and_empty(spark, corpus):
    docs, labels = corpus
    none = t.toxicity(docs.limit(5), labels.filter("false")).collect()
    assert {r["score"] for r in none} == {0.5}
    assert t.toxicity(docs.filter("false"), labels).count() == 0


def test_model_counts_all_texts(corpus):
    docs, _ = corpus
    counts = t.model_counts(docs)
    text = [r["text"] for r in docs.collect()]
    at = lambda s: (t.code(s[0]) * t.SIZE + t.code(s[1])) * t.SIZE + t.code(s[2])
    assert counts[at("riv")] == sum((x or "").count("riv") for x in text)


def exhaustive(d, s, apart):
    """The likeliest readings, by walking every path of the lattice."""
    best = {}

    def walk(i, text, p):
        if i == len(edges):
            x, y, total = 0, 0, p
            for c in text + " ":
                z = t.code(c)
                total += d.model[x][y][z]
                x, y = y, z
            best[text] = max(total, best.get(text, total))
            return
        for letters, q in edges[i]:
            walk(i + 1, text + letters, p + q)

    edges = d.lattice(s, apart)
    walk(0, "", 0.0)
    return sorted(best, key=lambda x: -best[x])[: t.READINGS], best


@pytest.mark.parametrize("s,apart", [("5p1te", False), ("s**rl", False), ("$$piii7e!", False), ("gr|umb13", False), ("55-ss.5", False), ("аpp1e", False), ("1-1!l|", False), ("walkriver", True), ("5narl", True), ("*", False), ("é3é", False), ("00ll00", False)])
def test_against_exhaustive_decoding(corpus, s, apart):
    docs, _ = corpus
    d = t.Decoder(t.log_model(t.model_counts(docs)))
    want, best = exhaustive(d, s, apart)
    got = d.viterbi(s, apart)
    assert len(got) == len(want) and np.allclose([best[x] for x in got], [best[x] for x in want])


def test_long_tokens_take_time_in_proportion(corpus):
    d = t.Decoder(np.zeros((t.SIZE,) * 3) - 3.0)
    for s, most in [("a" + "*" * 500 + "b", 1.0), ("a" * 100_000, 1.0), ("ab" * 50_000 + "aaa", 2.0), ("1" * 100_000, 1.0)]:
        start = time.process_time()
        d.token(s)
        assert time.process_time() - start < most, s[:5]
    assert d.viterbi("s n".replace(" ", "") * 3000, True)


def test_sparse_fit_against_dense_gradient():
    r = np.random.default_rng(3)
    x = (r.random((300, 12)) < 0.2).astype(float)
    y = (x[:, 0] + x[:, 1] > 0).astype(float)
    rows, words = np.nonzero(x)
    w, b = t.sparse_logistic(rows, words, 12, y, 1e-3, rounds=4000)
    g = x.T @ (1 / (1 + np.exp(-(x @ w + b))) - y) / 300  # at the optimum the gradient is within the penalty
    assert np.all(np.abs(g) <= 1e-3 + 1e-4) and np.all(np.abs(g[w != 0] + 1e-3 * np.sign(w[w != 0])) < 2e-4)
    assert set(np.argsort(-w)[:2]) == {0, 1}


def test_repeated_ids_and_odd_columns(spark, corpus):
    docs, labels = corpus
    more = docs.limit(3).select("doc_id", F.lit("another text").alias("text"), F.lit(1.0).alias("score"))
    both = docs.unionByName(more).select("*", *[F.lit("x").alias(c) for c in ("toxic", "words", "mark", "first")])
    a, b = ({(r["doc_id"], r["text"]): r["score"] for r in t.toxicity(x, labels).collect()} for x in (both, both.repartition(7)))
    assert a == b and len(a) == 611


def test_score_in_another_case(spark):
    docs = spark.createDataFrame([(1, "some words", 5.0)], "doc_id long, text string, Score double")
    out = t.toxicity(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert out.columns == ["doc_id", "text", "score"] and 0 <= out.select("score").head()[0] <= 1
