"""Every order applied step by step to the rows themselves, and the chains with fingerprints that collide."""

import random
import re
from collections import defaultdict
from itertools import permutations

import pytest
import xxhash

from assayloom.llm import filter_audit as audit


def plain_version(rows, labels):
    """rows: (doc_id, text, source)."""
    far = float("inf")
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    least = defaultdict(lambda: far)
    key = lambda d: far if d is None else d
    for d, t, _ in rows:
        least[t or ""] = min(least[t or ""], key(d))

    def fails(f, d, text):
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        return {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": key(d) > least[text],
        }[f]

    failing = [{f for f in "ABCDE" if fails(f, d, t)} for d, t, _ in rows]
    out = {}
    for part in {s or "" for *_, s in rows}:
        own = [(d, x) for (d, _, s), x in zip(rows, failing, strict=True) if (s or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shapley[f] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(f in x for _, x in own) - len(gone), sum(x == {f} for _, x in own), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone),
                ]
        for (p, order, step), r in out.items():
            if p == part:
                r.append(shapley[order[step - 1]])
    return out


def as_dict(df):
    rows = df.collect()
    out = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for r in rows}
    assert len(out) == len(rows)
    return out


LABELS = [(i, i % 2, int(i % 7 == 0)) for i in range(0, 200, 3)] + [(3, 1, None), (None, 1, 1), (6, None, 1)]


@pytest.fixture(scope="module")
def rows():
    r = random.Random(2)
    words = ["Aa", "b", "C", "é", "dd", "EEE", "f\x0bg", "h i", "50%", "#x"] + [f"w{i}" for i in range(60)]
    texts = [" ".join(r.choice(words[: r.choice([12, 70])]) for _ in range(r.choice([0, 3, 49, 50, 90]))) for _ in range(60)]
    out = [(i, r.choice(texts), r.choice([None, "", "s", "t"])) for i in range(170)]
    return out + [(i, "the hot one " * 20, "s") for i in range(170, 230)] + [(None, texts[0], "t"), (None, texts[0], "s"), (None, "alone", None), (400, None, "s"), (401, "", "u"), (5, out[5][1], "t"), (5, out[5][1], "t"), (5, "other", "t")]


@pytest.mark.parametrize("held", [5000, 1 << 25])
def test_every_order(spark, rows, held, monkeypatch):
    monkeypatch.setattr(audit, "HELD", held)
    docs = spark.createDataFrame([(*x, 1, "y") for x in rows], "doc_id long, text string, source string, part int, mask string").repartition(6)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert as_dict(audit.filter_audit(docs, labels)) == plain_version(rows, LABELS)


def test_joined_labels(spark, rows, monkeypatch):
    monkeypatch.setattr(audit, "BROADCAST_LABELS", 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert as_dict(audit.filter_audit(docs, labels)) == plain_version(rows, LABELS)


def test_fixture_rows(spark, docs):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert as_dict(audit.filter_audit(docs, labels)) == plain_version(rows, [])


def test_colliding_fingerprints():
    chains = audit.Chains()
    given = [(b"a", 5), (b"b", 4), (b"a", 3), (b"b", 9), (b"a", 3), (b"c", None), (b"c", 1)]
    out = [(found, len(gone)) for text, doc in given for found, gone in [chains.add(7, text, doc, [("p", 0, 1)])]]
    assert [x for x in out if x[1]] == [(5, 1), (9, 1), (None, 1)]
    assert sorted((text, doc, rows) for _, (text, doc, rows) in chains.empty()) == [(b"a", 3, [("p", 0, 2)]), (b"b", 4, [("p", 0, 1)]), (b"c", 1, [("p", 0, 1)])]
    assert not chains.chains and not chains.held


def test_empty(spark, none, nulls):
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    assert audit.filter_audit(none, labels).count() == 0
    got = as_dict(audit.filter_audit(nulls, labels))
    assert len(got) == 600 and {k[0] for k in got} == {""}
    assert got["", "ABCDE", 1] == [0, 3, 0, 3, 0, 0, 360]


def test_hash_is_stable():
    assert audit.hash_of(None) == audit.hash_of(None) != audit.hash_of(1)
    assert xxhash.xxh64_intdigest(b"") == 17241709254077376921
