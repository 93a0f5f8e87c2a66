import collections
import hashlib

import pytest

from assayloom.llm import suffix_dedup


def brute(rows):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(t[k : k + 200] for _, t in data for k in range(len(t) - 199))
    out = []
    for i, t in data:
        gone = bytearray(len(t))
        for k in range(len(t) - 199):
            if seen[t[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        spans = sum(1 for k in range(len(t)) if gone[k] and (not k or not gone[k - 1]))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return sorted(out)


def found(df):
    return sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in suffix_dedup.without_repeats(df).collect())


def test_against_brute_force(docs, plain):
    assert found(docs) == brute(plain)


def test_oversized_groups(docs, plain, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP", 3)
    assert found(docs) == brute(plain)


def test_join_instead_of_broadcast(docs, plain, monkeypatch):
    monkeypatch.setattr(suffix_dedup.removed_ranges, "__defaults__", (0,))
    assert found(docs) == brute(plain)


def test_empty_and_null(none, nulls):
    assert found(none) == []
    assert [r[:4] for r in found(nulls)] == [(None, 0, 0, 0)] * 3


def test_merge_keeps_order_and_prefixes():
    runs = [[(b"aa", b"", 1), (b"ab", b"x", 1)], [(b"a", b"", 2), (b"ab", b"y", 1), (b"b", b"", 1)], []]
    out = list(suffix_dedup.merged([suffix_dedup.front_coded(r) for r in runs]))
    assert [x[1] for x in out] == [b"a", b"aa", b"ab", b"ab", b"b"]
    assert [x[0] for x in out] == [0, 1, 1, 2, 0]
    assert list(suffix_dedup.merged([])) == []


@pytest.mark.parametrize("a,b,start,n", [(b"", b"", 0, 0), (b"x" * 40 + b"a", b"x" * 40 + b"b", 0, 40), (b"abc", b"abcd", 1, 3)])
def test_common(a, b, start, n):
    assert suffix_dedup.common(a, b, start) == n


def test_least_id_is_no_null(spark):
    repeated = hashlib.sha512(b"x").hexdigest() * 2 + hashlib.sha512(b"y").hexdigest()
    repeated = repeated[:300]
    rows = [(-(1 << 63), "p" + repeated, 1), (None, "q" + repeated, 2), (None, "alone", 3), (0, "r" + repeated, 4), (0, "alone two", 5)]
    got = suffix_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string, ID int")).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"]) for r in got) == sorted([(str(-(1 << 63)), 301, 300), ("None", 301, 300), ("None", 5, 0), ("0", 301, 300), ("0", 9, 0)])
