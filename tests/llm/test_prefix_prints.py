import hashlib
import random

import pytest

from assayloom.llm import prefix_prints as p


def test_spans_and_extensions():
    r = random.Random(1)
    a = "".join(r.choice("ab") for _ in range(400))
    b = a[:150] + "X" + a[151:]
    x, y = p.Prefix(a), p.Prefix(b)
    for _ in range(300):
        i, j, n = r.randrange(300), r.randrange(300), r.randrange(100)
        assert (x.span(i, n) == y.span(j, n)) == (a[i : i + n] == b[j : j + n])
        want = next((k for k in range(400) if i + k >= 400 or j + k >= 400 or a[i + k] != b[j + k]), 400)
        assert x.common(i, y, j) == want
    assert p.Prefix("").common(0, x, 0) == 0


B, M = 1_000_003, (1 << 31) - 1


def plain_print(text):
    """The fingerprint from its definition: the hash of every span written out as a sum."""
    values = set()
    for end in range(1, len(text) + 1):
        span = text[max(0, end - p.SPAN) : end]
        h = sum((ord(c) + 1) * pow(B, p.SPAN - len(span) + i, M) for i, c in enumerate(span)) % M
        values.add((h * 0x9E3779B97F4A7C15 % (1 << 64)) >> 32)
    return sorted(values)[: p.KEEP]


def plain_likeness(a, b):
    if not a or not b:
        return float(len(a) == len(b))
    union = sorted({*a, *b})[: p.KEEP]
    return len({*a} & {*b} & {*union}) / len(union)


def test_prints_by_definition():
    r = random.Random(4)
    for n in [0, 1, 2, 11, 12, 13, 63, 64, 65, 700]:
        text = "".join(r.choice("abcé日 ") for _ in range(n))
        assert p.print_of(p.Prefix(text)).tolist() == plain_print(text)


def test_likeness_of_prefixes_is_continuous():
    r = random.Random(8)
    text = "".join(r.choice("abcdefghijklmnop ") for _ in range(200))
    prints = [p.print_of(p.Prefix(text[:n])) for n in range(201)]
    for n in range(1, 200):
        assert p.likeness(prints[n], prints[n + 1]) >= min(0.93, n / (n + 1) - 1e-9)
        assert p.likeness(prints[n], prints[n + 1]) == plain_likeness(plain_print(text[:n]), plain_print(text[: n + 1]))


def test_likeness():
    r = random.Random(2)
    text = "".join(r.choice("abcdefgh ") for _ in range(5000))
    a = p.print_of(p.Prefix(text))
    assert p.likeness(a, p.print_of(p.Prefix(text))) == 1
    assert 0.15 < p.likeness(a, p.print_of(p.Prefix(text[:2500] + "".join(r.choice("ijklmnop ") for _ in range(2500))))) < 0.55
    assert p.likeness(a, p.print_of(p.Prefix("q" * 5000))) == 0
    assert p.likeness(p.print_of(p.Prefix("")), a) == 0 and p.likeness(p.print_of(p.Prefix("")), p.print_of(p.Prefix(""))) == 1


@pytest.mark.parametrize("rows", [5000, 3])
def test_against_brute_force(docs, plain, rows):
    unique = list({d: (d, t or "") for d, t in plain}.values())
    table = docs.dropDuplicates(["doc_id"])
    got = {r["doc_id"]: r for r in p.prints(table, rows).collect()}
    order = sorted(unique, reverse=True)
    assert len(got) == len(order)
    for (d, t), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        r = got[d]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        a, b, c = (plain_print(x) for x in (t, edited, following)) if max(len(t), len(following)) < 3000 else (p.print_of(p.Prefix(x)).tolist() for x in (t, edited, following))
        spell = lambda v: "".join(f"{x:08x}" for x in v)
        assert (r["fingerprint"], r["edited_fingerprint"], r["near_edited"], r["near_next"]) == (spell(a), spell(b), plain_likeness(a, b), plain_likeness(a, c))
        assert r["common_prefix"] == next((k for k, (x, y) in enumerate(zip(t, edited)) if x != y), min(len(t), len(edited)))


def test_repeated_rows_nulls_and_empty(docs, none, nulls, spark):
    assert p.prints(docs, 4).count() == docs.count()
    assert p.prints(none).count() == 0
    assert [(r["fingerprint"], r["near_next"]) for r in p.prints(nulls).collect()] == [("", 1.0)] * 3
    one = spark.createDataFrame([(5, "abcd")], "doc_id long, text string")
    assert [(r["edited_sha256"], r["near_next"]) for r in p.prints(one).collect()] == [(hashlib.sha256(b"abab").hexdigest(), 1.0)]
