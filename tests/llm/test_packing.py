import collections
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from assayloom.llm import packing as p

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows, capacity):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    out = []
    for d, x in rows:
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 0]
        cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
        out += [(d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(itertools.pairwise(cuts))]
    return sorted(out)


def test_pieces_and_places(docs, plain):
    rows = p.pack(docs, PATH, 64).collect()
    assert sorted(tuple(r)[:5] for r in rows) == expected(plain, 64)
    filled = collections.defaultdict(list)
    for r in rows:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for v in filled.values():
        v.sort()
        assert [o for o, _ in v] == [0, *itertools.accumulate(n for _, n in v)][:-1] and sum(n for _, n in v) <= 64
    assert len(filled) <= -(-sum(r["length"] for r in rows) // 64) + 2


def test_empty_and_null(none, nulls):
    assert p.pack(none, PATH).count() == 0
    assert [(r["length"], r["piece"]) for r in p.pack(nulls, PATH).collect()] == [(1, 0)] * 3


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=200))
def test_ids_are_the_tokenizers(text):
    encode = test_ids_are_the_tokenizers.__dict__.setdefault("ids", p.Ids(PATH))
    t = test_ids_are_the_tokenizers.__dict__.setdefault("tokenizer", encode.tokenizer)
    assert encode(text) == np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def least_bins(lengths, capacity):
    """Exact, by search over small instances."""
    lengths = sorted(lengths, reverse=True)
    best = [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for j in {r: k for k, r in enumerate(rooms) if r >= lengths[i]}.values():
            place(i + 1, [*rooms[:j], rooms[j] - lengths[i], *rooms[j + 1 :]])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best[0]


def test_reduction_keeps_the_optimum():
    r = random.Random(2)
    for _ in range(150):
        lengths = [r.randint(1, 20) for _ in range(r.randint(1, 9))]
        counts = dict(collections.Counter(lengths))
        fixed = p.reduced(counts, 20)
        used = [x for pattern, n in fixed for length, k in pattern for x in [length] * k * n]
        rest = [x for x, n in counts.items() for _ in range(n)]
        assert sorted(used + rest) == sorted(lengths)
        assert all(sum(length * k for length, k in pattern) <= 20 for pattern, _ in fixed)
        assert sum(n for _, n in fixed) + least_bins(rest, 20) == least_bins(lengths, 20)


def test_best_fit_places_everything():
    r = random.Random(4)
    for _ in range(100):
        counts = {r.randint(1, 30): r.randint(1, 40) for _ in range(12)}
        packed = p.best_fit(counts, 30)
        total = collections.Counter()
        for pattern, n in packed:
            assert n > 0 and sum(length * k for length, k in pattern) <= 30
            for length, k in pattern:
                total[length] += k * n
        assert dict(total) == counts
