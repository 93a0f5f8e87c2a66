"""Ids and decoded texts against the tokenizers library, merges against the plain definition."""

import random
import time

import public_tokenizers
import pytest

from assayloom.llm import bpe
from assayloom.llm.bpe import Bpe, decoded, encoded, merged

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.no_padding()
    t.no_truncation()
    return t


def plain_merges(symbols, pairs):
    """Look for the lowest rank, leftmost, again and again."""
    symbols = list(symbols)
    while True:
        found = [(pairs[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)) if p in pairs]
        if not found:
            return symbols
        _, i = min(found)
        symbols[i : i + 2] = [pairs[symbols[i], symbols[i + 1]][1]]


def test_merges_by_definition():
    r = random.Random(1)
    for _ in range(300):
        pairs, n = {}, 6
        for rank in range(r.randrange(1, 20)):
            pair = (r.randrange(n), r.randrange(n))
            if pair not in pairs:
                pairs[pair] = (rank, n)
                n += 1
        symbols = [r.randrange(6) for _ in range(r.randrange(0, 40))]
        made = [new for _, new in sorted(pairs.values())]
        ranks = {p: at << 32 for at, p in enumerate(sorted(pairs, key=pairs.get))}
        assert merged(list(symbols), ranks, made) == plain_merges(symbols, pairs)


TEXTS = [
    "", " ", "a", "Hello WORLD's we'LL 'tis 'S it's", "<|endoftext|>", "a<|startoftext|>B<|endoftext|><|endoftext|> c", "<|ENDOFTEXT|> <|endoftext |>", "x" * 3000, "été Œuvre Ǆ ŉ ª º ½ ² ÀÉ",
    "Σας ΟΔΟΣ ΌΣ", "İstanbul I ı", "é Å ̈́ 각", "日本語 テスト 12３٣", "😀👩‍👩‍👧 ok", "a\x85b\xa0c d​e", "tab\tline\r\nend \x0b\x0c\x1c\x1f\x00\x7f", "ﬁ ﬀ ß ẞ", "﻿bom �", "don''t 's's 'st",
]


def test_edge_texts(spark, library):
    df = spark.createDataFrame([(i, t, 3) for i, t in enumerate(TEXTS)], "doc_id long, text string, IDS int").repartition(2)
    rows = decoded(encoded(df, PATH), PATH).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        want = library.encode(TEXTS[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids"] == want, TEXTS[r["doc_id"]]
        assert r["decoded"] == library.decode(want, skip_special_tokens=False)


def test_random_texts(library):
    own, r = Bpe(PATH), random.Random(3)
    letters = [*map(chr, range(0x20, 0x250)), *"ΑΣσς αбв中文가́̈  🙂", *" " * 60, *"etaoin" * 20]
    for _ in range(400):
        text = "".join(r.choice(letters) for _ in range(r.randrange(60)))
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_documents(spark, docs, plain, library):
    rows = decoded(encoded(docs, PATH), PATH)
    assert rows.columns == [*docs.columns, "ids", "decoded"]
    got = sorted((r["doc_id"], r["ids"], r["decoded"]) for r in rows.collect())
    ids = [(d, library.encode(t or "", add_special_tokens=False).ids) for d, t in plain]
    assert got == sorted((d, i, library.decode(i, skip_special_tokens=False)) for d, i in ids)


def test_empty_and_null(spark, none, nulls):
    assert encoded(none, PATH).count() == 0
    assert [r["ids"] for r in encoded(nulls, PATH).collect()] == [[]] * 3
    odd = spark.createDataFrame([(1, None), (2, [-1, 320, 99_999_999, None, 49407])], "doc_id long, ids array<int>")
    assert sorted((r["doc_id"], r["decoded"]) for r in decoded(odd, PATH).collect()) == [(1, ""), (2, "a</w> <|endoftext|>")]


def test_long_word_and_full_table(monkeypatch, library):
    own = Bpe(PATH)
    start = time.time()
    assert len(own.encode("ab" * 100_000)) > 1000
    assert time.time() - start < 30
    monkeypatch.setattr(bpe, "KEPT", 2)
    small = Bpe(PATH)
    text = "one two three four one two three"
    assert small.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
