"""Byte pair encoding and decoding as a tokenizer file defines them, merged through a segment tree over adjacent pairs.

A piece of text (what the file's pre-tokenizer gives) starts as one symbol a character, the last one with the file's
word-end suffix. The tree's leaves hold (rank, place) of every adjacent pair, infinity where the pair can't merge, and each
inner node the least of its two: the root is the leftmost pair of lowest rank. Merging it changes three leaves and the
nodes above them, so a piece of n symbols takes n log n steps, also one of a million letters. Pieces repeat, so tasks keep
what they gave, in tables of bounded size.

Encoding and decoding are maps: nothing is shuffled, and a hot key or source means nothing to them.

Defined results: a null text is empty and has no ids; a null list of ids decodes to the empty text, an id that the file
doesn't know is left out; the file's added tokens count as such wherever a text spells them; repeated rows are rows of their
own; an empty table gives an empty result; other columns go along, whatever their names (`ids` and `decoded` are replaced).
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayloom.llm.common import short_batches

#: Texts without any other characters than these are lower-cased and split here, others by the file's own steps: for these,
#: normal forms, letters and digits are the same in every version of Unicode.
PLAIN = re.compile(r"[^\t\n\r\x20-\x7e\xa1-ɏ]")
#: Half of the pieces that a task keeps with their ids, and the longest of them.
KEPT, KEPT_CHARS = 300_000, 64
#: ASCII characters outside PLAIN.
BARE = [chr(c) for c in (*range(9), 11, 12, *range(14, 32), 127)]
NEVER = 1 << 62
BITS = 4
FAN = 1 << BITS


def merged(symbols: list[int], pairs: dict[tuple[int, int], int], made: list[int]) -> list[int]:
    """The symbols after all merges. pairs: (left, right) -> rank << 32; made: rank -> merged symbol. The lowest rank goes
    first, of equal ranks the leftmost. A node of the tree is the least of FAN below it; up to FAN
    pairs have a root alone."""
    n, rank_of = len(symbols), pairs.get
    if n < 2:
        return symbols
    leaves = [rank_of(pair, NEVER) | i for i, pair in enumerate(zip(symbols, symbols[1:], strict=False))]
    tree, level, alone = [leaves], leaves, n - 1 <= FAN
    while len(level) > 1 and not alone:
        level = [min(level[at : at + FAN]) for at in range(0, len(level), FAN)]
        tree.append(level)
    top = tree[-1]
    after, before = [*range(1, n), -1], [*range(-1, n - 1)]
    while (root := min(leaves) if alone else top[0]) < NEVER:
        i = root & 0xFFFFFFFF
        j = after[i]
        k, h, new = after[j], before[i], made[root >> 32]
        symbols[i], symbols[j] = new, -1
        after[i] = k
        # the pair at i is a new one, the pair at j is gone, and so is what stood before i
        leaves[i] = NEVER
        if k >= 0:
            before[k] = i
            leaves[i] = rank_of((new, symbols[k]), NEVER) | i
            leaves[j] = NEVER
        if h >= 0:
            leaves[h] = rank_of((symbols[h], new), NEVER) | h
        if alone:
            continue
        for at in {x >> BITS for x in (i, j, h) if 0 <= x < n - 1}:
            below = leaves
            for level in tree[1:]:
                least = min(below[at << BITS : at + 1 << BITS])
                if level[at] == least:
                    break
                level[at] = least
                below, at = level, at >> BITS
    return [s for s in symbols if s >= 0]


def byte_letters() -> list[str]:
    """The letter for each byte: printable Latin-1 ones stand for themselves, the others for 256 and on, in order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    far = iter(range(256, 512))
    return [chr(b if b in own else next(far)) for b in range(256)]


class Pieces(dict):
    """Piece -> its ids as 32-bit bytes, found when first asked for. Once it is full it becomes the old half, from which what is asked for
    again moves over; the old half before it goes."""

    def __init__(self, find) -> None:  # noqa: ANN001
        super().__init__()
        self.find = find
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.find(piece)
        if len(piece) <= KEPT_CHARS:
            if len(self) >= KEPT:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Bpe:
    """The vocabulary and merges of a tokenizer file of kind BPE, without padding and truncation."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        self.vocabulary: dict[str, int] = model["vocab"]
        if model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError(f"{path}: only plain merges with a word-end suffix are supported")
        self.suffix = model.get("end_of_word_suffix") or ""
        merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        of = self.vocabulary
        self.pairs = {(of[a], of[b]): rank << 32 for rank, (a, b) in reversed([*enumerate(merges)])}
        self.made = [of[a + b] for a, b in merges]
        self.added = {t["content"]: t["id"] for t in file["added_tokens"]}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.split_added = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.added else None
        names = {i: s for s, i in [*of.items(), *self.added.items()]}
        self.names = np.array([names.get(i) for i in range(max(names) + 1)], object)
        whole = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = whole.normalizer, whole.pre_tokenizer
        self.decoder = whole.decoder
        self.by_letters = Pieces(self._of_letters)
        self.by_piece = Pieces(self._of_piece)
        self.by_chunk = Pieces(self._of_chunk)
        self.pattern = self._plain_pattern(file)
        self.letters = str.maketrans({b: c for b, c in enumerate(byte_letters())})

    @staticmethod
    def _plain_pattern(file: dict):  # noqa: ANN205
        """The pattern of the pieces, if the file lower-cases, splits by one pattern that no white space can match, and
        spells bytes as letters; else None, and the file's own steps are taken for every text."""
        import regex

        steps = [s["type"] for s in (file.get("normalizer") or {}).get("normalizers", [])]
        cut = (file.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        known = steps == ["NFC", "Replace", "Lowercase"] and [s.get("type") for s in cut] == ["Split", "ByteLevel"]
        if not known or cut[0]["behavior"] != "Removed" or not cut[0]["invert"] or cut[1]["use_regex"] or cut[1]["add_prefix_space"] or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in file["added_tokens"]):
            return None
        own = file["normalizer"]["normalizers"][1]
        pattern = regex.compile(cut[0]["pattern"]["Regex"])
        return pattern if own["pattern"] == {"Regex": r"\s+"} and own["content"] == " " and not pattern.search(" \t\n\r") else None

    def _of_letters(self, piece: str) -> bytes:
        whole = self.vocabulary.get
        symbols = [*map(whole, piece[:-1]), whole(piece[-1:] + self.suffix)] if piece else []
        if None in symbols:
            symbols = [s for s in symbols if s is not None]
        return array("i", merged(symbols, self.pairs, self.made)).tobytes()

    def _of_piece(self, piece: str) -> bytes:
        return self._of_letters(piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters))

    def _of_chunk(self, chunk: str) -> bytes:
        """Of a lower-case run of plain characters without white space."""
        found = self.pattern.findall(chunk)
        return self._of_piece(chunk) if found == [chunk] else b"".join(map(self.by_piece.__getitem__, found))

    def _ids(self, text: str) -> bytes:
        if self.pattern is not None and (text.isascii() or not PLAIN.search(text)) and not any(c in text for c in BARE):
            return b"".join(map(self.by_chunk.__getitem__, text.lower().split()))
        normal = self.normalizer.normalize_str(text) if self.normalizer else text
        cut = [p for p, _ in self.pre_tokenizer.pre_tokenize_str(normal)] if self.pre_tokenizer else [normal]
        return b"".join(map(self.by_letters.__getitem__, cut))

    def encode(self, text: str) -> np.ndarray:
        if self.split_added is None or not any(t in text for t in self.added):
            return np.frombuffer(self._ids(text), np.int32)
        parts = [array("i", [self.added[p]]).tobytes() if p in self.added else self._ids(p) for p in self.split_added.split(text)]
        return np.frombuffer(b"".join(parts), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The names of the known ids through the file's decoder; without one, joined by a space."""
        ids = ids[(ids >= 0) & (ids < len(self.names))]
        names = [s for s in self.names[ids] if s is not None]
        return self.decoder.decode(names) if self.decoder else " ".join(names)


@lru_cache(maxsize=2)
def bpe(path: str) -> Bpe:
    """One a Python worker; its tables of pieces serve all tasks that the worker runs."""
    return Bpe(path)


def encoded(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """`docs` with ids array<int>, the text's ids by the tokenizer file, without special tokens around them."""
    short_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c.lower() != "ids"]
    rows = docs.select(F.struct(*[docs[c] for c in kept]).alias("row"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe(tokenizer)
        for b in batches:
            lists = [own.encode(x) for x in b.column("text").to_pylist()]
            ends = np.cumsum([0, *map(len, lists)])
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *lists])))
            yield pa.RecordBatch.from_arrays([b.column("row"), ids], names=["row", "ids"])

    return rows.mapInArrow(work, f"row {rows.schema['row'].dataType.simpleString()}, ids array<int>").select("row.*", "ids")


def decoded(tokens: DataFrame, tokenizer: str, ids: str = "ids") -> DataFrame:
    """`tokens` with decoded, the text of the list of ids, special tokens included."""
    short_batches(tokens.sparkSession)
    kept = [c for c in tokens.columns if c.lower() != "decoded"]
    rows = tokens.select(F.struct(*[tokens[c] for c in kept]).alias("row"), F.coalesce(tokens[ids].cast("array<int>"), F.array().cast("array<int>")).alias("ids"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe(tokenizer)
        for b in batches:
            column = b.column("ids")
            ends, values = column.offsets.to_numpy(), column.values.fill_null(-1).to_numpy()
            texts = [own.decode(values[i:j]) for i, j in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(texts, pa.string())], names=["row", "decoded"])

    return rows.mapInArrow(work, f"row {rows.schema['row'].dataType.simpleString()}, decoded string").select("row.*", "decoded")
