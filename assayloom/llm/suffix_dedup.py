"""Removal of repeated byte strings by a distributed merge sort of suffixes that never compares a known prefix again.

A byte goes if a string of LENGTH bytes covers it that also starts at another place, of the same document or another one.
Suffixes are taken at anchors only: of every WINDOW consecutive places the one whose GRAM bytes hash lowest. Every string
of LENGTH bytes holds the anchor of its first WINDOW places, and equal strings hold it at the same distance, so two equal
strings show as two anchors whose suffixes agree for REACH = LENGTH - WINDOW + 1 bytes at least.

1. Anchors whose first REACH bytes occur once are dropped: a count of 64-bit hashes over all texts.
2. Each task sorts the suffixes (with what stands before them) of the anchors that are left into a run, front-codes it and
   deals it out by ranges. A context that occurs often in a task is one entry with a count.
3. Each range merges its runs with a loser tree that keeps for every head its common prefix with the last winner: only
   ties of these are compared, and from there on. Suffixes that share REACH bytes come out one after another.
4. Among those, a context's strings that occur twice, by their distance to the anchor, give the range of removed bytes.
   Groups of more than GROUP contexts are counted as rows of string hashes in Spark instead.
5. Documents get their ranges back and lose those bytes.

Defined results: a null text is empty; empty texts and texts under LENGTH bytes lose nothing; repeated rows are documents
of their own, so all of a repeated text of LENGTH bytes or more goes; an empty table gives no rows; other columns are not
read. Hashes of 64 bits and more stand for the strings they are made from.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayloom.llm.common import keyed, short_batches, written

LENGTH, WINDOW, GRAM = 200, 150, 16
REACH, HEAD = LENGTH - WINDOW + 1, 40
#: So many hashes of repeated anchors are broadcast (8 bytes each); beyond, anchors and hashes are joined in a shuffle.
BROADCAST_HASHES = 4_000_000
#: Contexts of a group that a merge holds at once; bytes of contexts a range should have; texts looked at for its bounds.
GROUP, RANGE_BYTES, BOUNDS_FROM = 50_000, 12 << 20, 1000
CHUNK = 1 << 19
#: Hashes that a task counts, and contexts of a run that it sorts, before it hands them on.
LOT, RUN = 1_000_000, 40_000

_SEED = np.random.default_rng(20_240_607)
BYTE = _SEED.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
MIX = np.uint64(0xD6E8FEB86659FD93)


class Powers:
    """Powers of BASE and of its inverse modulo 2**64."""

    def __init__(self) -> None:
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) <= n:
            m = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(BASE, m, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(BASE, -m, 1 << 64))])
        return self.up[: n + 1], self.down[: n + 1]


POWERS = Powers()


def sums_of(data: np.ndarray) -> np.ndarray:
    """Prefix sums of the bytes' numbers times powers: two of them give the hash of any span."""
    up, _ = POWERS.upto(data.shape[-1])
    out = np.zeros((*data.shape[:-1], data.shape[-1] + 1), np.uint64)
    np.cumsum(BYTE[data] * up[:-1], axis=-1, out=out[..., 1:])
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX
    return (h ^ (h >> np.uint64(29))) * MIX


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts one after another, the last bytes' places in `ends`: anchors, their text's number, hash of REACH bytes."""
    none = np.zeros(0, np.int64)
    if len(data) < GRAM + WINDOW - 1:
        return none, none, none
    s = sums_of(data)
    _, down = POWERS.upto(len(data))
    n = len(data) - GRAM + 1
    low = mixed((s[GRAM:] - s[:n]) * down[:n]) >> np.uint64(32)
    ranked = (low << np.uint64(32)) | np.arange(n, dtype=np.uint64)
    rows = -(-n // WINDOW)
    square = np.full(rows * WINDOW, np.iinfo(np.uint64).max, np.uint64)
    square[:n] = ranked
    square = square.reshape(rows, WINDOW)
    ahead = np.minimum.accumulate(square, 1).ravel()
    behind = np.minimum.accumulate(square[:, ::-1], 1)[:, ::-1].ravel()
    least = np.minimum(behind[: n - WINDOW + 1], ahead[WINDOW - 1 : n])
    at = np.unique(least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    text = np.searchsorted(ends, at, side="right")
    fits = at + REACH <= ends[text]
    at, text = at[fits], text[fits]
    return at, text, mixed((s[at + REACH] - s[at]) * down[at]).view(np.int64)


def chunks(texts: list[bytes]) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Texts in lots of about CHUNK bytes: number of the first, the bytes, the ends of each."""
    at = 0
    while at < len(texts):
        lot, size = [], 0
        while at + len(lot) < len(texts) and (size < CHUNK or not lot):
            lot.append(texts[at + len(lot)])
            size += len(lot[-1])
        yield at, b"".join(lot), np.cumsum([len(x) for x in lot])
        at += len(lot)


def texts_of(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("text").cast(pa.large_binary()).to_pylist()


def anchor_hashes(texts: DataFrame) -> DataFrame:
    """h, n: the hash of REACH bytes at each anchor, and how often it stands in the texts, 2 standing for more."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(found: list[np.ndarray]) -> pa.RecordBatch:
            h, n = np.unique(np.concatenate([np.zeros(0, np.int64), *found]), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h), pa.array(n.astype(np.int64))], names=["h", "n"])

        found: list[np.ndarray] = []
        for b in batches:
            found += [anchors(np.frombuffer(data, np.uint8), ends)[2] for _, data, ends in chunks(texts_of(b))]
            if sum(map(len, found)) > LOT:
                yield counted(found)
                found = []
        yield counted(found)

    return texts.select("text").mapInArrow(work, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


class Repeated:
    """Which anchors of a text count: by a sorted array of hashes, or by the places a join found."""

    def __init__(self, hashes: np.ndarray | None) -> None:
        self.hashes = hashes

    def of(self, batch: pa.RecordBatch) -> Iterator[tuple[int, int, bytes, bytes]]:
        """(row, place, bytes before, bytes from it on) of each anchor that counts."""
        texts = texts_of(batch)
        places = None if self.hashes is not None else batch.column("places").to_pylist()
        for first, data, ends in chunks(texts):
            if places is not None:
                lengths = [len(p or ()) for p in places[first : first + len(ends)]]
                text = np.repeat(np.arange(len(ends)), lengths)
                starts = np.concatenate([[0], ends[:-1]])
                at = np.array([x for p in places[first : first + len(ends)] for x in p or ()], np.int64) + starts[text]
            else:
                at, text, h = anchors(np.frombuffer(data, np.uint8), ends)
                if not len(self.hashes):
                    continue
                i = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
                kept = self.hashes[i] == h
                at, text = at[kept], text[kept]
            starts = np.concatenate([[0], ends[:-1]])
            for a, t, low, high in zip(at.tolist(), text.tolist(), starts[text].tolist(), ends[text].tolist(), strict=True):
                yield first + t, a - low, data[max(low, a - WINDOW + 1) : a], data[a : min(high, a + LENGTH)]


def key_of(before: bytes, after: bytes) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(len(before).to_bytes(2, "little") + before + after)
    return (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63)


def common(a: bytes, b: bytes, start: int) -> int:
    """The length of the common prefix, known to be `start` at least."""
    end = min(len(a), len(b))
    while start < end and a[start : start + 16] == b[start : start + 16]:
        start += 16
    start = min(start, end)
    while start < end and a[start] == b[start]:
        start += 1
    return start


def front_coded(run: list[tuple[bytes, bytes, int]]) -> bytes:
    """A sorted run of (after, before, n): each `after` as its common prefix with the one before and the rest."""
    out, last = [], b""
    for after, before, n in run:
        c = common(last, after, 0)
        rest = after[c:]
        out.append(bytes((c, len(rest), len(before))) + min(n, 2).to_bytes(1, "little") + rest + before)
        last = after
    return b"".join(out)


def decoded(data: bytes) -> Iterator[tuple[int, bytes, bytes, int]]:
    """(common prefix with the one before, after, before, n)"""
    at, last = 0, b""
    while at < len(data):
        c, rest, before, n = data[at : at + 4]
        at += 4
        last = last[:c] + data[at : at + rest]
        yield c, last, data[at + rest : at + rest + before], n
        at += rest + before


def merged(runs: list[bytes]) -> Iterator[tuple[int, bytes, bytes, int]]:
    """All entries of front-coded runs in order, each with its common prefix with the one before it.

    A loser tree: every node holds the loser of its match with its common prefix with the winner. Of two heads, both with
    their common prefix with the last winner, the one with the longer is smaller, and that needs no look at the bytes.
    """
    streams = [decoded(r) for r in runs]
    k = 1 << max(0, len(streams) - 1).bit_length()
    heads = [next(s, None) for s in streams] + [None] * (k - len(streams))
    prefix = [0] * k
    losers = [-1] * k

    def match(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's prefix becomes that with the winner."""
        x, y = heads[a], heads[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        if prefix[a] != prefix[b]:
            return (a, b) if prefix[a] > prefix[b] else (b, a)
        c = common(x[1], y[1], prefix[a])
        if x[1][c:] <= y[1][c:]:
            prefix[b] = c
            return a, b
        prefix[a] = c
        return b, a

    winners = list(range(k))
    level, base = k, k // 2
    while level > 1:
        fresh = []
        for i in range(0, level, 2):
            w, loser = match(winners[i], winners[i + 1])
            losers[base + i // 2] = loser
            fresh.append(w)
        winners, level, base = fresh, level // 2, base // 2
    w = winners[0]
    while heads[w] is not None:
        _, after, before, n = heads[w]
        yield prefix[w], after, before, n
        heads[w] = next(streams[w], None)
        prefix[w] = heads[w][0] if heads[w] is not None else 0
        node = (w + k) // 2
        while node:
            w, losers[node] = match(w, losers[node])
            node //= 2


def string_hashes(contexts: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """For contexts (before, after): the hashes of the LENGTH-byte strings that start 0, 1, ... WINDOW - 1 bytes before
    the anchor, and which of them there are."""
    wide = WINDOW - 1 + LENGTH
    data = np.frombuffer(b"".join(before.rjust(WINDOW - 1, b"\0") + after.ljust(LENGTH, b"\0") for before, after in contexts), np.uint8).reshape(-1, wide)
    s = sums_of(data)
    _, down = POWERS.upto(wide)
    start = WINDOW - 1 - np.arange(WINDOW)
    h = mixed((s[:, start + LENGTH] - s[:, start]) * down[start])
    d = np.arange(WINDOW)
    left = np.array([len(b) for b, _ in contexts])[:, None]
    right = np.array([len(a) for _, a in contexts])[:, None]
    return h, (d <= left) & (LENGTH - d <= right)


def repeated_ranges(contexts: list[tuple[bytes, bytes]], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each context the least and greatest distance at which its string occurs twice; -1 where none does."""
    least, most = np.full(len(contexts), -1), np.full(len(contexts), -1)
    if not contexts:
        return least, most
    h, there = string_hashes(contexts)
    for d in range(WINDOW):
        rows = np.flatnonzero(there[:, d])
        order = rows[np.argsort(h[rows, d], kind="stable")]
        v, n = h[order, d], counts[order]
        if not len(v):
            continue
        starts = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        total = np.repeat(np.add.reduceat(n, starts), np.diff(np.concatenate([starts, [len(v)]])))
        twice = order[total > 1]
        most[twice] = d
        least[twice[least[twice] < 0]] = d
    return least, most


RANGES = "k1 long, k2 long, least int, most int, strings array<long>"


def merge_ranges(runs: DataFrame) -> DataFrame:
    """RANGES rows of (part, run) rows: a context's removed range, or in oversized groups its string hashes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["k1", "k2", "least", "most", "strings"]

        def rows(contexts: list, least: list, most: list, strings: list | None) -> pa.RecordBatch:
            keys = [key_of(*c) for c in contexts]
            columns = [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array(least, pa.int32()), pa.array(most, pa.int32())]
            return pa.RecordBatch.from_arrays([*columns, pa.array(strings or [None] * len(keys), pa.list_(pa.int64()))], names=names)

        def settled(held: dict) -> pa.RecordBatch:
            contexts = list(held)
            least, most = repeated_ranges(contexts, np.array([held[c] for c in contexts], np.int64))
            hit = np.flatnonzero(most >= 0)
            return rows([contexts[i] for i in hit], least[hit].tolist(), most[hit].tolist(), None)

        def opened(group: dict) -> pa.RecordBatch:
            """String hashes; of a context that occurs twice, each stands twice."""
            contexts = list(group)
            h, there = string_hashes(contexts)
            strings = [np.where(t, x.view(np.int64), 0).tolist() for x, t in zip(h, there, strict=True)]
            return rows(contexts, [-group[c] for c in contexts], [-1] * len(contexts), strings)

        def ranges(parts: list[bytes]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple[bytes, bytes], int] = {}  # whole groups
            group: dict[tuple[bytes, bytes], int] = {}  # the group that is coming out
            oversized = False
            for c, after, before, n in merged(parts):
                if c < REACH:
                    if oversized:
                        yield opened(group)
                    elif len(group) > 1 or max(group.values(), default=0) > 1:
                        held |= group
                    group, oversized = {}, False
                    if len(held) > GROUP:
                        yield settled(held)
                        held = {}
                group[before, after] = group.get((before, after), 0) + n
                if len(group) > GROUP:
                    yield opened(group)
                    group, oversized = {}, True
            if oversized:
                yield opened(group)
            elif group:
                held |= group
            yield settled(held)

        part, parts = None, []
        for b in batches:
            for p, run in zip(b.column("part").to_pylist(), b.column("run").to_pylist(), strict=True):
                if p != part and parts:
                    yield from ranges(parts)
                    parts = []
                part = p
                parts.append(run)
        if parts:
            yield from ranges(parts)

    return runs.sortWithinPartitions("part").mapInArrow(work, RANGES)


def bounds(texts: DataFrame, parts: int) -> list[bytes]:
    """At most parts - 1 heads of suffixes that divide the order evenly, as far as a few texts show; only balance rests on it."""
    heads = []
    for _, data, ends in chunks([r["text"].encode() for r in texts.select("text").limit(BOUNDS_FROM).collect()]):
        at = anchors(np.frombuffer(data, np.uint8), ends)[0]
        heads += [data[a : a + HEAD] for a in at.tolist()]
    heads.sort()
    return sorted({heads[len(heads) * i // parts] for i in range(1, parts)}) if heads else []


def sorted_runs(texts: DataFrame, shared: Broadcast) -> DataFrame:
    """part, run: the front-coded sorted runs of every range, of RUN contexts or more. shared: (Repeated, bounds)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated, cuts = shared.value

        def dealt(found: dict[tuple[bytes, bytes], int]) -> pa.RecordBatch:
            parts: list[list] = [[] for _ in range(len(cuts) + 1)]
            for (after, before), n in sorted(found.items()):
                parts[bisect.bisect_right(cuts, after[:HEAD])].append((after, before, n))
            full = [p for p, x in enumerate(parts) if x]
            return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([front_coded(parts[p]) for p in full], pa.binary())], names=["part", "run"])

        found: dict[tuple[bytes, bytes], int] = {}
        for b in batches:
            for _, _, before, after in repeated.of(b):
                found[after, before] = found.get((after, before), 0) + 1
            if len(found) > RUN:
                yield dealt(found)
                found = {}
        yield dealt(found)

    return texts.mapInArrow(work, "part int, run binary")


def anchor_places(texts: DataFrame) -> DataFrame:
    """id, mark, place, h of every anchor."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, data, ends in chunks(texts_of(b)):
                at, text, h = anchors(np.frombuffer(data, np.uint8), ends)
                rows = pa.array(first + text)
                place = at - np.concatenate([[0], ends[:-1]])[text]
                yield pa.RecordBatch.from_arrays([b.column("id").take(rows), b.column("mark").take(rows), pa.array(place), pa.array(h)], names=["id", "mark", "place", "h"])

    return texts.mapInArrow(work, "id long, mark long, place long, h long")


def occurrences(texts: DataFrame, shared: Broadcast) -> DataFrame:
    """id, mark, place, k1, k2 of each anchor that counts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated, _ = shared.value
        for b in batches:
            rows, places, first, second = [], [], [], []
            for row, place, before, after in repeated.of(b):
                k1, k2 = key_of(before, after)
                rows.append(row)
                places.append(place)
                first.append(k1)
                second.append(k2)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("id").take(at), b.column("mark").take(at), pa.array(places, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64())], names=["id", "mark", "place", "k1", "k2"])

    return texts.mapInArrow(work, "id long, mark long, place long, k1 long, k2 long")


def oversized_ranges(rows: DataFrame) -> DataFrame:
    """k1, k2, least, most of contexts in oversized groups: their strings counted as rows."""
    own = rows.filter("strings IS NOT NULL").select("k1", "k2", (-F.col("least")).alias("n"), F.posexplode("strings").alias("d", "h")).filter("h != 0")
    twice = own.groupBy("d", "h").agg(F.sum("n").alias("n")).filter("n > 1")
    return own.join(twice.select("d", "h"), ["d", "h"], "left_semi").groupBy("k1", "k2").agg(F.min("d").alias("least"), F.max("d").alias("most"))


def removed_ranges(docs: DataFrame, broadcast: int = BROADCAST_HASHES) -> tuple[DataFrame, DataFrame]:
    """(texts, ranges): texts are rows (doc_id, id, mark, text), ranges rows (id, mark, spans array<struct<start,end>>)."""
    spark = docs.sparkSession
    short_batches(spark)
    texts = keyed(docs)
    hashes = written(anchor_hashes(texts).filter("n > 1"), "anchor-hashes")
    size = hashes.agg(F.count("*").alias("hashes"), F.coalesce(F.sum("n"), F.lit(0)).alias("anchors")).head()
    if size["hashes"] <= broadcast:
        column = hashes.select("h").toArrow().column("h")
        repeated = Repeated(np.sort(column.to_numpy()) if len(column) else np.zeros(0, np.int64))
        known = texts
    else:
        found = anchor_places(texts).join(hashes.select("h"), "h", "left_semi").distinct()
        repeated = Repeated(None)
        known = texts.join(found.groupBy("id", "mark").agg(F.sort_array(F.collect_list("place")).alias("places")), ["id", "mark"])
    parts = max(spark.sparkContext.defaultParallelism, -(-size["anchors"] * (LENGTH + WINDOW) // RANGE_BYTES))
    shared = spark.sparkContext.broadcast((repeated, bounds(texts, parts)))
    runs = sorted_runs(known, shared)
    result = written(merge_ranges(runs.repartitionById(parts, "part")), "context-ranges")
    settled = result.filter("strings IS NULL").select("k1", "k2", "least", "most")
    ranges = settled.unionByName(oversized_ranges(result)).groupBy("k1", "k2").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    ranges = written(ranges, "ranges")  # so that the join below has nothing but its two shuffles, and a hot context can be split
    span = F.struct((F.col("place") - F.col("most")).alias("start"), (F.col("place") - F.col("least") + LENGTH).alias("end"))
    hits = occurrences(known, shared).join(ranges, ["k1", "k2"])
    return texts, hits.select("id", "mark", span.alias("span")).groupBy("id", "mark").agg(F.sort_array(F.collect_set("span")).alias("spans"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_bytes, n_removed, n_spans, kept binary."""
    texts, ranges = removed_ranges(docs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], []]
            for data, spans in zip(texts_of(b), b.column("spans").to_pylist(), strict=True):
                kept, at, n = [], 0, 0
                for s in spans or ():
                    if s["start"] > at or not n:
                        kept.append(data[at : s["start"]])
                        n += 1
                    at = max(at, s["end"])
                kept.append(data[at:])
                whole = b"".join(kept)
                for column, v in zip(out, (len(data), len(data) - len(whole), n, whole), strict=True):
                    column.append(v)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = texts.join(ranges, ["id", "mark"], "left").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "spans")
    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
