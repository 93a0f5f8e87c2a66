"""Groups of texts by the Jaccard similarity of their word n-gram sets: T-occurrence search with DivideSkip.

Two sets of sizes a and b link when 100 * overlap >= percent * union, so a set of size n shares all but
slack = n - ceil(percent * n / 100) of its shingles with any partner. In this order:

1. Each text becomes a set of 64-bit shingle hashes. Texts with equal sets are one class from here on.
2. Of the shingles that hash into the lowest share of the range, a text that can link has all but slack in common with
   another text. One count of those hashes over all texts drops every text that doesn't; no link is lost.
3. The shingles of what is left are counted, and each class shows the slack + 1 rarest of its shingles: two classes that
   link share one. Connected components over them are blocks that no link leaves. A block of more than `giant` shingles,
   which chance can make of many unrelated texts, is taken apart again: a part for each shown shingle, in which only pairs
   count that share no shown shingle of a lower hash.
4. A block or part of more than `block_size` shingles is cut by length and, within a length, by a hash into chunks; sets
   that link differ by one length step at most, and every pair of such chunks is a task of its own, so a task holds about
   2 * block_size shingles. One of many small sets is cut as well, into at most SPREAD chunks, so that its pairs, which grow
   with the square of its sets, are the work of many tasks.
5. Each task is searched through inverted lists (see `search`). Every pair that can link is decided; links are summed at
   each class, not stored, and the pairs kept for step 6 are those that connect.
6. Connected components of the links.

Defined results: a null or empty text, or one without words, has the empty set, which links with nothing; a text of fewer
than `words` words is one shingle; repeated rows are one class; rows of one doc_id with different texts are texts of their
own; an empty table gives no rows; only doc_id and text are read. A row of a null doc_id links like any other; it never
names a component, and in one without any doc_id component_id is null.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayloom.llm.common import keyed, short_batches, small, written
from assayloom.llm.components import components
from assayloom.llm.suffix_dedup import POWERS, chunks, mixed, sums_of, texts_of

#: So many hashes (8 bytes each) and row keys (16 bytes each) are broadcast; beyond, joins shuffle.
BROADCAST_HASHES, BROADCAST_ROWS = 4_000_000, 500_000
#: Sets of fewer shingles are tested on all of them.
FEW = 32
#: Shingles in a chunk of a block, and in a block that stays one.
BLOCK, GIANT = 1_000_000, 64_000_000
#: Sets from which a block is cut into chunks of so many, and the most chunks of a length step that are made for that.
ROWS, SPREAD = 64, 24
#: Shingles of more classes than this are joined by broadcast, so that no task gets all rows of one.
HOT = 200
#: Hashes that a task counts before it hands them on.
LOT = 1_000_000
#: DivideSkip's weight of a probe against a merge step, as published; lists of so many postings together merge on a heap.
MU, HEAP = 0.0085, 512

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
STEPS = [np.uint64(x) for x in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]


def shingles(data: bytes, ends: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Of texts joined by single spaces, `ends` where each stops: (text number, hash) of the distinct shingles, in order."""
    x = LOWER[np.frombuffer(data, np.uint8)]
    gap = np.concatenate([[True], SPACE[x], [True]])
    first, last = np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if not len(first):
        return none
    s = sums_of(x)
    _, down = POWERS.upto(len(x))
    w = mixed((s[last] - s[first]) * down[first])
    text = np.searchsorted(ends, first, side="right")
    n = len(w) - words + 1
    own, h = none
    if n > 0:
        whole = text[:n] == text[words - 1 :]
        h = np.zeros(n, np.uint64)
        for j in range(words):
            h += w[j : j + n] * STEPS[j]
        own, h = text[:n][whole], mixed(h[whole])
    for t in np.flatnonzero((counts := np.bincount(text)) < words):  # short texts: all their words are one shingle
        if counts[t]:
            at = np.searchsorted(text, t)
            total = sum(int(w[at + j]) * int(STEPS[j]) for j in range(counts[t])) + int(counts[t])
            own, h = np.append(own, t), np.append(h, mixed(np.array([total % (1 << 64)], np.uint64)))
    order = np.lexsort((h, own))
    own, h = own[order], h[order]
    new = np.concatenate([[True], (own[1:] != own[:-1]) | (h[1:] != h[:-1])]) if len(h) else np.zeros(0, bool)
    return own[new], h[new]


def sets_of(batch: pa.RecordBatch, words: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Lots of a batch: rows, where each row's shingles start in the array (and its end), the array."""
    for at, data, ends in chunks([t + b" " for t in texts_of(batch)]):
        own, h = shingles(data, ends, words)
        yield np.arange(at, at + len(ends)), np.searchsorted(own, np.arange(len(ends) + 1)), h


class Screen:
    """Which shingles of a set count for step 2, and how many of them must be shared."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.limit = np.uint64(min((1 << 64) - 1, (1 << 64) * 2 * (100 - percent) // 100))
        self.all_of = FEW * 100 // percent + 1  # sets that may link with one of fewer than FEW

    def shown(self, starts: np.ndarray, h: np.ndarray) -> np.ndarray:
        n = np.diff(starts)
        return (h < self.limit) | np.repeat(n < self.all_of, n)

    def tested(self, starts: np.ndarray, h: np.ndarray) -> np.ndarray:
        n = np.diff(starts)
        return (h < self.limit) | np.repeat(n < FEW, n)


def screen_counts(texts: DataFrame, words: int, screen: Screen) -> DataFrame:
    """h, n: in how many texts each shown shingle is."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(kept: list[np.ndarray]) -> pa.RecordBatch:
            h, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *kept]), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])

        kept: list[np.ndarray] = []
        for b in batches:
            kept += [h[screen.shown(starts, h)] for _, starts, h in sets_of(b, words)]
            if sum(map(len, kept)) > LOT:  # enough for repeats to meet here
                yield counted(kept)
                kept = []
        yield counted(kept)

    return texts.select("text").mapInArrow(work, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


KEYS = ["doc_id", "id", "mark"]
SIZES = "doc_id long, id long, mark long, n long, k1 long, k2 long, tested long, shared long"


def sizes(texts: DataFrame, words: int, screen: Screen, known: Broadcast | None) -> DataFrame:
    """SIZES rows: set size, two sums that stand for the set, tested shingles and how many of those are shared (with a
    broadcast array of shared hashes; else 0, to be counted by a join)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = known.value if known is not None else np.zeros(0, np.uint64)
        for b in batches:
            out: list[list] = [[] for _ in range(5)]
            for _, starts, h in sets_of(b, words):
                add = lambda v: np.concatenate([[np.uint64(0)], np.cumsum(v, dtype=np.uint64)])
                tested = screen.tested(starts, h)
                hit = tested & (shared[np.minimum(np.searchsorted(shared, h), len(shared) - 1)] == h) if len(shared) else np.zeros(len(h), bool)
                for column, v in zip(out, (mixed(h), mixed(h ^ np.uint64(0x5851F42D4C957F2D)), tested.astype(np.uint64), hit.astype(np.uint64)), strict=False):
                    total = add(v)
                    column.append(total[starts[1:]] - total[starts[:-1]])
                out[4].append(np.diff(starts))
            k1, k2, tested, hit, n = (np.concatenate([np.zeros(0, np.int64), *(x.view(np.int64) for x in c)]) for c in out)
            yield pa.RecordBatch.from_arrays([*map(b.column, KEYS), *map(pa.array, (n, k1, k2, tested, hit))], names=[*KEYS, "n", "k1", "k2", "tested", "shared"])

    return texts.select(*KEYS, "text").mapInArrow(work, SIZES)


def shared_by_join(texts: DataFrame, words: int, screen: Screen, hashes: DataFrame) -> DataFrame:
    """id, mark, shared: as `sizes` counts it, for more hashes than are broadcast."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, starts, h in sets_of(b, words):
                kept = screen.tested(starts, h)
                at = pa.array(np.repeat(rows, np.diff(starts))[kept])
                yield pa.RecordBatch.from_arrays([b.column("id").take(at), b.column("mark").take(at), pa.array(h[kept].view(np.int64))], names=["id", "mark", "h"])

    # repeated rows count twice here, which keeps more of them for the exact steps that follow and loses none
    rows = texts.mapInArrow(work, "id long, mark long, h long")
    return rows.join(hashes, "h", "left_semi").groupBy("id", "mark").agg(F.count("*").alias("shared"))


def set_rows(texts: DataFrame, words: int) -> DataFrame:
    """node, n, shingles array<long> of each row (node, text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, starts, h in sets_of(b, words):
                lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column("node").take(pa.array(rows)), pa.array(np.diff(starts)), lists], names=["node", "n", "shingles"])

    return texts.mapInArrow(work, "node long, n long, shingles array<long>")


class Lists:
    """Inverted lists of sets numbered by size. A list that holds more than half of the sets is stored as its gaps."""

    def __init__(self, starts: np.ndarray, h: np.ndarray, place: np.ndarray, gaps: bool = True) -> None:
        m = len(starts) - 1
        self.starts = starts
        _, self.token = np.unique(h, return_inverse=True)
        bits = max(1, int(m).bit_length())
        keys = np.sort(self.token.astype(np.int64) << bits | np.repeat(place, np.diff(starts)))
        self.begin = np.searchsorted(keys >> bits, np.arange(self.token.max(initial=-1) + 2))
        self.posting = keys & ((1 << bits) - 1)
        self.length = np.diff(self.begin)
        self.gaps = {}
        for t in np.flatnonzero(self.length * 2 > m) if gaps and m > 16 else ():
            lacks = np.ones(m, bool)
            lacks[self.of(t)] = False
            self.gaps[int(t)] = np.flatnonzero(lacks)

    def of(self, t: int) -> np.ndarray:
        return self.posting[self.begin[t] : self.begin[t + 1]]

    def tokens(self, row: int) -> np.ndarray:
        return self.token[self.starts[row] : self.starts[row + 1]]


def merged(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in sorted lists and how many lists each is in: by a heap, or for many postings by the stable sort, which
    merges the sorted runs that it finds."""
    total = sum(map(len, lists))
    if total <= HEAP:
        flat = np.fromiter(heapq.merge(*(x.tolist() for x in lists)), np.int64, total)
    else:
        flat = np.sort(np.concatenate(lists), kind="stable")
    if not total:
        return flat, flat
    first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    return flat[first], np.diff(np.append(first, total))


def search(starts: np.ndarray, h: np.ndarray, percent: int, weight: np.ndarray, side: np.ndarray, shown: tuple[np.ndarray, np.ndarray, int] | None = None) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links between sets (by row) that connect all that links connect, and for each set the weights of all it links with.

    side: 0 or 1; if there are both, only pairs across count. shown: (starts, hashes, h): pairs count unless they share a
    shown hash below h.

    Sets are taken by size, each against the smaller ones before it. DivideSkip: a partner is in T of the set's lists; of
    these the L longest are left out, the shorter ones are merged, and what is in T - L of them is probed in the long lists
    by binary search until its overlap is reached or out of reach. Lists that most sets are in (near copies share most of
    theirs) count against those sets that they lack, which is the merge of their gaps.
    """
    m, n = len(starts) - 1, np.diff(starts)
    order = np.argsort(n, kind="stable")
    place = np.empty(m, np.int64)
    place[order] = np.arange(m)  # sets are numbered by size from here on
    size, side, weight = n[order], side[order], weight[order]
    across = len(np.unique(side)) > 1
    lists = Lists(starts, h, place)
    early = Lists(shown[0], shown[1], place, gaps=False) if shown else None
    label, links, linked = np.arange(m), [], np.zeros(m, np.int64)
    for q in range(m):
        t_least = -(-int(size[q]) * percent // 100)  # T for the smallest partner there can be
        own = lists.tokens(order[q])
        lengths = lists.length[own]
        own, lengths = own[lengths > 1], lengths[lengths > 1]
        if not t_least or len(own) < t_least:
            continue
        by = np.argsort(lengths, kind="stable")
        own, lengths = own[by], lengths[by]
        cut = int(np.searchsorted(lengths, m // 2, side="right")) if lists.gaps else len(own)
        gaps = [lists.gaps[t] for t in own[cut:].tolist()]
        long = min(cut, t_least - 1, int(t_least / (MU * math.log2(max(2, lengths[cut - 1])) + 1))) if cut else 0
        found, seen = merged([lists.of(t) for t in own[: cut - long].tolist()])
        if gaps:
            lack = np.bincount(np.concatenate(gaps), minlength=m)[:q]
            known = len(gaps) - lack
            before = found < q
            known[found[before]] += seen[before]
            found = np.flatnonzero(known >= t_least - long)
            seen = known[found]
        fits = (found < q) & (seen >= t_least - long)
        found, seen = found[fits], seen[fits]
        fits = size[found] * 100 >= size[q] * percent
        if across:
            fits &= side[found] != side[q]
        found, seen = found[fits], seen[fits]
        if early is not None and len(found):
            mine = early.tokens(order[q])
            lower = mine[shown[1][early.starts[order[q]] : early.starts[order[q] + 1]] < shown[2]]
            if len(lower):
                fits = ~np.isin(found, np.concatenate([early.of(t) for t in lower.tolist()]))
                found, seen = found[fits], seen[fits]
        if not len(found):
            continue
        need = -(-percent * (size[q] + size[found]) // (100 + percent)) - seen
        yes = found[need <= 0]
        left = (need > 0) & (need <= long)
        found, need = found[left], need[left]
        for i in range(cut - long, cut):  # probes; a set that is in enough lists, or can't be any more, is decided
            if not len(found):
                break
            one = lists.of(own[i])
            need = need - (one[np.minimum(np.searchsorted(one, found), len(one) - 1)] == found)
            if (done := need <= 0).any():
                yes = np.concatenate([yes, found[done]])
            left = (need > 0) & (need <= cut - 1 - i)
            found, need = found[left], need[left]
        if not len(yes):
            continue
        linked[q] += weight[yes].sum()
        linked[yes] += weight[q]
        labels, first = np.unique(label[yes], return_index=True)
        links += [(int(order[b]), int(order[q])) for b in yes[first].tolist()]
        if len(labels) > 1:
            seen_so_far = label[:q]
            seen_so_far[np.isin(seen_so_far, labels)] = labels[0]
        label[q] = labels[0]
    out = np.zeros(m, np.int64)
    out[order] = linked
    return links, out


TASK = ["block", "low", "high"]


def block_links(rows: DataFrame, percent: int) -> DataFrame:
    """a, b, n of rows (block, low, high, chunk, part, node, weight, shingles, shown), from each task: links that connect (n
    is null), and for each node a with links the rows it links with there, n (b is null)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(task: tuple, held: list) -> pa.RecordBatch:
            nodes, side, weight = (np.array([x[i] for x in held], np.int64) for i in range(3))
            start = lambda i: np.concatenate([[0], np.cumsum([len(x[i]) for x in held])])
            shown = (start(4), np.concatenate([x[4] for x in held]), task[0]) if task[3] else None
            some = len(held) > 1 and (task[1] == task[2] or 0 < side.sum() < len(side))
            links, linked = search(start(3), np.concatenate([x[3] for x in held]), percent, weight, side, shown) if some else ([], np.zeros(len(held), np.int64))
            some = np.flatnonzero(linked)
            a, b, n = [*(nodes[x[0]] for x in links), *nodes[some]], [*(nodes[x[1]] for x in links), *[None] * len(some)], [*[None] * len(links), *linked[some].tolist()]
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, n)], names=["a", "b", "n"])

        task, held = None, []
        for b in batches:
            flat = {c: (b.column(c).offsets.to_numpy(), b.column(c).values.to_numpy(zero_copy_only=False)) for c in ("shingles", "shown")}
            part = lambda c, i: flat[c][1][flat[c][0][i] : flat[c][0][i + 1]].copy()
            for i, key in enumerate(zip(*(b.column(c).to_pylist() for c in (*TASK, "part", "chunk", "node", "weight")), strict=True)):
                if key[:4] != task and held:
                    yield solved(task, held)
                    held = []
                task = key[:4]
                held.append((key[5], int(key[4] != key[1]), key[6], part("shingles", i), part("shown", i)))
        if held:
            yield solved(task, held)

    return rows.mapInArrow(work, "a long, b long, n long")


def beside(rows: DataFrame, table: DataFrame, n: str) -> DataFrame:
    """rows joined with `table` (a row for each h); rows of an h that more than HOT rows have go by broadcast."""
    hot = small(table.filter(F.col(n) > HOT), BROADCAST_ROWS)
    return rows.join(hot, "h").unionByName(rows.join(hot.select("h"), "h", "left_anti").join(table.filter(F.col(n) <= HOT), "h"))


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """node, h: each class's slack + 1 rarest shingles; those that no other class has are left out."""
    each = sets.select("node", "n", F.explode("shingles").alias("h"))
    counts = written(each.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1"), "counts")
    often = beside(each, counts, "df").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("often"))
    # shingles that are in one class alone come first in the order of rarity
    room = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - (F.col("n") - F.size("often"))
    shown = often.withColumn("room", room.cast("int")).filter("room > 0")
    return written(shown.select("node", F.explode(F.slice("often", F.lit(1), F.col("room"))).alias("x")).select("node", F.col("x.h").alias("h")), "prefixes")


def blocks(prefix: DataFrame) -> DataFrame:
    """node, block: classes that show one shingle are in one block; others are in none."""
    hubs = written(prefix.groupBy("h").agg(F.min("node").alias("hub"), F.count("*").alias("n")).filter("n > 1"), "hubs")
    stars = beside(prefix, hubs, "n").filter("node != hub").select("hub", "node").distinct()
    found = components(stars, "hub", "node")
    return found.select("node", F.col("root").alias("block")).unionByName(found.select(F.col("root").alias("node"), F.col("root").alias("block")).distinct())


def parts(where: DataFrame, prefix: DataFrame, giant: int) -> DataFrame:
    """node, n, block, part, shown of rows (node, n, block): giant blocks go by a row for each shown shingle (part is true)."""
    large = where.groupBy("block").agg(F.sum("n").alias("total")).filter(F.col("total") > giant).select("block")
    if large.isEmpty():
        return where.withColumns({"part": F.lit(False), "shown": F.array().cast("array<long>")})
    large = small(large, BROADCAST_ROWS)
    whole = where.join(large, "block", "left_anti").withColumns({"part": F.lit(False), "shown": F.array().cast("array<long>")})
    shown = prefix.groupBy("node").agg(F.sort_array(F.collect_set("h")).alias("shown"))
    apart = where.join(large, "block", "left_semi").join(shown, "node")
    each = apart.select("node", "n", F.explode("shown").alias("block"), F.lit(True).alias("part"), "shown")
    return whole.unionByName(each)


def tasks(placed: DataFrame, percent: int, block_size: int) -> DataFrame:
    """The rows of `parts` with chunk, low and high: a row for each pair of chunks that a node takes part in.

    chunk is 0 in a block of one chunk; else a length step and a hash of the node give it. No window: sums by (block, part,
    step) are all that is needed, and only blocks of several chunks are in the table that comes of them.
    """
    step = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / max(1, percent - 1))).cast("int")
    by_step = placed.groupBy("block", "part", step.alias("step")).agg(F.sum("n").alias("n"), F.count("*").alias("sets"))
    cuts = F.greatest(F.ceil(F.col("n") / block_size), F.least(F.ceil(F.col("sets") / ROWS), F.lit(SPREAD)))
    entry = F.struct("step", cuts.cast("int").alias("cuts"))
    cut = by_step.groupBy("block", "part").agg(F.sum("n").alias("n"), F.sum("sets").alias("sets"), F.collect_list(entry).alias("steps"))
    cut = cut.filter((F.col("n") > block_size) | (F.col("sets") > ROWS)).drop("n", "sets")
    rows = placed.join(small(cut, BROADCAST_ROWS), ["block", "part"], "left").withColumn("step", step)
    name = lambda s, k: s.cast("long") * (1 << 32) + k

    def others(s: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), s["cuts"] - 1), lambda k: name(s["step"], k))

    own = F.filter("steps", lambda s: s["step"] == F.col("step"))[0]["cuts"]
    chunk = F.when(F.col("steps").isNull(), F.lit(0).cast("long")).otherwise(name(F.col("step"), F.pmod(F.xxhash64("node"), own)))
    near = F.flatten(F.transform(F.filter("steps", lambda s: F.abs(s["step"] - F.col("step")) <= 1), others))
    each = rows.withColumn("chunk", chunk).withColumn("other", F.explode(F.when(F.col("steps").isNull(), F.array("chunk")).otherwise(near)))
    return each.select("node", "block", "part", "shown", "chunk", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"))


def groups(docs: DataFrame, words: int = 5, percent: int = 80, block_size: int = BLOCK, broadcast: int = BROADCAST_HASHES, giant: int = GIANT) -> DataFrame:
    """doc_id, id, mark, n_shingles, component_id, component, n_links for each row of docs.

    component_id is the least doc_id that links reach; component stands for the same group, also without any doc_id (null:
    no words). id and mark tell rows of different doc_id or text apart, nulls included (see `keyed`). n_links is the number
    of other rows that the row links with, those of its own class among them.
    """
    spark = docs.sparkSession
    short_batches(spark)
    texts = keyed(docs)
    screen = Screen(percent)
    shared = written(screen_counts(texts, words, screen).filter("n > 1").select("h"), "shared-shingles")
    if shared.count() <= broadcast:
        column = shared.toArrow().column("h")
        known = np.sort((column.to_numpy() if len(column) else np.zeros(0, np.int64)).view(np.uint64))
        each = written(sizes(texts, words, screen, spark.sparkContext.broadcast(known)), "sizes")
    else:
        counted = shared_by_join(texts, words, screen, shared)
        each = sizes(texts, words, screen, None).drop("shared").join(counted, ["id", "mark"], "left")
        each = written(each.withColumn("shared", F.coalesce("shared", F.lit(0))), "sizes")
    spare = F.col("n") - F.ceil(F.col("n") * percent / 100)
    likely = each.filter((F.col("n") > 0) & (F.col("shared") >= F.col("tested") - spare))
    node = F.xxhash64("k1", "k2").alias("node")
    classes = likely.groupBy(node).agg(F.min(F.struct("id", "mark")).alias("at"), F.min("doc_id").alias("least"), F.count("*").alias("weight"))
    classes = written(classes.select("node", "at.*", "least", "weight"), "classes")
    picked = texts.join(small(classes.select("id", "mark", "node"), BROADCAST_ROWS), ["id", "mark"]).select("node", "text").dropDuplicates(["node"])
    sets = written(set_rows(picked, words), "sets")
    prefix = prefixes(sets, percent)
    where = written(blocks(prefix), "blocks").join(sets.select("node", "n"), "node")
    placed = tasks(written(parts(where, prefix, giant), "parts"), percent, block_size)
    rows = sets.select("node", "shingles").join(placed, "node").join(classes.select("node", "weight"), "node")
    solved = written(block_links(rows.repartition(*TASK, "part").sortWithinPartitions("part", *TASK, "chunk", "node"), percent), "links")
    found = components(solved.filter("n IS NULL").select("a", "b"))
    ends = solved.filter("n IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n_other"))
    linked = written(classes.select("node", "least", "weight").join(found, "node", "left").join(ends, "node", "left").withColumn("root", F.coalesce("root", "node")), "linked")
    first = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    class_of = linked.join(small(first, BROADCAST_ROWS), "root").select("node", F.col("root").alias("component"), "component_id", (F.col("weight") - 1 + F.coalesce("n_other", F.lit(0))).alias("n_links"))
    out = each.withColumn("node", F.when(F.col("n") > 0, F.xxhash64("k1", "k2"))).join(small(class_of, BROADCAST_ROWS), "node", "left")
    return out.select(
        "doc_id",
        "id",
        "mark",
        F.col("n").alias("n_shingles"),
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("component", "node").alias("component"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
