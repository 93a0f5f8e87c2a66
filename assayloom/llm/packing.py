"""Best-fit packing of tokenised documents after Martello-Toth dominance reduction.

Tokenising is a map over the documents. The instance of the packing problem is the histogram of piece lengths, at most
`capacity` numbers whatever the input: reduction and best fit work on it with multiplicities, and give a list of filling
patterns with their counts. Every piece then finds its place from its rank among the pieces of its length; ranks come
from counts of (length, salt) groups, so that a length that a third of all pieces have is spread over SALTS tasks.

Defined results: a null text is empty and yields the end id alone; repeated rows are documents of their own; an empty
table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

import base64
import bisect
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayloom.llm.common import short_batches, written

SALTS = 64
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Texts of these characters alone may be encoded from the rank file; all others by the tokenizer itself.
PLAIN = re.compile(r"[^\t\n\r\x20-\x7e\xa1-ɏ]")


class Ids:
    """Token ids of texts as little-endian 32-bit bytes, as the tokenizer file at `path` defines them.

    Where a rank file of the same vocabulary and name stands beside it, texts of ordinary characters are encoded from
    that, which gives the same ids in a quarter of the time.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        ranks, self.fast = path.removesuffix(".json") + ".tiktoken", None
        if os.path.exists(ranks):
            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def __call__(self, text: str) -> bytes:
        if self.fast is not None and (text.isascii() or not PLAIN.search(text)):
            return self.fast.encode_to_numpy(text).astype("<u4", copy=False).tobytes()
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end: int = 0) -> DataFrame:
    """PIECES rows: each document's ids and the end id, cut into pieces of `capacity` ids of which the first may be shorter."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last, wide = Ids(tokenizer), end.to_bytes(4, "little"), capacity * 4
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                data = encode(text.as_py() or "") + last
                start, stop, n = 0, len(data) % wide or wide, 0
                while start < len(data):
                    one = data[start:stop]
                    for column, v in zip(out, (doc, n, start // 4, len(one) // 4, zlib.crc32(one)), strict=True):
                        column.append(v)
                    start, stop, n = stop, stop + wide, n + 1
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


Pattern = tuple[tuple[int, int], ...]  # (length, how many of it), in the order they stand in


def reduced(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Martello-Toth reduction: fill sequences whose content dominates every other that holds the same piece, take their
    pieces out of `counts`, and return (pattern, how many). For a piece j and the longest piece k that fits beside it:

    * nothing fits beside j: j alone;
    * j and k fill the sequence: whatever else might stand beside j could stand where k would;
    * no two pieces fit beside j: of single companions the longest, k, dominates;
    * no three fit, and no two that fit are together longer than k: k dominates those as well.
    """
    out = []
    lengths = sorted(counts)

    def drop(length: int, n: int) -> None:
        counts[length] -= n
        if not counts[length]:
            del counts[length]
            del lengths[bisect.bisect_left(lengths, length)]

    def least(j: int, n: int) -> list[int]:
        """The n shortest pieces besides one of length j."""
        found: list[int] = []
        for x in lengths:
            found += [x] * min(n - len(found), counts[x] - (x == j))
            if len(found) == n:
                break
        return found

    def longest(room: int, j: int, but: int = 0) -> int:
        """The longest piece of at most `room`, besides one of length j and one of length `but`; 0 if there is none."""
        i = bisect.bisect_right(lengths, room) - 1
        while i >= 0 and counts[lengths[i]] - (lengths[i] == j) - (lengths[i] == but) <= 0:
            i -= 1
        return lengths[i] if i >= 0 else 0

    def best_pair(room: int, j: int) -> int:
        """The largest sum of two pieces that is at most `room`."""
        return max((x + y for x in lengths if x <= room and counts[x] > (x == j) and (y := longest(room - x, j, x))), default=0)

    again = True
    while again:
        again = False
        for j in sorted(counts, reverse=True):
            if j not in counts:
                continue
            room, k = capacity - j, longest(capacity - j, j)
            if not k:
                n = counts[j] if j * 2 > capacity else 1
                out.append((((j, 1),), n))
                drop(j, n)
                again = True
                continue
            two, three = least(j, 2), least(j, 3)
            alone = len(two) < 2 or sum(two) > room
            if k == room or alone or ((len(three) < 3 or sum(three) > room) and best_pair(room, j) <= k):
                # all pieces of j at once where the case rests on k alone; else one, and the rest is looked at again
                n = counts[j] // 2 if j == k else min(counts[j], counts[k])
                n = max(1, n) if k == room or alone else 1
                out.append((((j, 2),) if j == k else ((j, 1), (k, 1)), n))
                drop(j, n)
                drop(k, n)
                again = True
    return out


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best fit of the lengths in descending order, all pieces of one length together."""
    open_, rooms = {}, []  # room left -> [(pattern, how many)]; the rooms in order

    def put(room: int, pattern: Pattern, n: int) -> None:
        if n:
            if room not in open_:
                bisect.insort(rooms, room)
            open_.setdefault(room, []).append((pattern, n))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left and (i := bisect.bisect_left(rooms, length)) < len(rooms):
            room = rooms[i]
            pattern, n = open_[room].pop()
            if not open_[room]:
                del open_[room], rooms[i]
            fit = room // length  # a sequence that took one piece is the tightest, so it takes all that fit
            full = min(n, left // fit)
            left -= full * fit
            put(room - fit * length, (*pattern, (length, fit)), full)
            if full < n:
                put(room - left * length, (*pattern, (length, left)) if left else pattern, 1)
                left = 0
                put(room, pattern, n - full - 1)
        if left:
            fit = capacity // length
            put(capacity - fit * length, ((length, fit),), left // fit)
            if left % fit:
                put(capacity - left % fit * length, ((length, left % fit),), 1)
    return [x for room in rooms for x in open_[room]]


def places(patterns: list[tuple[Pattern, int]]) -> np.ndarray:
    """Rows (length, first rank, how many in a sequence, first sequence, offset), by length and rank."""
    rows, taken, sequence = [], {}, 0
    for pattern, n in patterns:
        offset = 0
        for length, fit in pattern:
            rank = taken.get(length, 0)
            rows.append((length, rank, fit, sequence, offset))
            taken[length] = rank + fit * n
            offset += fit * length
        sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def ranked(df: DataFrame) -> DataFrame:
    """`df` with rank, from 0 among the rows of one length, by (doc_id, piece) within salted groups."""
    salted = df.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SALTS)).cast("int"))
    sizes = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    own = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32"))
    return salted.withColumn("_own", own).join(base, ["length", "_salt"]).withColumn("rank", F.col("_base") + F.col("_own") - 1).drop("_salt", "_own", "_base")


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece."""
    short_batches(docs.sparkSession)
    cut = written(pieces(docs, tokenizer, capacity), "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most `capacity` rows
    patterns = reduced(counts, capacity)
    table = places(patterns + best_fit(counts, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = table[:, 0] << 44 | table[:, 1]
        for b in batches:
            length, rank = (b.column(c).to_numpy() for c in ("length", "rank"))
            row = table[np.searchsorted(keys, length << 44 | rank, side="right") - 1]
            at = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(row[:, 3] + at // row[:, 2]), pa.array(row[:, 4] + at % row[:, 2] * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked(cut).select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(place, PIECES + ", sequence_id long, offset long")
