"""Document fingerprints from prefix polynomial hashes.

`Prefix` keeps two modular prefix arrays of a text: any two spans compare in constant time, and the longest common
extension of two places comes from a binary search over such comparisons. A fingerprint is the bottom of the sorted hashes
of a text's spans, one for each code point: the SPAN code points that end there, filled up in front at the start of the
text. So a text of n code points has n spans at any length, equal texts have equal fingerprints, and the share of common
values estimates the share of common spans.

`with_next` gives every row its successor in descending doc_id with one shuffle of the texts: rows are dealt by ranges of
doc_id, and the first row of each range also goes to the range above it. Only one number a range reaches the driver.

Defined results: a null text is empty, an empty text has the empty fingerprint (likeness 1 to another empty one, else 0);
a null doc_id sorts last, rows of one doc_id sort by a hash of their text and are one range; a single row is its own successor; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayloom.llm.common import short_batches

P = (1 << 31) - 1
BASES = (1_000_003, 2_038_074_743 % P)
SPAN, KEEP = 12, 64
#: Rows of a range, and ranges from which on they get more rows (up to ten times as many).
ROWS, RANGES = 5000, 2000
LOWEST = -(1 << 63)
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, common_prefix long"


def fold(x: np.ndarray) -> np.ndarray:
    """x mod P for x < 2**62, without a division."""
    x = (x & P) + (x >> 31)
    x = (x & P) + (x >> 31)
    return np.where(x >= P, x - P, x)


class Powers:
    """Powers of the bases and of their inverses, as far as a text so far needed them."""

    def __init__(self) -> None:
        self.up = [np.ones(1, np.uint64) for _ in BASES]
        self.down = [np.ones(1, np.uint64) for _ in BASES]

    def grow(self, n: int) -> None:
        while len(self.up[0]) <= n:
            for i, b in enumerate(BASES):
                for side, base in ((self.up, b), (self.down, pow(b, -1, P))):
                    step = np.uint64(pow(base, len(side[i]), P))
                    side[i] = np.concatenate([side[i], fold(side[i] * step)])


POWERS = Powers()


class Prefix:
    """The prefix arrays of a text's code points."""

    def __init__(self, text: str) -> None:
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
        self.n = len(codes)
        POWERS.grow(self.n)
        self.sums = [fold(np.concatenate([np.zeros(1, np.uint64), np.cumsum(fold(codes * POWERS.up[i][: self.n]))])) for i in range(len(BASES))]

    def span(self, start: int, length: int) -> tuple[int, ...]:
        """A hash of the span that doesn't depend on its place: equal spans have equal ones."""
        return tuple((int(s[start + length]) - int(s[start])) % P * int(POWERS.down[i][start]) % P for i, s in enumerate(self.sums))

    def spans(self, length: int) -> np.ndarray:
        """Hashes, in the first base, of the spans of one length that end at each place, filled up in front where they
        would start before the text."""
        s, n = self.sums[0], max(0, self.n - length + 1)
        POWERS.grow(length)
        cut = min(length - 1, self.n)
        first = fold(s[1 : cut + 1] * POWERS.up[0][length - 1 : length - 1 - cut : -1]) if cut else s[:0]
        return np.concatenate([first, fold(fold(s[length : length + n] + np.uint64(P) - s[:n]) * POWERS.down[0][:n])])

    def common(self, start: int, other: Prefix, at: int) -> int:
        """How far the texts agree from `start` here and `at` there."""
        low, high = 0, min(self.n - start, other.n - at)
        while low < high:
            middle = (low + high + 1) // 2
            if self.span(start, middle) == other.span(at, middle):
                low = middle
            else:
                high = middle - 1
        return low


def print_of(x: Prefix) -> np.ndarray:
    """The KEEP smallest distinct values of the mixed span hashes; fewer if there aren't so many."""
    if not x.n:
        return np.zeros(0, np.uint32)
    h = x.spans(SPAN)
    h = ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
    if len(h) > 8 * KEEP:
        some = np.unique(np.partition(h, 4 * KEEP)[: 4 * KEEP])
        if len(some) >= KEEP:
            return some[:KEEP]
    return np.unique(h)[:KEEP]


def spelled(values: np.ndarray) -> str:
    return values.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of common values among the KEEP smallest of both together."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = set(a.tolist()) & set(b.tolist())
    union = np.union1d(a, b)[:KEEP]
    return len(both.intersection(union.tolist())) / len(union)


def with_next(docs: DataFrame, rows_a_range: int = ROWS) -> DataFrame:
    """(doc_id, text) dealt and sorted by ranges: columns doc_id, text, _range, _tail. Within a range every row but the
    tail rows is followed by its successor in descending doc_id; the tail rows repeat the row that follows the range."""
    from pyspark.ml.feature import Bucketizer

    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(LOWEST)).alias("_key")).withColumn("_at", F.col("_key").cast("double"))
    ids = keyed.select("_key", "_at")
    rows = ids.count()
    ranges = max(min(RANGES, -(-rows // rows_a_range)), -(-rows // (10 * rows_a_range)))
    cuts = ids.approxQuantile("_at", [i / ranges for i in range(1, ranges)], 0.25 / ranges) if ranges > 1 else []
    inner = sorted(set(cuts) - {float("-inf"), float("inf"), float(LOWEST)})
    deal = Bucketizer(splits=[float("-inf"), *inner, float("inf")], inputCol="_at", outputCol="_range") if inner else None
    dealt = lambda df: deal.transform(df) if deal else df.withColumn("_range", F.lit(0.0))
    tops = sorted((r["_range"], r["top"]) for r in dealt(ids).groupBy("_range").agg(F.max("_key").alias("top")).collect())  # a row for each range
    spark = docs.sparkSession
    follows = [(tops[i - 1][1], tops[i][0]) for i in range(len(tops))]  # the lowest range is followed by the highest row
    edges = spark.createDataFrame(follows, "_key long, _to double")
    placed = dealt(keyed).join(F.broadcast(edges), "_key", "left")
    own, tail = F.struct("_range", F.lit(False).alias("_tail")), F.struct(F.col("_to").alias("_range"), F.lit(True).alias("_tail"))
    each = placed.select("doc_id", "text", "_key", F.explode(F.when(F.col("_to").isNull(), F.array(own)).otherwise(F.array(own, tail))).alias("_p"))
    out = each.select("doc_id", "text", "_key", F.col("_p._range").cast("int").alias("_range"), "_p._tail").repartitionById(int(tops[-1][0]) + 1 if tops else 1, "_range")
    return out.sortWithinPartitions("_range", "_tail", F.desc("_key"), F.xxhash64("text"), "text").drop("_key")


def edited_text(text: str, following: str) -> str:
    """The last half of the text, rounded down, gives way to as many first code points of the next one, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def prints(docs: DataFrame, rows_a_range: int = ROWS) -> DataFrame:
    """SCHEMA rows, one for each row of docs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        types = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), *((n, pa.string()) for n in names[2:5]), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("common_prefix", pa.int64())])
        held = None  # range, doc_id, text, prefix arrays, fingerprint of the row whose successor comes next
        for b in batches:
            out: list[list] = [[] for _ in names]
            for doc, text, at, tail in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "_range", "_tail")), strict=True):
                if tail and (held is None or held[0] != at):
                    continue
                arrays = Prefix(text)
                own = print_of(arrays)
                if held is not None:
                    _, was, before, its_arrays, its_print = held
                    edited = edited_text(before, text)
                    its_edited = Prefix(edited)
                    edited_print = print_of(its_edited)
                    row = (was, len(before), hashlib.sha256(edited.encode()).hexdigest(), spelled(its_print), spelled(edited_print), likeness(its_print, edited_print), likeness(its_print, own), its_arrays.common(0, its_edited, 0))
                    for column, v in zip(out, row, strict=True):
                        column.append(v)
                held = None if tail else (at, doc, text, arrays, own)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types.types, strict=True)], schema=types)

    short_batches(docs.sparkSession)
    return with_next(docs, rows_a_range).mapInArrow(work, SCHEMA)
