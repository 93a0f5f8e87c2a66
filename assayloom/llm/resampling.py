"""Importance resampling towards a target corpus by hashed word runs, counted by a vectorised byte automaton.

A task takes the UTF-8 buffer of an Arrow batch as it is: a lookup table gives every byte's class and lower case, places
where the class changes are word boundaries, and the CRCs of all words advance together, a byte a step, each through the
same 256-entry table. The state after a word goes on over a space and the next word, which gives the runs of two. Corpus
and target are two vectors of `buckets` counts; a document's weight is the floored mean of its features' gains.

The draw adds Gumbel noise from a hash of doc_id and keeps the highest scores. Scores are whole numbers in a narrow range,
so a table with a row a score finds the last one drawn; only rows from there up are put in order, by ranges, and a range's
own places are added to the rows before it. No rank is made in one task, and rows of equal keys lie spread over ranges.

Defined results: a null text is empty, has no features and weight 0; a null doc_id is hashed as the empty string and is
last among equal scores; repeated rows are rows of their own and stand side by side in the ranking; an empty table gives
an empty result, an empty target counts no feature; other columns aren't read, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayloom.llm.common import short_batches, written

#: Bytes of text that are worked on at once (a longer text by itself), and so few words that they are finished one by one.
BLOCK, FEW = 4 << 20, 8


def crc_table() -> np.ndarray:
    """The table of the reflected CRC-32 polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


CRC = crc_table()
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)
#: Bytes of words once A-Z are lower case: digits, a-z, and all bytes of characters beyond ASCII.
IN_WORD = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])


def advanced(state: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The CRC states after data[start:end] of each, all at once; states as they run, without the last inversion."""
    size = end - start
    order = np.argsort(-size, kind="stable")
    out, at, size = state[order], start[order], size[order]
    longer = len(size) - np.searchsorted(size[::-1], np.arange(int(size[0]) if len(size) else 0), side="right")
    for step, n in enumerate(longer):
        if n <= FEW:
            for i in range(n):
                rest = data[at[i] + step : at[i] + size[i]].tobytes()
                out[i] = zlib.crc32(rest, int(out[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
            break
        out[:n] = CRC[(out[:n] ^ data[at[:n] + step]) & np.uint32(0xFF)] ^ out[:n] >> np.uint32(8)
    back = np.empty_like(out)
    back[order] = out
    return back


def features(data: np.ndarray, rows: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, the text of each feature, its bucket) of texts data[rows[i]:rows[i + 1]] in UTF-8: every word
    and every two neighbouring words of a text, by the CRC-32 of their bytes."""
    low = LOWER[data]
    inside = IN_WORD[low]
    before, after = np.zeros(len(low), bool), np.zeros(len(low), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = rows[(rows > 0) & (rows < len(low))]
    before[edges], after[edges - 1] = False, False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    text = np.searchsorted(rows, start, side="right") - 1
    one = advanced(np.full(len(start), 0xFFFFFFFF, np.uint32), low, start, end)
    next_to = np.flatnonzero(text[1:] == text[:-1])
    spaced = CRC[(one[next_to] ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ one[next_to] >> np.uint32(8)
    two = advanced(spaced, low, start[next_to + 1], end[next_to + 1])
    bucket = (~np.concatenate([one, two]) % np.uint32(buckets)).astype(np.int64)
    return np.bincount(text, minlength=len(rows) - 1), np.concatenate([text, text[next_to]]), bucket


def blocks(column: pa.Array, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """`features` of a string column without nulls, from its own buffer, some BLOCK bytes of it at a time."""
    ends = np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_string(column.type) else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + BLOCK, side="right")) - 1)
        last = min(last, len(column))
        yield features(data[ends[first] : ends[last]], ends[first : last + 1] - ends[first], buckets)
        first = last


def text_or_empty(df: DataFrame):  # noqa: ANN201
    return F.coalesce(df["text"].cast("string"), F.lit("")).alias("text")


def bucket_counts(texts: DataFrame, buckets: int) -> DataFrame:
    """bucket, n: features of all texts; a task sends a row a bucket."""
    short_batches(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, _, bucket in blocks(b.column(0), buckets):
                total += np.bincount(bucket, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    each = texts.select(text_or_empty(texts)).mapInArrow(count, "bucket int, n long")
    return each.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """Each bucket's gain from the counts of both, smoothed by one: 1000 times the log of the ratio of shares, floored."""
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for counts, into in ((corpus, s), (target, t)):
        for r in counts.collect():  # at most `buckets` rows
            into[r["bucket"]] = r["n"]
    all_s, all_t = int(s.sum()) + buckets, int(t.sum()) + buckets
    return np.array([math.floor(1000 * math.log((a + 1) * all_s / ((b + 1) * all_t))) for a, b in zip(t.tolist(), s.tolist(), strict=True)], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight of every row."""
    short_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, n, sums = [], [], []
            for each, text, bucket in blocks(b.column("text"), len(gain)):
                words.append(each)
                n.append(np.bincount(text, minlength=len(each)))
                sums.append(np.bincount(text, gain[bucket], len(each)).astype(np.int64))  # whole numbers far below 2^53
            words, n, sums = (np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64) for x in (words, n, sums))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(words), pa.array(n), pa.array(sums // np.maximum(n, 1))], names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", text_or_empty(docs)).mapInArrow(weigh, f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(seed: int):  # noqa: ANN201
    """1000 times a Gumbel number from a hash of doc_id, floored."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def drawn(scored: DataFrame, percent: int) -> DataFrame:
    """`scored` (doc_id, score, can) with rank 1, 2, 3... for floor(percent * N / 100) of the N rows that `can`, the highest
    scores first, equal ones by doc_id; null for others."""
    able = scored.filter("can")
    counts = written(able.groupBy("score").count(), "score-counts")  # a row a score: whole numbers in a narrow range
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).head()[0]
    most = percent * total // 100
    above = F.coalesce(F.sum("count").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = counts.withColumn("above", above).filter(F.col("above") < most).agg(F.min("score")).head()[0]
    if last is None:
        return scored.drop("can").withColumn("rank", F.lit(None).cast("long"))
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("_tie")]
    parts = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top = able.filter(F.col("score") >= last).withColumn("_tie", F.monotonically_increasing_id())  # parts equal rows
    placed = top.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = written(placed.drop("can", "_tie"), "drawn")
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("_part")).count()
    first = F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", first.alias("_first"))  # a row a range
    rank = F.col("_first") + place + 1
    ranked = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn("rank", F.when(rank <= most, rank)).drop("_part", "_first", "_at")
    return ranked.unionByName(scored.filter(~F.col("can") | (F.col("score") < last)).drop("can").withColumn("rank", F.lit(None).cast("long")))


def resampled(docs: DataFrame, target: DataFrame, buckets: int = 10_000, percent: int = 25, least_words: int = 20, seed: int = 7) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of docs (doc_id, text), drawn towards `target` (text)."""
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets), buckets)
    scored = weighed(docs, gain).select("doc_id", "n_features", "weight", (F.col("weight") + noise(seed)).alias("score"), (F.col("n_words") >= least_words).alias("can"))
    return drawn(written(scored, "scored"), percent).select("doc_id", "n_features", "weight", "score", "rank")
