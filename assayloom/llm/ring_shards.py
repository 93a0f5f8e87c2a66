"""Consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations.

The ring has CELLS positions. A key's position is the top bits of its hash; every shard owns `vnodes` positions. A key
goes to the first virtual node clockwise; where that shard is full it continues to the next one that has room, so no
shard exceeds its capacity. Only the counts of the CELLS positions reach the driver, and only the plan made from them
(at most CELLS + shards * 2 rows, whatever the input) is broadcast.

Rows get their places by rank within a ring position. Ranks come from sums: a position's rows are counted by a hash of
their order columns and a part of equal rows, sums over salts of that hash give every count its first rank, and only equal
rows of one part are numbered one by one. So a key that a third of all rows have, null or not, is spread over tasks.

Defined results: a null key has a position of its own like any other, repeated rows each take a place, an empty table
gives no rows, further columns of the input go along whatever their names; columns named shard or slot are replaced.
"""

from __future__ import annotations

import bisect
import zlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayloom.llm.common import others, written

CELL_BITS = 14
CELLS = 1 << CELL_BITS
#: Tasks that a ring position's rows may be spread over, and that equal rows may.
SALTS, PARTS = 256, 64


def ring(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(position, shard) of all virtual nodes in ring order. A shard's points don't depend on how many shards there are."""
    return sorted((zlib.crc32(f"{s}/{v}/{s * 7919 + v}".encode()) >> (32 - CELL_BITS), s) for s in range(shards) for v in range(vnodes))


def capacities(total: int, shards: int, slack: float) -> list[int]:
    """Rows each shard may take. With slack 0 they add up to the total and differ by at most one."""
    if slack <= 0:
        return [total // shards + (s < total % shards) for s in range(shards)]
    return [int(-(-total * (1 + slack) // shards))] * shards


def plan(counts: dict[int, int], shards: int, vnodes: int, slack: float) -> list[tuple[int, int, int, int, int]]:
    """(cell, first rank, end rank, shard, slot of the first) so that the ranks of every cell are covered once."""
    points = ring(shards, vnodes)
    at = [p for p, _ in points]
    room = capacities(sum(counts.values()), shards, slack)
    used, out = [0] * shards, []
    following = list(range(len(points)))  # the next point whose shard may have room, with path compression

    def open_point(i: int) -> int:
        path = []
        while used[points[i][1]] >= room[points[i][1]]:
            path.append(i)
            i = (i + 1) % len(points) if following[i] == i else following[i]
        for j in path:
            following[j] = i
        return i

    for cell in sorted(counts):
        left, done = counts[cell], 0
        i = bisect.bisect_left(at, cell) % len(points)
        while left:
            i = open_point(i)
            shard = points[i][1]
            n = min(left, room[shard] - used[shard])
            out.append((cell, done, done + n, shard, used[shard]))
            used[shard] += n
            done += n
            left -= n
    return out


def ranks(rows: DataFrame) -> DataFrame:
    """rows (cell, hash, part, ...) with rank, from 0 in each cell, by hash and, among equal ones, by part."""
    salt = F.pmod(F.shiftright("hash", 40), F.lit(SALTS)).alias("salt")
    counted = written(rows.groupBy("cell", salt, "hash", "part").agg(F.count("*").alias("n")), "ring-counts")
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    sums = counted.groupBy("cell", "salt").agg(F.sum("n").alias("n"))
    base = sums.select("cell", "salt", F.coalesce(F.sum("n").over(before("cell").orderBy("salt")), F.lit(0)).alias("base"))
    within = counted.select("cell", "salt", "hash", "part", F.coalesce(F.sum("n").over(before("cell", "salt").orderBy("hash", "part")), F.lit(0)).alias("within"))
    first = within.join(base, ["cell", "salt"]).select("cell", "hash", "part", (F.col("base") + F.col("within")).alias("first"))
    own = F.row_number().over(Window.partitionBy("cell", "hash", "part").orderBy("hash"))
    return rows.withColumn("own", own).join(first, ["cell", "hash", "part"]).withColumn("rank", F.col("first") + F.col("own") - 1).drop("own", "first")


def assign(df: DataFrame, key: Column, order: list[Column], shards: int, vnodes: int = 64, slack: float = 0.05) -> DataFrame:
    """`df` with shard and slot (gapless from 0 in each shard).

    slack: a shard takes at most (1 + slack) / shards of the rows; at 0 counts are at most one apart. Within a ring
    position rows rank by a hash of key and `order`, which ought to tell rows apart that differ.
    """
    spark = df.sparkSession
    cell = F.shiftrightunsigned(F.xxhash64(key), 64 - CELL_BITS).cast("int").alias("cell")
    part = F.pmod(F.monotonically_increasing_id(), F.lit(PARTS)).cast("int").alias("part")
    placed = written(df.select(F.struct(*df.columns).alias("row"), cell, F.xxhash64(key, *order).alias("hash"), part), "ring-rows")
    counts = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}  # at most CELLS rows
    rows = plan(counts, shards, vnodes, slack)
    segments = spark.createDataFrame(rows, "at int, start long, stop long, shard int, base long")
    on = (F.col("cell") == F.col("at")) & (F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("stop"))
    out = ranks(placed).join(F.broadcast(segments), on)
    kept = [F.col("row")[c].alias(c) for c in others(df, "shard", "slot")]
    return out.select(*kept, "shard", (F.col("base") + F.col("rank") - F.col("start")).alias("slot"))
