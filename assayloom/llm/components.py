"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayloom.llm.common import written


class Forest:
    """Union-find over the numbers 0 to n - 1; a root is the least of its set."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def local_stars(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Edges (u, v), v the least node that a batch of edges joins u to: at most a row for each node of a batch."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            nodes, at = np.unique(np.concatenate([x, y]), return_inverse=True)
            forest = Forest(len(nodes))
            for i, j in zip(at[: len(x)].tolist(), at[len(x) :].tolist(), strict=True):
                forest.join(i, j)
            roots = np.array([forest.find(i) for i in range(len(nodes))], np.int64)
            far = np.flatnonzero(roots != np.arange(len(nodes)))
            yield pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(nodes[roots[far]])], names=["u", "v"])

    return edges.select(F.col(a).cast("long"), F.col(b).cast("long")).mapInArrow(work, "u long, v long")


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, root): every node of an edge but the roots, with the least node of its component.

    A round is a large star (every node's larger neighbours go to its least neighbour) and a small star (its smaller ones
    do); rounds grow with the logarithm of the nodes, and running out of them is an error. Loops and repeated edges don't matter. Rows that a hub has are
    aggregated before the shuffle, and the joins back are ones that adaptive execution may split.
    """
    now = written(local_stars(edges.filter(F.col(a) != F.col(b)), a, b).distinct(), "edges")
    state = None
    for _ in range(most_rounds):
        after = now.agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))).alias("s")).head()
        if (after["n"], after["s"]) == state:
            break
        state = after["n"], after["s"]
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        first = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(first, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(first.select("u", F.col("m").alias("v")))
        now = written(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct(), "edges")
    else:
        raise RuntimeError(f"components are not stable after {most_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
