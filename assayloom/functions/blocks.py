"""Results that need every row against all others, and running sums over one order of all rows, in bounded tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayloom.functions.stats import qnorm


Work = Callable[[pd.DataFrame, pd.DataFrame, Any], Any]


def fold_blocks(rows: DataFrame, others: DataFrame, key: str, work: Work, schema: str, blocks: int, groups: int = 1, chunk: int = 1000) -> DataFrame:
    """`work(block, chunk, before)` on every block of `rows` against all of `others` (the same columns), a chunk at a time;
    `before` is what it returned for the chunks so far, None at first, and its last result is the block's row set, or has it
    as `table()`.

    A task holds a block, a chunk and that result, at any number of rows, so what is stored grows with `rows` and not with
    the pairs. Blocks and `groups` of the others, each of which is folded by itself, are dealt by a hash of `key`.
    """
    columns = [F.col(c).alias(c) for c in rows.columns]
    of = lambda parts: F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    held = rows.select(*columns, of(blocks).alias("_q"), every(groups).alias("_g"), F.lit(0).alias("_side"))
    passing = others.select(*columns, every(blocks).alias("_q"), of(groups).alias("_g"), F.lit(1).alias("_side"))
    dealt = held.unionByName(passing).withColumn("_at", F.col("_q") * groups + F.col("_g")).drop("_q", "_g")
    placed = dealt.repartitionById(blocks * groups, F.col("_at")).sortWithinPartitions("_at", "_side")

    def folded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, block, out = None, None, None
        for batch in batches:
            for (now, side), part in batch.groupby(["_at", "_side"], sort=True):
                part = part.drop(columns=["_at", "_side"])
                if now != at:
                    if out is not None:
                        yield out if isinstance(out, pd.DataFrame) else out.table()
                    at, block, out = now, None, None
                if side == 0:
                    block = part if block is None else pd.concat([block, part], ignore_index=True)
                elif block is not None:
                    for start in range(0, len(part), chunk):
                        out = work(block, part.iloc[start : start + chunk].reset_index(drop=True), out)
        if out is not None:
            yield out if isinstance(out, pd.DataFrame) else out.table()

    return placed.mapInPandas(folded, schema)


def block_pairs(rows: DataFrame, work: Work, schema: str, most: int = 2000) -> DataFrame:
    """`work` folded over all of `rows` (one row a sample), for every block of them; blocks have about `most` samples, and up
    to ten times as many where there would be more than 48."""
    n = rows.count()
    return fold_blocks(rows, rows, "sample", work, schema, max(1, -(-n // min(max(most, n // 48), 10 * most))))


def distances(a: pd.DataFrame, b: pd.DataFrame, columns: list[str], rows: int = 64) -> np.ndarray:
    """Euclidean distances of the rows of a from those of b; so few `rows` at once that they stay in the processor's cache."""
    x, y = (np.ascontiguousarray(t[columns].to_numpy(float).T) for t in (a, b))
    out = np.zeros((len(a), len(b)))
    gap = np.empty((min(rows, len(a)), len(b)))
    for start in range(0, len(a), rows):
        d = out[start : start + rows]
        g = gap[: len(d)]
        for c in range(len(columns)):
            np.subtract(x[c, start : start + rows, None], y[c], out=g)
            np.multiply(g, g, out=g)
            d += g
        np.sqrt(d, out=d)
    return out


class Nearest:
    """The k nearest others of each row of a block, ties by id, as chunks of others come by. Candidates wait until there are as
    many as are kept, and are sorted then."""

    def __init__(self, own: np.ndarray, k: int) -> None:
        self.own, self.k = own, k
        self.bound = np.full(len(own), np.inf if k > 0 else -np.inf)
        self.waiting: list[tuple[np.ndarray, ...]] = []
        self.kept: tuple[np.ndarray, ...] | None = None

    def add(self, d: np.ndarray, names: np.ndarray, marks: np.ndarray | None = None) -> None:
        """d: block by chunk, infinite where it doesn't count; names, marks: ids of the chunk and what goes with them."""
        free = np.isinf(self.bound)
        if 0 < self.k <= len(names) and free.any():
            self.bound[free] = np.partition(d[free], self.k - 1, axis=1)[:, self.k - 1]
        row, col = np.nonzero((d <= self.bound[:, None]) & np.isfinite(d))
        self.take(row, d[row, col], names[col], np.zeros(len(col), np.int64) if marks is None else marks[col])

    def take(self, row: np.ndarray, d: np.ndarray, names: np.ndarray, marks: np.ndarray) -> None:
        """Others that may be among the nearest ones of these rows."""
        self.waiting.append((row, d, names, marks))
        if sum(len(w[0]) for w in self.waiting) > self.k * len(self.own):
            self.settle()

    def settle(self) -> tuple[np.ndarray, ...]:
        """row, d, id, mark, rank (from 0) of what is kept, by row and rank."""
        if self.waiting:
            parts = self.waiting if self.kept is None else [self.kept[:4], *self.waiting]
            row, d, name, mark = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.argsort(d)
            order = order[np.argsort(row[order].astype(np.min_scalar_type(len(self.own))), kind="stable")]
            row, d = row[order], d[order]
            tied = (row[1:] == row[:-1]) & (d[1:] == d[:-1])
            if tied.any():
                equal = np.append(tied, False) | np.append(False, tied)
                ids = name[part := order[equal]]
                order[equal] = part[np.lexsort((ids if ids.dtype.kind in "iuf" else pd.factorize(ids, sort=True)[0], d[equal], row[equal]))]
            name, mark = name[order], mark[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            near = rank < self.k
            self.kept, self.waiting = tuple(c[near] for c in (row, d, name, mark, rank)), []
            last = self.kept[4] == self.k - 1
            self.bound[self.kept[0][last]] = self.kept[1][last]
        return self.kept

    def table(self) -> pd.DataFrame:
        row, d, name, _, rank = self.settle()
        return pd.DataFrame({"s": self.own[row], "t": name, "d": d, "rank": rank + 1})


class LabelSums:
    """Sums of distances and numbers of others by the others' labels (codes, negative: none), for each row of a block."""

    def __init__(self, n: int) -> None:
        self.d, self.n = np.zeros((n, 0)), np.zeros((n, 0))

    def widen(self, codes: np.ndarray) -> None:
        if (more := int(codes.max(initial=-1)) + 1 - self.d.shape[1]) > 0:
            self.d, self.n = (np.pad(x, ((0, 0), (0, more))) for x in (self.d, self.n))

    def add(self, d: np.ndarray, codes: np.ndarray, same: np.ndarray) -> None:
        """d: block by chunk; a pair of `same` is one sample, which is no other of its own."""
        self.widen(codes)
        member = (codes[:, None] == np.arange(self.d.shape[1])).astype(float)
        row, col = np.nonzero(same & (codes >= 0))
        d[row, col] = 0.0
        self.d += d @ member
        self.n += member.sum(0)
        np.subtract.at(self.n, (row, codes[col]), 1)

    def silhouettes(self, codes: np.ndarray) -> np.ndarray:
        """Of rows of these labels: 0 for one alone in its label, NaN without a label or another one to compare with."""
        if not self.d.shape[1]:
            return np.full(len(self.d), np.nan)
        mean = np.divide(self.d, self.n, out=np.full_like(self.d, np.nan), where=self.n > 0)
        at = np.arange(len(mean)), np.maximum(codes, 0)
        a = mean[at]
        mean[at] = np.inf
        b = np.nan_to_num(mean, nan=np.inf).min(1)
        top = np.maximum(a, b)
        out = np.divide(b - a, top, out=np.full(len(a), np.nan), where=(top > 0) & np.isfinite(b))
        return np.where(codes < 0, np.nan, np.where(np.isnan(a), 0.0, out))


class Products:
    """A block's rows (`x`, a row a sample) against chunks of others, for `Nearest` and `LabelSums` both: squared distances are
    |x|^2 + |y|^2 - 2xy, a matrix product for each tile of rows, which stays in the processor's cache.

    A product may be off by some bits of the two lengths, so pairs that may be among the nearest ones are measured again,
    coordinate by coordinate as `distances` does it; their sums take that distance too.
    """

    def __init__(self, own: np.ndarray, x: np.ndarray, near: Nearest, sums: LabelSums) -> None:
        self.own, self.x, self.near, self.sums = own, x, near, sums
        self.order = np.argsort(own, kind="stable")
        self.center = x.mean(0) if len(x) else np.zeros(x.shape[1])
        moved = x - self.center
        self.length = (moved * moved).sum(1)
        self.left = np.column_stack([-2 * moved, self.length, np.ones(len(x))])

    def same(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """row, place among `names` of the pairs that are one sample, by row."""
        known = self.own[self.order]
        low, high = np.searchsorted(known, names, "left"), np.searchsorted(known, names, "right")
        col = np.repeat(np.arange(len(names)), high - low)
        row = self.order[np.arange(len(col)) - np.repeat(np.cumsum(high - low) - high, high - low)]
        by = np.argsort(row, kind="stable")
        return row[by], col[by]

    def add(self, names: np.ndarray, y: np.ndarray, codes: np.ndarray, tile: int = 262_144) -> None:
        """names, y, codes: ids, coordinates and labels (negative: none) of a chunk of others."""
        if not len(names) or not len(self.own):
            return
        order = np.argsort(codes, kind="stable")  # a label's others stand side by side
        names, y, codes = names[order], y[order], codes[order]
        ends = np.searchsorted(codes, np.arange(codes[-1] + 2))
        labels = [(c, ends[c], ends[c + 1]) for c in range(len(ends) - 1) if ends[c] < ends[c + 1]]
        moved = y - self.center
        length = (moved * moved).sum(1)
        right = np.ascontiguousarray(np.column_stack([moved, np.ones(len(y)), length]).T)
        slack = 16 * (y.shape[1] + 4) * np.finfo(float).eps * (self.length + length.max())
        k, bound, sums, wide = self.near.k, self.near.bound, self.sums, len(names)
        limit = np.maximum(np.where(np.isfinite(bound), bound * bound, bound), slack) + slack
        sums.widen(codes)
        row, col = self.same(names)
        one, step = np.ones(wide), max(1, tile // wide)
        room, marks, found = np.empty((step, wide)), np.zeros(-(-step * wide // 8) * 8, bool), []
        with np.errstate(invalid="ignore"):  # a root of less than nothing is among those that are measured again
            for start in range(0, len(self.own), step):
                rows = slice(start, start + step)
                left, most = self.left[rows], limit[rows]
                g = np.matmul(left, right, out=room[: len(left)])
                first, last = np.searchsorted(row, [start, start + step])
                itself = row[first:last] - start, col[first:last]
                g[itself] = np.inf
                free = np.isinf(most)
                if 0 < k <= wide and free.any():
                    most[free] = np.partition(g[free], k - 1, axis=1)[:, k - 1] + 2 * slack[rows][free]
                np.less_equal(g, most[:, None], out=marks[: g.size].reshape(g.shape))
                marks[g.size :] = False
                eight = np.flatnonzero(marks.view(np.uint64))  # few are marked, so eight are looked at in one
                near = (eight[:, None] * 8 + np.arange(8))[marks.reshape(-1, 8)[eight]]
                np.sqrt(g, out=g)
                g[itself] = 0.0
                g.reshape(-1)[near] = 0.0
                for c, low, high in labels:
                    sums.d[rows, c] += g[:, low:high] @ one[low:high]
                found.append(near + start * wide)
        near = np.concatenate(found)
        if np.isinf(limit).any():  # everything is near to those, the sample itself too
            near = near[~np.isin(near, row * wide + col)]
        near, other = np.divmod(near, wide)
        d = np.zeros(len(near))
        for c in range(y.shape[1]):
            gap = self.x[near, c] - y[other, c]
            d += gap * gap
        d = np.sqrt(d)
        for c, low, high in labels:
            sums.n[:, c] += high - low
        known = codes[other] >= 0
        np.add.at(sums.d, (near[known], codes[other[known]]), d[known])
        known = codes[col] >= 0
        np.subtract.at(sums.n, (row[known], codes[col[known]]), 1)
        keep = d <= bound[near]
        self.near.take(near[keep], d[keep], names[other[keep]], codes[other[keep]])


class Codes:
    """Whole numbers for labels as they come up; -1 for none."""

    def __init__(self) -> None:
        self.of: dict = {}

    def __call__(self, labels: pd.Series) -> np.ndarray:
        at, found = pd.factorize(labels)
        known = np.array([self.of.setdefault(x, len(self.of)) for x in found] + [-1])
        return known[at]


def running(cells: DataFrame, order: str, *sums: str, descending: bool = False, parts: int = 64) -> DataFrame:
    """`cells` (one row an `order` value; a null one is first, or last if descending) with run_<c>: the sum of c up to this row.

    Values are cut into ranges of about equal numbers of rows; a range sums its own rows and adds what the ranges before it
    hold, so no task sees more than a range. The ranges' bounds, `parts` values, are all that the driver gets.
    """
    bounds = cells.agg(F.percentile_approx(order, [i / parts for i in range(1, parts)], 10_000).alias("b")).head()["b"]
    below = [F.lit(b) for b in sorted(set(bounds or []))]
    part = F.size(F.filter(F.array(*below), lambda b: b < F.col(order))) if below else F.lit(0)
    placed = cells.withColumn("_part", F.when(F.col(order).isNull(), -1).otherwise(part))
    way = F.desc if descending else F.asc
    before = Window.orderBy(way("_part")).rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    totals = placed.groupBy("_part").agg(*[F.sum(c).alias(f"_sum_{c}") for c in sums])
    offsets = totals.select("_part", *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sums])
    within = Window.partitionBy("_part").orderBy(way(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = placed.join(F.broadcast(offsets), "_part")
    return out.withColumns({f"run_{c}": F.sum(c).over(within) + F.col(f"_off_{c}") for c in sums}).drop("_part", *[f"_off_{c}" for c in sums])


def ranked_values(rows: DataFrame, value: str, **counts) -> DataFrame:  # noqa: ANN003
    """value, n, `counts` (aggregates) and rank, ties averaged, of every distinct non-null value among all rows."""
    cells = rows.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"), *[c.alias(k) for k, c in counts.items()])
    return running(cells, value, "n").withColumn("rank", F.col("run_n") - (F.col("n") - 1) / 2).drop("run_n")


def quantiles(rows: DataFrame, value: str, **shares: float) -> DataFrame:
    """One row with the exact, interpolated quantile of `value` at each share, from counts of its values in ranges."""
    cells = rows.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    ranked = running(cells, value, "n").crossJoin(F.broadcast(cells.agg((F.sum("n") - 1).alias("_last"))))
    at = lambda place: F.min(F.when(F.col("run_n") > place, F.col(value)))
    places = {name: F.col("_last") * F.lit(share) for name, share in shares.items()}
    ends = [c.alias(f"{end}_{name}") for name, p in places.items() for end, c in (("_low", at(F.floor(p))), ("_high", at(F.ceil(p))), ("_part", F.max(p - F.floor(p))))]
    found = ranked.agg(*ends)
    return found.select(*[(F.col(f"_low_{name}") * (1 - F.col(f"_part_{name}")) + F.col(f"_high_{name}") * F.col(f"_part_{name}")).alias(name) for name in shares])


def normal_ranks(rows: DataFrame, value: str, by: str, least: int = 3, parts: int = 16) -> DataFrame:
    """`rows` with `value` as its rank-based inverse normal transform within `by`, ties averaged; groups of fewer than `least`
    values stay as they are.

    A group is cut into ranges of about equal numbers of rows, which are sorted once, each by itself, and go on from the ranges
    before them; the ranges' bounds and counts go to all tasks, a few numbers a group.
    """
    bounds = rows.groupBy(by).agg(F.percentile_approx(value, [i / parts for i in range(1, parts)], 10_000).alias("_bounds"))
    part = F.when(F.col(value).isNull(), -1).otherwise(F.size(F.filter(F.array_distinct("_bounds"), lambda b: b < F.col(value))))
    placed = rows.join(F.broadcast(bounds), by, "left").withColumn("_part", part).drop("_bounds")
    order = Window.partitionBy(by).orderBy("_part")
    sizes = placed.groupBy(by, "_part").agg(F.count(value).alias("_size"))
    offsets = sizes.select(by, "_part", (F.sum("_size").over(order) - F.col("_size")).alias("_before"), F.sum("_size").over(Window.partitionBy(by)).alias("_n"))
    within = Window.partitionBy(by, "_part").orderBy(value)
    rank = F.rank().over(within) + (F.count(value).over(within.rangeBetween(0, 0)) - 1) / 2.0
    ranked = placed.withColumn("_rank", rank).join(F.broadcast(offsets), [by, "_part"])
    p = (F.col("_before") + F.col("_rank") - 0.5) / F.col("_n")
    out = F.when(F.col("_n") < least, F.col(value)).when(F.col(value).isNotNull(), qnorm(p))
    return ranked.withColumn(value, out).select(*rows.columns)
