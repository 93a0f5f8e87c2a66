"""Logistic elastic nets along a path of strengths, for all folds and mixings at once (survey I5, I6).

Rows are packed into strips of a matrix once. A pass over the strips gives, for every model together, the gradient on its
training rows and, at the end of a step of the path, the area under the curve of its held-out ones from binned scores. What
comes to the driver is as wide as features times models, once a pass, and doesn't grow with rows or strips. Between passes all models move by coordinate descent on one shared square of cross-products, a
quarter of which is never below a logistic loss's curvature, so each move lowers every model's loss. Strengths go from the
strongest down, each from the solution before it. What is chosen is then fitted to the end with its own curvature.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayloom.operators.genetics import settled

#: Bins of held-out probabilities from which areas under the curve are read.
BINS = 4096


@dataclass
class Strips:
    """Packed rows: x, y, outer, inner, n as bytes; each outer fold's facts of its training rows."""

    rows: DataFrame
    width: int
    outers: list[int]  # held-out folds, 0 for none
    mean: np.ndarray  # outer, feature
    scale: np.ndarray
    weight: np.ndarray  # outer, class
    total: np.ndarray  # outer, inner fold held out (0: none): sum of weights
    square: np.ndarray  # outer, 1 + feature, 1 + feature: cross-products of all rows in the outer fold's units


def summed(rows: DataFrame, work: Callable, finish: Callable = lambda key, total: total) -> dict[int, np.ndarray]:
    """key -> finish(key, the sum over all strips of the arrays that work(x, y, outer, inner) gives under that key).

    Sums are made and finished in tasks, a key in one, so the driver gets one finished array a key and none a strip. Floats
    are added in the order of the strips, which makes a sum the same in every run.
    """

    def part(index: int, strips: Iterator) -> Iterator[tuple[int, list]]:
        total: dict = {}
        for s in strips:
            y, outer, inner = (np.frombuffer(s[c], np.int8).astype(np.int64) for c in ("y", "outer", "inner"))
            for key, out in work(np.frombuffer(s["x"]).reshape(len(y), -1), y, outer, inner).items():
                total[key] = total[key] + out if key in total else out
        return iter([(key, [(index, out)]) for key, out in total.items()])

    def joined(a: list, b: list) -> list:
        return [(0, a[0][1] + b[0][1])] if a[0][1].dtype.kind == "i" else a + b

    def added(pair: tuple[int, list]) -> tuple[int, np.ndarray]:
        key, parts = pair
        return key, finish(key, reduce(np.add, [x for _, x in sorted(parts, key=lambda p: p[0])]))

    parts = rows.rdd.mapPartitionsWithIndex(part)
    return parts.reduceByKey(joined, min(parts.getNumPartitions(), 32)).map(added).collectAsMap()


def packed(vectors: DataFrame, label: str, folds: int, inner: int, seed: int, balanced: bool = True) -> Strips:
    """Strips of vectors (sample, label 0/1, features) with outer folds 1..folds by class (0 folds: none held out) and inner
    ones 1..inner by a hash. `balanced`: both classes weigh the same, else every row does."""
    from pyspark.ml.functions import vector_to_array

    from assayloom.operators.prediction import stratified_folds

    known = vectors.filter(F.col(label).isNotNull())
    dealt = stratified_folds(known, "sample", label, folds, seed) if folds else known.withColumn("fold", F.lit(0))
    rows = dealt.select(vector_to_array("features").alias("v"), F.col(label).cast("int").alias("y"), F.col("fold").cast("int").alias("outer"), (F.pmod(F.xxhash64("sample", F.lit(seed + 1)), F.lit(inner)) + 1).cast("int").alias("inner"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                small = [b.column(c).to_numpy().astype(np.int8).tobytes() for c in ("y", "outer", "inner")]
                x = b.column("v").flatten().to_numpy().astype(float).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in (x, *small)], names=["x", "y", "outer", "inner"])

    strips = settled(rows.mapInArrow(pack, "x binary, y binary, outer binary, inner binary"))
    first = known.select(F.size(vector_to_array("features")).alias("n")).head()
    if first is None:
        raise ValueError("no labelled rows")
    width, cells = first["n"], (folds + 1) * (inner + 1) * 2

    def count(x: np.ndarray, y: np.ndarray, outer: np.ndarray, inner_of: np.ndarray) -> dict[int, np.ndarray]:
        cell = (outer * (inner + 1) + inner_of) * 2 + y
        n = np.bincount(cell, minlength=cells)
        sums = np.zeros((cells, 2 * width))
        np.add.at(sums, cell, np.hstack([x, x * x]))
        wide = np.hstack([np.ones((len(y), 1)), x])
        squares = [wide[y == c].T @ wide[y == c] for c in (0, 1)]
        return {0: np.concatenate([n, sums.ravel(), *(s.ravel() for s in squares)])}

    facts = summed(strips, count)[0]
    n = facts[:cells].reshape(folds + 1, inner + 1, 2)
    sums = facts[cells : cells * (1 + 2 * width)].reshape(folds + 1, inner + 1, 2, 2 * width)
    squares = facts[cells * (1 + 2 * width) :].reshape(2, 1 + width, 1 + width)
    outers = [*range(1, folds + 1)] or [0]
    mean, scale, weight, total, square = [], [], [], [], []
    for o in outers:
        kept = [f for f in range(folds + 1) if f != o or not folds]
        own, s = n[kept].sum((0, 1)), sums[kept].sum((0, 1, 2))
        m, size = s[:width] / own.sum(), own.sum()
        var = (s[width:] - size * m * m) / max(size - 1, 1)
        mean.append(m)
        scale.append(np.where(var > 1e-24, np.sqrt(np.maximum(var, 0)), 1.0))
        weight.append(np.where((own > 0) & balanced, 0.5 * size / np.maximum(own, 1), 1.0))
        by_inner = (n[kept] * weight[-1]).sum((0, 2))
        total.append([by_inner.sum(), *(by_inner.sum() - by_inner[1:])])
        turn = np.zeros((1 + width, 1 + width))
        turn[0, 0], turn[1:, 0], turn[1:, 1:] = 1, -m / scale[-1], np.diag(1 / scale[-1])
        square.append(turn @ (weight[-1][0] * squares[0] + weight[-1][1] * squares[1]) @ turn.T)
    return Strips(strips, width, outers, *map(np.array, (mean, scale, weight, total, square)))


def one_pass(s: Strips, b: np.ndarray, held: np.ndarray, curved: bool = False, judged: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Gradients (outer, 1 + feature, model) of models b at their training rows; if `judged`, the areas under the curve (outer,
    model) of held-out rows, counted by class and bin of probability; with `curved`, for one model an outer fold, its curvature.
    held: the inner fold that a model leaves out, 0 for none. Bins are summed and read in tasks and don't come to the driver."""
    spark = s.rows.sparkSession
    sent = spark.sparkContext.broadcast((b, s.mean, s.scale, s.weight, s.outers, held))
    models, wide, outers = b.shape[2], 1 + s.width, len(s.outers)
    keys = models + 2  # of an outer fold: gradient, curvature, a model's bins

    def work(x: np.ndarray, y: np.ndarray, outer: np.ndarray, inner: np.ndarray) -> dict[int, np.ndarray]:
        b, mean, scale, weight, outers, held = sent.value
        out = {}
        for k, o in enumerate(outers):
            mine = outer != o if o else np.ones(len(y), bool)
            z = np.hstack([np.ones((mine.sum(), 1)), (x[mine] - mean[k]) / scale[k]])
            c, label, fold = weight[k][y[mine]][:, None], y[mine][:, None], inner[mine][:, None]
            p = 1 / (1 + np.exp(-np.clip(z @ b[k], -30, 30)))
            away = fold == held[None]
            out[k * keys] = z.T @ np.where(away, 0.0, c * (p - label))
            if curved:
                out[k * keys + 1] = z.T @ (z * (c * p * (1 - p)))
            if judged:
                for m in range(models):
                    i = np.flatnonzero(away[:, m])
                    at = label[i, 0] * BINS + np.minimum((p[i, m] * BINS).astype(np.int64), BINS - 1)
                    out[k * keys + 2 + m] = np.bincount(at, minlength=2 * BINS)
        return out

    def finish(key: int, total: np.ndarray) -> np.ndarray:
        return auc_of(total.reshape(2, BINS)) if key % keys > 1 else total

    found = summed(s.rows, work, finish)
    sent.destroy()
    g = np.stack([found[k * keys] for k in range(outers)])
    if curved:
        return g, np.stack([found[k * keys + 1] for k in range(outers)])
    return g, np.array([[found[k * keys + 2 + m] for m in range(models)] for k in range(outers)]) if judged else None


def descend(b: np.ndarray, g: np.ndarray, square: np.ndarray, per: np.ndarray, alpha: np.ndarray, strength: np.ndarray, sweeps: int, tolerance: float) -> np.ndarray:
    """Coordinate descent of every model (outer, 1 + feature, model) on its quadratic at b: gradient g, curvature square
    (shared by an outer fold's models), both over `per`; strength * (alpha * |b| + (1 - alpha) / 2 * b^2), the first free."""
    b, g = b.copy(), g / per[:, None]
    lasso, ridge = strength * alpha, strength * (1 - alpha)
    for _ in range(sweeps):
        most = 0.0
        for j in range(b.shape[1]):
            h = square[:, j, j][:, None] / per
            v = h * b[:, j] - g[:, j]
            if j:
                new = np.sign(v) * np.maximum(np.abs(v) - lasso, 0) / np.maximum(h + ridge, 1e-300)
                new = np.where(h + ridge > 0, new, 0.0)
            else:
                new = v / h
            step = new - b[:, j]
            if step.any():
                b[:, j] = new
                g += square[:, :, j][:, :, None] * (step / per)[:, None]
                most = max(most, float((np.abs(step) * np.sqrt(h)).max()))
        if most < tolerance:
            break
    return b


def auc_of(bins: np.ndarray) -> np.ndarray:
    """Areas under the curve of counts (..., class, bin), ties within a bin counting half; half without one of the classes."""
    no, yes = bins[..., 0, :], bins[..., 1, :]
    below = np.cumsum(no, -1) - no
    area, pairs = (yes * (below + no / 2)).sum(-1), no.sum(-1) * yes.sum(-1)
    return np.where(pairs > 0, area / np.maximum(pairs, 1), 0.5)


@dataclass
class Paths:
    """strength and mean and standard error of the inner folds' areas (outer, mixing, step); the start of each best model."""

    strength: np.ndarray
    auc: np.ndarray
    error: np.ndarray
    near: np.ndarray  # outer, mixing, 1 + feature: where the best step's inner models stood, on average


def paths(s: Strips, alphas: list[float], strengths: int | list[float], inner: int, least: float = 1e-3, moves: int = 3) -> Paths:
    """Every mixing's path in every outer fold, judged by the inner folds. strengths: how many, by equal factors
    from below the one that leaves no weight down to `least` of it; or the strengths themselves."""
    alpha = np.repeat(np.array(alphas, float), inner)
    held = np.tile(np.arange(1, inner + 1), len(alphas))
    per = s.total[:, held]
    b = np.zeros((len(s.outers), 1 + s.width, len(alpha)))
    g, _ = one_pass(s, b, held)
    if isinstance(strengths, int):
        g0, _ = one_pass(s, np.zeros((len(s.outers), 1 + s.width, 1)), np.zeros(1, int))
        top = np.abs(g0[:, 1:, 0]).max(1) / s.total[:, 0]
        grid = top[:, None, None] / np.maximum(np.array(alphas), 1e-3)[None, :, None] * np.geomspace(1, least, strengths + 1)[1:]
    else:
        grid = np.broadcast_to(np.array(sorted(strengths, reverse=True)), (len(s.outers), len(alphas), len(strengths)))
    mean, error, best, near = [], [], np.full((len(s.outers), len(alphas)), -1.0), np.zeros((len(s.outers), len(alphas), 1 + s.width))
    for at in range(grid.shape[2]):
        strength = np.repeat(grid[:, :, at], inner, 1)
        for move in range(1, moves + 1):
            after = descend(b, g, s.square / 4, per, alpha, strength, 50, 1e-4)
            moved, b = np.abs(after - b).max(), after
            last = moved < 1e-3 or move == moves
            g, auc = one_pass(s, b, held, judged=last)
            if last:
                break
        auc = auc.reshape(len(s.outers), len(alphas), inner)
        mean.append(auc.mean(2))
        error.append(auc.std(2, ddof=1) / np.sqrt(inner) if inner > 1 else np.zeros(auc.shape[:2]))
        better = mean[-1] > best
        best = np.where(better, mean[-1], best)
        near[better] = b.reshape(len(s.outers), -1, len(alphas), inner).mean(3).transpose(0, 2, 1)[better]
    return Paths(grid, np.stack(mean, 2), np.stack(error, 2), near)


def settled_models(s: Strips, alpha: np.ndarray, strength: np.ndarray, near: np.ndarray, most: int = 60, tolerance: float = 1e-8) -> np.ndarray:
    """One model an outer fold on all its training rows, to the end: Newton steps by coordinate descent with the models' own
    curvature; a step that would raise a model's slope is halved. Weights (outer, 1 + feature) in the fold's units."""
    held, per = np.zeros(1, int), s.total[:, :1]
    a, lam = np.asarray(alpha, float)[:, None], np.asarray(strength, float)[:, None]
    lasso, ridge = (lam * a)[:, None], (lam * (1 - a))[:, None]

    def slope(b: np.ndarray, g: np.ndarray) -> np.ndarray:
        """How far each model is from its optimum: the largest entry of the least subgradient."""
        full = g / per[:, None]
        free, bound = full[:, :1], full[:, 1:] + ridge * b[:, 1:]
        still = np.where(b[:, 1:] != 0, bound + lasso * np.sign(b[:, 1:]), np.sign(bound) * np.maximum(np.abs(bound) - lasso, 0))
        return np.abs(np.concatenate([free, still], 1)).max((1, 2))

    b = near[:, :, None].copy()
    g, h = one_pass(s, b, held, curved=True)
    far = slope(b, g)
    size = np.ones(len(b))
    for _ in range(most):
        if far.max() < tolerance:
            break
        aim = descend(b, g, h + 1e-12 * s.square, per, a, lam, 1000, 1e-12)
        tried = b + size[:, None, None] * (aim - b)
        g2, h2 = one_pass(s, tried, held, curved=True)
        now = slope(tried, g2)
        good = (now < far) | (size < 1e-3)
        b[good], g[good], h[good] = tried[good], g2[good], h2[good]
        far = np.where(good, now, far)
        size = np.where(good, np.minimum(1.0, 2 * size), size / 2)
    return b[:, :, 0]


def nested(vectors: DataFrame, label: str, alphas: list[float], strengths: int | list[float], folds: int = 5, inner: int = 5, seed: int = 42) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Out-of-fold scores (sample, label, fold, score), weights of the outer models (fold, at, weight) and what each fold
    chose (fold, alpha, strength, auc of the inner folds). A fold takes the mixing and strength of the largest mean area over
    its inner folds, of equal ones the stronger."""
    from pyspark.ml.functions import vector_to_array

    from assayloom.operators.prediction import stratified_folds

    s = packed(vectors, label, folds, inner, seed)
    found = paths(s, alphas, strengths, inner)
    pick = [np.unravel_index(int(np.argmax(a)), a.shape) for a in found.auc]
    alpha, strength = np.array([alphas[i] for i, _ in pick]), np.array([found.strength[k, i, j] for k, (i, j) in enumerate(pick)])
    w = settled_models(s, alpha, strength, np.array([found.near[k, i] for k, (i, _) in enumerate(pick)]))
    own = w[:, 1:] / s.scale
    intercept = w[:, 0] - (own * s.mean).sum(1)
    spark = vectors.sparkSession
    weights = spark.createDataFrame([(o, i, float(x)) for o, row in zip(s.outers, own, strict=True) for i, x in enumerate(row)], "fold int, at int, weight double")
    chosen = spark.createDataFrame([(o, float(alpha[k]), float(strength[k]), float(found.auc[k].max())) for k, o in enumerate(s.outers)], "fold int, alpha double, strength double, auc double")

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                k = b["fold"].to_numpy() - 1
                eta = np.einsum("ij,ij->i", np.stack(b["v"].to_list()), own[k]) + intercept[k]
                yield b.drop(columns="v").assign(score=1 / (1 + np.exp(-np.clip(eta, -30, 30))))

    dealt = stratified_folds(vectors.filter(F.col(label).isNotNull()), "sample", label, folds, seed)
    kinds = dict(dealt.dtypes)
    rows = dealt.select("sample", label, F.col("fold").cast("int").alias("fold"), vector_to_array("features").alias("v"))
    return rows.mapInPandas(score, f"sample {kinds['sample']}, {label} {kinds[label]}, fold int, score double"), weights, chosen


def one_error(vectors: DataFrame, label: str, alpha: float, strengths: int | list[float] = 30, inner: int = 5, seed: int = 42, errors: float = 1.0, balanced: bool = True) -> tuple[float, np.ndarray, float]:
    """The strongest strength whose mean area is within `errors` standard errors of the best (0: the best itself), and the
    model of all rows there: (strength, weights, intercept) in the vectors' own units."""
    s = packed(vectors, label, 0, inner, seed, balanced)
    found = paths(s, [alpha], strengths, inner)
    auc, error = found.auc[0, 0], found.error[0, 0]
    best = int(np.argmax(auc))
    at = int(np.argmax(auc >= auc[best] - errors * error[best]))
    w = settled_models(s, np.array([alpha]), found.strength[:, 0, at], found.near[:, 0])[0]
    own = w[1:] / s.scale[0]
    return float(found.strength[0, 0, at]), own, float(w[0] - own @ s.mean[0])
