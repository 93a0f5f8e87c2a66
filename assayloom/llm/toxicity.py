"""Toxicity behind obfuscation: a noisy channel undone by Viterbi decoding, then a linear score of the restored words.

A character language model (trigrams over letters and word ends, accents folded) is counted over all texts. A token that
shows noise, or a run of single letters set apart, becomes a lattice: a sign may stand for the letters it looks like, a
repeated letter or sign for one or two, a mark between letters for nothing, a star for any letter (more than STARS of them
are a line, not letters, and stand for nothing), and between letters set apart a word may end. Viterbi decoding gives the
READINGS likeliest readings under the model, exactly, in time proportional to the token; a word that only a less likely
reading holds isn't seen. A sparse logistic model, fitted to a bounded sample of the labelled rows (`most_rows`), scores
the set of restored words and of their beginnings; every word with enough support in that sample takes part.

Defined results: null and empty texts have no words and get the model's base score; repeated rows score alike; of a doc_id
with several texts the one of the least hash is in the sample; with no labels of either class the score is the smoothed
share of label 1; only doc_id and text are read of the texts, and nothing but the text enters a score; other columns go
along, and one named score is replaced.
"""

from __future__ import annotations

import itertools
import math
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayloom.llm.common import others, short_batches, written

#: Signs and the letters they may stand for (fixed values).
LOOKS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ı": "i", "к": "k", "м": "m", "т": "t", "ѕ": "s",
}
LETTERS = "abcdefghijklmnopqrstuvwxyz"
STEP, MASK = 1_000_003, (1 << 61) - 1
SIZE = 28  # word end, a-z, any other letter
EDGE = ".,;:!?\"'()[]{}<>|&#%/\\*+-_=~^`$@"
APART = re.compile(r"(?<![^\W_])[^\W_](?:[\s.\-_*]{1,2}[^\W_](?![^\W_])){2,}")
#: Log probabilities of the channel: a sign for a letter, a dropped mark, a repeated letter as one or as two, any letter for a star, a word end between letters set apart.
SIGN, DROP, ONE, TWO, STAR, END = -1.0, -0.7, -0.7, -1.2, -3.5, -1.5
READINGS, STARS, CACHE = 3, 3, 60_000
#: Labelled rows with label 1 that a word must be in, and nats by which it must stand out, to take part in the fit.
SUPPORT, GAIN = 3, 4.0
#: Beginnings of words count as features of their own: compounds of one stem share it.
PREFIXES, BEGINS = (3, 4, 5, 6, 7), "^"
THRICE, LETTERS_ONLY = re.compile(r"(.)\1\1"), re.compile(r"[^\W\d_]+")


def code(c: str) -> int:
    """0 for what is no letter, 1 to 26 for a to z with or without accents, 27 for any other letter."""
    if c in LETTERS:
        return LETTERS.index(c) + 1
    if not c.isalpha():
        return 0
    base = unicodedata.normalize("NFKD", c.lower())[0]
    return LETTERS.index(base) + 1 if base in LETTERS else 27


def model_counts(docs: DataFrame) -> np.ndarray:
    """How often each letter trigram stands in the texts. Each task adds up its own; at most SIZE**3 rows come back."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array([code(chr(i)) for i in range(0x10000) if not 0xD800 <= i < 0xE000], np.uint8)
        table = np.concatenate([table[:0xD800], np.zeros(0x800, np.uint8), table[0xD800:], [27]])  # beyond: other letters
        total = np.zeros(SIZE**3, np.int64)
        for b in batches:
            column = b.column("text").cast(pa.large_string())
            for at in range(0, len(column), 256):  # small slices keep the arrays small
                data = " \n".join([t for t in column.slice(at, 256).to_pylist() if t])
                c = table[np.minimum(np.frombuffer(f"  {data} ".encode("utf-32-le"), "<u4"), 0x10000)]
                c = c[np.concatenate([[True, True], (c[2:] != 0) | (c[1:-1] != 0) | (c[:-2] != 0)])].astype(np.int32)
                total += np.bincount((c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:], minlength=SIZE**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["gram", "n"])

    out = np.zeros(SIZE**3, np.int64)
    for r in docs.select("text").mapInArrow(count, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        out[r["gram"]] = r["n"]
    return out


def log_model(counts: np.ndarray) -> np.ndarray:
    """log P(third | first two), interpolated with shorter contexts."""
    n = counts.reshape(SIZE, SIZE, SIZE).astype(float)
    one = (n.sum((0, 1)) + 1) / (n.sum() + SIZE)
    two = (n.sum(0) + 5 * one) / (n.sum((0, 2))[:, None] + 5)
    return np.log((n + 5 * two[None]) / (n.sum(2)[..., None] + 5))


class Decoder:
    """Readings of noisy tokens under the language model, kept for tokens seen before."""

    def __init__(self, model: np.ndarray, wanted: set[str] | None = None) -> None:
        self.model = model.tolist()
        self.wanted = wanted
        self.known: dict[str, tuple[str, ...]] = {}

    def lattice(self, s: str, apart: bool) -> list[list[tuple[str, float]]]:
        """Place by place the edges (letters, log probability of the channel); a run of one character is one place."""
        out = []
        for c, same in itertools.groupby(s):
            run = len(list(same))
            if apart or run == 1:
                one, two = [(c, 0.0)], []
            else:
                one, two = [(c, ONE)], [(c + c, 0.0 if run == 2 else TWO)]
            if not c.isalpha() or c in LOOKS:
                signs = [(x, SIGN + p) for x in LOOKS.get(c, "") for _, p in one] + [(x + x, SIGN + p) for x in LOOKS.get(c, "") for _, p in two]
                if c == "*" and run <= STARS:
                    signs += [(x, STAR) for x in LETTERS]
                if not c.isalnum():
                    signs.append(("", DROP))
                edges = signs or one + two
            else:
                edges = one + two
            # letters set apart are one place each; so are a few stars, of which each may be any letter
            times = run if apart or (c == "*" and run <= STARS) else 1
            if apart:  # a word may end after any letter
                edges = [e for x, p in edges for e in ((x, p), (x + " ", p + END))]
            out += [edges] * times
        return out

    def viterbi(self, s: str, apart: bool) -> list[str]:
        """The READINGS likeliest readings, best first."""
        model, coded = self.model, {}
        # of each pair of last letters the READINGS best paths: (log probability, hash of the letters, path before, letters)
        now: dict[tuple[int, int], list[tuple]] = {(0, 0): [(0.0, 0, None, "")]}
        for edges in self.lattice(s, apart):
            after: dict[tuple[int, int], list[tuple]] = {}
            for letters, _ in edges:
                if letters not in coded:
                    own = 0
                    for c in letters:
                        own = (own * STEP + ord(c)) & MASK
                    coded[letters] = [code(c) for c in letters], own, STEP ** len(letters) & MASK
            for (a, b), paths in now.items():
                for letters, q in edges:
                    codes, own, shift = coded[letters]
                    x, y, step = a, b, q
                    for z in codes:
                        step += model[x][y][z]
                        x, y = y, z
                    spot = after.get((x, y))
                    if spot is None:
                        spot = after[x, y] = []
                    for path in paths:
                        p = path[0] + step
                        if len(spot) == READINGS and p <= spot[-1][0]:
                            break  # paths come best first
                        h = (path[1] * shift + own) & MASK
                        same = next((i for i, e in enumerate(spot) if e[1] == h), None)
                        if same is not None:
                            if spot[same][0] >= p:
                                continue
                            del spot[same]
                        at = 0
                        while at < len(spot) and spot[at][0] >= p:
                            at += 1
                        spot.insert(at, (p, h, path, letters))
                        del spot[READINGS:]
            now = after
        ends = sorted(((p + model[a][b][0], path) for (a, b), paths in now.items() for path in paths for p in (path[0],)), key=lambda e: -e[0])[:READINGS]
        out = []
        for _, path in ends:
            letters = []
            while path is not None:
                letters.append(path[3])
                path = path[2]
            out.append("".join(reversed(letters)))
        return out

    def token(self, token: str) -> tuple[str, ...]:
        """The words that a token may be; most tokens are one word as they stand. A letter that stands twice is spelling,
        one that stands three times or more is noise."""
        core = token.strip(EDGE)
        at = token.find(core)
        whole = token[at - 1] + core if at and token[at - 1] in LOOKS else core
        if whole.isalpha() and not THRICE.search(whole) and not any(c in LOOKS for c in whole):
            return (whole,)
        parts = [core] if core.isalpha() else LETTERS_ONLY.findall(core)
        if not parts:
            return ()
        return tuple(dict.fromkeys([*parts, *(r for f in {whole, core} for r in self.viterbi(f, False))]))

    def features(self, text: str) -> set[str]:
        """Words of a restored text, and how they begin, as far as they are in `wanted` (all of them if it is None)."""
        low = text.lower()
        known, tokens = self.known, set(low.split())
        found = list(map(known.get, tokens))
        if None in found:
            found = [self.keep(t, self.token(t)) if f is None else f for t, f in zip(tokens, found, strict=True)]
        out = set().union(*filter(None, found))
        for m in APART.finditer(low):
            joined = "".join(filter(str.isalnum, m[0]))
            found = known.get("\0" + joined)
            out.update(self.keep("\0" + joined, [w for r in self.viterbi(joined, True) for w in r.split()]) if found is None else found)
        return out

    def keep(self, token: str, words: Iterable[str]) -> tuple[str, ...]:
        found = {f for w in words if w for f in (w, *(w[:n] + BEGINS for n in PREFIXES if n < len(w)))}
        if self.wanted is not None:
            found &= self.wanted
        if len(self.known) > CACHE:
            self.known.clear()
        out = self.known[token] = tuple(sorted(found))
        return out


def training_rows(labels: DataFrame, most: int) -> DataFrame:
    """doc_id, toxic of at most `most` labelled rows for training, by a hash order of their ids."""
    usable = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(~held_out(F.col("doc_id")))
    return usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def sparse_logistic(rows: np.ndarray, words: np.ndarray, k: int, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Weights of k words and bias of an L1-penalised logistic model, by accelerated proximal steps.

    rows, words: the places of the ones in the table of rows and words.
    """
    n = len(y)
    times = lambda v: np.bincount(rows, v[words], n) + v[-1]
    back = lambda g: np.append(np.bincount(words, g[rows], k), g.sum())
    u = np.ones(k + 1)
    for _ in range(30):
        u = back(times(u / np.linalg.norm(u))) / n
    step = 3.6 / max(1.0, float(np.linalg.norm(u)))
    w = np.zeros(k + 1)
    w[-1] = math.log((y.sum() + 1) / (n - y.sum() + 1))
    v, t = w.copy(), 1.0
    for _ in range(rounds):
        new = v - step * back(1 / (1 + np.exp(-np.clip(times(v), -30, 30))) - y) / n
        new[:-1] = np.sign(new[:-1]) * np.maximum(0, np.abs(new[:-1]) - step * penalty)
        grown = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v = new + (t - 1) / grown * (new - w)
        w, t = new, grown
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, model: np.ndarray, most_rows: int = 20_000, penalty: float = 2e-4) -> tuple[dict[str, float], float]:
    """Weights of words and a bias. `most_rows` bounds the labelled sample; of its words all with SUPPORT and GAIN count."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = own.join(F.broadcast(training_rows(labels, most_rows)), "doc_id").groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("mark"), "text")).alias("first"))

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model)
        for b in (whole.slice(i, 256) for whole in batches for i in range(0, whole.num_rows, 256)):  # a row has thousands of features
            words = [sorted(decoder.features(t or "")) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), b.column("toxic").cast(pa.int32()), pa.array(words, pa.list_(pa.string()))], names=["doc_id", "toxic", "words"])

    rows = written(sample.select("doc_id", "toxic", "first.text").mapInArrow(restore, "doc_id long, toxic int, words array<string>"), "restored-sample")
    labelled = sorted((r["doc_id"], r["toxic"]) for r in rows.select("doc_id", "toxic").collect())  # at most most_rows
    y = np.array([t for _, t in labelled], float)
    bad, good = int(y.sum()), int(len(y) - y.sum())
    if not bad or not good:
        return {}, math.log((bad + 1) / (good + 1))
    seen = rows.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    a, b = F.col("a"), F.col("b")
    expected = (a + b) * (bad / (bad + good))
    gain = a * F.log((a + 0.5) / expected) - (a - expected)  # how much more often than by chance, in nats
    chosen = written(seen.filter((a > expected) & (a >= SUPPORT) & (gain >= GAIN)).select("word"), "words")
    top = sorted(r["word"] for r in chosen.collect())  # words of the bounded sample
    place, at = {w: i for i, w in enumerate(top)}, {d: i for i, (d, _) in enumerate(labelled)}
    ones = rows.select("doc_id", F.explode("words").alias("word")).join(F.broadcast(chosen), "word").groupBy("doc_id").agg(F.collect_list("word").alias("words")).collect()
    x = np.array([(at[r["doc_id"]], place[w]) for r in ones for w in r["words"]], np.int64).reshape(-1, 2)
    weights, bias = sparse_logistic(x[:, 0], x[:, 1], len(top), y, penalty)
    return {w: float(v) for w, v in zip(top, weights, strict=True) if abs(v) > 1e-9}, bias


def logistic(z: Iterable[float]) -> np.ndarray:
    return 1 / (1 + np.exp(-np.asarray(list(z), float)))


def score(docs: DataFrame, model: np.ndarray, weights: dict[str, float], bias: float) -> DataFrame:
    """`docs` with score, from 0 to 1."""
    keep = others(docs, "score")
    schema = docs.select(*keep).schema.add("score", "double")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model, set(weights))
        for b in batches:
            z = (bias + sum(weights[w] for w in sorted(decoder.features(t or ""))) for t in b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(logistic(z))], names=[*keep, "score"])

    return docs.select(*keep).mapInArrow(work, schema)


def toxicity(docs: DataFrame, labels: DataFrame, most_rows: int = 20_000) -> DataFrame:
    """`docs` with score: the language model over all of `docs`, the weights from the labelled rows among them."""
    short_batches(docs.sparkSession)
    model = log_model(model_counts(docs))
    return score(docs, model, *fit(docs, labels, model, most_rows))
