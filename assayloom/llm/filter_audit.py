"""What filters do to one another: counts for every order in which they can be applied.

Four filters look at a row alone; the fifth, exact copies, needs the table. Texts are routed by their xxhash fingerprint as
key-value pairs: a task keeps, for each fingerprint, a chain of the full texts that have it with the least id so far, and
gives out every row whose id isn't the least as soon as that is known. Map tasks do the same with their own rows first, so
of a text that a third of all rows hold each sends one row (and rows with equal id beside it), however many it has.
A row then goes by its mask, five bits. Masks are counted as vectors by part, merged with combineByKey; orders and Shapley
sums come from these vectors of 32 masks alone.

Defined results: a null text is empty, a null part is the empty string; a null doc_id is larger than any other, so it is
never the least while there is another one; rows of equal id and text aren't copies of one another and share one decision;
a doc_id with several labels counts as good or toxic if any of them says so; an empty table gives no rows; other columns
aren't read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import permutations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayloom.llm.common import small

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = re.compile(rb"[#$%&*|]")
#: The bytes that go on with a code point in UTF-8.
INSIDE = bytes(range(0x80, 0xC0))
#: Bytes of text that a map task holds before it sends its chains on, and that a reducing task gets on average.
HELD = 32 << 20
BROADCAST_LABELS = 500_000

Row = tuple[int | None, str, int]  # doc_id, part, mask


def failures(text: bytes) -> int:
    """The bits of A to D that a text fails: short, few different words, many capitals, marks. Only spaces, tabs and the
    like part words, so bytes can be split; code points are the bytes that don't go on with one."""
    words = text.split()
    capitals = len(text) - len(text.translate(None, UPPER))
    return (
        (len(words) < 50)
        | (100 * len(set(words)) < 65 * len(words)) << 1
        | (100 * capitals > 5 * len(text.translate(None, INSIDE))) << 2
        | (MARKS.search(text) is not None) << 3
    )


def later(a: int | None, b: int | None) -> bool:
    """Whether id a comes after id b; a null id is last."""
    return a is not None and b is not None and a > b or a is None and b is not None


class Chains:
    """Fingerprint -> texts with that fingerprint, each with its least id so far and the rows that have it."""

    def __init__(self) -> None:
        self.chains: dict[int, list[list]] = {}
        self.held = 0

    def add(self, key: int, text: bytes, doc: int | None, rows: list[tuple[str, int, int]]) -> tuple[int | None, list]:
        """Take in rows (part, mask, how many) of one id and text; what comes back, (id, rows), are rows that aren't the least."""
        chain = self.chains.setdefault(key, [])
        for link in chain:
            if link[0] == text:
                if later(doc, link[1]):
                    return doc, rows
                if later(link[1], doc):
                    link[1], doc, link[2], rows = doc, link[1], rows, link[2]
                    return doc, rows
                counts = {r[:2]: r[2] for r in link[2]}
                for part, mask, n in rows:
                    counts[part, mask] = counts.get((part, mask), 0) + n
                link[2] = [(*k, n) for k, n in counts.items()]
                return doc, []
        chain.append([text, doc, rows])
        self.held += len(text) + 200
        return doc, []

    def empty(self) -> Iterator[tuple[int, tuple]]:
        """What is in the chains as (fingerprint, (text, id, rows)); they are empty then."""
        for key, chain in self.chains.items():
            for text, doc, rows in chain:
                yield key, (text, doc, rows)
        self.__init__()


def masks(docs: DataFrame, part: str) -> DataFrame:
    """doc_id, part, mask, n: how many rows have that id, part and failures."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.encode(F.coalesce(docs["text"].cast("string"), F.lit("")), "UTF-8").alias("text"), F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"))
    volume = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 200), F.lit(0))).head()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-volume // HELD))

    def route(rows: Iterator) -> Iterator[tuple[int, tuple]]:
        """Own copies are told apart at once, with a null text; what may be a copy of another task's row goes on by its text."""
        import xxhash

        chains = Chains()
        for doc, text, name in rows:
            text = bytes(text)
            key = xxhash.xxh64_intdigest(text)
            found, gone = chains.add(key, text, doc, [(name, failures(text), 1)])
            if gone:
                yield hash_of(found), (None, found, gone)
            if chains.held > HELD:
                yield from chains.empty()
        yield from chains.empty()

    def decide(pairs: Iterator[tuple[int, tuple]]) -> Iterator[tuple]:
        chains = Chains()
        for key, (text, doc, rows) in pairs:
            found, gone = (doc, rows) if text is None else chains.add(key, text, doc, rows)
            for name, mask, n in gone:
                yield found, name, mask | COPY, n
        for _, (_, doc, rows) in chains.empty():
            for name, mask, n in rows:
                yield doc, name, mask, n

    routed = rows.rdd.mapPartitions(route).partitionBy(parts, int)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return spark.createDataFrame(routed.mapPartitions(decide), f"doc_id {kind}, part string, mask int, n long", verifySchema=False)


def hash_of(doc: int | None) -> int:
    """Where a row goes that needs no text any more: spread by its id."""
    import xxhash

    return xxhash.xxh64_intdigest(repr(doc).encode())


def mask_counts(masked: DataFrame, labels: DataFrame, good: str = "quality", toxic: str = "toxic"):  # noqa: ANN201
    """An RDD of (part, 32 triples of rows, good rows, toxic rows by mask). Labels meet rows by id, after those are summed."""
    marks = labels.filter(f"doc_id IS NOT NULL AND ({good} = 1 OR {toxic} = 1)").groupBy("doc_id").agg(F.max(F.coalesce(F.col(good) == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col(toxic) == 1, F.lit(False))).alias("toxic"))
    summed = masked.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    rows = summed.join(small(marks, BROADCAST_LABELS), "doc_id", "left").select("part", "mask", "n", F.coalesce("good", F.lit(False)), F.coalesce("toxic", F.lit(False)))

    def add(vector: list[int], row: tuple) -> list[int]:
        mask, n, is_good, is_toxic = row
        vector[3 * mask] += n
        vector[3 * mask + 1] += n * is_good
        vector[3 * mask + 2] += n * is_toxic
        return vector

    pairs = rows.rdd.map(lambda r: (r[0], tuple(r[1:])))
    return pairs.combineByKey(lambda row: add([0] * 3 * 32, row), add, lambda a, b: [x + y for x, y in zip(a, b, strict=True)])


AUDIT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def audit_of(part: str, vector: list[int], filters: str = FILTERS) -> Iterator[tuple]:
    """AUDIT rows of one part from its counts by mask."""
    bit = {f: 1 << i for i, f in enumerate(filters)}
    total = sum(vector[::3])

    def failing(first: int, none_of: int = 0) -> tuple[int, int, int]:
        """Rows, good and toxic ones whose mask meets `first` and doesn't meet `none_of`."""
        at = [m for m in range(32) if m & first and not m & none_of]
        return tuple(sum(vector[3 * m + k] for m in at) for k in range(3))

    rows, removed_in_all = [], dict.fromkeys(filters, 0)
    for order in permutations(filters):
        before, kept = 0, total
        for step, f in enumerate(order, 1):
            removed, good, toxic = failing(bit[f], before)
            kept -= removed
            removed_in_all[f] += removed
            rows.append((f, "".join(order), step, kept, removed, failing(bit[f])[0] - removed, vector[3 * bit[f]], good, toxic))
            before |= bit[f]
    return ((part, *r[1:], removed_in_all[r[0]]) for r in rows)


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """AUDIT rows: for each part of docs (doc_id, text, part), each order of the filters and each step of it, zeros included."""
    counted = mask_counts(masks(docs, part), labels)
    return docs.sparkSession.createDataFrame(counted.flatMap(lambda x: audit_of(*x)), AUDIT, verifySchema=False)
