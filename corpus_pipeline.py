"""The corpus pipeline: toxic documents go, one document of each group of near copies stays, documents with benchmark
passages go, personal data is replaced, and what is left is packed into training sequences.

A stage's result is written before the next one starts, as `run` does: the next one begins by deleting the intermediate
tables of the stages before it, but for those that its own input reads, so disk holds one stage's tables at a time.

Every stage takes all its predecessor kept, and all but the last return the columns of its input in their order. Further
columns go along, also those whose names operators use; nulls, ties, repeated rows and empty tables are defined at each
stage and its operator.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayloom.llm.common import MADE, keyed, removed, small, table, written
from assayloom.llm.jaccard_join import BROADCAST_ROWS, groups
from assayloom.llm.packing import pack
from assayloom.llm.phrase_index import decontaminated
from assayloom.llm.pii_weak import find, fit, label, redact
from assayloom.llm.toxicity import toxicity


def whole(docs: DataFrame) -> DataFrame:
    """doc_id, text and the row as one column, so that no name of its columns can clash with an operator's."""
    return docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row"))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored under 0.5 stay. A null or empty text has the base score; rows of one text score alike and go together."""
    scored = toxicity(whole(docs), table(spark, sf_dir, "labels"))
    return scored.filter("score < 0.5").select("_row.*")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8 or more; of a group the row of the least doc_id stays (a null one comes last, ties
    go by a hash of the text), and of repeated rows one. Rows without words are in no group and all stay."""
    found = written(groups(docs, words=5, percent=80).filter("component IS NOT NULL"), "near-copies")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "id", "mark")
    least = found.groupBy("component").agg(F.min(order).alias("least"), F.count("*").alias("rows")).filter("rows > 1")
    grouped = found.join(small(least, BROADCAST_ROWS), "component").withColumn("stays", F.col("least") == order)
    keys = written(grouped.groupBy("id", "mark").agg(F.max("stays").alias("stays"), F.count("*").alias("rows")), "near-copy-keys")
    rows = keyed(docs, whole=True)
    kept = rows.join(small(keys.filter("NOT stays").select("id", "mark"), BROADCAST_ROWS), ["id", "mark"], "left_anti")
    repeated = keys.filter("stays AND rows > 1").select("id", "mark")
    if not repeated.isEmpty():
        repeated = small(repeated, BROADCAST_ROWS)
        one = kept.join(repeated, ["id", "mark"], "left_semi").dropDuplicates(["id", "mark"])
        kept = kept.join(repeated, ["id", "mark"], "left_anti").unionByName(one)
    return kept.select("row.*")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with ten consecutive words of a benchmark item (all words of a shorter item) go, whatever their doc_id."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become <KIND>; n_chars follows the text. A null text stays null, an empty one empty."""
    labelled = label(whole(docs))
    text = F.when(F.col("text").isNotNull(), redact(F.col("text"), "spans"))
    clean = find(labelled, fit(labelled)).select("_row", text.alias("_clean"))
    new = {"text": F.col("_clean"), "n_chars": F.length("_clean").cast("long")}
    return clean.select(*[new[c].alias(c) if c in new else F.col("_row")[c].alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens in their sequences; a null text is empty, repeated rows are documents of their own."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), 2048)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Intermediate tables that the stages so far have left.
LEFT: list[str] = []


def tidy(stage: Stage) -> Stage:
    """The stage, which first deletes what the stages before it have left."""

    @wraps(stage)
    def one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        LEFT[:] = removed(spark, LEFT, docs)
        before = len(MADE)
        out = stage(spark, docs, sf_dir)
        LEFT.extend(MADE[before:])
        return out

    return one


STAGES = [
    ("toxicity", tidy(without_toxic)),
    ("near_copies", tidy(without_near_copies)),
    ("decontamination", tidy(without_benchmark)),
    ("personal_data", tidy(without_personal_data)),
    ("packing", tidy(packed)),
]

#: No stage but the benchmark's is within SQL's reach; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, read = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        out = written(stage(spark, docs, sf_dir), f"stage-{name}")
        LEFT.extend(read)  # the stage's input, which isn't needed any more
        docs, read = out, MADE[-1:]
    return docs
