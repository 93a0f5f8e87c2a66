"""Small helpers that the training-data operators share: tables, the shared folder, text forms."""

from __future__ import annotations

import tempfile
import urllib.parse
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table `name` under `sf_dir`, by whatever file system the path names."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share (spark.checkpoint.dir).

    A temporary folder of this machine stands in only where a local session names no folder, as in tests.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.gettempdir() + "/assayloom-shared"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Paths of the tables that `written` has made, in their order, for whoever runs operators one after another and knows when
#: a table isn't read any more.
MADE: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder, read again: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    MADE.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, paths: list[str], reader: DataFrame) -> list[str]:
    """Delete the tables at `paths`, but for those that `reader` reads; the paths that stay."""
    in_use = [urllib.parse.urlsplit(f).path for f in reader.inputFiles()]
    stay = []
    for path in paths:
        folder = urllib.parse.urlsplit(path).path.rstrip("/") + "/"
        if any(f.startswith(folder) for f in in_use):
            stay.append(path)
        else:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
            if path in MADE:
                MADE.remove(path)
    return stay


def short_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Have Spark hand texts to Python in batches of so many rows, so that a batch of long texts stays small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def keyed(docs: DataFrame, whole: bool = False) -> DataFrame:
    """doc_id, id, mark, text of each row, a null text as the empty one, and with `whole` all its columns as the struct row.

    Rows with one id and mark are rows of one doc_id (or of a null one) and one text; neither of the two is ever null, so
    they can be joined on. Names of the input's columns can't clash with an operator's while they are in the struct.
    """
    body = text_or_empty(F.col("text"))
    own = [F.col("doc_id"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"), F.xxhash64(body, F.col("doc_id").isNull()).alias("mark"), body.alias("text")]
    return docs.select(*own, *[F.struct(*docs.columns).alias("row")] * whole)


def others(df: DataFrame, *names: str) -> list[str]:
    """The columns of df that have none of these names, compared as the session compares names."""
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"
    same = (lambda c: c) if exact else str.lower
    return [c for c in df.columns if same(c) not in set(map(same, names))]


def utf8(text: Column) -> Column:
    return F.encode(text_or_empty(text), "UTF-8")


def sha256_hex(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with value evaluated once, however often `use` names it, also inside of lambdas."""
    return F.transform(F.array(value), use)[0]


def scanned(items: Column, state: Column, advance: Callable[[Column, Column], Column], emit: Callable[[Column, Column], Column], kind: str, block: int = 256) -> Column:
    """What `emit(state, item)` gives for the items of an array one after another, all arrays joined; kind is their type.

    The state starts as `state` and goes on by `advance(state, item)`. Results gather in blocks, so that arrays of many
    thousand items take time in proportion: an aggregate that adds to one array copies it at every step.
    """
    none = F.array().cast(kind)

    def one(acc: Column, x: Column) -> Column:
        return F.struct(advance(acc["state"], x).alias("state"), F.concat(acc["out"], emit(acc["state"], x)).alias("out"))

    def many(acc: Column, part: Column) -> Column:
        done = F.aggregate(part, F.struct(acc["state"].alias("state"), none.alias("out")), one)
        return F.struct(done["state"].alias("state"), F.concat(acc["out"], F.array(done["out"])).alias("out"))

    def whole(all_: Column) -> Column:
        parts = F.when(F.size(all_) > 0, F.transform(F.sequence(F.lit(1), F.size(all_), F.lit(block)), lambda at: F.slice(all_, at, F.lit(block))))
        start = F.struct(state.alias("state"), F.array().cast(f"array<{kind}>").alias("out"))
        return F.coalesce(F.flatten(F.aggregate(parts, start, many)["out"]), none)

    return bound(items, whole)


def small(df: DataFrame, most: int) -> DataFrame:
    """`df` with a broadcast hint if it has at most `most` rows, counted here; beyond that the join shuffles."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
