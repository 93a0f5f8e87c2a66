"""Where queries register with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings as a measurement matrix in long form: sample, feature, value, grp."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("feature", "x"))
    return e.select(F.col("vec_id").alias("sample"), "feature", F.col("x").cast("double").alias("value"), F.col("label").alias("grp"))


#: The same in SQL, as the start of a WITH clause.
M = "m AS (SELECT vec_id AS sample, unnest(range(0, 64))::INT AS feature, unnest(embedding)::DOUBLE AS value, label AS grp FROM embeddings)"


def projections(m: DataFrame, names: str) -> DataFrame:
    """sample and a column for each letter: the sample's values times fixed weights of all features, summed."""
    return m.groupBy("sample").agg(*[F.sum(F.col("value") * F.cos(F.col("feature") * float(k))).alias(c) for k, c in enumerate(names, 1)])


def projections_sql(names: str) -> str:
    """The same as a DuckDB select list over rows grouped by sample."""
    return ", ".join(f"sum(value * cos(feature * {k}::DOUBLE)) AS {c}" for k, c in enumerate(names, 1))


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Doubles to `digits` places, negative zero as zero: sums differ in their last bits with the order of rows."""
    return df.withColumns({c: F.round(F.col(c), digits) + F.lit(0.0) for c in columns})


def correlation_p_sql(r: str, n: str) -> str:
    """DuckDB SQL of the two-sided p of a correlation over an even number n of rows, by the t distribution's finite sum."""
    terms = f"list_transform(range(0, ({n} // 2 - 1)::BIGINT), lambda k: exp(lgamma(k + 0.5::DOUBLE) - lgamma(k + 1.0::DOUBLE) - 0.5::DOUBLE * ln(pi()) + k * ln(1 - {r} * {r})))"
    return f"(1 - abs({r}) * list_sum({terms}))"
