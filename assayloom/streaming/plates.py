"""Flags for new plates as they come in, against limits frozen from a batch; rows once each, windows and running states that
go on after a restart (survey K3)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from assayloom.functions.stats import center_and_mad


def frozen_limits(plates: DataFrame, value: str = "mean_value", k: float = 5.0) -> tuple[float, float]:
    """The range outside which a plate's mean is flagged: median -+ k MADs of known plates."""
    r = center_and_mad(plates, value).head()
    return r["median"] - k * r["mad"], r["median"] + k * r["mad"]


def plate_windows(stream: DataFrame, limits: tuple[float, float], at: str = "ts", window: str = "1 hour", late: str | None = "2 hours") -> DataFrame:
    """plate, start, end, n, mean_value, outlier of a stream (ts, plate, value): rows later than the watermark are left out,
    and a window's row comes once it is closed. late: None where the stream has its watermark already."""
    means = (stream if late is None else stream.withWatermark(at, late)).groupBy(F.window(at, window), "plate").agg(F.count("value").alias("n"), F.avg("value").alias("mean_value"))
    outside = (F.col("mean_value") < limits[0]) | (F.col("mean_value") > limits[1])
    return means.select("plate", F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n", "mean_value", outside.alias("outlier"))


def measured_once(stream: DataFrame, keys: tuple[str, ...] = ("plate", "sample"), at: str = "ts", late: str = "2 hours") -> DataFrame:
    """`stream` without rows whose keys have come before, within the watermark: a file that is sent twice counts once, and
    keys older than the watermark are forgotten."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(list(keys))


PROGRESS = "plate string, n long, mean_value double, outlier boolean, closed boolean"


def plate_progress(stream: DataFrame, limits: tuple[float, float], gap: str = "1 hour", at: str = "ts", late: str | None = "2 hours") -> DataFrame:
    """PROGRESS rows of a stream (ts, plate, value): a plate's count and mean so far whenever it gets values, and once more,
    closed, when the watermark is `gap` past its last value; its state is dropped then. Rows behind the watermark are left
    out, null values aren't counted. late: None where the stream has its watermark already."""
    from pyspark.sql.streaming.state import GroupStateTimeout

    wait = int(pd.Timedelta(gap).total_seconds() * 1000)

    def row(plate: str, n: int, total: float, closed: bool) -> pd.DataFrame:
        mean = total / n if n else None
        outside = None if mean is None else bool(mean < limits[0] or mean > limits[1])
        return pd.DataFrame({"plate": [plate], "n": [n], "mean_value": [mean], "outlier": [outside], "closed": [closed]})

    def update(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:  # noqa: ANN001
        n, total, last = state.get if state.exists else (0, 0.0, 0)
        if state.hasTimedOut:
            state.remove()
            yield row(key[0], n, total, True)
            return
        for b in batches:
            known = b["value"].dropna()
            n, total = n + len(known), total + float(known.sum())
            last = max(last, int(b[at].max().timestamp() * 1000))
        state.update((n, total, last))
        state.setTimeoutTimestamp(max(last + wait, state.getCurrentWatermarkMs() + 1))
        yield row(key[0], n, total, False)

    rows = (stream if late is None else stream.withWatermark(at, late)).select("plate", at, F.col("value").cast("double").alias("value"))
    return rows.groupBy("plate").applyInPandasWithState(update, PROGRESS, "n long, total double, last long", "append", GroupStateTimeout.EventTimeTimeout)


def follow(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Write what has come in to Parquet files and stop; the next call with the same checkpoint goes on where this one was."""
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("append").format("parquet").option("path", target).start()
