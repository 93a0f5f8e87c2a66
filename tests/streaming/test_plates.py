"""Streams that are cut, repeated and late against the batch result."""

import pytest
from pyspark.sql import functions as F

from assayloom.streaming import plates

SCHEMA = "ts timestamp, plate string, sample string, value double"
LIMITS = (5.0, 15.0)


def rows(spark, data):
    return spark.createDataFrame(data, "t string, plate string, sample string, value double").select(F.to_timestamp("t").alias("ts"), "plate", "sample", "value")


def at(hour, minute=0):
    return f"2024-01-01 {hour:02d}:{minute:02d}:00"


FIRST = [(at(1, m), p, f"{p}{m}", v) for m in (5, 20, 40) for p, v in (("a", 10.0), ("b", 30.0))] + [(at(2, 10), "a", "a9", None)]
AGAIN = FIRST[:4]  # sent twice
SECOND = [(at(2, 30), "b", "b7", 12.0), (at(6, 0), "c", "c1", 9.0)]
LATE = [(at(1, 1), "a", "late", 1000.0), (at(12, 0), "c", "c2", 11.0)]  # behind the watermark that 06:00 has set


@pytest.fixture
def feed(spark, tmp_path):
    """Writes files one after another and follows them, a new stream from the same checkpoint each time."""

    def send(transform):
        def one(n, data):
            rows(spark, data).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
            stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
            q = plates.follow(transform(stream), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
            assert q.awaitTermination(120)

        for n, data in enumerate((FIRST, AGAIN + SECOND, LATE)):
            one(n, data)
        return spark.read.parquet(f"{tmp_path}/out")

    return send


def test_windows_after_restarts(spark, feed):
    def transform(stream):
        once = plates.measured_once(stream, late="2 hours")
        return plates.plate_windows(once, LIMITS, late=None)

    got = {(r["plate"], r["start"].hour): (r["n"], r["mean_value"], r["outlier"]) for r in feed(transform).collect()}
    batch = rows(spark, FIRST + SECOND + LATE[1:]).dropDuplicates(["plate", "sample"])
    means = batch.groupBy("plate", F.hour("ts").alias("h")).agg(F.count("value").alias("n"), F.avg("value").alias("m"))
    want = {(r["plate"], r["h"]): (r["n"], r["m"], None if r["m"] is None else not LIMITS[0] <= r["m"] <= LIMITS[1]) for r in means.collect()}
    assert got == {k: v for k, v in want.items() if k[1] < 10}  # the last hour's window is still open


def test_progress_after_restarts(spark, feed):
    out = feed(lambda s: plates.plate_progress(plates.measured_once(s, late="2 hours"), LIMITS, "1 hour", late=None))
    last = {}
    for r in sorted(out.collect(), key=lambda r: (r["n"], r["closed"])):
        last[r["plate"]] = (r["n"], r["mean_value"], r["outlier"], r["closed"])
    assert last["a"] == (3, 10.0, False, True) and last["b"] == (4, 25.5, True, True)
    assert last["c"][0] == 2 or last["c"] == (1, 11.0, False, False)
