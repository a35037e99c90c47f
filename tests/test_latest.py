"""The latest record per key from a stream: batches out of order, restarts, late rows, forgotten keys."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.incremental import latest_per_key
from ledgerline.sinks.bucketed import read_snapshot
from ledgerline.streaming.latest import keep_latest, latest_of_batches

SCHEMA = "k string, n long, at timestamp, v long"
START = datetime.datetime(2024, 3, 30, 12, tzinfo=datetime.timezone.utc)


def hours(n):
    return START + datetime.timedelta(hours=n)


def stream(spark, base, rows, **options):
    spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(f"{base}/in")
    arrived = spark.readStream.schema(SCHEMA).parquet(f"{base}/in")
    return keep_latest(arrived, ["k", "n"], ["at", "v"], f"{base}/snapshot", f"{base}/checkpoint", n_buckets=2, **options)


def state(spark, base):
    reader = spark.read.format("statestore").option("stateVarName", "last")
    return {tuple(r["key"]): r["value"]["_rank_1"] for r in reader.load(f"{base}/checkpoint").collect()}


def snapshot(spark, base):
    return sorted(map(tuple, read_snapshot(spark, f"{base}/snapshot").select("k", "n", "v").collect()), key=repr)


@pytest.mark.parametrize("ansi", [("true", "America/Los_Angeles")], indirect=True)
def test_batches_out_of_order_and_restarts(spark, tmp_path, ansi):
    rng = random.Random(5)
    everything = [(rng.choice([None, "a", "b", "hot"]), rng.choice([None, 1, 2]), hours(rng.randrange(100)), i) for i in range(400)]
    everything += [("hot", 1, hours(i / 7), 1000 + i) for i in range(400)]
    rng.shuffle(everything)
    base = str(tmp_path)
    for turn in range(3):
        query = stream(spark, base, everything[turn::3], late="30 days", forget="30 days")
        assert query.exception() is None
    want = latest_per_key(spark.createDataFrame(everything, SCHEMA), ["k", "n"], ["at", "v"])
    got = read_snapshot(spark, f"{base}/snapshot")
    assert got.count() == want.count() == 12 and got.exceptAll(want).count() == 0
    assert len(state(spark, base)) == 12
    # A run without new files changes nothing.
    arrived = spark.readStream.schema(SCHEMA).parquet(f"{base}/in")
    keep_latest(arrived, ["k", "n"], ["at", "v"], f"{base}/snapshot", f"{base}/checkpoint", late="30 days", forget="30 days")
    assert read_snapshot(spark, f"{base}/snapshot").exceptAll(want).count() == 0


def test_late_rows_and_forgotten_keys(spark, tmp_path):
    base = str(tmp_path)
    options = {"late": "10 hours", "forget": "5 hours"}
    stream(spark, base, [("a", 1, hours(0), 1), ("b", 1, hours(100), 1)], **options)
    # a is 100 hours behind: its state is gone, the snapshot keeps its record.
    assert state(spark, base) == {("b", 1): 1} and snapshot(spark, base) == [("a", 1, 1), ("b", 1, 1)]
    stream(spark, base, [("a", 1, hours(80), 2), ("b", 1, hours(95), 2), ("c", 1, hours(95), 1)], **options)
    # a's second record is behind the watermark, b's is only older than the one held.
    assert snapshot(spark, base) == [("a", 1, 1), ("b", 1, 1), ("c", 1, 1)]
    stream(spark, base, [("a", 1, hours(99), 3), ("b", 1, hours(100), 0), ("b", 1, hours(100), 3)], **options)
    assert snapshot(spark, base) == [("a", 1, 3), ("b", 1, 3), ("c", 1, 1)]
    assert state(spark, base) == {("a", 1): 3, ("b", 1): 3, ("c", 1): 1}


def test_rows_are_reduced_before_they_are_moved(spark):
    rows = spark.range(30_000, numPartitions=2).select(
        F.lit("hot").alias("k"), (F.col("id") % 3).alias("n"), F.timestamp_seconds(F.col("id") % 1000).alias("at"), F.col("id").alias("v")
    )
    few = latest_of_batches(rows, ["k", "n"], ["at", "v"])
    assert few.count() <= 3 * 4
    assert few.agg(F.max("v")).first()[0] == 29_999
    same = latest_per_key(few, ["k", "n"], ["at", "v"]).exceptAll(latest_per_key(rows, ["k", "n"], ["at", "v"]))
    assert same.count() == 0


def test_watermarks_need_a_timestamp(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "in"))
    with pytest.raises(TypeError, match="timestamp"):
        keep_latest(spark.readStream.schema("id long").parquet(str(tmp_path / "in")), ["id"], ["id"], "x", "y")
