"""Loads that replace the partitions they bring."""

import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import plan
from ledgerline import LENIENT, ColumnSpec, Contract
from ledgerline.plans import load_json_rows
from ledgerline.sinks.partitions import DAY, MONTH, replace_partitions, within
from ledgerline.sinks.replacement import Replacement

SCHEMA = "k int, at timestamp_ntz, place string"


def frame(spark, rows):
    df = spark.createDataFrame(rows, "k int, at string, place string")
    return df.withColumn("at", F.to_timestamp_ntz("at"))


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def held(spark, path):
    return sorted(((r["k"], str(r["month"])) for r in spark.read.parquet(path).collect()), key=repr)


def test_only_partitions_of_the_load_are_replaced(spark, tmp_path):
    path, derived = str(tmp_path / "t"), {"month": ("at", MONTH)}
    first = [(1, "2024-01-31 23:59:59", "a"), (2, "2024-02-01 00:00:00", "a"), (3, "2024-03-05 00:00:00", "b"), (4, None, "c")]
    replace_partitions(frame(spark, first), path, ["month"], derived)
    before = files(path)
    replace_partitions(frame(spark, [(5, "2024-02-10 00:00:00", "a"), (6, "2024-04-01 00:00:00", "a"), (7, None, "x")]), path, ["month"], derived)
    assert held(spark, path) == [(1, "2024-01"), (3, "2024-03"), (5, "2024-02"), (6, "2024-04"), (7, "None")]
    same = {f for f, t in files(path).items() if before.get(f) == t}
    assert {re.search("month=([^/]+)", f)[1] for f in same} == {"2024-01", "2024-03"}
    replace_partitions(frame(spark, []), path, ["month"], derived)
    assert len(held(spark, path)) == 5 and not [f for f in os.listdir(path) if f.startswith(("_new", "_old"))]


def test_several_levels_and_a_failure(spark, tmp_path, monkeypatch):
    path, by, derived = str(tmp_path / "t"), ["place", "day"], {"day": ("at", DAY)}
    rows = [(i, f"2024-01-0{i % 3 + 1} 05:00:00", "odd = /name" if i % 2 else None) for i in range(12)]
    replace_partitions(frame(spark, rows), path, by, derived)
    before, stored = files(path), sorted(r["k"] for r in spark.read.parquet(path).collect())
    assert stored == list(range(12)) and len({os.path.dirname(f) for f in before}) == 6
    move, moved = Replacement._move, []

    def dies(self, source, target, undo=None):
        if undo is not None:
            moved.append(target)
            if len(moved) == 5:
                raise OSError("gone")
        move(self, source, target, undo)

    monkeypatch.setattr(Replacement, "_move", dies)
    again = frame(spark, [(k + 100, at, place) for k, at, place in rows if at < "2024-01-03"])
    with pytest.raises(OSError):
        replace_partitions(again, path, by, derived)
    assert files(path) == before
    monkeypatch.undo()
    replace_partitions(again, path, by, derived)
    assert sorted(r["k"] for r in spark.read.parquet(path).collect()) == sorted(k + 100 if k % 3 < 2 else k for k in range(12))


def test_reading_a_span_opens_its_months(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(366).select(F.col("id").cast("int").alias("k"), F.expr("TIMESTAMP_NTZ'2024-01-01 12:00:00' + make_dt_interval(id)").alias("at"))
    replace_partitions(rows, path, ["month"], {"month": ("at", MONTH)})
    stored = spark.read.schema(rows.schema.add("month", "string")).parquet(path)
    some = within(stored, "at", "month", "2024-03-31 12:00:00", "2024-05-01 12:00:00")
    assert sorted(r["k"] for r in some.collect()) == list(range(90, 121))
    assert re.search(r"PartitionFilters: \[.*month.*>= 2024-03.*month.*<= 2024-05", plan(some))
    months = {re.search("month=([^/]+)", r[0])[1] for r in some.select("_metadata.file_path").distinct().collect()}
    assert months == {"2024-03", "2024-04"}


def test_loads_by_partition(spark, tmp_path):
    contract = Contract("rows", (ColumnSpec("k", "KEY"), ColumnSpec("s", "STATE")))
    target = str(tmp_path / "t")
    for i, rows in enumerate(([("1", "WA"), ("2", "OR")], [("3", "OR")])):
        spark.createDataFrame(rows, "k string, s string").write.parquet(str(tmp_path / f"in{i}"))
        load_json_rows(spark, str(tmp_path / f"in{i}"), contract, target, policy=LENIENT, mode="partitions", partition_by=["STATE"])
    assert sorted(tuple(r) for r in spark.read.parquet(target).collect()) == [("1", "WA"), ("3", "OR")]
    with pytest.raises(ValueError, match="partition columns"):
        load_json_rows(spark, str(tmp_path / "in0"), contract, target, policy=LENIENT, mode="partitions")
