"""Snapshots in buckets: merges against the plain aggregate, and what they leave alone."""

import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.incremental import latest_per_key
from ledgerline.sinks import bucketed
from ledgerline.sinks.bucketed import bucket_report, create_snapshot, merge_into_snapshot, read_snapshot, vacuum

SCHEMA = "a long, b string, at int, v string"


def files(path):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(os.path.join(path, "rows")) for f in names if f.startswith("part-")
    }


def by_bucket(found):
    out = {}
    for f in found:
        out.setdefault(int(f.split("_bucket=")[1].split("/")[0]), set()).add(f)
    return out


def rows(df):
    return sorted(map(tuple, df.select("a", "b", "at", "v").collect()), key=repr)


def test_merges_against_the_aggregate(spark, tmp_path):
    """Random records with null and repeated keys, late, equal and null orders, merge after merge."""
    rng = random.Random(2)
    path = str(tmp_path / "s")

    def batch(n, v):
        made = [(rng.choice([None, *range(60)]), rng.choice([None, "x", "y"]), rng.choice([None, *range(9)])) for _ in range(n)]
        # One value for each key and order of a batch, so that ties within it are no matter.
        return [(a, b, at, f"{v} {at}") for a, b, at in made]

    seen = batch(80, "first")
    create_snapshot(spark.createDataFrame(seen, SCHEMA), path, ["a", "b"], ["at"], n_buckets=8)
    held = {}
    for i, more in enumerate([seen, *[batch(rng.randint(0, 60), f"merge {i}") for i in range(5)]]):
        if i:
            met = merge_into_snapshot(spark, path, spark.createDataFrame(more, SCHEMA).select("v", "at", "b", "a").repartition(3))
        latest = {}
        for a, b, at, v in more:
            if (a, b) not in latest or (at is not None, at or 0) >= (latest[a, b][0] is not None, latest[a, b][0] or 0):
                latest[a, b] = (at, v)
        wins = {k: r for k, r in latest.items() if k not in held or (r[0] is not None, r[0] or 0) >= (held[k][0] is not None, held[k][0] or 0)}
        if i:
            assert met.n_new == len(latest.keys() - held.keys())
            assert met.n_modified == len(wins.keys() & held.keys()) and met.n_stale == len(latest) - len(wins)
        held |= wins
        assert rows(read_snapshot(spark, path)) == sorted(((*k, *r) for k, r in held.items()), key=repr)
        assert bucket_report(spark, path).agg(F.sum("n_rows")).first()[0] == len(held)


def test_one_percent_leaves_most_buckets_alone(spark, sf_oracle, tmp_path):
    path = str(tmp_path / "s")
    orders = spark.read.parquet(f"{sf_oracle}/orders.parquet")
    create_snapshot(orders, path, ["o_orderkey"], ["o_orderdate"], n_buckets=256)
    before = files(path)
    changed = orders.where("o_orderkey % 100 = 3").withColumn("o_totalprice", F.lit(1.0))
    new = orders.where("o_orderkey < 40").withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000)
    met = merge_into_snapshot(spark, path, changed.union(new))
    assert (met.n_new, met.n_modified, met.n_stale) == (40, 150, 0)
    assert met.n_untouched > 80 and 0 < len(met.added_to) <= 40
    after = files(path)
    assert before.items() <= after.items()  # nothing that was written is touched before vacuum
    written = by_bucket(after.keys() - before.keys())
    assert set(written) == {*met.rewritten, *met.added_to}
    # A bucket that is only added to gets its new rows and keeps its folder.
    added = spark.read.parquet(*[f for b in met.added_to for f in written[b]])
    assert added.count() <= 40 and added.agg(F.min("o_orderkey")).first()[0] >= 10_000_000
    read = {int(f.split("_bucket=")[1].split("/")[0]) for f in read_snapshot(spark, path).inputFiles()}
    assert len(read) == 256
    assert vacuum(spark, path) == len(met.rewritten)
    assert set(by_bucket(files(path))) == set(range(256))
    got = read_snapshot(spark, path)
    want = latest_per_key(orders.where("o_orderkey % 100 <> 3").union(changed).union(new), ["o_orderkey"], ["o_orderdate"])
    assert got.count() == want.count() == 15_040 and got.exceptAll(want).count() == 0


def test_stale_records_touch_nothing(spark, tmp_path):
    path = str(tmp_path / "s")
    create_snapshot(spark.createDataFrame([(i, "x", 5, "old") for i in range(50)], SCHEMA), path, ["a"], ["at"], n_buckets=4)
    before = files(path)
    met = merge_into_snapshot(spark, path, spark.createDataFrame([(i, "x", 4, "late") for i in range(50)], SCHEMA))
    assert (met.n_stale, met.rewritten, met.added_to, met.n_untouched) == (50, (), (), 4) and files(path) == before


def test_filters_miss_no_key_and_few_others(spark, tmp_path):
    path = str(tmp_path / "s")
    keys = spark.range(200_000).select(F.col("id").alias("a"), F.lit("x").alias("b"), F.lit(1).alias("at"), F.lit("v").alias("v"))
    create_snapshot(keys.where("a % 2 = 0"), path, ["a"], ["at"], n_buckets=4)
    layout = bucketed._layout(spark, path)
    assert layout.n_segments == 8
    segment, places = bucketed._bits(layout)
    asked = keys.withColumns({"_bucket": bucketed._bucket(layout), "segment": segment, "places": places})
    filters = spark.read.parquet(f"{path}/filters/_merge=1")
    told = asked.join(filters, ["_bucket", "segment"], "left").withColumn("held", bucketed._held(F.col("bits"), F.col("places")))
    even = told.groupBy((F.col("a") % 2).alias("odd")).agg(F.count_if("held").alias("n")).collect()
    n = {r["odd"]: r["n"] for r in even}
    assert n[0] == 100_000 and n[1] < 3_000


def test_a_failing_merge_leaves_the_snapshot(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    create_snapshot(spark.createDataFrame([(i, "x", 5, "old") for i in range(50)], SCHEMA), path, ["a"], ["at"], n_buckets=4)
    before = rows(read_snapshot(spark, path))
    exchange = bucketed.Replacement._exchange_path

    def dies(self, beside, target, *lists):
        if "/lines/" in target:
            raise OSError("gone")
        exchange(self, beside, target, *lists)

    incoming = spark.createDataFrame([(1, "x", 6, "new"), (99, "x", 1, "new")], SCHEMA)
    monkeypatch.setattr(bucketed.Replacement, "_exchange_path", dies)
    with pytest.raises(OSError):
        merge_into_snapshot(spark, path, incoming)
    assert rows(read_snapshot(spark, path)) == before
    monkeypatch.undo()
    met = merge_into_snapshot(spark, path, incoming)
    assert (met.n_new, met.n_modified) == (1, 1) and len(rows(read_snapshot(spark, path))) == 51


def test_buckets_with_many_folders_are_rewritten(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bucketed, "MOST_FOLDERS", 3)
    path = str(tmp_path / "s")
    create_snapshot(spark.createDataFrame([(0, "x", 5, "old")], SCHEMA), path, ["a"], ["at"], n_buckets=1)
    for i in range(1, 5):
        met = merge_into_snapshot(spark, path, spark.createDataFrame([(i, "x", 1, "new")], SCHEMA))
        assert (met.rewritten, met.added_to) == (((0,), ()) if i == 3 else ((), (0,)))
    assert [r[0] for r in rows(read_snapshot(spark, path))] == [0, 1, 2, 3, 4]
    assert bucket_report(spark, path).first()["n_folders"] == 2 and vacuum(spark, path) == 3
