"""Summaries kept up with random changes against the full aggregate."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.kept_summaries import Measure, add_changes, arriving, fold, read_summary, signed_changes

SCHEMA = "k long, g string, h int, v double, extra string"
MEASURES = [Measure("n"), Measure("some", where="v > 3"), Measure("v", "v", scale=3), Measure("big", "v", where="h = 1", scale=3)]


def full(spark, held):
    """The same summary from all records at once."""
    df = spark.createDataFrame([(k, *r) for k, r in held.items()], SCHEMA)
    value = F.col("v").cast("decimal(28,3)")
    of = lambda name, column: [
        F.sum(column).cast("decimal(38,3)").alias(f"{name}_sum"), (F.sum(column).cast("double") / F.count(column)).alias(f"{name}_mean")
    ]
    return df.groupBy("g", "h").agg(
        F.count("*").alias("n"), F.count_if(F.col("v") > 3).alias("some"), *of("v", value), *of("big", F.when(F.col("h") == 1, value))
    )


def rows(df):
    return sorted((tuple(round(c, 9) if isinstance(c, float) else c for c in r) for r in df.collect()), key=repr)


def test_many_loads(spark, tmp_path):
    rng = random.Random(6)
    path, by, columns = str(tmp_path / "s"), ["g", "h"], ["g", "h", "v"]

    def record():
        return (rng.choice([None, "a", "b", "hot"]), rng.choice([None, 1, 2]), rng.choice([None, 0.1, 0.25, 2.5, 7.125, 1e9]), "x")

    held = {k: record() for k in range(200)}
    frame = lambda of: spark.createDataFrame([(k, *r) for k, r in of.items()], SCHEMA)
    add_changes(arriving(frame(held)), path, by, MEASURES, 1)
    assert rows(read_summary(spark, path, by, MEASURES)) == rows(full(spark, held))
    for load in range(2, 7):
        incoming = {k: record() for k in rng.sample(range(300), 40)}
        incoming |= {k: (*held[k][:3], "other") for k in list(held)[:20]}  # nothing that counts has changed
        gone = [] if load == 3 else [*rng.sample(sorted(held), 15), 9999]
        if load == 6:
            gone = [k for k, r in held.items() if r[0] == "a"]  # a group that goes
            incoming = {k: r for k, r in incoming.items() if r[0] != "a"}
        deleted = spark.createDataFrame([(k,) for k in gone + gone[:1]], "k long")
        changes = signed_changes(frame(incoming), frame(held), ["k"], columns, deleted)
        assert changes.columns == ["_sign", *columns]
        for _ in range(2):  # a load that is repeated counts once
            add_changes(changes, path, by, MEASURES, load)
        held = {k: r for k, r in (held | incoming).items() if k not in gone}
        if load == 4:
            fold(spark, path, by)
        assert rows(read_summary(spark, path, by, MEASURES)) == rows(full(spark, held))
    assert all(r[0] != "a" for r in rows(read_summary(spark, path, by, MEASURES)))
    folded = spark.read.parquet(path)
    assert {r[0] for r in folded.select("_load").distinct().collect()} == {4, 5, 6}


def test_only_touched_groups_are_written(spark, tmp_path):
    path, by = str(tmp_path / "s"), ["g"]
    held = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 50).cast("string").alias("g"), F.lit(1.0).alias("v"))
    add_changes(arriving(held.select("g", "v")), path, by, [Measure("v", "v")], 1)
    incoming = held.where("k = 7").withColumn("v", F.lit(2.0)).union(held.where("k = 8").withColumn("g", F.lit("9")))
    add_changes(signed_changes(incoming, held, ["k"], ["g", "v"]), path, by, [Measure("v", "v")], 2)
    written = spark.read.parquet(path).where("_load = 2")
    assert sorted((r["g"], r["rows_n"], float(r["v_sum"])) for r in written.collect()) == [("7", 0, 1.0), ("8", -1, -1.0), ("9", 1, 1.0)]


def test_sums_are_exact_after_many_retractions(spark, tmp_path):
    path, by = str(tmp_path / "s"), ["g"]
    add_changes(arriving(spark.sql("SELECT 'a' g, 0.1D v FROM range(10)")), path, by, [Measure("v", "v")], 1)
    both = spark.sql("SELECT 'a' g, 1e15D + 0.3 v, s _sign FROM (SELECT explode(array(1, -1)) s FROM range(1000))")
    for load in (2, 3):
        add_changes(both, path, by, [Measure("v", "v")], load)
    assert float(read_summary(spark, path, by, [Measure("v", "v")]).first()["v_sum"]) == 1.0


@pytest.mark.parametrize("n", [0, 1])
def test_empty_changes(spark, tmp_path, n):
    path, by = str(tmp_path / "s"), ["g", "h"]
    df = spark.createDataFrame([(1, "a", 1, 1.0, "x")][:n], SCHEMA)
    add_changes(arriving(df), path, by, MEASURES, 1)
    add_changes(signed_changes(df, df, ["k"], ["g", "h", "v"]), path, by, MEASURES, 2)
    fold(spark, path, by)
    assert read_summary(spark, path, by, MEASURES).count() == n
