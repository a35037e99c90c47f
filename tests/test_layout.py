"""Clustering along a curve, the depth of overlapping files, and their upkeep."""

import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.contracts import VEHICLES
from ledgerline.plans import load_json_rows
from ledgerline.plans.derived import registrations
from ledgerline.sinks.curve import curve_clustered, curve_place, file_ranges, files_left, key_cuts, pruning_report
from ledgerline.sinks.tables import clustered, write_table
from ledgerline.sinks.upkeep import depth_report, file_spans, overlap_groups, recluster


@pytest.mark.parametrize("n,bits", [(1, 4), (2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_next_to_the_last(spark, n, bits):
    cells = spark.range(1 << n * bits).select(*[((F.col("id") / (1 << bits * i)).cast("long") % (1 << bits)).cast("int").alias(f"k{i}") for i in range(n)])
    cuts = [list(range(1, 1 << bits))] * n
    keys = cells.columns
    rows = cells.withColumn("place", curve_place(keys, cuts, bits)).orderBy("place").collect()
    assert [r["place"] for r in rows] == list(range(1 << n * bits))
    assert all(sum(abs(x - y) for x, y in zip(a[:n], b[:n], strict=True)) == 1 for a, b in zip(rows, rows[1:], strict=False))


def test_ranges_of_values(spark):
    """NULL lies in the first range; a key of two values uses the highest bit."""
    rng = random.Random(4)
    rows = [(rng.choice([None, "a", "b"]), rng.choice([None, *range(100)]), rng.random()) for _ in range(500)]
    df = spark.createDataFrame(rows, "s string, n int, x double").repartition(3)
    cuts = key_cuts(df, ["s", "n", "x"], 4)
    assert cuts[0] == ["b"] and len(cuts[1]) == len(cuts[2]) == 15
    got = df.select("*", *[curve_place([k], [at], 4).alias(f"r{k}") for k, at in zip("snx", cuts, strict=True)]).collect()
    for r in got:
        for value, at, number in zip(r[:3], cuts, r[3:], strict=True):
            assert number == (0 if value is None else (sum(c <= value for c in at) << 4) // (len(at) + 1))
    with pytest.raises(ValueError, match="62"):
        curve_place(["s"] * 11, [[]] * 11, 6)


def test_samples_are_bounded_and_empty_tables_have_no_cuts(spark):
    big = spark.range(50_000).select((F.col("id") % 1000).alias("n"))
    cuts = key_cuts(big, ["n"], 6, sample_rows=2_000)[0]
    assert len(cuts) == 63 and all(abs(c - 1000 * i / 64) < 60 for i, c in enumerate(cuts, 1))
    none = spark.createDataFrame([], "n int")
    assert key_cuts(none, ["n"]) == [[]] and curve_clustered(none, ["n"], 3).count() == 0


def test_every_key_prunes(spark, sf_oracle, tmp_path):
    rows = spark.read.parquet(f"{sf_oracle}/orders.parquet").select(
        (F.col("o_custkey") % 50).alias("a"), (F.col("o_orderkey") % 47).alias("b"), "o_totalprice", "o_orderkey"
    )
    keys = ["a", "b", "o_totalprice"]
    write_table(clustered(rows, keys, partitions=64), str(tmp_path / "sorted"))
    write_table(curve_clustered(rows, keys, 64), str(tmp_path / "curve"))
    left = {
        layout: {r["key"]: r["mean_left"] for r in pruning_report(spark, str(tmp_path / layout), keys).collect()}
        for layout in ("sorted", "curve")
    }
    assert left["sorted"]["o_totalprice"] > 60 and left["sorted"]["a"] < 4
    assert all(left["curve"][k] < 26 for k in keys)
    assert sum(left["curve"].values()) < 0.6 * sum(left["sorted"].values())
    assert spark.read.parquet(str(tmp_path / "curve")).exceptAll(rows).count() == 0


def test_a_hot_place_is_divided_and_appends_follow_the_same_curve(spark, tmp_path):
    rows = spark.range(20_000).select(F.lit("WA").alias("s"), F.lit(1).alias("n"), "id")
    path = str(tmp_path / "t")
    write_table(curve_clustered(rows, ["s", "n"], 8), path)
    sizes = [r["n_rows"] for r in file_ranges(spark, path, ["s", "n"]).collect()]
    assert len(sizes) == 8 and max(sizes) < 4_000
    more = spark.range(1_000).select(F.lit("OR").alias("s"), F.col("id").cast("int").alias("n"), "id")
    cuts = key_cuts(more, ["s", "n"])
    write_table(curve_clustered(more, ["s", "n"], 4, cuts=cuts), path, mode="append")
    left = files_left(file_ranges(spark, path, ["s", "n"]), "n", [0, 999]).collect()
    assert all(r["n_files"] == 12 and r["n_left"] == 1 for r in left)


def test_loads_along_the_curve(spark, sf_small, tmp_path):
    registrations(spark, sf_small).write.parquet(str(tmp_path / "in"))
    for curve in (False, True):
        load_json_rows(spark, str(tmp_path / "in"), VEHICLES, str(tmp_path / f"typed{curve}"), bytes_per_file=5_000, curve=curve)
    sorted_, curved = (spark.read.parquet(str(tmp_path / f"typed{c}")) for c in (False, True))
    assert curved.schema == sorted_.schema
    plain = lambda df: df.withColumn("VEHICLE_LOCATION", F.to_json("VEHICLE_LOCATION"))
    assert plain(curved).exceptAll(plain(sorted_)).count() == 0 and curved.count() == sorted_.count()
    cities = [r[0] for r in curved.select("CITY").distinct().limit(20).collect()]
    left = [
        files_left(file_ranges(spark, str(tmp_path / f"typed{c}"), ["CITY"]), "CITY", cities).agg(F.avg("n_left") / F.max("n_files")).first()[0]
        for c in (False, True)
    ]
    assert left[1] < 0.7 * left[0]


def test_groups_and_depth_of_random_spans(spark):
    rng = random.Random(9)
    for _ in range(6):
        spans = []
        for i in range(60):
            low = rng.randrange(100)
            spans.append((f"f{i}", 1, 1, low, low + rng.choice([0, 0, 1, 3, 10])))
        df = spark.createDataFrame(spans, "file string, n_rows long, n_bytes long, low int, high int")
        df = df.withColumns({c: F.struct(F.col(c).alias("k")) for c in ("low", "high")})
        got = {r["file"]: (r["group"], r["depth"]) for r in overlap_groups(df).collect()}
        groups = {s[0]: {s[0]} for s in spans}
        for a in spans:
            for b in spans:
                if a[3] < b[4] and b[3] < a[4]:
                    both = groups[a[0]] | groups[b[0]]
                    for f in both:
                        groups[f] = both
        by_number = {}
        for f, (number, _) in got.items():
            by_number.setdefault(number, set()).add(f)
        assert {frozenset(g) for g in by_number.values()} == {frozenset(g) for g in groups.values()}
        for files in by_number.values():
            held = [s for s in spans if s[0] in files]
            halves = [x / 2 for s in held for x in range(2 * s[3], 2 * s[4] + 1)]
            # Files that hold one and the same key do not lie on each other.
            deepest = max(sum(s[3] < x < s[4] for s in held) + any(s[3] == x == s[4] for s in held) for x in halves)
            assert {got[f][1] for f in files} == {max(1, deepest)}


def digests(path):
    return {f: hashlib.sha256(open(os.path.join(path, f), "rb").read()).hexdigest() for f in os.listdir(path) if f.startswith("part")}


def test_only_overlapping_files_are_written_again(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(10_000).select((F.col("id") % 100).alias("k"), F.col("id").cast("string").alias("v"))
    write_table(clustered(rows, ["k"], partitions=10), path)
    assert depth_report(spark, path, ["k"]).first().asDict() == {"n_files": 10, "n_overlapping": 0, "max_depth": 1, "mean_depth": 1.0}
    assert recluster(spark, path, ["k"]) == 0
    more = rows.where("k between 31 and 48").withColumn("v", F.concat(F.lit("more "), "v"))
    write_table(clustered(more, ["k"], partitions=1), path, mode="append")
    write_table(clustered(more.where("k = 33"), ["k"], partitions=1), path, mode="append")
    before, report = digests(path), depth_report(spark, path, ["k"]).first()
    assert report["max_depth"] >= 2 and 3 <= report["n_overlapping"] <= 6
    want = spark.read.parquet(path)
    n = want.count()
    assert recluster(spark, path, ["k"], bytes_per_file=20_000) == report["n_overlapping"]
    after = digests(path)
    assert len(before.items() & after.items()) == 12 - report["n_overlapping"]
    assert depth_report(spark, path, ["k"]).first()["max_depth"] == 1
    got = spark.read.parquet(path)
    assert got.count() == n and got.columns == ["k", "v"]
    every = rows.unionByName(more).unionByName(more.where("k = 33"))
    assert got.exceptAll(every).count() == 0 and every.exceptAll(got).count() == 0
    assert {f for f in os.listdir(path) if f.startswith(("_new", "_old"))} == set()


def test_spans_of_null_keys_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(None, "a"), (1, None), (2, "b")], "k int, v string").coalesce(1).write.parquet(path)
    span = file_spans(spark, path, ["k", "v"]).first()
    assert tuple(span["low"]) == (None, "a") and tuple(span["high"]) == (2, "b")
    spark.createDataFrame([], "k int").write.parquet(str(tmp_path / "none"))
    assert depth_report(spark, str(tmp_path / "none"), ["k"]).first()["n_files"] == 0
    assert recluster(spark, str(tmp_path / "none"), ["k"]) == 0
