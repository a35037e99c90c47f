"""Pairs within a distance and nearest places, against every pair; poles, date line, crowded cells."""

import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import places
from ledgerline.operators.places import EARTH_KM, great_circle_km, nearest, pairs_within

SCHEMA = "id int, lon double, lat double"


def km(a, b):
    up, along = math.sin(math.radians(b[2] - a[2]) / 2), math.sin(math.radians(b[1] - a[1]) / 2)
    h = up * up + math.cos(math.radians(a[2])) * math.cos(math.radians(b[2])) * along * along
    return 2 * EARTH_KM * math.asin(min(1, math.sqrt(h)))


@pytest.fixture(scope="module")
def globe():
    rng = random.Random(10)
    made = [(rng.uniform(-180, 180), math.degrees(math.asin(rng.uniform(-1, 1)))) for _ in range(150)]
    made += [(rng.uniform(-180, 180), rng.choice([-1, 1]) * rng.uniform(88, 90)) for _ in range(60)]  # around the poles
    made += [(rng.choice([-1, 1]) * rng.uniform(179.5, 180), rng.uniform(-80, 80)) for _ in range(60)]  # along the date line
    made += [(180.0, 10.0), (-180.0, 10.0), (0.0, 90.0), (77.0, 90.0), (0.0, -90.0), (0.0, 0.0), (0.0, 0.0), (1e-9, 0.0)]
    return [(i, *p) for i, p in enumerate(made)]


def both(spark, globe):
    odd = [(1000, None, 1.0), (1001, 1.0, None), (1002, float("nan"), 1.0), (1003, 181.0, 0.0), (1004, 0.0, -90.5)]
    return spark.createDataFrame(globe[::2] + odd, SCHEMA), spark.createDataFrame(globe[1::2] + globe[:20] + odd, SCHEMA).repartition(3)


@pytest.mark.parametrize("limit,hot", [(0.0, 50_000), (60.0, 2), (500.0, 3), (5_000.0, 50_000), (30_000.0, 50_000)])
def test_pairs_against_every_pair(spark, globe, limit, hot):
    left, right = both(spark, globe)
    got = pairs_within(left, right, limit, hot=hot).select("left.id", "right.id", "km").collect()
    a, b = globe[::2], globe[1::2] + globe[:20]
    want = sorted((x[0], y[0]) for x in a for y in b if km(x, y) <= limit)
    near = {(x[0], y[0]) for x in a for y in b if abs(km(x, y) - limit) < 1e-6}  # for arithmetic to decide
    assert [p for p in sorted(tuple(r[:2]) for r in got) if p not in near] == [p for p in want if p not in near]
    of = {p[0]: p for p in globe}
    assert all(r["km"] == pytest.approx(km(of[r[0]], of[r[1]]), abs=1e-6) for r in got)


@pytest.mark.parametrize("k,start", [(1, None), (3, 1.0), (500, None)])
def test_nearest_against_every_pair(spark, globe, k, start):
    left, right = both(spark, globe)
    got = {}
    for r in nearest(left, right, k, ["id"], start_km=start).collect():
        got.setdefault(r["left"]["id"], []).append((r["rank"], r["km"], r["right"]["id"]))
    a, b = globe[::2], sorted(globe[1::2] + globe[:20])
    assert set(got) == {x[0] for x in a}
    for x in a:
        want = sorted(km(x, y) for y in b)[:k]
        mine = sorted(got[x[0]])
        assert [m[0] for m in mine] == list(range(1, len(want) + 1))
        assert [m[1] for m in mine] == pytest.approx(want, abs=1e-6)
        for rank, (_, distance, id_) in enumerate(mine[:-1]):  # ties by id
            if distance == mine[rank + 1][1]:
                assert id_ <= mine[rank + 1][2]


def test_crowded_cells_are_divided(spark):
    rows = spark.range(4_000).select(F.col("id").cast("int").alias("id"), F.lit(5.0).alias("lon"), F.lit(47.0).alias("lat"))
    few = spark.createDataFrame([(1, 5.0, 47.0), (2, 5.0, 47.0001)], SCHEMA)
    parts = pairs_within(few, rows, 1.0, hot=500)
    assert parts.count() == 8_000 and parts.select("left.id", "right.id").distinct().count() == 8_000
    turned = pairs_within(rows, few, 1.0, hot=500)
    assert turned.count() == 8_000
    grid = places._Grid(1.0)
    b = places._points(rows, ("lon", "lat")).select("_row", *grid.own())
    counts = spark.createDataFrame([(*b.select("_band", "_cell").first(), 1, 8)], "_band int, _cell long, _parts_a long, _parts_b long")
    dealt = places._parted(b, "_row", counts, "_parts_b", "_parts_a").groupBy("_at__parts_b").count().collect()
    assert len(dealt) == 8 and max(r["count"] for r in dealt) < 700
    # Of one place no more than k rows are ever met.
    assert [r["right"]["id"] for r in sorted(nearest(few, rows, 2, ["id"]).collect(), key=lambda r: (r["left"]["id"], r["rank"]))] == [0, 1, 0, 1]


def test_empty_sides(spark, globe):
    some, none = spark.createDataFrame(globe[:3], SCHEMA), spark.createDataFrame([], SCHEMA)
    for a, b in ((some, none), (none, some), (none, none)):
        assert pairs_within(a, b, 100).count() == 0 and nearest(a, b, 2, ["id"]).count() == 0


def test_distances(spark):
    row = spark.range(1).select(
        great_circle_km(F.lit(0.0), F.lit(0.0), F.lit(180.0), F.lit(0.0)).alias("half"),
        great_circle_km(F.lit(179.5), F.lit(0.0), F.lit(-179.5), F.lit(0.0)).alias("over"),
        great_circle_km(F.lit(10.0), F.lit(90.0), F.lit(-100.0), F.lit(90.0)).alias("pole"),
    ).first()
    assert row["half"] == pytest.approx(math.pi * EARTH_KM) and row["over"] == pytest.approx(111.195, abs=0.01) and row["pole"] < 1e-9


def test_tasks_follow_the_pairs(spark, monkeypatch):
    """Few points that make many pairs are not left to a few tasks; a crowded cell is divided on its larger side."""
    monkeypatch.setattr(places, "TASK_PAIRS", 10_000)
    monkeypatch.setattr(places, "PART_PAIRS", 50_000)
    at = lambda n: spark.range(n).selectExpr("cast(id AS int) id", "5.0 + id % 40 / 1000 AS lon", "47.0 + id % 30 / 1000 AS lat")
    for left, right in ((at(300), at(1_000)), (at(1_000), at(300))):
        pairs = pairs_within(left, right, 20.0)
        per_task = [r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(per_task) == 300_000 == pairs.select("left.id", "right.id").distinct().count()
        assert pairs.rdd.getNumPartitions() >= 30 and max(per_task) <= 4 * 50_000 and len(per_task) >= 5
    counts = spark.createDataFrame([(0, 0, 200_000, 10), (0, 1, 1_000, 2_000), (0, 2, 10, 10)], "_band int, _cell long, _n_a long, _n_b long")
    assert sorted(map(tuple, places._parts(counts, 50_000).collect())) == [(0, 0, 40, 1), (0, 1, 1, 40)]


def test_rounded_as_round(spark):
    rng = random.Random(4)
    values = [rng.uniform(0, 20_016) for _ in range(20_000)] + [i / 2000 for i in range(20_000)] + [0.0, 1e-9, 0.0005, 1e13, 1.0005, 2.6755]
    values += [math.nextafter(v, s) for v in values[20_000:22_000] for s in (0, math.inf)]
    df = spark.createDataFrame([(v,) for v in values], "km double")
    for digits in (0, 3, 6):
        assert df.where(~places.rounded("km", digits).eqNullSafe(F.round("km", digits))).count() == 0
