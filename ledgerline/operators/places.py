"""Points in use: all pairs within a distance, and the nearest places.

The globe is cut into bands of latitude about as high as the distance, and every band into cells about as wide. A
point lies in one cell; what is within the distance of it lies in the cells its circle touches, in its own
band and the two beside it. So both sides meet by an equality of cells, and the exact distance (great circle, on
a sphere) decides. Cells near the poles and across the date line are reached like any others: a circle that holds
a pole touches every cell of its bands, and cells are counted around the globe.

A cell with many points is divided on both sides: each of its parts on one side meets each on the other in a
task of its own (rows that are alike in every column stay together). Tasks are as many as the candidates ask for, not the
bytes of the points: few points can make very many pairs. Points that are NULL, no numbers or off the globe meet nothing.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.contract import quoted
from ledgerline.scratch import scratch_path

EARTH_KM = 6371.0088
#: Points of one side in a cell from which on the cell is divided.
HOT = 50_000
#: Candidates (pairs in one cell) of a task, and of a part of a cell; tasks at most.
TASK_PAIRS, PART_PAIRS, TASKS = 2_000_000, 20_000_000, 4_000
_LON, _LAT = "_lon", "_lat"


def great_circle_km(lon_a: Column, lat_a: Column, lon_b: Column, lat_b: Column) -> Column:
    """The distance of two points given in degrees."""
    return _km(lon_a, lat_a, F.cos(F.radians(lat_a)), lon_b, lat_b, F.cos(F.radians(lat_b)))


def rounded(km: str, digits: int) -> Column:
    """``round`` of a distance, which goes by way of its decimal digits, only where a tie is near: else the nearest
    whole number of the least unit is the same, at a fraction of the cost."""
    units = F.col(km) * 10**digits
    tie = F.abs(units - F.floor(units) - 0.5) < 1e-3
    return F.when(tie | (units >= 1e12), F.round(km, digits)).otherwise(F.rint(units) / F.lit(10.0**digits))


def _km(lon_a: Column, lat_a: Column, cos_a: Column, lon_b: Column, lat_b: Column, cos_b: Column) -> Column:
    """The distance, the cosines of the latitudes given."""
    up = F.sin(F.radians(lat_b - lat_a) / 2)
    along = F.sin(F.radians(lon_b - lon_a) / 2)
    h = up * up + cos_a * cos_b * along * along
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


class _Grid:
    """Bands and cells for one distance."""

    def __init__(self, km: float):
        # A little more than the distance, for what arithmetic rounds off.
        self.angle = min(math.degrees(km / EARTH_KM) * (1 + 1e-9) + 1e-9, 180.0)
        self.bands = max(1, min(math.floor(180 / self.angle), 1 << 20))
        self.height = 180 / self.bands

    def band(self, lat: Column) -> Column:
        return F.greatest(F.least(F.floor((lat + 90) / self.height), F.lit(self.bands - 1)), F.lit(0)).cast("int")

    def cells(self, band: Column) -> Column:
        """How many cells a band has: about as wide as high where the band is narrowest."""
        edge = F.greatest(F.abs(-90 + band * self.height), F.abs(-90 + (band + 1) * self.height))
        return F.greatest(F.floor(F.cos(F.radians(edge)) * 360 / self.height), F.lit(1)).cast("long")

    def own(self) -> list[Column]:
        band = self.band(F.col(_LAT))
        at = F.floor(F.pmod(F.col(_LON) + 180, F.lit(360.0)) / 360 * self.cells(band))
        return [band.alias("_band"), F.least(at, self.cells(band) - 1).alias("_cell")]

    def touched(self, rows: DataFrame) -> DataFrame:
        """One row for each cell that a point's circle touches."""
        lat, lon = F.col(_LAT), F.col(_LON)
        first, last = self.band(lat - self.angle), self.band(lat + self.angle)
        rows = rows.withColumn("_band", F.explode(F.sequence(first, last)))
        reach = F.sin(F.radians(F.lit(self.angle))) / F.cos(F.radians(lat))
        around = (F.abs(lat) + self.angle >= 90) | (F.lit(self.angle) >= 90) | (reach >= 1)
        half = F.when(around, 180.0).otherwise(F.degrees(F.asin(F.least(reach, F.lit(1.0)))) * (1 + 1e-9) + 1e-9)
        n = self.cells(F.col("_band"))
        place = lambda at: F.floor((at + 180) / 360 * n)
        low, high = place(lon - half), place(lon + half)
        every = F.sequence(F.lit(0).cast("long"), n - 1)
        some = F.transform(F.sequence(low, high), lambda c: F.pmod(c, n))
        return rows.withColumn("_cell", F.explode(F.when(high - low >= n - 1, every).otherwise(some)))


def _points(df: DataFrame, point: Sequence[str]) -> DataFrame:
    """The rows as a struct with their point as doubles; without those that have none."""
    lon, lat = (F.col(quoted(c)).cast("double") for c in point)
    row = F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("_row")
    return df.select(row, lon.alias(_LON), lat.alias(_LAT)).where(F.col(_LON).between(-180, 180) & F.col(_LAT).between(-90, 90))


def _parted(rows: DataFrame, row: str, counts: DataFrame, own: str, other: str) -> DataFrame:
    """Rows in their part of a divided cell, once for each part of the other side.

    The part follows from the row itself, so that a task that runs again deals as it did before.
    """
    both = rows.join(counts, ["_band", "_cell"], "left")
    mine = F.pmod(F.xxhash64(row), F.coalesce(F.col(own), F.lit(1)))
    theirs = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(other), F.lit(1)) - 1))
    return both.withColumn(f"_at_{own}", mine).withColumn(f"_at_{other}", theirs).drop(own, other)


def pairs_within(
    left: DataFrame, right: DataFrame, km: float, left_point: Sequence[str] = ("lon", "lat"),
    right_point: Sequence[str] = ("lon", "lat"), hot: int = HOT,
) -> DataFrame:
    """All pairs of rows whose points are at most ``km`` apart: left and right (the rows as structs), km."""
    grid = _Grid(km)
    a = grid.touched(_points(left, left_point)).select(F.col("_row").alias("left"), *_placed("a"), "_band", "_cell")
    b = _points(right, right_point).select(F.col("_row").alias("right"), *_placed("b"), *grid.own())
    cells = lambda rows, name: rows.groupBy("_band", "_cell").agg(F.count(F.lit(1)).alias(name))
    counts = cells(a, "_n_a").join(cells(b, "_n_b"), ["_band", "_cell"])
    pairs = counts.agg(F.sum(F.col("_n_a").cast("double") * F.col("_n_b"))).first()[0] or 0
    tasks = max(1, min(TASKS, math.ceil(pairs / TASK_PAIRS)))
    counts = _parts(counts, hot)
    a, b = _parted(a, "left", counts, "_parts_a", "_parts_b"), _parted(b, "right", counts, "_parts_b", "_parts_a")
    met = ["_band", "_cell", "_at__parts_a", "_at__parts_b"]
    # Fewer partitions, by the bytes, would leave the pairs to a few tasks.
    both = a.repartition(tasks, *met).join(b.repartition(tasks, *met), met)
    distance = _km(*(F.col(f"_{c}_{side}") for side in "ab" for c in ("lon", "lat", "cos")))
    # The angle's cosine tells cheaply which pairs are near; the distance is asked only where it might err.
    cosine = reduce(operator.add, (F.col(f"_{c}_a") * F.col(f"_{c}_b") for c in "xyz"))
    edge = math.cos(min(km / EARTH_KM, math.pi)) if km >= 0 else 3.0
    is_near = (cosine > edge + 1e-12) | ((cosine > edge - 1e-12) & (distance <= km))
    return both.where(is_near).select("left", "right", distance.alias("km"))


def _placed(side: str) -> list[Column]:
    """A point's degrees, the cosine of its latitude and its direction from the middle of the globe."""
    lon, lat = F.col(_LON), F.col(_LAT)
    cos = F.cos(F.radians(lat))
    told = {"lon": lon, "lat": lat, "cos": cos, "x": cos * F.cos(F.radians(lon)), "y": cos * F.sin(F.radians(lon)), "z": F.sin(F.radians(lat))}
    return [value.alias(f"_{name}_{side}") for name, value in told.items()]


def _parts(counts: DataFrame, hot: int) -> DataFrame:
    """Cells to be divided, and into how many parts on either side: none of more than ``hot`` rows, the larger side
    so far that parts have ``PART_PAIRS`` candidates."""
    for own in "ab":
        counts = counts.withColumn(f"_parts_{own}", F.ceil(F.col(f"_n_{own}") / hot).cast("long"))
    pairs = F.col("_n_a").cast("double") * F.col("_n_b") / (F.col("_parts_a") * F.col("_parts_b"))
    more = F.ceil(pairs / PART_PAIRS).cast("long")
    a_larger = F.col("_n_a") > F.col("_n_b")
    parts = {"_parts_a": F.when(a_larger, F.col("_parts_a") * more).otherwise(F.col("_parts_a")),
             "_parts_b": F.when(a_larger, F.col("_parts_b")).otherwise(F.col("_parts_b") * more)}
    counts = counts.withColumns(parts).where((F.col("_parts_a") > 1) | (F.col("_parts_b") > 1))
    return counts.select("_band", "_cell", "_parts_a", "_parts_b")


def nearest(
    left: DataFrame, right: DataFrame, k: int, tie: Sequence[str], left_point: Sequence[str] = ("lon", "lat"),
    right_point: Sequence[str] = ("lon", "lat"), start_km: float | None = None, hot: int = HOT,
) -> DataFrame:
    """For every row of ``left`` with a point its ``k`` nearest rows of ``right``: left, right, km, rank (from 1).

    Equal distances go by the columns ``tie`` of ``right``. Circles around the places of ``left`` grow until each
    holds ``k`` rows; a round looks only at places that are not done. Rows of one place count once on the left, and
    at most ``k`` times on the right, whatever their number.
    """
    spark = left.sparkSession
    base = scratch_path(spark, "nearest")
    a, b = _points(left, left_point), _points(right, right_point)
    order = [F.col(f"_row.{quoted(c)}") for c in tie]
    at_place = Window.partitionBy(_LON, _LAT).orderBy(*order)
    b = b.withColumn("_n", F.row_number().over(at_place)).where(F.col("_n") <= k).drop("_n")
    b.select(F.col("_row").alias("row"), F.col(_LON).alias("lon"), F.col(_LAT).alias("lat")).write.parquet(f"{base}/right")
    b = spark.read.parquet(f"{base}/right")
    n = b.count()
    open_ = a.select(F.col(_LON).alias("lon"), F.col(_LAT).alias("lat")).distinct()
    open_.write.parquet(f"{base}/open-0")
    open_ = spark.read.parquet(f"{base}/open-0")
    far = math.pi * EARTH_KM + 1
    km = min(far, start_km or EARTH_KM * math.sqrt(k / max(n, 1)))
    by_place = Window.partitionBy("lon", "lat").orderBy("km", *[F.col(f"row.{quoted(c)}") for c in tie])
    for turn in range(1, 64):
        pairs = pairs_within(open_, b, km, hot=hot).select("left.lon", "left.lat", "right.row", "km")
        ranked = pairs.withColumn("rank", F.row_number().over(by_place)).where(F.col("rank") <= k)
        ranked.write.parquet(f"{base}/round-{turn}")
        ranked = spark.read.parquet(f"{base}/round-{turn}")
        if km >= far or n == 0:
            done = ranked
        else:
            full = ranked.where(F.col("rank") == k).select("lon", "lat")
            done = ranked.join(full, ["lon", "lat"], "left_semi")
            open_.join(full, ["lon", "lat"], "left_anti").write.parquet(f"{base}/open-{turn}")
            open_ = spark.read.parquet(f"{base}/open-{turn}")
        done.write.mode("append").parquet(f"{base}/found")
        if km >= far or n == 0 or open_.isEmpty():
            break
        km = min(far, km * 3)
    found = spark.read.parquet(f"{base}/found")
    here = a.select(F.col("_row").alias("left"), F.col(_LON).alias("lon"), F.col(_LAT).alias("lat"))
    return here.join(found, ["lon", "lat"]).select("left", F.col("row").alias("right"), "km", "rank")
