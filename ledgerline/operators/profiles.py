"""Profiles of a table's columns, one for each load, that can be merged for any span of loads and compared.

A profile has a row for each column: exact counts, least and greatest value, and three mergeable sketches
from one pass over the load: quantiles (KLL), distinct values (HyperLogLog) and frequent values. Profiles are
kilobytes whatever the load's size. Merged over loads they describe the span as one pass over all of it
would, within the sketches' bounds; two spans are compared without reading either again.

Numbers, dates and instants (as seconds) have quantiles of their values, texts of their lengths. Texts
beyond ``LONG`` characters are counted among the frequent values by their hash.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.contract import quoted
from ledgerline.sinks.replacement import Replacement

#: KLL's k (a rank is within 1.33 % of the true one at 200, 0.7 % at 400, with 99 % confidence),
#: HyperLogLog's lgK (2.3 % standard error at 11, 1.6 % at 12), frequent values followed per load.
KLL_K, HLL_LGK, FOLLOWED = 400, 12, 1000
LONG = 256
#: Ranks at which two spans are compared; a distance is exact to two of their steps, beside KLL's bound.
_PROBES = 256


def column_value(df: DataFrame, name: str) -> Column:
    """What the quantiles of a column are of, as a double."""
    column, kind = F.col(quoted(name)), df.schema[name].dataType
    if isinstance(kind, T.NumericType | T.BooleanType):
        return column.cast("double")
    if isinstance(kind, T.DateType | T.TimestampType | T.TimestampNTZType):
        micros = f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast({quoted(name)} as timestamp_ntz))"
        return F.expr(micros).cast("double") / 1e6
    return F.length(column.cast("string")).cast("double")


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: column, type, n_rows, n_null, low, high (of what the quantiles are of), low_text, high_text (of
    texts), and the sketches ``quantiles``, ``distinct`` and ``frequent``."""
    rows = []
    for field in df.schema.fields:
        if columns is not None and field.name not in columns:
            continue
        text = F.col(quoted(field.name)).cast("string")
        value = column_value(df, field.name)
        short = F.when(F.length(text) <= LONG, text).otherwise(F.sha2(text, 256))
        is_text = isinstance(field.dataType, T.StringType)
        rows.append(
            F.struct(
                F.lit(field.name).alias("column"),
                F.lit(field.dataType.simpleString()).alias("type"),
                F.count(F.lit(1)).alias("n_rows"),
                F.count_if(F.col(quoted(field.name)).isNull()).alias("n_null"),
                F.min(value).alias("low"),
                F.max(value).alias("high"),
                (F.min(text) if is_text else F.lit(None).cast("string")).alias("low_text"),
                (F.max(text) if is_text else F.lit(None).cast("string")).alias("high_text"),
                F.kll_sketch_agg_double(value, F.lit(KLL_K)).alias("quantiles"),
                F.hll_sketch_agg(text, F.lit(HLL_LGK)).alias("distinct"),
                F.call_function("approx_top_k_accumulate", short, F.lit(FOLLOWED)).alias("frequent"),
            )
        )
    return df.agg(F.array(*rows).alias("columns")).select(F.inline("columns"))


def store_profile(df: DataFrame, path: str, load: int, columns: Sequence[str] | None = None) -> None:
    """Profile a load and keep that under ``path`` by its number; a load that is repeated replaces its profile."""
    with Replacement(df.sparkSession) as replaced:
        profile(df, columns).write.parquet(replaced.path(f"{path.rstrip('/')}/_load={load}"))


def read_profiles(spark: SparkSession, path: str, loads: Sequence[int] | None = None) -> DataFrame:
    """The stored profiles, with ``_load``."""
    found = spark.read.parquet(path)
    return found if loads is None else found.where(F.col("_load").isin(list(loads)))


def merged(profiles: DataFrame) -> DataFrame:
    """One profile of all loads given. A column that changed its type is one of its own for each type."""
    return profiles.groupBy("column", "type").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("low_text").alias("low_text"), F.max("high_text").alias("high_text"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"), F.hll_union_agg("distinct").alias("distinct"),
        F.call_function("approx_top_k_combine", F.col("frequent"), F.lit(FOLLOWED)).alias("frequent"),
    )


def _at(sketch: str, ranks: Sequence[float]) -> Column:
    """Values at some ranks; none of an empty sketch."""
    some = F.kll_sketch_get_n_double(sketch) > 0
    wanted = F.array(*[F.lit(float(r)) for r in ranks])
    return F.when(some, F.kll_sketch_get_quantile_double(sketch, wanted))


def _frequent(sketch: str, n: int) -> Column:
    """The ``n`` most frequent values (item, count) without NULL, which the sketch counts as well."""
    return F.filter(F.call_function("approx_top_k_estimate", F.col(sketch), F.lit(n)), lambda e: e["item"].isNotNull())


def described(profiles: DataFrame, ranks: Sequence[float] = (0.05, 0.25, 0.5, 0.75, 0.95), top: int = 5) -> DataFrame:
    """Profiles as readable values: counts, ends, n_distinct, quantile values, and the ``top`` frequent values
    (item, count; estimates)."""
    return profiles.select(
        "column", "type", "n_rows", "n_null", "low", "high", "low_text", "high_text",
        F.hll_sketch_estimate("distinct").alias("n_distinct"), _at("quantiles", ranks).alias("quantiles"),
        F.slice(_frequent("frequent", top + 1), 1, top).alias("top"),
    )


def drift(earlier: DataFrame, later: DataFrame) -> DataFrame:
    """How far two merged profiles are apart, per column of either: column, n_earlier, n_later (rows; NULL where
    the column is absent), null_share (later minus earlier), rank_distance (the most by which the shares below any
    value differ), value_distance (half the sum by which the shares of frequent values differ), distinct_ratio."""
    sides = []
    for profiles, side in ((earlier, "a"), (later, "b")):
        sides.append(profiles.select(F.col("column"), *[F.col(c).alias(f"{c}_{side}") for c in ("n_rows", "n_null", "quantiles", "distinct", "frequent")]))
    both = sides[0].join(sides[1], "column", "full")
    # Each side as its values at evenly spread ranks; the share below a value is that of those at most as large.
    ranks = [i / _PROBES for i in range(1, _PROBES)]
    below = lambda s, at: F.size(F.filter(f"ranked_{s}", lambda v: v <= at))
    apart = F.transform(F.concat("ranked_a", "ranked_b"), lambda at: F.abs(below("a", at) - below("b", at)) / _PROBES)
    shares = lambda s: F.map_from_entries(
        F.transform(
            _frequent(f"frequent_{s}", FOLLOWED),
            lambda e: F.struct(e["item"], e["count"] / F.col(f"valued_{s}")),
        )
    )
    share = lambda s, item: F.coalesce(F.element_at(f"shares_{s}", item), F.lit(0.0))
    items = F.array_union(F.map_keys("shares_a"), F.map_keys("shares_b"))
    total = F.aggregate(items, F.lit(0.0), lambda sum_, i: sum_ + F.abs(share("a", i) - share("b", i)))
    nulls = lambda s: F.col(f"n_null_{s}") / F.col(f"n_rows_{s}")
    return (
        both.withColumns({f"ranked_{s}": _at(f"quantiles_{s}", ranks) for s in "ab"})
        .withColumns({f"valued_{s}": F.col(f"n_rows_{s}") - F.col(f"n_null_{s}") for s in "ab"})
        .withColumns({f"shares_{s}": F.when(F.col(f"valued_{s}") > 0, shares(s)) for s in "ab"})
        .select(
            "column",
            F.col("n_rows_a").alias("n_earlier"),
            F.col("n_rows_b").alias("n_later"),
            (nulls("b") - nulls("a")).alias("null_share"),
            F.array_max(apart).alias("rank_distance"),
            (total / 2).alias("value_distance"),
            (F.hll_sketch_estimate("distinct_b") / F.nullif(F.hll_sketch_estimate("distinct_a"), F.lit(0))).alias("distinct_ratio"),
        )
    )


def drifted(null_share: float = 0.05, rank_distance: float = 0.1, value_distance: float = 0.2) -> Column:
    """Whether a row of :func:`drift` is beyond any of the limits, or its column on one side alone."""
    beyond = [
        F.col("n_earlier").isNull() | F.col("n_later").isNull(),
        F.abs("null_share") > null_share,
        F.col("rank_distance") > rank_distance,
        F.col("value_distance") > value_distance,
    ]
    return reduce(Column.__or__, [F.coalesce(b, F.lit(False)) for b in beyond])
