"""New and modified records, keyed snapshots.

Nothing here ranks or collects a whole key group: the latest record of a key is
an aggregate that combines inside each task before the shuffle, so a key holding
a large share of all rows sends one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.contract import quoted


def _cols(names: list[str]) -> list[Column]:
    return [F.col(quoted(n)) for n in names]


def latest_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """For every key the record with the greatest ``order`` values (NULL counts lowest).

    Ties on ``order`` keep one of the tied records; add columns to settle them.
    """
    rest = [c for c in df.columns if c not in key]
    newest = F.max_by(F.struct(*_cols(rest)), F.struct(*_cols(order)))
    picked = df.groupBy(*_cols(key)).agg(newest.alias("_newest"))
    return picked.select(
        *[F.col(quoted(c)) if c in key else F.col("_newest").getField(c).alias(c) for c in df.columns]
    )


def new_or_modified(
    incoming: DataFrame, snapshot: DataFrame, key: list[str], compare: list[str]
) -> DataFrame:
    """Incoming records the snapshot lacks (``new``) or holds otherwise (``modified``).

    The snapshot has one record per key (see :func:`latest_per_key`) and brings only
    its key and compared columns to the join. Incoming rows are the outer side, which
    adaptive execution splits when one key is hot.
    """
    held = snapshot.select(
        *[F.col(quoted(k)).alias(f"_held_{i}") for i, k in enumerate(key)],
        F.struct(*_cols(compare)).alias("_held"),
    )
    same_key = [F.col(quoted(k)).eqNullSafe(F.col(f"_held_{i}")) for i, k in enumerate(key)]
    same = F.struct(*_cols(compare)).eqNullSafe(F.col("_held"))
    return (
        incoming.join(held, same_key, "left")
        .where(F.col("_held").isNull() | ~same)
        .select(
            *_cols(incoming.columns),
            F.when(F.col("_held").isNull(), "new").otherwise("modified").alias("change"),
        )
    )


def merge_latest(
    snapshot: DataFrame, incoming: DataFrame, key: list[str], order: list[str]
) -> DataFrame:
    """The next snapshot: the latest record per key over the old one and the new rows.

    On equal ``order`` values the incoming record wins. Write the result to a new
    place; a path cannot be replaced while it is read.
    """
    both = snapshot.withColumn("_source", F.lit(0)).unionByName(
        incoming.select(*_cols(snapshot.columns)).withColumn("_source", F.lit(1))
    )
    return latest_per_key(both, key, [*order, "_source"]).drop("_source")
