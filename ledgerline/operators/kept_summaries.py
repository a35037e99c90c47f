"""Grouped counts, sums and means kept up with a table's changes.

A summary is a table of partial states, one for each group: how many rows, how many values, their sum. A changed
record takes its old values out of its old group and puts the new ones into its new group; a deleted one only
goes out. So a load costs what it changed, not what the table holds. Sums are exact decimals:
taking out what was put in leaves nothing behind, however often. (Least and greatest values cannot be
taken back, and are not kept.)

Every load adds the states of the groups it touched, in a folder of its own; reading adds them up, and
:func:`fold` does so for good. A load that is repeated under its number replaces its folder.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.contract import quoted
from ledgerline.sinks.replacement import Replacement

#: Column that says whether a record comes (1) or goes (-1).
SIGN = "_sign"


@dataclass(frozen=True)
class Measure:
    """Rows that satisfy ``where`` (SQL), or the sum and mean of ``column`` over them, to ``scale`` decimals."""

    name: str
    column: str | None = None
    where: str | None = None
    scale: int = 2

    def states(self) -> list[tuple[str, Column]]:
        """The signed parts of the state: their names and aggregates."""
        sign = F.col(SIGN) if self.where is None else F.when(F.expr(self.where), F.col(SIGN)).otherwise(0)
        if self.column is None:
            return [(f"{self.name}_n", F.sum(sign).cast("bigint"))]
        value = F.col(quoted(self.column)).cast(f"decimal(28,{self.scale})")
        signed = (value * sign).cast(f"decimal(28,{self.scale})")
        present = F.when(value.isNotNull(), sign).otherwise(0)
        return [
            (f"{self.name}_n", F.sum(present).cast("bigint")),
            (f"{self.name}_sum", F.coalesce(F.sum(signed), F.lit(0)).cast(f"decimal(38,{self.scale})")),
        ]

    def results(self) -> list[Column]:
        if self.column is None:
            return [F.col(f"{self.name}_n").alias(self.name)]
        n, total = F.col(f"{self.name}_n"), F.col(f"{self.name}_sum")
        return [
            F.when(n > 0, total).alias(f"{self.name}_sum"),
            F.when(n > 0, total.cast("double") / n).alias(f"{self.name}_mean"),
        ]


def signed_changes(
    incoming: DataFrame, snapshot: DataFrame, key: Sequence[str], columns: Sequence[str], deleted: DataFrame | None = None
) -> DataFrame:
    """What incoming records, and deleted keys, change: old values with sign -1, new ones with 1.

    Incoming and snapshot have one record per key (:func:`~ledgerline.operators.incremental.latest_per_key`);
    records whose ``columns`` are as they were come and go nowhere. Only key and columns are moved. A key that
    is both incoming and deleted is deleted.
    """
    values = F.struct(*[F.col(quoted(c)) for c in columns])
    keyed = lambda df, prefix: [F.col(quoted(k)).alias(f"{prefix}{i}") for i, k in enumerate(key)]
    new = incoming.select(*keyed(incoming, "_new_"), values.alias("_new"))
    old = snapshot.select(*keyed(snapshot, "_old_"), values.alias("_old"))
    match = lambda a, b: reduce(Column.__and__, [F.col(f"{a}{i}").eqNullSafe(F.col(f"{b}{i}")) for i in range(len(key))])
    signed = lambda value, sign: F.struct(F.lit(sign).alias(SIGN), F.col(value).alias("_values"))
    if deleted is not None:
        gone = deleted.select(*keyed(deleted, "_gone_")).distinct()
        new = new.join(gone, match("_new_", "_gone_"), "left_anti")
    both = new.join(old, match("_new_", "_old_"), "left")
    moved = both.where(F.col("_old").isNull() | ~F.col("_new").eqNullSafe(F.col("_old")))
    each = F.filter(F.array(signed("_new", 1), signed("_old", -1)), lambda c: c["_values"].isNotNull())
    changes = moved.select(F.explode(each).alias("_change"))
    if deleted is not None:
        going = old.join(gone, match("_old_", "_gone_"), "left_semi")
        changes = changes.union(going.select(signed("_old", -1).alias("_change")))
    return changes.select(f"_change.{SIGN}", "_change._values.*")


def states_of(changes: DataFrame, by: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """The states of signed records per group, combined inside each task before they are moved."""
    parts = [("rows_n", F.sum(SIGN).cast("bigint")), *[s for m in measures for s in m.states()]]
    found = changes.groupBy(*[F.col(quoted(k)) for k in by]).agg(*[value.alias(name) for name, value in parts])
    return found.where(reduce(Column.__or__, [F.col(quoted(name)) != 0 for name, _ in parts]))


def add_changes(
    changes: DataFrame, path: str, by: Sequence[str], measures: Sequence[Measure], load: int
) -> None:
    """Add signed records to the summary under ``path`` as load number ``load``.

    For the first load give all records sign 1 (:func:`arriving`).
    """
    with Replacement(changes.sparkSession) as replaced:
        states_of(changes, by, measures).write.parquet(replaced.path(f"{path.rstrip('/')}/_load={load}"))


def arriving(df: DataFrame) -> DataFrame:
    """Every record as one that comes."""
    return df.withColumn(SIGN, F.lit(1))


def _added_up(spark: SparkSession, path: str, by: Sequence[str]) -> DataFrame:
    states = spark.read.parquet(path).drop("_load")
    names = [f.name for f in states.schema.fields if f.name not in by]
    kinds = {f.name: f.dataType for f in states.schema.fields}
    return states.groupBy(*[F.col(quoted(k)) for k in by]).agg(*[F.sum(quoted(n)).cast(kinds[n]).alias(n) for n in names])


def read_summary(spark: SparkSession, path: str, by: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """The groups that have rows, with each measure's results (a count's name; ``_sum`` and ``_mean``)."""
    groups = _added_up(spark, path, by).where("rows_n > 0")
    return groups.select(*[F.col(quoted(k)) for k in by], *[c for m in measures for c in m.results()])


def fold(spark: SparkSession, path: str, by: Sequence[str]) -> None:
    """Add all loads up into one, which takes the number of the last, and leave out empty groups."""
    loads = sorted(r[0] for r in spark.read.parquet(path).select("_load").distinct().collect())
    if len(loads) < 2:
        return
    with Replacement(spark) as replaced:
        folder = f"{replaced.path(path)}/_load={loads[-1]}"
        _added_up(spark, path, by).where("rows_n <> 0").write.parquet(folder)
