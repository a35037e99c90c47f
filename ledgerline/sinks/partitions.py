"""Loads that replace the partitions they bring, and no others.

The rows of a load are written beside the table, a folder for each partition, and every one of these takes the place
of the partition of its name when all are complete; if one cannot, all are put back. Partitions the
load does not bring are not opened. Partition columns may follow from a timestamp (its month, say), so
that a month that is loaded again replaces that month.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.contract import quoted
from ledgerline.sinks.replacement import Replacement
from ledgerline.sinks.tables import rebalanced

#: Texts that sort as the times they stand for, to name partitions by.
MONTH, DAY, YEAR = "yyyy-MM", "yyyy-MM-dd", "yyyy"


def part_of(column: str, unit: str = MONTH) -> Column:
    """The month (day, year) of a timestamp or date, as a text."""
    return F.date_format(F.col(quoted(column)).cast("timestamp_ntz"), unit)


def replace_partitions(
    df: DataFrame, path: str, by: Sequence[str], derived: Mapping[str, tuple[str, str]] | None = None
) -> None:
    """Write rows into a partitioned folder, replacing the partitions they belong to.

    ``by`` names the partition columns; ``derived`` those among them that follow from another column, as
    ``{"month": ("CREATED_AT", MONTH)}``. The rows of one load are all there is of its partitions afterwards.
    """
    for name, (column, unit) in (derived or {}).items():
        df = df.withColumn(name, part_of(column, unit))
    with Replacement(df.sparkSession) as replaced:
        rebalanced(df, by).write.partitionBy(*by).parquet(replaced.partitions(path, len(by)))


def within(df: DataFrame, column: str, partition: str, start: str, end: str, unit: str = MONTH) -> DataFrame:
    """Rows with ``start <= column < end`` (timestamps as text), from the partitions these lie in.

    The second condition follows from the first, but only said does it reach the listing of folders.
    """
    at = lambda text: F.lit(text).cast("timestamp_ntz")
    name = lambda text: F.date_format(at(text), unit)
    value, place = F.col(quoted(column)), F.col(quoted(partition))
    return df.where((value >= at(start)) & (value < at(end)) & (place >= name(start)) & (place <= name(end)))
