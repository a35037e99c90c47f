"""Grouped summaries and previews of typed tables.

All groupings are plain aggregates: they combine inside each task before the
shuffle, so a group that holds most rows costs no more than a small one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.contract import quoted


def _keys(keys: str | list[str]) -> list[Column]:
    return [F.col(quoted(k)) for k in ([keys] if isinstance(keys, str) else keys)]


def avg_by(
    df: DataFrame, keys: str | list[str], value: str, alias: str, positive_only: bool = True
) -> DataFrame:
    """Mean of a column per group, highest first; zero and negative values left out."""
    by = _keys(keys)
    column = F.col(quoted(value))
    rows = df.where(column > 0) if positive_only else df
    return (
        rows.groupBy(*by)
        .agg(F.avg(column).alias(alias))
        .orderBy(F.col(quoted(alias)).desc(), *by)
    )


def count_by(
    df: DataFrame,
    keys: str | list[str],
    alias: str = "total",
    where: Column | None = None,
    most_frequent_first: bool = False,
) -> DataFrame:
    """Rows per group (NULL is a group of its own), optionally filtered and ranked."""
    by = _keys(keys)
    rows = df if where is None else df.where(where)
    counted = rows.groupBy(*by).agg(F.count(F.lit(1)).alias(alias))
    return counted.orderBy(F.col(quoted(alias)).desc(), *by) if most_frequent_first else counted


def trend_by(df: DataFrame, key: str, alias: str = "total") -> DataFrame:
    """Rows per value of a column in ascending order, NULL left out."""
    column = F.col(quoted(key))
    return (
        df.where(column.isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias(alias))
        .orderBy(column)
    )


def row_count(df: DataFrame, alias: str = "n") -> DataFrame:
    """The number of rows, as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def preview(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows by some columns: a top-n, not a full sort."""
    return df.orderBy(*_keys(order)).limit(n)
