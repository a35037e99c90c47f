"""Raw copies, typed tables, their layout, and counts taken while writing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.contract import STRICT, Contract, quoted

#: Parquet input per range of a clustered table; some four times as much in memory.
BYTES_PER_FILE = 128 << 20


def clustered(
    df: DataFrame,
    keys: Sequence[str | Column],
    spread: Sequence[str | Column] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Rows range-partitioned and sorted by the keys, ready to be written.

    Finding the ranges runs the input once more, so bring it here before costly
    conversions and give the keys as expressions where they need one.

    ``spread`` settles ties in the range split, so that rows sharing one hot key are
    divided between tasks yet stay next to each other. It defaults to a hash of the
    whole row; give a row number where many rows are full copies.

    Each partition is sorted by one task and becomes one file. Give their number from the
    bytes at hand (:func:`range_partitions`). Without it the session's number of shuffle
    partitions holds: adaptive execution joins small ones but splits none.
    """
    by = [F.col(quoted(k)) if isinstance(k, str) else k for k in keys]
    ties = list(spread) or [F.xxhash64(*[F.col(quoted(c)) for c in df.columns])]
    if partitions is None:
        ranged = df.repartitionByRange(*by, *ties)
    else:
        ranged = df.repartitionByRange(partitions, *by, *ties)
    return ranged.sortWithinPartitions(*by)


def range_partitions(spark: SparkSession, n_bytes: int, bytes_per_file: int = BYTES_PER_FILE) -> int:
    """How many ranges give files of about ``bytes_per_file`` of input.

    Small input is spread over the cores at hand, down to a megabyte each.
    """
    spread = min(spark.sparkContext.defaultParallelism, -(-n_bytes // min(bytes_per_file, 1 << 20)))
    return max(1, spread, -(-n_bytes // bytes_per_file))


def rebalanced(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows brought together by key for a partitioned write.

    Adaptive execution splits the shuffle partitions of large keys and joins those of
    small ones, so a hot key is written by many tasks and a rare one by few.
    """
    return df.hint("rebalance", *[F.col(quoted(k)) for k in keys])


def write_raw(df: DataFrame, path: str) -> None:
    """A full Parquet copy, replacing what the path held."""
    df.write.mode("overwrite").parquet(path)


def write_table(
    df: DataFrame,
    path: str | None = None,
    table: str | None = None,
    fmt: str = "parquet",
    mode: str = "overwrite",
    options: dict[str, str] | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Write to a path, a catalog table, or a connector addressed by its options alone."""
    writer = df.write.format(fmt).mode(mode).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if table is not None:
        writer.saveAsTable(table)
    elif path is not None:
        writer.save(path)
    else:
        writer.save()


def counted(df: DataFrame, name: str, *extra: Column) -> tuple[DataFrame, Observation]:
    """The rows with a row count (and further aggregates) taken as they are written.

    Apply it last, right before the write: a shuffle by range runs its input twice.
    """
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *extra), seen


def create_table(
    spark: SparkSession,
    contract: Contract,
    table: str,
    policy: str = STRICT,
    fmt: str = "parquet",
    location: str | None = None,
) -> None:
    """Create or replace the empty typed table of a contract, with its limits and comment."""
    columns = ", ".join(f"{quoted(c.target)} {c.sql_type(policy)}" for c in contract.columns)
    statement = f"CREATE TABLE {table} ({columns}) USING {fmt}"
    if location is not None:
        statement += f" LOCATION '{_escaped(location)}'"
    if contract.comment is not None:
        statement += f" COMMENT '{_escaped(contract.comment)}'"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(statement)


def _escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def insert_by_name(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """Insert matching columns by name; text and numbers beyond a column's limit are errors."""
    spark = df.sparkSession
    verb = "INSERT OVERWRITE" if overwrite else "INSERT INTO"
    spark.sql(f"{verb} {table} BY NAME SELECT * FROM {{incoming}}", incoming=df)
