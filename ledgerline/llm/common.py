"""What the operators share: Arrow batches in blocks of bounded size, and written tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.scratch import discard, scratch_path

#: Bytes of text a task holds in arrays at a time; a single longer text is a block of its own.
BLOCK_BYTES = 4 << 20
#: Rows for which a written table gets a file more, where their number is known.
FILE_ROWS = 20_000
#: Rows up to which a joined table may pass through the driver to all tasks.
SENT_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_text(df: DataFrame, key: str, text: str) -> DataFrame:
    """The key and the text alone, a null text as the empty one; other columns do not come along."""
    return df.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )


def text_bytes(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def blocks(
    batches: Iterator[pa.RecordBatch], name: str = "text", limit: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose values of one text column come to ``limit`` bytes at most.

    Memory that Arrow holds for nothing goes back after each, or a worker keeps it from task to task.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy().astype(np.int64)
        block = np.cumsum(sizes) // limit
        cuts = np.flatnonzero(np.diff(block)) + 1
        start = 0
        for end in [*cuts.tolist(), batch.num_rows]:
            yield batch.slice(start, end - start)
            pa.default_memory_pool().release_unused()
            start = end


def by_block(
    work: Callable[[pa.RecordBatch], pa.RecordBatch], name: str = "text"
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that works block by block."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, name):
            yield work(block)

    return task


def written(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """The rows written to the shared folder and read again: lineage ends here, and a lost
    executor costs nothing that is already written.

    ``rows``, if known, is how many they are at most. As many files as these ask for are then written,
    though there be more shuffle partitions: each file has its executor start processes that set its mode.
    """
    if rows is not None:
        df = df.coalesce(max(-(-rows // FILE_ROWS), 1))
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    _WRITTEN.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def merged(df: DataFrame, rows: int) -> DataFrame:
    """A table for a join, of ``rows`` at most: if these are many, the join sorts and merges.

    Spark would broadcast what it takes to be small. It goes by the files, which may compress well, and keeps to that
    when the rows of an aggregate turn out to be more.
    """
    return df.hint("merge") if rows > SENT_ROWS else df


#: Tables written so far, for those who know when they are read no more.
_WRITTEN: list[str] = []


def n_written() -> int:
    return len(_WRITTEN)


def drop_written(spark: SparkSession, since: int, keep: int = 0) -> None:
    """Remove the tables written after the first ``since``, but for the last ``keep``."""
    end = len(_WRITTEN) - keep
    discard(spark, *_WRITTEN[since:end])
    del _WRITTEN[since:end]
