"""Token ids as Parquet lists: dictionary-coded ids, delta-coded positions, bounded row groups.

Documents are dealt by ranges of their key and written in its order, one file a range. Token ids
are a list column whose values Parquet keeps as indexes into a dictionary; document ids, starts
and lengths are delta-coded. Row groups and pages are bounded, and every page has an entry in
the file's column and offset index, so a reader takes single documents or the lengths alone
without touching other pages. ``part`` numbers the ranges; a document's place in the whole
stream is the sum of the lengths of earlier parts plus its start within its own.

Rows: a null text is an empty one and has the end id only; null keys come first; rows with equal
keys are ordered by their text, and repeated rows are kept; an empty table gives empty files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import blocks, keyed_text
from ledgerline.llm.tokens import VOCABULARY, vocabulary_path, word_ids

END_ID = 2
#: A reader's batch ends with its row group, and holds the ids of all its rows side by side.
ROW_GROUP_BYTES = 1 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2_000
#: Rows of whole texts that a task holds side by side while files are written, at most: those the
#: reader decodes at once, and those of a batch for Python. Both are thousands else, in arrays that
#: grow by doubling and have the executor's heap grow with them.
BATCH_ROWS = {"spark.sql.parquet.columnarReaderBatchSize": 128, "spark.sql.execution.arrow.maxRecordsPerBatch": 1_000}
#: Rows whose ids go back from Python at a time.
SENT_ROWS = 100

#: Parquet's own settings, under Parquet's own names.
LAYOUT = {
    "parquet.block.size": str(ROW_GROUP_BYTES),
    "parquet.page.size": str(PAGE_BYTES),
    "parquet.page.row.count.limit": str(PAGE_ROWS),
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#ids.list.element": "true",
    "compression": "zstd",
}


def encoded(
    df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, end_id: int = END_ID
) -> DataFrame:
    """Per row, in order of the key within ranges: doc_id, part, start (in the part), n_tokens, ids."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_ids(vocabulary_path(vocabulary))
        part, start = TaskContext.get().partitionId(), 0
        for block in blocks(batches):
            ids, counts = table.encode(block.column("text"), end_id)
            ends = np.cumsum(counts)
            offsets = np.concatenate(([0], ends)).astype(np.int32)
            values = pa.array(ids.astype(np.int32))
            found = pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"),
                    pa.array(np.full(len(counts), part, np.int32)),
                    pa.array(start + ends - counts),
                    pa.array(counts),
                    pa.ListArray.from_arrays(pa.array(offsets), values),
                ],
                ["doc_id", "part", "start", "n_tokens", "ids"],
            )
            for i in range(0, len(counts), SENT_ROWS):
                yield found.slice(i, SENT_ROWS)
            start += int(ends[-1])

    return (
        keyed_text(df, key, text)
        .repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(task, "doc_id long, part int, start long, n_tokens long, ids array<int>")
    )


def write_tokens(df: DataFrame, path: str, **settings) -> None:
    with _small_batches(df.sparkSession):
        encoded(df, **settings).write.options(**LAYOUT).parquet(path)


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """The session with batches of ``BATCH_ROWS`` or what it has, if less; as it was afterwards."""
    before = {name: spark.conf.get(name, None) for name in BATCH_ROWS}
    try:
        for name, rows in BATCH_ROWS.items():
            if not 0 < int(spark.conf.get(name)) < rows:
                spark.conf.set(name, rows)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_tokens`` wrote, with ``start`` counted over the whole stream.

    The lengths of the parts are read on their own first: two columns, no token.
    """
    rows = spark.read.parquet(path)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(parts), "part").withColumn("start", F.col("base") + F.col("start")).drop("base")


def digests(tokens: DataFrame) -> DataFrame:
    """Per row: doc_id, start, n_tokens, ids_crc32, both of the latter from the ids read."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            values = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
            edges = ids.offsets.to_numpy()
            crc = [zlib.crc32(values[a:b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("start"),
                    pa.array(np.diff(edges).astype(np.int64)),
                    pa.array(crc, pa.int64()),
                ],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    wanted = tokens.select("doc_id", "start", "ids")
    return wanted.mapInArrow(task, "doc_id long, start long, n_tokens long, ids_crc32 long")
