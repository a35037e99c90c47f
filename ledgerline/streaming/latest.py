"""The latest record per key, kept up to date by a stream.

The stream holds, for each key, the order of the record it last let through: a small keyed state in
RocksDB, which survives restarts with the checkpoint. A record goes on to the snapshot only if it is not older than
that, so late and repeated records cost no merge. Records behind the watermark are left out, and
a key's state is dropped by a timer once the watermark is ``forget`` beyond its record: whatever may
still come is newer then.

Before they are moved, rows are reduced to the latest of each key within every Arrow batch, so that a key
with a large share of all rows sends one row for each batch of them. This is the library's only
Python code that sees rows; Spark's keyed state has no other interface here.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ledgerline.contract import quoted
from ledgerline.plans.changed_files import _exists
from ledgerline.sinks.bucketed import create_snapshot, merge_into_snapshot

# Its functions travel to the executors with the task, which need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _rank(values: Sequence) -> tuple:
    """Order with NULL lowest, as the aggregates of the library have it."""
    return tuple((v is not None, v) for v in values)


def latest_of_batches(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of the rows of every Arrow batch the latest of each key; for batch and streaming input."""
    names = [*key, *order]
    n_key = len(key)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best: dict[tuple, tuple] = {}
            for i, cells in enumerate(zip(*[batch.column(n).to_pylist() for n in names], strict=True)):
                rank = (*_rank(cells[n_key:]), i)
                if cells[:n_key] not in best or rank > best[cells[:n_key]]:
                    best[cells[:n_key]] = rank
            yield batch.take(pa.array(sorted(rank[-1] for rank in best.values()), pa.int64()))

    return rows.mapInArrow(work, rows.schema)


class _Latest(StatefulProcessor):
    """Lets a record through that is not older than the last one of its key."""

    def __init__(self, ranks: list[str], state: T.StructType, forget_ms: int):
        self.ranks, self.state, self.forget_ms = ranks, state, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", self.state)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        newest = max(rows, key=lambda r: _rank([r[c] for c in self.ranks]))
        order = tuple(newest[c] for c in self.ranks)
        held = self.last.get() if self.last.exists() else None
        if held is not None and _rank(order) < _rank(held):
            return
        self.last.update(order)
        if order[0] is not None:
            # An earlier timer of the same key finds a newer record and leaves it.
            self.handle.registerTimer(order[0] // 1000 + self.forget_ms)
        yield newest

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        if self.last.exists() and self.last.get()[0] // 1000 + self.forget_ms <= due:
            self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def _duration_ms(rows: DataFrame, duration: str) -> int:
    micros = rows.sparkSession.sql(
        f"SELECT cast(unix_micros(TIMESTAMP'1970-01-01 00:00:00Z' + INTERVAL {duration}) AS bigint) AS n"
    )
    return micros.first()["n"] // 1000


def keep_latest(
    rows: DataFrame,
    key: list[str],
    order: list[str],
    snapshot_path: str,
    checkpoint: str,
    late: str = "7 days",
    forget: str = "7 days",
    n_buckets: int = 64,
) -> StreamingQuery:
    """Merge the latest record per key of a stream into a snapshot; returns when all that is there is in.

    ``order`` begins with the timestamp the records are about; further columns settle ties, and
    records of equal order replace each other. A record more than ``late`` behind the newest one of earlier
    batches is left out. Keys keep their state for ``forget`` beyond that. A snapshot is a table of
    :mod:`~ledgerline.sinks.bucketed`, made by the first batch.

    A batch that is repeated merges the same records once more, which changes nothing.
    """
    spark = rows.sparkSession
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    if not isinstance(kinds[order[0]], T.TimestampType):
        raise TypeError(f"{order[0]!r} is no timestamp, and watermarks need one")
    # Instants go to the state as numbers, which no time zone changes.
    ranks = {
        f"_rank_{i}": F.unix_micros(quoted(c)) if isinstance(kinds[c], T.TimestampType) else F.col(quoted(c))
        for i, c in enumerate(order)
    }
    ranked = latest_of_batches(rows.withColumns(ranks), key, list(ranks)).withWatermark(order[0], late)
    state = T.StructType([T.StructField(n, ranked.schema[n].dataType) for n in ranks])
    changes = ranked.groupBy(*[F.col(quoted(k)) for k in key]).transformWithState(
        statefulProcessor=_Latest(list(ranks), state, _duration_ms(rows, forget)),
        outputStructType=ranked.schema, outputMode="Update", timeMode="EventTime",
    ).drop(*ranks)

    def merge(batch: DataFrame, number: int) -> None:
        if _exists(spark, f"{snapshot_path}/layout"):
            merge_into_snapshot(spark, snapshot_path, batch)
        else:
            create_snapshot(batch, snapshot_path, key, order, n_buckets)

    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)  # read once, as the query starts
    try:
        writer = changes.writeStream.foreachBatch(merge).outputMode("update").trigger(availableNow=True)
        query = writer.option("checkpointLocation", checkpoint).start()
    finally:
        spark.conf.set(_PROVIDER, before)
    query.awaitTermination()
    return query
