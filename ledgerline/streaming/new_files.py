"""Incremental loads: every run takes the files that arrived since the last one.

The file source remembers in its checkpoint which files it has read, and each batch is
committed once, so a run that is stopped and repeated neither loses nor doubles rows.
Keep checkpoint and target in the folders the cluster shares.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerline.contract import LENIENT, STRICT, Contract, check_policy
from ledgerline.errors import ContractViolation
from ledgerline.operators.mapping import apply_contract, missing_columns
from ledgerline.plans.loads import load_envelopes
from ledgerline.sources.files import read_staged
from ledgerline.sources.json_rows import extract
from ledgerline.sources.long_documents import LONG_FILE_BYTES

_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def _run(df: DataFrame, target_path: str, checkpoint: str, partition_by: Sequence[str]) -> StreamingQuery:
    writer = df.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.option("checkpointLocation", checkpoint).start(target_path)
    query.awaitTermination()
    return query


def load_new_files(
    spark: SparkSession,
    path: str,
    contract: Contract,
    target_path: str,
    checkpoint: str,
    policy: str = LENIENT,
    payload: str | None = None,
    partition_by: Sequence[str] = (),
    max_files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append the typed rows of new Parquet files under ``path``; returns when all are in.

    Rows are raw rows, or hold a JSON object in the column ``payload``. The contract's columns
    are read from every file that has them, also from files that come later; a strict load
    ends where no file present has one.
    """
    check_policy(policy)
    reader = spark.readStream.schema(_incoming_schema(spark, path, contract, policy, payload))
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    incoming = reader.parquet(path)
    if payload is not None:
        typed = extract(incoming, payload, contract, policy)
    else:
        typed = apply_contract(incoming, contract, policy)
    return _run(typed, target_path, checkpoint, partition_by)


def _incoming_schema(
    spark: SparkSession, path: str, contract: Contract, policy: str, payload: str | None
) -> T.StructType:
    """The columns a load needs, typed as the files present have them, else as text."""
    if payload is not None:
        return T.StructType().add(payload, "string")
    found = read_staged(spark, path).schema
    absent = missing_columns(contract, found.names)
    if absent and policy == STRICT:
        raise ContractViolation(f"contract {contract.name!r}: missing columns {absent}")
    needed = {*contract.sources, *contract.targets}
    fields = [f for f in found.fields if f.name in needed]
    return T.StructType(fields + [T.StructField(name, T.StringType()) for name in absent])


def load_new_documents(
    spark: SparkSession,
    path: str,
    contract: Contract,
    raw_path: str,
    target_path: str,
    checkpoint: str,
    quarantine_path: str,
    policy: str = LENIENT,
    max_files_per_batch: int = 10000,
    long_file_bytes: int = LONG_FILE_BYTES,
) -> StreamingQuery:
    """Load new envelope documents as :func:`load_envelopes` does; returns when all are in.

    The stream carries the names of the new files. Every batch of them is one load, into
    folders of its own (``load=<batch>``) under the raw, typed and quarantine paths; a
    batch that is repeated replaces its folders. Raw folders differ in their columns where
    documents do: :func:`~ledgerline.sources.files.read_staged` reads them with all.
    """
    check_policy(policy)

    def load(files: DataFrame, batch: int) -> None:
        # A name is taken as it is, not as a pattern.
        found = [re.sub(r"([\[\]{}*?\\])", r"\\\1", row["path"]) for row in files.collect()]
        if not found:
            return
        load_envelopes(
            spark, found, contract, f"{raw_path}/load={batch}", f"{target_path}/load={batch}",
            policy=policy, long_file_bytes=long_file_bytes,
            quarantine_path=f"{quarantine_path}/load={batch}",
        )

    names = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("maxFilesPerTrigger", max_files_per_batch)
        .load(path)
        .select("path")
    )
    writer = names.writeStream.foreachBatch(load).trigger(availableNow=True)
    query = writer.option("checkpointLocation", checkpoint).start()
    query.awaitTermination()
    return query
