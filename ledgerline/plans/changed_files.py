"""Loads of new and changed files, with a ledger of every file taken.

The ledger is a table with a line for each file of each load: its path, length and change time as they
were listed, the rows it gave, and why it was taken (``new``, ``changed``, ``gone``, ``moved``). A run
compares the listing with each file's last line and takes only what differs. Typed rows carry their
file and load, one folder for each load. A row counts as long as its load is in the ledger and no later load
has its file, so a changed file's rows take the place of its old ones without touching a folder that
is already written, however large.

The ledger's lines are put in place last, by one rename: they are what makes a load count. A load that fails
leaves no line, and the folder it may have left is passed over by readers and replaced by the
next load. One run at a time may write to a ledger.

:func:`compact` moves the rows that still count out of loads that are mostly replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.contract import LENIENT, STRICT, Contract, check_policy
from ledgerline.errors import ContractViolation
from ledgerline.operators.incremental import latest_per_key
from ledgerline.operators.mapping import apply_contract, missing_columns, resolve
from ledgerline.plans.loads import _PLACE, _clustered_cells, _row_place, envelopes_to_raw
from ledgerline.scratch import discard
from ledgerline.sinks.replacement import Replacement
from ledgerline.sinks.tables import BYTES_PER_FILE, clustered, range_partitions
from ledgerline.sources.files import input_bytes, read_staged
from ledgerline.sources.json_rows import column_fields, parse_fields
from ledgerline.sources.long_documents import LONG_FILE_BYTES

_LINE = "_load bigint, file string, length bigint, changed_at timestamp, n_rows bigint, status string"
#: Columns of typed rows beside the contract's: where a row came from.
LINEAGE = ("_file", "_load")


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def _folder(path: str, load: int) -> str:
    return f"{path.rstrip('/')}/_load={load}"


def ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """Every line: _load, file, length, changed_at, n_rows, status."""
    schema = T.StructType.fromDDL(_LINE)
    if not _exists(spark, ledger_path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(ledger_path).select(*schema.names)


def last_lines(spark: SparkSession, ledger_path: str) -> DataFrame:
    """The line that counts for each file."""
    return latest_per_key(ledger(spark, ledger_path), ["file"], ["_load"])


def _listed(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The files under a path as their file system lists them; none is opened."""
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.load(paths).select(
        F.col("_metadata.file_path").alias("file"),
        "path",
        "length",
        F.col("modificationTime").alias("changed_at"),
    )


def pending(spark: SparkSession, path: str | Sequence[str], ledger_path: str, drop_gone: bool = False) -> DataFrame:
    """Files whose listing differs from the ledger: file, path, length, changed_at, status.

    With ``drop_gone`` also those of the ledger that are no longer listed.
    """
    held = last_lines(spark, ledger_path).where("status <> 'gone'").select(
        F.col("file").alias("held"), F.col("length").alias("held_length"), F.col("changed_at").alias("held_at")
    )
    here = _listed(spark, path)
    both = here.join(held, here["file"] == held["held"], "full")
    same = (F.col("length") == F.col("held_length")) & (F.col("changed_at") == F.col("held_at"))
    status = F.when(F.col("held").isNull(), "new").when(F.col("file").isNull(), "gone").when(~same, "changed")
    found = both.withColumn("status", status).where(F.col("status").isNotNull())
    if not drop_gone:
        found = found.where("status <> 'gone'")
    gone = F.col("status") == "gone"
    return found.select(
        F.coalesce("file", "held").alias("file"),
        "path",
        F.when(gone, F.col("held_length")).otherwise(F.col("length")).alias("length"),
        F.when(gone, F.col("held_at")).otherwise(F.col("changed_at")).alias("changed_at"),
        "status",
    )


def _last_load(spark: SparkSession, ledger_path: str) -> int:
    return ledger(spark, ledger_path).agg(F.max("_load")).first()[0] or 0


#: The typed rows of some files with their ``_file``: (paths, load, what is being replaced) -> rows.
_Take = Callable[[list[str], int, Replacement], DataFrame]


def _run(
    spark: SparkSession, path: str | Sequence[str], target_path: str, ledger_path: str, drop_gone: bool,
    max_files: int, take: _Take,
) -> list[int]:
    """Load until nothing is pending; returns the numbers of the loads.

    The names of a load's files pass the driver, as they do in any listing; a load takes at most
    ``max_files`` of them.
    """
    loads = []
    while True:
        files = pending(spark, path, ledger_path, drop_gone).orderBy("file").limit(max_files).collect()
        if not files:
            return loads
        load = _last_load(spark, ledger_path) + 1
        with Replacement(spark) as replaced:
            # A name is taken as it is, not as a pattern.
            paths = [re.sub(r"([\[\]{}*?\\])", r"\\\1", f["path"]) for f in files if f["status"] != "gone"]
            written = replaced.path(_folder(target_path, load))
            if paths:
                take(paths, load, replaced).write.parquet(written)
            else:  # an empty folder keeps the loads numbered alike in both places
                spark.createDataFrame([], "_file string").write.parquet(written)
            _write_lines(spark, files, written, replaced.path(_folder(ledger_path, load)))
        loads.append(load)


def _write_lines(spark: SparkSession, files: list[Row], written: str, path: str) -> None:
    """The ledger's lines, with the rows each file has in what was written."""
    taken = spark.createDataFrame(
        [(f["file"], f["length"], f["changed_at"], f["status"]) for f in files],
        "file string, length bigint, changed_at timestamp, status string",
    )
    rows = spark.read.parquet(written).groupBy("_file").agg(F.count(F.lit(1)).alias("n"))
    lines = taken.join(rows, F.col("file") == F.col("_file"), "left")
    lines.select("file", "length", "changed_at", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_rows"), "status").write.parquet(path)


def load_changed_files(
    spark: SparkSession,
    path: str | Sequence[str],
    contract: Contract,
    target_path: str,
    ledger_path: str,
    policy: str = STRICT,
    payload: str | None = None,
    drop_gone: bool = False,
    max_files_per_load: int = 100_000,
    bytes_per_file: int = BYTES_PER_FILE,
) -> list[int]:
    """Load the staged Parquet files under ``path`` that are new or have changed since the last run.

    Rows are raw rows, or hold a JSON object in the column ``payload``. With ``drop_gone`` the rows
    of files that are no longer there stop counting. Returns the numbers of the loads made, none when
    nothing has changed; :func:`current_rows` reads the result.
    """
    check_policy(policy)

    def take(paths: list[str], load: int, replaced: Replacement) -> DataFrame:
        staged = read_staged(spark, paths)
        if payload is None and policy == STRICT:
            if missing := [s for s in contract.sources if s not in staged.columns]:
                raise ContractViolation(f"contract {contract.name!r}: missing columns {missing}")
        rows = staged.select("*", F.col("_metadata.file_path").alias("_file"), *_row_place())
        keep = ("_file", *_PLACE)
        if payload is None:
            cells = column_fields(rows, contract, keep=keep)
        else:
            cells = parse_fields(rows, payload, contract, policy, keep=keep)
        partitions = range_partitions(spark, input_bytes(spark, paths), bytes_per_file)
        placed = _clustered_cells(cells, contract, policy, {c.target: c.source for c in contract.columns}, partitions)
        return apply_contract(placed, contract, policy, keep=["_file"])

    return _run(spark, path, target_path, ledger_path, drop_gone, max_files_per_load, take)


def load_changed_documents(
    spark: SparkSession,
    path: str | Sequence[str],
    contract: Contract,
    raw_path: str,
    target_path: str,
    ledger_path: str,
    policy: str = LENIENT,
    drop_gone: bool = False,
    max_files_per_load: int = 10_000,
    long_file_bytes: int = LONG_FILE_BYTES,
    bytes_per_file: int = BYTES_PER_FILE,
) -> list[int]:
    """As :func:`load_changed_files`, for envelope documents: each load's raw copy, and what a lenient load
    refuses, lie in a folder of its own (``_load=<number>``) under ``raw_path`` and ``<raw_path>-refused``."""
    check_policy(policy)

    def take(paths: list[str], load: int, replaced: Replacement) -> DataFrame:
        raw_at = replaced.path(_folder(raw_path, load))
        refused = replaced.path(_folder(raw_path.rstrip("/") + "-refused", load)) if policy == LENIENT else None
        envelopes_to_raw(
            spark, paths, raw_at, policy, long_file_bytes=long_file_bytes, quarantine_path=refused, lineage=True,
            fallback=contract.sources if policy == LENIENT else (),
            required=contract.columns if policy == STRICT else (),
        )
        raw = spark.read.parquet(raw_at)
        if policy == STRICT and (missing := missing_columns(contract, raw.columns)):
            raise ContractViolation(f"contract {contract.name!r}: missing columns {missing}")
        fed_by = resolve(contract, raw.columns)
        used = [F.col(f"`{name}`") for name in fed_by.values() if name is not None]
        partitions = range_partitions(spark, input_bytes(spark, raw_at), bytes_per_file)
        cells = raw.select(*used, "_file", *_row_place())
        return apply_contract(_clustered_cells(cells, contract, policy, fed_by, partitions), contract, policy, keep=["_file"])

    return _run(spark, path, target_path, ledger_path, drop_gone, max_files_per_load, take)


def _replaced_lines(spark: SparkSession, ledger_path: str) -> DataFrame:
    """(file, _load) of the lines that a later line of the same file has replaced."""
    lines = ledger(spark, ledger_path).select("file", "_load", "n_rows")
    last = lines.groupBy("file").agg(F.max("_load").alias("last"))
    return lines.join(last, "file").where(F.col("_load") < F.col("last")).select("file", "_load", "n_rows")


def current_rows(spark: SparkSession, contract: Contract, target_path: str, ledger_path: str, policy: str = STRICT) -> DataFrame:
    """The rows that count: the contract's columns and ``_file``, ``_load``.

    The loads in the ledger are chosen by folder; only if some line has been replaced are its rows left
    out, by a join with the replaced lines (one for each file loaded again).
    """
    schema = T.StructType([*contract.schema(policy).fields, T.StructField("_file", T.StringType())])
    loads = sorted(r[0] for r in ledger(spark, ledger_path).select("_load").distinct().collect())
    if not loads:
        return spark.createDataFrame([], schema.add("_load", "long"))
    return _counting(spark, schema, target_path, ledger_path, loads)


def _counting(spark: SparkSession, schema: T.StructType, target_path: str, ledger_path: str, loads: list[int]) -> DataFrame:
    with_load = T.StructType([*schema.fields, T.StructField("_load", T.LongType())])
    rows = spark.read.schema(with_load).parquet(target_path).where(F.col("_load").isin(loads)).select(*with_load.names)
    old = _replaced_lines(spark, ledger_path).where("n_rows > 0")
    if old.isEmpty():
        return rows
    old = old.select(F.col("file").alias("_old_file"), F.col("_load").alias("_old_load"))
    replaced = (F.col("_file") == F.col("_old_file")) & (F.col("_load") == F.col("_old_load"))
    return rows.join(old, replaced, "left_anti")


def load_report(spark: SparkSession, ledger_path: str) -> DataFrame:
    """Per load: its files by status, its rows, and how many of them still count."""
    lines = ledger(spark, ledger_path)
    last = lines.groupBy("file").agg(F.max("_load").alias("last"))
    told = lines.join(last, "file")
    count = lambda status: F.count_if(F.col("status") == status).alias(f"n_{status}")
    return told.groupBy("_load").agg(
        *[count(s) for s in ("new", "changed", "gone", "moved")],
        F.sum("n_rows").alias("n_rows"),
        F.sum(F.when(F.col("_load") == F.col("last"), F.col("n_rows")).otherwise(0)).alias("n_current"),
    )


def compact(
    spark: SparkSession, contract: Contract, target_path: str, ledger_path: str, policy: str = STRICT,
    most_replaced: float = 0.3, bytes_per_file: int = BYTES_PER_FILE,
) -> int | None:
    """Move what still counts out of loads of which more than a share ``most_replaced`` of the rows has been
    replaced, into one new load, and remove their folders; returns the new load's number, if any.

    Their lines follow the rows (status ``moved``), so a file stays known as it was listed. Until the new lines
    are in place the old folders count, afterwards the new one does.
    """
    shares = load_report(spark, ledger_path).where("n_rows > 0")
    worn = sorted(r[0] for r in shares.where(F.col("n_current") < (1 - most_replaced) * F.col("n_rows")).select("_load").collect())
    worn = [n for n in worn if _exists(spark, _folder(target_path, n))]
    if not worn:
        return None
    schema = T.StructType([*contract.schema(policy).fields, T.StructField("_file", T.StringType())])
    rows = _counting(spark, schema, target_path, ledger_path, worn).drop("_load")
    load = _last_load(spark, ledger_path) + 1
    size = input_bytes(spark, [_folder(target_path, n) for n in worn])
    by = [*contract.cluster_by] or ["_file"]
    with Replacement(spark) as replaced:
        written = replaced.path(_folder(target_path, load))
        clustered(rows, by, partitions=range_partitions(spark, size, bytes_per_file)).write.parquet(written)
        lines = last_lines(spark, ledger_path).where(F.col("_load").isin(worn) & (F.col("status") != "gone"))
        lines.select("file", "length", "changed_at", "n_rows", F.lit("moved").alias("status")).write.parquet(
            replaced.path(_folder(ledger_path, load))
        )
    discard(spark, *[_folder(target_path, n) for n in worn])
    spark.catalog.refreshByPath(target_path)
    return load
