"""The two loads: envelope documents, and rows holding JSON objects."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.contract import LENIENT, STRICT, ColumnSpec, Contract, check_policy, quoted
from ledgerline.errors import ContractViolation
from ledgerline.operators.mapping import apply_contract, missing_columns, resolve, typed_cell
from ledgerline.sinks.curve import curve_clustered
from ledgerline.sinks.replacement import Replacement
from ledgerline.sinks.tables import (
    BYTES_PER_FILE,
    clustered,
    counted,
    create_table,
    insert_by_name,
    range_partitions,
    write_raw,
    write_table,
)
from ledgerline.sources.envelope import (
    CORRUPT,
    OK,
    RAGGED,
    check_names,
    envelope_rows,
    first_header,
    quarantined_rows,
    read_envelopes,
    to_raw,
)
from ledgerline.sources.files import input_bytes, read_staged
from ledgerline.sources.json_rows import column_fields, malformed_rows, parse_fields
from ledgerline.sources.long_documents import LONG_FILE_BYTES, cut_documents


@dataclass(frozen=True)
class LoadMetrics:
    """What a load did."""

    n_rows: int
    n_source_columns: int
    n_columns: int
    target: str
    n_ragged: int = 0
    n_corrupt: int = 0
    missing: tuple[str, ...] = ()
    extra: tuple[str, ...] = ()
    raw_path: str | None = None
    quarantine_path: str | None = None

    def as_dataframe(self, spark: SparkSession) -> DataFrame:
        """The metrics as a one-row table."""
        schema = (
            "n_rows bigint, n_source_columns int, n_columns int, target string, "
            "n_ragged bigint, n_corrupt bigint, missing array<string>, extra array<string>, "
            "raw_path string, quarantine_path string"
        )
        lists = {"missing": list(self.missing), "extra": list(self.extra)}
        return spark.createDataFrame([{**asdict(self), **lists}], schema)


def envelopes_to_raw(
    spark: SparkSession,
    path: str | list[str],
    raw_path: str,
    policy: str = LENIENT,
    names: Sequence[str] = (),
    one_per_line: bool = False,
    long_file_bytes: int = LONG_FILE_BYTES,
    quarantine_path: str | None = None,
    lineage: bool = False,
    fallback: Sequence[str] = (),
    required: Sequence[ColumnSpec] = (),
) -> tuple[list[str], dict[str, int]]:
    """Write the all-string copy of the documents; returns its columns and row counts.

    The documents are read once: names start from ``names`` or from the first header
    found, and the write reports headers that hold others. Only then is it repeated, with
    all of them. Files above ``long_file_bytes`` are cut between tasks.

    A lenient load always keeps what it refuses: in ``quarantine_path``, or beside the copy
    in ``<raw_path>-refused``, which hold the refused rows of this load alone. A load that
    fails leaves both as they were.
    """
    with Replacement(spark) as replaced:
        return _raw_copy(
            spark, path, replaced.path(raw_path), policy, names, one_per_line, long_file_bytes,
            _refused(replaced, raw_path, quarantine_path, policy), lineage, fallback, required,
        )


def refused_beside(raw_path: str) -> str:
    """Where a lenient load keeps what it refuses unless told otherwise."""
    return raw_path.rstrip("/") + "-refused"


def _refused(replaced: Replacement, raw_path: str, given: str | None, policy: str) -> str | None:
    # A strict load refuses nothing: it ends.
    if given is None and policy == STRICT:
        return None
    return replaced.path(given or refused_beside(raw_path))


def _raw_copy(
    spark: SparkSession,
    path: str | list[str],
    raw_path: str,
    policy: str,
    names: Sequence[str],
    one_per_line: bool,
    long_file_bytes: int,
    quarantine_path: str | None,
    lineage: bool,
    fallback: Sequence[str],
    required: Sequence[ColumnSpec],
) -> tuple[list[str], dict[str, int]]:
    check_policy(policy)
    cut = None if one_per_line else cut_documents(spark, path, long_file_bytes, policy)
    whole_up_to = None if one_per_line else long_file_bytes
    documents = read_envelopes(spark, path, policy, one_per_line, whole_up_to)
    known = list(names)
    if not known:
        known = first_header(
            read_envelopes(spark, path, policy, one_per_line, whole_up_to, headers_only=True)
        )
    if cut is not None:
        known = known or first_header(cut.headers)
    known = check_names(known or list(fallback))
    if not known:
        raise ContractViolation(f"no readable header under {path}")
    try:
        while True:
            rows = envelope_rows(documents, known, required)
            if cut is not None:
                rows = rows.unionByName(cut.rows(known, required))
            counts = _write_counted_raw(rows, known, policy, raw_path, ["_file", "_pos"] if lineage else [])
            others = sorted({name for group in counts.pop("others") for name in group})
            if not others:
                break
            known = check_names([*known, *others])
        if quarantine_path is not None:
            refused = quarantined_rows(rows)
            if counts["n_ragged"] + counts["n_corrupt"] == 0:
                refused = refused.where(F.lit(False))
            refused.write.mode("overwrite").parquet(quarantine_path)
    finally:
        if cut is not None:
            cut.discard()
    return known, counts


def _write_counted_raw(
    rows: DataFrame, names: Sequence[str], policy: str, raw_path: str, keep: Sequence[str]
) -> dict:
    # Counts sit in the task that writes, before the rows they describe are filtered.
    seen_rows, seen = counted(
        rows,
        "raw",
        F.count_if(F.col("_status") == OK).alias("n_ok"),
        F.count_if(F.col("_status") == RAGGED).alias("n_ragged"),
        F.count_if(F.col("_status") == CORRUPT).alias("n_corrupt"),
        F.collect_set("_others").alias("others"),
    )
    write_raw(to_raw(seen_rows, names, policy, keep), raw_path)
    return dict(seen.get)


def load_envelopes(
    spark: SparkSession,
    path: str | list[str],
    contract: Contract,
    raw_path: str,
    target_path: str | None = None,
    table: str | None = None,
    policy: str = LENIENT,
    names: Sequence[str] = (),
    one_per_line: bool = False,
    long_file_bytes: int = LONG_FILE_BYTES,
    quarantine_path: str | None = None,
    fmt: str = "parquet",
    mode: str = "overwrite",
    options: dict[str, str] | None = None,
    partition_by: Sequence[str] = (),
    lineage: bool = False,
    refuse_extra: bool = False,
    bytes_per_file: int = BYTES_PER_FILE,
    curve: bool = False,
) -> LoadMetrics:
    """Documents to a raw all-string copy to the contract's typed, clustered table.

    The typed rows go to a path, to a catalog ``table``, or through ``fmt`` and its
    ``options`` to a connector. A document without some contract column ends a strict load;
    ``refuse_extra`` ends any load whose documents hold undeclared columns. A load that ends
    early leaves raw copy, quarantine and target as they were (an appending connector may
    hold a part). With ``curve`` rows are laid out along a curve through all cluster keys
    (:mod:`~ledgerline.sinks.curve`) instead of being sorted by them.
    """
    check_policy(policy)
    with Replacement(spark) as replaced:
        new_raw = replaced.path(raw_path)
        names, counts = _raw_copy(
            spark, path, new_raw, policy, names, one_per_line, long_file_bytes,
            _refused(replaced, raw_path, quarantine_path, policy), lineage,
            fallback=contract.sources if policy == LENIENT else (),
            required=contract.columns if policy == STRICT else (),
        )
        extra = [n for n in names if n not in contract.sources and n not in contract.targets]
        if refuse_extra and extra:
            raise ContractViolation(f"contract {contract.name!r}: undeclared columns {extra}")
        raw = spark.read.parquet(new_raw)
        missing = missing_columns(contract, raw.columns)
        fed_by = resolve(contract, raw.columns)
        used = [F.col(quoted(name)) for name in fed_by.values() if name is not None]
        partitions = range_partitions(spark, input_bytes(spark, new_raw), bytes_per_file)
        placed = _clustered_cells(raw.select(*used, *_row_place()), contract, policy, fed_by, partitions, curve)
        written, seen = counted(apply_contract(placed, contract, policy), "typed")
        _fill(replaced, written, contract, policy, target_path, table, fmt, mode, options, partition_by)
    return LoadMetrics(
        n_rows=seen.get["n_rows"],
        n_source_columns=len(names),
        n_columns=len(contract.columns),
        target=table or target_path or fmt,
        n_ragged=counts["n_ragged"],
        n_corrupt=counts["n_corrupt"],
        missing=tuple(missing),
        extra=tuple(extra),
        raw_path=raw_path,
        quarantine_path=quarantine_path or (refused_beside(raw_path) if policy == LENIENT else None),
    )


def load_json_rows(
    spark: SparkSession,
    path: str | list[str],
    contract: Contract,
    target_path: str | None = None,
    table: str | None = None,
    policy: str = STRICT,
    payload: str | None = None,
    mode: str = "overwrite",
    quarantine_path: str | None = None,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    partition_by: Sequence[str] = (),
    refuse_extra: bool = False,
    bytes_per_file: int = BYTES_PER_FILE,
    curve: bool = False,
) -> LoadMetrics:
    """Staged Parquet files to the contract's typed, clustered table.

    Rows hold a JSON object in the column ``payload``, or are the object themselves; then the
    columns of all files count, and a strict load ends where no file has a contract column. A
    row whose file lacks it has NULL there, like an object without the key. A catalog
    ``table`` is created anew with the contract's limits when overwritten, and filled by
    column name. With ``quarantine_path`` malformed payloads, which a lenient load turns into
    rows of NULLs, are kept there with file and row number. A load that ends early leaves
    its targets as they were. ``curve`` as in :func:`load_envelopes`.
    """
    check_policy(policy)
    staged = read_staged(spark, path)
    if payload is None:
        missing = [s for s in contract.sources if s not in staged.columns]
        extra = [c for c in staged.columns if c not in contract.sources]
        n_source = len(staged.columns)
    else:
        missing, extra, n_source = [], [], len(contract.columns)
    if policy == STRICT and missing:
        raise ContractViolation(f"contract {contract.name!r}: missing columns {missing}")
    if refuse_extra and extra:
        raise ContractViolation(f"contract {contract.name!r}: undeclared columns {extra}")
    rows = staged.select("*", *_row_place())
    if payload is not None:
        cells = parse_fields(rows, payload, contract, policy, keep=_PLACE)
    else:
        cells = column_fields(rows, contract, keep=_PLACE)
    fed_by = {c.target: c.source for c in contract.columns}
    partitions = range_partitions(spark, input_bytes(spark, path), bytes_per_file)
    with Replacement(spark) as replaced:
        n_corrupt = 0
        if quarantine_path is not None:
            refused, held = counted(_malformed(spark, path, payload), "refused")
            refused.write.parquet(replaced.path(quarantine_path))
            n_corrupt = held.get["n_rows"]
        placed = _clustered_cells(cells, contract, policy, fed_by, partitions, curve)
        written, seen = counted(apply_contract(placed, contract, policy), "typed")
        _fill(replaced, written, contract, policy, target_path, table, fmt, mode, options, partition_by)
    return LoadMetrics(
        n_rows=seen.get["n_rows"],
        n_source_columns=n_source,
        n_columns=len(contract.columns),
        target=table or target_path or fmt,
        n_corrupt=n_corrupt,
        missing=tuple(missing),
        extra=tuple(extra),
        quarantine_path=quarantine_path,
    )


def _malformed(spark: SparkSession, path: str | list[str], payload: str | None) -> DataFrame:
    staged = read_staged(spark, path, lineage=True)
    if payload is None:
        return staged.where(F.lit(False)).select("_file", "_row_number")
    return malformed_rows(staged, payload).select("_file", "_row_number", F.col(quoted(payload)).alias("payload"))


def _fill(
    replaced: Replacement,
    typed: DataFrame,
    contract: Contract,
    policy: str,
    path: str | None,
    table: str | None,
    fmt: str,
    mode: str,
    options: dict[str, str] | None,
    partition_by: Sequence[str],
) -> None:
    """Write the typed rows; what they overwrite stays until they are complete.

    A table is created with the contract's limits and comment and filled by column name,
    unless ``options`` or ``partition_by`` ask for a layout of its own. With the mode ``partitions`` only
    the partitions that the rows belong to are overwritten, in a folder of Parquet files.
    """
    if mode == "partitions":
        if path is None or not partition_by or fmt != "parquet":
            raise ValueError("the mode 'partitions' needs a target path of Parquet files and partition columns")
        write_table(typed, replaced.partitions(path, len(partition_by)), options=options, partition_by=partition_by)
        return
    plain = table is not None and not options and not partition_by
    if mode == "overwrite":
        table = None if table is None else replaced.table(table)
        path = None if path is None or table is not None else replaced.path(path)
        if plain:
            create_table(typed.sparkSession, contract, table, policy, fmt)
    if plain:
        insert_by_name(typed, table)
    else:
        write_table(typed, path, table, fmt, mode, options, partition_by)


_PLACE = ("_place_file", "_place_row")


def _row_place() -> list:
    """Where a staged row lies; settles ties between equal rows in the range split."""
    return [
        F.xxhash64("_metadata.file_path").alias(_PLACE[0]),
        F.col("_metadata.row_index").alias(_PLACE[1]),
    ]


def _clustered_cells(
    cells: DataFrame, contract: Contract, policy: str, fed_by: dict[str, str | None], partitions: int, curve: bool = False
) -> DataFrame:
    """Cells as they were read, in the layout of the typed table.

    Rows are moved as read and converted afterwards: the pass that finds the ranges
    reads only text, and every cell is converted once.
    """
    keys = [
        typed_cell(cells, fed_by[c.target], c, policy)
        for target in contract.cluster_by
        for c in contract.columns
        if c.target == target and fed_by[target] is not None
    ]
    if keys and curve:
        cells = curve_clustered(cells, keys, partitions, spread=list(_PLACE))
    elif keys:
        cells = clustered(cells, keys, spread=list(_PLACE), partitions=partitions)
    return cells.drop(*_PLACE)
