"""Header-plus-rows JSON documents.

A document names its columns under ``meta.view.columns`` and carries its rows as
arrays under ``data``; cell *i* belongs to column *i*. Many documents are read in
parallel, each by one task, and nothing but column names reaches the driver.
Documents too large for one task go through :mod:`ledgerline.sources.long_documents`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.contract import LENIENT, STRICT, ColumnSpec, check_policy, quoted
from ledgerline.errors import ContractViolation

_HEADER = "meta: struct<view: struct<columns: array<struct<name: string>>>>"
_ROWS, _TEXTS, _VALUES = "data: array<array<string>>", "data: array<string>", "data: array<variant>"

OK, RAGGED, EMPTY, CORRUPT = "ok", "ragged", "empty", "corrupt"


def _read(text: Column, data: str | None) -> Column:
    """The document alone in ``text``, its data read as given; NULL when that cannot be.

    Readers stop at the end of the first value. The document is therefore read as the first
    of two entries, the second holding the text's hash: whatever follows the document stands
    between them.
    """
    seal = F.xxhash64(text).cast("string")
    wrapped = F.concat(F.lit('{"documents": ['), text, F.lit('\n, {"_seal": "'), seal, F.lit('"}]}'))
    fields = ", ".join([_HEADER, *([] if data is None else [data]), "_seal: string"])
    schema = f"documents array<struct<{fields}>>, _corrupt_record string"
    parsed = F.from_json(wrapped, schema, {"columnNameOfCorruptRecord": "_corrupt_record"})
    return F.struct(parsed.alias("parsed"), seal.alias("seal"))


def _alone(read: str) -> Column:
    documents = F.col(f"{read}.parsed.documents")
    sealed = (F.size(documents) == 2) & (F.get(documents, F.lit(1))["_seal"] == F.col(f"{read}.seal"))
    return F.when(F.col(f"{read}.parsed._corrupt_record").isNull() & sealed, F.get(documents, F.lit(0)))


def _element(cells: Column, text: Column) -> Column:
    return F.struct(cells.alias("cells"), text.alias("text"))


def row_element(cells: Column) -> Column:
    """An element of the data that is a row."""
    return _element(cells, F.lit(None).cast("string"))


def mixed_elements(texts: Column, values: Column) -> Column:
    """Elements of the data of any kind, read as texts and as variants: rows have cells."""
    return F.zip_with(
        texts,
        values,
        lambda text, value: _element(
            F.when(F.schema_of_variant(value).startswith("ARRAY"), F.from_json(text, "array<string>")), text
        ),
    )


def read_envelopes(
    spark: SparkSession,
    path: str | list[str],
    policy: str = LENIENT,
    one_per_line: bool = False,
    max_file_bytes: int | None = None,
    headers_only: bool = False,
) -> DataFrame:
    """One row per document: ``_file``, ``names``, ``data``, ``_corrupt``, ``_text``.

    A document is a whole file, or a line of it with ``one_per_line`` (files are then
    split between tasks). Under the strict policy an unreadable document ends the query;
    under the lenient one it gives a row with ``_corrupt`` set, and with its text where it
    is a line. ``max_file_bytes`` skips larger files before they are opened;
    ``headers_only`` leaves ``data`` out unparsed.

    Files are read as text, not by Spark's multi-line JSON source: that one goes back to
    the file for every number in a string column, one positioned read per cell.
    """
    texts = spark.read.text(path, wholetext=not one_per_line)
    if max_file_bytes is not None:
        texts = texts.where(F.col("_metadata.file_size") <= max_file_bytes)
    if one_per_line:
        texts = texts.where(F.trim("value") != "")
    texts = texts.select(F.col("_metadata.file_path").alias("_file"), "value")
    return parse_envelopes(texts, "value", F.col("_file"), policy, headers_only, keep_text=one_per_line)


def parse_envelopes(
    df: DataFrame,
    text: str,
    file: Column | None = None,
    policy: str = LENIENT,
    headers_only: bool = False,
    keep_text: bool = True,
) -> DataFrame:
    """As :func:`read_envelopes`, for documents held in a text column.

    A document is unreadable when its text is not one JSON value with nothing behind it, when
    it has no list of column names or its data is no list, or when a name is absent or equal
    to another (case ignored). An element of the data that is no row makes only itself ragged.
    """
    strict = check_policy(policy) == STRICT
    value = F.col("_value")
    read = df.select(
        (F.lit(None).cast("string") if file is None else file).alias("_file"),
        F.col(quoted(text)).alias("_value"),
    ).withColumn("_first", _read(value, None if headers_only else _ROWS))
    document = _alone("_first")
    if headers_only:
        parsed = read.select("_file", "_value", document["meta"].alias("meta"))
    else:
        # Documents whose data holds other elements than rows are read again, element by element.
        odd = F.col("_first.parsed._corrupt_record").isNotNull()
        read = read.withColumns(
            {"_second": F.when(odd, _read(value, _TEXTS)), "_third": F.when(odd, _read(value, _VALUES))}
        )
        parsed = read.select(
            "_file",
            "_value",
            F.coalesce(document["meta"], _alone("_second")["meta"]).alias("meta"),
            F.coalesce(
                F.transform(document["data"], row_element),
                mixed_elements(_alone("_second")["data"], _alone("_third")["data"]),
            ).alias("data"),
        )
    names = F.transform(F.col("meta.view.columns"), lambda c: c["name"])
    nameless = F.exists(names, lambda n: n.isNull())
    twice = F.size(F.array_distinct(F.transform(names, F.lower))) < F.size(names)
    where = F.concat(F.lit(" in "), F.coalesce("_file", F.lit("the document")))
    if strict:
        names = (
            F.when(names.isNull(), _failing("unreadable document", where))
            .when(nameless, _failing("nameless column", where))
            .when(twice, _failing("duplicate column names", where, F.lit(": "), F.array_join(names, ", ")))
            .otherwise(names)
        )
    else:
        names = F.when(~(nameless | twice), names)
    found = parsed.withColumn("names", names)
    corrupt = F.col("names").isNull()
    data = [] if headers_only else [F.when(~corrupt, F.col("data")).alias("data")]
    kept = F.when(corrupt, F.col("_value")) if keep_text else F.lit(None).cast("string")
    return found.select("_file", "names", *data, corrupt.alias("_corrupt"), kept.alias("_text"))


def _failing(what: str, *more: Column) -> Column:
    return F.raise_error(F.concat(F.lit(what), *more)).cast("array<string>")


def envelope_columns(documents: DataFrame) -> DataFrame:
    """Column names of every document with their position: ``_file``, ``position``, ``name``."""
    return documents.select("_file", F.posexplode("names").alias("position", "name"))


def locate(
    documents: DataFrame, names: Sequence[str], required: Sequence[ColumnSpec] = ()
) -> DataFrame:
    """Documents with ``_at``, ``_others`` and ``_width``, worked out once per document.

    ``_width`` is the number of cells the header asks for; ``_at`` holds, for each of
    ``names``, its place in the document's rows (NULL when the document lacks it); ``_others`` the document's names not among them (NULL when none).
    A document that provides none of the two names of a ``required`` column ends the query.
    """
    listed = F.array(*[F.lit(n) for n in names]).cast("array<string>")
    straight = F.sequence(F.lit(0), F.lit(len(names) - 1)) if names else F.array().cast("array<int>")
    looked_up = F.transform(
        listed, lambda n: F.nullif(F.array_position("names", n), F.lit(0)).cast("int") - 1
    )
    others = F.array_except("names", listed)
    at = F.when(F.col("names") == listed, straight).otherwise(looked_up)
    if required:
        lacks = F.array_compact(
            F.array(
                *[
                    F.when(~F.arrays_overlap("names", F.array(F.lit(c.source), F.lit(c.target))), c.source)
                    for c in required
                ]
            )
        )
        message = F.concat(
            F.lit("missing columns in "), F.coalesce("_file", F.lit("the document")),
            F.lit(": "), F.array_join(lacks, ", "),
        )
        at = F.when(F.size(lacks) > 0, F.raise_error(message).cast("array<int>")).otherwise(at)
    return documents.withColumns(
        {
            "_at": at,
            "_others": F.when(F.size(others) > 0, others),
            "_width": F.size("names"),
        }
    )


def envelope_rows(
    documents: DataFrame, names: Sequence[str] = (), required: Sequence[ColumnSpec] = ()
) -> DataFrame:
    """One row per data row, its cells ready to be taken by :func:`to_raw` for ``names``.

    Columns ``_file``, ``_pos``, ``_row``, ``_status`` and those of :func:`locate`. ``_pos`` is
    the element's place in the data, from 0. An element that is no row is ragged and has its
    JSON text as its only cell. A document without rows still gives one line (``empty`` or
    ``corrupt``, no ``_pos``; the text of an unreadable line as its only cell), so the counts
    of a load account for every document.
    """
    exploded = locate(documents, names, required).select(
        "_file",
        "_corrupt",
        "_text",
        "_width",
        "_at",
        "_others",
        F.posexplode_outer("data").alias("_pos", "_element"),
    )
    return exploded.select(
        "_file",
        F.col("_pos").cast("bigint").alias("_pos"),
        row_cells(F.col("_text")).alias("_row"),
        F.when(F.col("_corrupt"), CORRUPT)
        .when(F.col("_pos").isNull(), EMPTY)
        .otherwise(row_status())
        .alias("_status"),
        "_width",
        "_at",
        "_others",
    )


def row_cells(text: Column | None = None) -> Column:
    """The cells of ``_element``, else the text standing in for them as one cell."""
    texts = [F.col("_element.text"), *([] if text is None else [text])]
    held = F.coalesce(*texts)
    return F.coalesce(F.col("_element.cells"), F.when(held.isNotNull(), F.array(held)))


def row_status() -> Column:
    """Whether ``_element`` is a row of the width its header asks for."""
    cells = F.col("_element.cells")
    return F.when(cells.isNull() | (F.size(cells) != F.col("_width")), RAGGED).otherwise(OK)


def header_names(documents: DataFrame) -> list[str]:
    """The distinct column names of all documents, in order of first position."""
    found = (
        envelope_columns(documents)
        .groupBy("name")
        .agg(F.min("position").alias("position"))
        .orderBy("position", "name")
        .collect()
    )
    return check_names([r["name"] for r in found])


def first_header(documents: DataFrame) -> list[str]:
    """The column names of one readable document; stops at the first one found."""
    found = documents.where(F.col("names").isNotNull()).select("names").take(1)
    return check_names(list(found[0]["names"])) if found else []


def check_names(names: Sequence[str]) -> list[str]:
    """The names as a list, refused when equal but for case."""
    folded: dict[str, str] = {}
    for name in names:
        other = folded.setdefault(name.lower(), name)
        if other != name:
            raise ContractViolation(f"column names differ by case alone: {other!r}, {name!r}")
    return list(names)


def raw_columns(names: Sequence[str]) -> list[Column]:
    """The cells of ``_row`` as string columns; a name the document lacks gives NULL."""
    return [
        F.get(F.col("_row"), F.get(F.col("_at"), F.lit(i))).alias(name) for i, name in enumerate(names)
    ]


def to_raw(
    rows: DataFrame, names: Sequence[str], policy: str = LENIENT, keep: Sequence[str | Column] = ()
) -> DataFrame:
    """The all-string table of the well-formed rows, one column per name.

    ``names`` are those the rows were located for, in the same order.
    Ragged rows are left to :func:`quarantined_rows` under the lenient policy and end the
    query under the strict one.
    """
    if check_policy(policy) == STRICT:
        message = F.concat(
            F.lit("row does not match its header: "), F.coalesce("_file", F.lit("the document")),
            F.lit(" row "), F.coalesce(F.col("_pos").cast("string"), F.lit("-")),
        )
        bad = F.col("_status").isin(RAGGED, CORRUPT)
        rows = rows.withColumn(
            "_status", F.when(bad, F.raise_error(message).cast("string")).otherwise(F.col("_status"))
        )
    return rows.where(F.col("_status") == OK).select(*raw_columns(names), *keep)


def quarantined_rows(rows: DataFrame) -> DataFrame:
    """Rows and documents left out of the raw table, with the reason."""
    return rows.where(F.col("_status").isin(RAGGED, CORRUPT)).select(
        "_file", "_pos", F.col("_status").alias("reason"),
        F.when(F.col("_width") >= 0, F.col("_width")).alias("n_names"),
        F.when((F.col("_status") == RAGGED) & F.col("_row").isNotNull(), F.size("_row")).alias("n_cells"),
        "_row",
    )
