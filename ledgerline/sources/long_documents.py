"""Envelope documents too large for one task, cut between tasks at any layout.

The text is scanned in pieces ending at ``]`` (a splittable text scan). Whether a
bracket counts, and how deep it lies, depends on all text before it, so each piece
first yields a few numbers for both cases (it starts inside a string, or not); those
numbers, not the text, are then summed: inside each block (a run of pieces), then over
the blocks of a file. That fixes where the ``data`` array opens, and where each row starts and
ends, whatever the white space, nesting or brackets inside strings. Rows are put
together from their pieces inside each block, where the pieces already lie together; only
the few rows that cross a block's edge are moved again.

Rows, their numbers and the documents found unreadable are those of
:func:`~ledgerline.sources.envelope.read_envelopes`, whatever the size of a file. Pieces and
rows are kept as tables in the shared folder, so every later step sees the same cut even when
executors come and go.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.contract import LENIENT, STRICT, ColumnSpec, check_policy
from ledgerline.scratch import discard, scratch_path
from ledgerline.sources.envelope import (
    CORRUPT,
    EMPTY,
    locate,
    mixed_elements,
    parse_envelopes,
    row_cells,
    row_element,
    row_status,
)
from ledgerline.sources.files import any_longer

LONG_FILE_BYTES = 128 << 20
BROADCAST_BYTES = 8 << 20
_SALTS = 64
_DATA_OPENS = r'(?<!\\)"data"\s*:\s*\['
_BLOCK = ["_file", "_split", "_run"]
_RUN_PIECES = 1 << 16


@dataclass(frozen=True)
class CutDocuments:
    """``headers``: one line per document; :meth:`rows`: as from ``envelope_rows``."""

    headers: DataFrame
    elements: DataFrame
    n_documents: int
    header_bytes: int
    kept: tuple[str, ...]

    def rows(self, names: Sequence[str] = (), required: Sequence[ColumnSpec] = ()) -> DataFrame:
        # A located header carries its file, its names and one place per wanted name.
        size = self.header_bytes + 8 * len(names) * self.n_documents
        located = locate(self.headers, names, required)
        return _rows(self.elements, located, size <= BROADCAST_BYTES)

    def discard(self) -> None:
        """Remove the intermediate tables; the DataFrames cannot be read any more."""
        discard(self.headers.sparkSession, *self.kept)


def cut_documents(
    spark: SparkSession,
    path: str | list[str],
    min_file_bytes: int = LONG_FILE_BYTES,
    policy: str = LENIENT,
) -> CutDocuments | None:
    """The rows of every document file larger than ``min_file_bytes``; None without such files."""
    check_policy(policy)
    if not any_longer(spark, path, min_file_bytes):
        return None
    base = scratch_path(spark, "long-documents")
    pieces = _kept(_pieces(spark, path, min_file_bytes), f"{base}/pieces")
    states = _block_states(pieces.drop("text"), base)
    parts = _kept(_parts(pieces, states), f"{base}/parts")
    edges = _kept(_edges(parts), f"{base}/edges")
    numbers = _kept(_numbers(parts, edges), f"{base}/numbers")
    headers = _headers(pieces, states, numbers)
    if policy == STRICT:
        headers = headers.withColumn("names", _or_raise(F.col("names"), F.col("_corrupt")))
    # One line per document: kept, as both the rows and the caller read it.
    sizes = Observation("headers")
    names_size = F.coalesce(F.length(F.array_join("names", ",")), F.lit(0))
    headers = headers.observe(
        sizes, F.count(F.lit(1)).alias("n"), F.sum(F.length("_file") + names_size).alias("size")
    )
    headers = _kept(headers, f"{base}/headers")
    elements = _elements(parts, edges, numbers)
    return CutDocuments(headers, elements, sizes.get["n"], sizes.get["size"], (base,))


def _or_raise(names: Column, corrupt: Column) -> Column:
    message = F.concat(F.lit("unreadable document "), F.col("_file"))
    return F.when(corrupt, F.raise_error(message).cast("array<string>")).otherwise(names)


def _pieces(spark: SparkSession, path: str | list[str], min_file_bytes: int) -> DataFrame:
    """Text up to each ``]``, its place, and its counts for both starting cases."""
    scanned = (
        spark.read.option("lineSep", "]")
        .text(path)
        .where(F.col("_metadata.file_size") > min_file_bytes)
        .select(
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_split"),
            # Runs of pieces bound the work of a task even where a file cannot be split.
            F.expr(f"monotonically_increasing_id() div {_RUN_PIECES}").alias("_run"),
            F.monotonically_increasing_id().alias("_at"),
            F.col("_metadata.file_size").alias("_size"),
            F.col("value").alias("text"),
        )
    )
    opens = (F.instr("text", '"data"') > 0) & F.col("text").rlike(_DATA_OPENS)
    head = F.when(opens, F.split("text", _DATA_OPENS, 2).getItem(0))
    marked = scanned.select(
        "*",
        (F.octet_length("text") + 1).cast("bigint").alias("n_bytes"),
        _marks(F.col("text")).alias("marks"),
        _marks(head).alias("head"),
    )
    return marked.select(
        *scanned.columns,
        "n_bytes",
        _count(F.col("marks"), '"').alias("quotes"),
        _depth_change(F.col("marks"), False).alias("change_out"),
        _depth_change(F.col("marks"), True).alias("change_in"),
        F.when(F.col("head").isNotNull(), _depth_change(F.col("head"), False)).alias("head_out"),
        F.when(F.col("head").isNotNull(), _depth_change(F.col("head"), True)).alias("head_in"),
    )


def _marks(text: Column) -> Column:
    """Only the quotes and brackets of a text, escaped characters left out."""
    escaped = F.instr(text, "\\") > 0
    unescaped = F.when(escaped, F.regexp_replace(text, r"(?s)\\.", "")).otherwise(text)
    return F.regexp_replace(unescaped, r'[^"\[\]{}]+', "")


def _count(marks: Column, characters: str) -> Column:
    return F.length(marks) - F.length(F.translate(marks, characters, ""))


def _depth_change(marks: Column, in_string: bool) -> Column:
    """Brackets opened less closed outside strings, given whether the text starts in one."""
    body = F.concat(F.lit('"'), marks) if in_string else marks
    bare = F.regexp_replace(body, '"[^"]*"?', "")
    return _count(bare, "[{") - _count(bare, "]}")


def _within_block(value: Column, how=F.sum, current: bool = False) -> Column:
    window = Window.partitionBy(*_BLOCK).orderBy("_at")
    return how(value).over(
        window.rowsBetween(Window.unboundedPreceding, Window.currentRow if current else -1)
    )


def _over_blocks(value: Column, how=F.sum) -> Column:
    # One line per run of pieces of a file (a file of 30 TB has some 500,000).
    window = Window.partitionBy("_file").orderBy("_split", "_run")
    return how(value).over(window.rowsBetween(Window.unboundedPreceding, -1))


def _zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def _step(in_string: Column) -> Column:
    """Depth change of a piece including its closing bracket, when that one counts."""
    ends_in_string = (in_string + F.col("quotes")) % 2
    return F.when(in_string == 0, F.col("change_out")).otherwise(F.col("change_in")) - F.when(
        ends_in_string == 0, 1
    ).otherwise(0)


def _block_states(numbers: DataFrame, base: str) -> DataFrame:
    """What holds at the start of every block: string state, depth, byte, last marks."""
    quotes_before = _zero(_within_block(F.col("quotes")))
    sums = (
        numbers.select(
            *_BLOCK,
            "quotes",
            "n_bytes",
            "_size",
            _step(quotes_before % 2).alias("step_out"),
            _step((quotes_before + 1) % 2).alias("step_in"),
        )
        .groupBy(*_BLOCK)
        .agg(
            *[F.sum(c).alias(c) for c in ("quotes", "n_bytes", "step_out", "step_in")],
            F.max("_size").alias("_size"),
        )
    )
    entered = sums.select(
        "*",
        (_zero(_over_blocks(F.col("quotes"))) % 2).alias("in_string"),
        _zero(_over_blocks(F.col("n_bytes"))).alias("start"),
    ).withColumn("step", F.when(F.col("in_string") == 0, F.col("step_out")).otherwise(F.col("step_in")))
    whole = Window.partitionBy("_file")
    starts = entered.select(
        *_BLOCK,
        "in_string",
        "start",
        _zero(_over_blocks(F.col("step"))).alias("depth"),
        # The last piece has no bracket of its own, so a whole document sums to -1. Where the
        # bytes fit without that bracket, the text ends in one too many.
        ((F.sum("step").over(whole) == -1) & (F.sum("n_bytes").over(whole) != F.max("_size").over(whole)))
        .alias("whole"),
    )
    starts = _kept(starts, f"{base}/starts")
    marks = (
        _placed(numbers, starts)
        .groupBy(*_BLOCK)
        .agg(*[F.max(c).alias(c) for c in ("opened", "low_end", "row_end")])
        .select(
            *_BLOCK,
            *[_over_blocks(F.col(c), F.max).alias(f"{c}_before") for c in ("opened", "low_end", "row_end")],
        )
    )
    return _kept(starts.join(marks, _BLOCK), f"{base}/states")


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _placed(pieces: DataFrame, starts: DataFrame) -> DataFrame:
    """Pieces with byte position, depth after them, and the marks they set.

    ``opened``: the document's data array opens here; ``low_end``: depth falls to that
    of the document or less; ``row_end``: depth falls to that of the data array or less, by a
    bracket outside strings (``closes``).
    """
    in_string = (F.col("in_string") + _zero(_within_block(F.col("quotes")))) % 2
    joined = pieces.join(starts, _BLOCK).withColumn("in_string", in_string)
    step = _step(F.col("in_string"))
    depth_before = F.col("depth") + _zero(_within_block(F.col("step")))
    head = F.when(F.col("in_string") == 0, F.col("head_out")).otherwise(F.col("head_in"))
    return (
        joined.withColumn("step", step)
        .withColumn("pos", F.col("start") + _zero(_within_block(F.col("n_bytes"))))
        .withColumn("depth_before", depth_before)
        .withColumn("depth_after", F.col("depth_before") + F.col("step"))
        .withColumn("end", F.col("pos") + F.col("n_bytes"))
        .withColumn("opened", F.when(F.col("depth_before") + head == 1, F.col("pos")))
        .withColumn("low_end", F.when(F.col("depth_after") <= 1, F.col("end")))
        .withColumn("closes", (F.col("in_string") + F.col("quotes")) % 2 == 0)
        .withColumn("row_end", F.when((F.col("depth_after") <= 2) & F.col("closes"), F.col("end")))
    )


def _assigned(pieces: DataFrame, states: DataFrame) -> DataFrame:
    """Placed pieces; those of the data with the first byte of their row.

    ``closing`` marks the piece whose bracket ends the data: text before it belongs to
    elements behind the last row that is an array.
    """
    marks = {
        "opened_at": F.greatest(_within_block(F.col("opened"), F.max, current=True), F.col("opened_before")),
        "low_at": F.greatest(_within_block(F.col("low_end"), F.max), F.col("low_end_before")),
        "row_at": F.greatest(_within_block(F.col("row_end"), F.max), F.col("row_end_before")),
    }
    in_data = F.col("opened_at").isNotNull() & (F.col("low_at").isNull() | (F.col("low_at") <= F.col("opened_at")))
    return (
        _placed(pieces, states)
        .withColumns(marks)
        .withColumn("in_data", in_data)
        .withColumn("closing", F.col("in_data") & (F.col("depth_after") < 2))
        .withColumn("row", F.greatest("opened_at", "row_at"))
    )


def _headers(pieces: DataFrame, states: DataFrame, numbers: DataFrame) -> DataFrame:
    """Names and number of rows per document, from its text without the rows."""
    frame = (
        _assigned(pieces.drop("text"), states)
        .where(F.col("whole") & (~F.col("in_data") | F.col("opened").isNotNull() | F.col("closing")))
        .select(*_BLOCK, "_at", "pos", "opened", "in_data", "closing", "depth_after")
    )
    before = F.concat(F.split("text", _DATA_OPENS, 2).getItem(0), F.lit('"data": ['))
    text = (
        F.when(F.col("opened").isNotNull(), F.concat(before, F.when(F.col("closing"), "]").otherwise("")))
        .when(F.col("closing"), "]")
        .otherwise(F.concat("text", F.when(F.col("depth_after") < 0, "").otherwise("]")))
    )
    documents = (
        pieces.select(*_BLOCK, "_at", "text")
        .join(frame, [*_BLOCK, "_at"])
        .select("_file", F.struct("pos", text.alias("text")).alias("part"))
        .groupBy("_file")
        .agg(F.array_sort(F.collect_list("part")).alias("parts"))
        .select("_file", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("document"))
    )
    parsed = parse_envelopes(documents, "document", F.col("_file"), keep_text=False).drop("data", "_text")
    broken = (
        states.where(~F.col("whole"))
        .select("_file")
        .distinct()
        .select("_file", F.lit(None).cast("array<string>").alias("names"), F.lit(True).alias("_corrupt"))
    )
    counts = numbers.groupBy("_file").agg(
        F.sum(F.col("n") + F.col("n_edge")).alias("n_rows"), F.bool_or("bad").alias("bad")
    )
    corrupt = F.col("_corrupt") | F.coalesce("bad", F.lit(False))
    return (
        parsed.unionByName(broken)
        .join(counts, "_file", "left")
        .select(
            "_file",
            F.when(~corrupt, F.col("names")).alias("names"),
            corrupt.alias("_corrupt"),
            _zero(F.col("n_rows")).alias("n_rows"),
        )
    )


def _parts(pieces: DataFrame, states: DataFrame) -> DataFrame:
    """The rows of each block, parsed where they lie in it whole, else as text.

    ``_base`` is the number of elements before a row in its block.
    """
    text = F.when(F.col("opened").isNotNull(), F.split("text", _DATA_OPENS, 2).getItem(1)).otherwise(
        F.col("text")
    )
    ends = F.col("row_end").isNotNull()
    joined = F.array_join(F.transform("parts", lambda p: p["text"]), "]")
    complete = F.col("starts") & F.col("ends")
    parts = (
        _assigned(pieces, states)
        .where(F.col("in_data") & F.col("whole"))
        .select(
            *_BLOCK,
            "row",
            "closing",
            F.struct("_at", text.alias("text")).alias("part"),
            F.col("opened").isNotNull().alias("opens"),
            (F.col("pos") == F.col("row")).alias("starts"),
            ends.alias("ends"),
        )
        .groupBy(*_BLOCK, "row")
        .agg(
            F.array_sort(F.collect_list("part")).alias("parts"),
            *[F.bool_or(c).alias(c) for c in ("opens", "starts", "ends", "closing")],
        )
        .withColumn("text", F.concat(joined, F.when(F.col("closing"), "").otherwise("]")))
        .withColumn("complete", complete)
    )
    parsed = _parsed(parts, F.col("complete")).withColumn("n", _n_elements())
    window = Window.partitionBy(*_BLOCK).orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return parsed.select(
        *_BLOCK,
        "row",
        "opens",
        "closing",
        "complete",
        "n",
        _zero(F.sum("n").over(window)).alias("_base"),
        "elements",
        F.when(~F.col("complete"), F.col("text")).alias("text"),
    )


def _parsed(rows: DataFrame, when: Column) -> DataFrame:
    """Rows with the ``elements`` in their text; NULL where it cannot be read.

    Nearly every row's text is one array behind a comma. Other text is read as a list, after
    an entry that stands for what lies before its comma.
    """
    text, opens = F.col("text"), F.col("opens")
    begins = F.when(opens, text.rlike(r"^\s*\[")).otherwise(text.rlike(r"^\s*,\s*\["))
    plain = begins & ~F.col("closing")
    cells = F.from_json(F.expr("substring(text, instr(text, '['))"), "array<string>")
    listed = F.concat(F.when(opens, "[").otherwise("[null"), text, F.lit("]"))
    texts, values = F.from_json(listed, "array<string>"), F.from_json(listed, "array<variant>")
    behind = F.when(opens, F.col("mixed")).otherwise(
        F.slice("mixed", F.lit(2), F.greatest(F.size("mixed") - 1, F.lit(0)))
    )
    one = F.when(F.col("cells").isNotNull(), F.array(row_element(F.col("cells"))))
    return (
        rows.withColumn("plain", plain)
        .withColumn("cells", F.when(when & F.col("plain"), cells))
        .withColumn("mixed", F.when(when & ~F.col("plain"), mixed_elements(texts, values)))
        .withColumn("elements", F.when(F.col("plain"), one).otherwise(behind))
    )


def _n_elements() -> Column:
    return F.coalesce(F.when(F.col("elements").isNotNull(), F.size("elements")), F.lit(0)).cast("bigint")


def _edges(parts: DataFrame) -> DataFrame:
    """The rows that cross from one block into others, with the block they start in."""
    joined = F.array_join(F.transform("parts", lambda p: p["text"]), "")
    rows = (
        parts.where(~F.col("complete"))
        .groupBy("_file", "row")
        .agg(
            F.array_sort(F.collect_list(F.struct("_split", "_run", "text"))).alias("parts"),
            F.bool_or("opens").alias("opens"),
            F.bool_or("closing").alias("closing"),
        )
        .select(
            "_file",
            F.get("parts", F.lit(0))["_split"].alias("_split"),
            F.get("parts", F.lit(0))["_run"].alias("_run"),
            "opens",
            "closing",
            joined.alias("text"),
        )
    )
    return _parsed(rows, F.lit(True)).select(*_BLOCK, "elements", _n_elements().alias("n"))


def _numbers(parts: DataFrame, edges: DataFrame) -> DataFrame:
    """Per block: elements before it in its file, elements inside it, whether one is unreadable."""
    inside = parts.select(
        *_BLOCK, "n", F.lit(0).cast("bigint").alias("n_edge"),
        (F.col("complete") & F.col("elements").isNull()).alias("bad"),
    )
    crossing = edges.select(
        *_BLOCK, F.lit(0).cast("bigint").alias("n"), F.col("n").alias("n_edge"),
        F.col("elements").isNull().alias("bad"),
    )
    sums = (
        inside.unionByName(crossing)
        .groupBy(*_BLOCK)
        .agg(F.sum("n").alias("n"), F.sum("n_edge").alias("n_edge"), F.bool_or("bad").alias("bad"))
    )
    return sums.withColumn("before", _zero(_over_blocks(F.col("n") + F.col("n_edge"))))


def _elements(parts: DataFrame, edges: DataFrame, numbers: DataFrame) -> DataFrame:
    """Every element of the data with its place: ``_file``, ``_pos``, ``_element``."""
    inside = parts.where("complete").select(*_BLOCK, "_base", "elements").join(
        numbers.select(*_BLOCK, "before"), _BLOCK
    )
    # The row that leaves a block comes after all others in it.
    crossing = edges.select(*_BLOCK, "elements").join(
        numbers.select(*_BLOCK, F.col("n").alias("_base"), "before"), _BLOCK
    )
    return (
        inside.unionByName(crossing)
        .select(
            "_file",
            (F.col("before") + F.col("_base")).alias("_first"),
            F.posexplode("elements").alias("_nth", "_element"),
        )
        .select("_file", (F.col("_first") + F.col("_nth")).alias("_pos"), "_element")
    )


def _with_names(rows: DataFrame, headers: DataFrame, small: bool) -> DataFrame:
    """Join each row to its document's header without moving a document to one task."""
    if small:
        return rows.join(F.broadcast(headers), "_file")
    salted = headers.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    salt = F.pmod(F.xxhash64("_pos"), F.lit(_SALTS)).cast("int")
    return rows.withColumn("_salt", salt).join(salted, ["_file", "_salt"]).drop("_salt")


def _rows(elements: DataFrame, headers: DataFrame, small: bool) -> DataFrame:
    readable = headers.where(~F.col("_corrupt"))
    found = _with_names(elements, readable.select("_file", "_width", "_at", "_others"), small)
    rows = found.select(
        "_file", "_pos", row_cells().alias("_row"), row_status().alias("_status"), "_width", "_at", "_others"
    )
    # As ``envelope_rows``: a line for every document that gives no row.
    without = headers.where(F.col("_corrupt") | (F.col("n_rows") == 0)).select(
        "_file",
        F.lit(None).cast("bigint").alias("_pos"),
        F.lit(None).cast("array<string>").alias("_row"),
        F.when(F.col("_corrupt"), CORRUPT).otherwise(EMPTY).alias("_status"),
        "_width", "_at", "_others",
    )
    return rows.unionByName(without)
