"""Rows that hold their fields as a JSON object."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.contract import LENIENT, STRICT, Contract, check_policy, quoted
from ledgerline.functions import cell

_PARSED, _TEXT = "_parsed", "_payload_text"


def one_value(text: Column) -> Column:
    """Whether text holds a single JSON value with nothing behind it; null for null.

    Readers stop at the end of the first value. Read as the first entry of a list whose second
    entry is the text's own hash, whatever follows the value shows: the hash is then not the
    second entry.
    """
    seal = F.xxhash64(text).cast("string")
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit('\n,"'), seal, F.lit('"]')))
    whole = F.try_variant_get(listed, "$[1]", "string") == seal
    # One closing brace, and that at the end: an object of plain fields, no second reading needed.
    plain = text.startswith("{") & (F.instr(text, "}") == F.length(text))
    return F.when(text.isNotNull(), plain | F.coalesce(whole, F.lit(False)))


def row_as_variant(df: DataFrame, alias: str = "v") -> DataFrame:
    """Each row as one semi-structured object, its fields addressed by name."""
    return df.select(F.to_variant_object(F.struct("*")).alias(alias))


def field(v: str | Column, key: str, data_type: str, policy: str = STRICT) -> Column:
    """One top-level field of a variant; keys may hold spaces and brackets.

    An absent field is NULL. A value that cannot be converted ends the query under the
    strict policy and is NULL under the lenient one.
    """
    path = "$['{}']".format(key) if '"' in key else '$["{}"]'.format(key)
    variant = F.col(quoted(v)) if isinstance(v, str) else v
    get = F.variant_get if check_policy(policy) == STRICT else F.try_variant_get
    return get(variant, path, data_type)


def parse_fields(
    df: DataFrame, payload: str, contract: Contract, policy: str = LENIENT, keep: tuple[str, ...] = ()
) -> DataFrame:
    """The contract's source keys of each object as strings: one parse per row.

    Missing and null keys are NULL, nested values keep their JSON text. Malformed text, and
    text behind the object, gives a row of NULLs under the lenient policy and an error under
    the strict one; JSON that is no object has no fields under either.
    """
    schema = contract.source_schema().add("_corrupt_record", "string")
    text = F.col(quoted(payload))
    parsed = F.from_json(text, schema, {"columnNameOfCorruptRecord": "_corrupt_record"})
    rows = df.select(parsed.alias(_PARSED), text.alias(_TEXT), *[F.col(quoted(k)) for k in keep])
    fields = F.col(_PARSED)
    alone = F.coalesce(one_value(F.col(_TEXT)) | (F.trim(_TEXT) == ""), F.lit(True))
    if check_policy(policy) == LENIENT:
        rows = rows.withColumn(_PARSED, F.when(alone, fields))
    else:
        # Only text the object reader refused is parsed again, and raises if it is not JSON.
        corrupt = fields["_corrupt_record"]
        not_json = corrupt.isNotNull() & F.parse_json(corrupt).isNull()
        message = F.concat(F.lit("text behind the JSON value: "), F.col(_TEXT))
        tail = F.raise_error(message).cast(rows.schema[_PARSED].dataType)
        rows = rows.withColumn(_PARSED, F.when(not_json, F.lit(None)).when(~alone, tail).otherwise(fields))
    return rows.select(
        *[F.col(_PARSED).getField(s).alias(s) for s in contract.sources],
        *[F.col(quoted(k)) for k in keep],
    )


def malformed_rows(df: DataFrame, payload: str) -> DataFrame:
    """The rows whose payload is not one JSON value; blank text counts as absent."""
    text = F.col(quoted(payload))
    bad = F.try_parse_json(text).isNull() | ~one_value(text)
    return df.where(text.isNotNull() & (F.trim(text) != "") & bad)


def key_drift(df: DataFrame, payload: str, contract: Contract) -> DataFrame:
    """Undeclared and absent keys of the objects: ``column``, ``status``, ``n_rows``.

    ``extra``: rows holding a key the contract does not name; ``missing``: rows of an object
    without a key it names. A repeated key counts once. Rows that are no object are left out.
    """
    keys = df.select(F.array_distinct(F.json_object_keys(F.col(quoted(payload)))).alias("keys"))
    objects = keys.where(F.col("keys").isNotNull())
    wanted = F.array(*[F.lit(s) for s in contract.sources])
    entries = F.concat(
        F.transform(F.array_except("keys", wanted), lambda k: _drift(k, "extra")),
        F.transform(F.array_except(wanted, "keys"), lambda k: _drift(k, "missing")),
    )
    drifted = objects.select(F.inline(entries))
    return drifted.groupBy("column", "status").agg(F.count(F.lit(1)).alias("n_rows"))


def _drift(key: Column, status: str) -> Column:
    return F.struct(key.alias("column"), F.lit(status).alias("status"))


def extract(
    df: DataFrame, payload: str, contract: Contract, policy: str = LENIENT, keep: tuple[str, ...] = ()
) -> DataFrame:
    """The typed table of rows holding a JSON object in a text column."""
    fields = parse_fields(df, payload, contract, policy, keep)
    return fields.select(
        *[cell(F.col(quoted(c.source)), c, policy).alias(c.target) for c in contract.columns],
        *[F.col(quoted(k)) for k in keep],
    )


def column_fields(df: DataFrame, contract: Contract, keep: tuple[str, ...] = ()) -> DataFrame:
    """As :func:`parse_fields`, for rows that are themselves the object: fields are columns.

    Numeric columns keep their type. A field the rows lack is NULL, as for a missing key.
    """
    present = set(df.columns)
    return df.select(
        *[
            (F.col(quoted(s)) if s in present else F.lit(None).cast("string")).alias(s)
            for s in contract.sources
        ],
        *[F.col(quoted(k)) for k in keep],
    )
