"""Nested payloads: arrays of objects as child rows, and the contract that payloads themselves suggest.

A payload is a VARIANT (:func:`~ledgerline.sources.json_rows.row_as_variant`, ``parse_json``). An array in
it becomes one row for each element, with the parent's key columns and the element's position, by a lateral
join with ``variant_explode``: elements are taken apart where the payload lies, and nothing is grouped.

An element that is an object gives the fields asked for; a field it lacks is NULL. An element that is null, a
scalar or an array of its own gives none: strictly it ends the load, leniently it stays a row with its
``_status`` and its JSON text. A parent without the array (missing, null, empty, or no array at all) has no
child rows, or with ``keep_childless`` one with ``_status`` saying which.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.contract import LENIENT, STRICT, ColumnSpec, Contract, check_policy, quoted
from ledgerline.errors import ContractViolation
from ledgerline.functions import cell

OBJECT, SCALAR, NULL, ARRAY = "object", "scalar", "null", "array"
MISSING, EMPTY, NO_ARRAY = "missing", "empty", "no array"
_ADDED = ("_pos", "_status", "_element", "_texts")


def _step(name: str) -> str:
    """A name as a step of a path; Spark's paths have no escapes."""
    quote = '"' if "'" in name else "'"
    if quote in name:
        raise ContractViolation(f"no path leads to {name!r}, which has both kinds of quotes")
    return f"[{quote}{name}{quote}]"


def _path(*names: str) -> str:
    return "$" + "".join(_step(n) for n in names)


def _kind(value: Column) -> Column:
    """Object, array, scalar or null; found without looking into what an object or an element holds."""
    return (
        F.when(value.isNull() | F.is_variant_null(value), NULL)
        .when(F.try_variant_get(value, "$", "struct<>").isNotNull(), OBJECT)
        .when(F.try_variant_get(value, "$", "array<variant>").isNotNull(), ARRAY)
        .otherwise(SCALAR)
    )


def _texts(contract: Contract, element: Column) -> Column:
    """The fields that a contract asks of an object as text, taken out of it together; NULL for what is no object."""
    for name in contract.sources:
        _step(name)  # names that no path leads to are refused as everywhere
    kind = ", ".join(f"{quoted(name)}: string" for name in contract.sources)
    return F.try_variant_get(element, "$", f"struct<{kind}>")


def elements(df: DataFrame, payload: str, path: Sequence[str], keep: Sequence[str] = (), keep_childless: bool = False) -> DataFrame:
    """One row for each element of the array at ``path``: the columns ``keep``, ``_pos`` (from 0), ``_status`` and
    ``_element`` (VARIANT)."""
    held = F.variant_get(F.col(quoted(payload)), _path(*path), "variant") if path else F.col(quoted(payload))
    kept = [F.col(quoted(k)).alias(f"k{i}") for i, k in enumerate(keep)]
    parents = df.select(*kept, held.alias("held"))
    back = [F.col(f"k{i}").alias(k) for i, k in enumerate(keep)]
    # Fields of an object have a key, elements none. To ask before would make the payload once more for the filter.
    exploded = parents.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("held").outer())).where(F.col("key").isNull())
    found = exploded.select(*back, F.col("pos").alias("_pos"), _kind(F.col("value")).alias("_status"), F.col("value").alias("_element"))
    if not keep_childless:
        return found
    none = F.lit(None).cast("variant")
    empty = F.schema_of_variant("held") == "ARRAY<VOID>"
    parents = parents.withColumn("kind", F.when(F.col("held").isNull(), MISSING).otherwise(_kind(F.col("held"))))
    childless = parents.where((F.col("kind") != ARRAY) | (empty & (F.to_json("held") == "[]")))
    why = F.when(F.col("kind") == ARRAY, EMPTY).when(F.col("kind").isin(MISSING, NULL), F.col("kind")).otherwise(NO_ARRAY)
    return found.unionByName(childless.select(*back, F.lit(None).cast("int").alias("_pos"), why.alias("_status"), none.alias("_element")))


def child_rows(
    df: DataFrame, payload: str, path: Sequence[str], contract: Contract, policy: str = LENIENT,
    keep: Sequence[str] = (), keep_childless: bool = False,
) -> DataFrame:
    """The elements of an array as typed rows: the columns ``keep`` (parent keys), ``_pos``, the contract's
    columns; and, under the lenient policy, ``_status`` and ``_element`` (the JSON text of what is no object)."""
    check_policy(policy)
    if clash := sorted({*keep} & {*contract.targets, *_ADDED} | {*contract.targets} & {*_ADDED}):
        raise ContractViolation(f"contract {contract.name!r}: columns {clash} occur twice among child rows")
    rows = elements(df, payload, path, keep, keep_childless)
    is_object = F.col("_status") == OBJECT
    if policy == STRICT:
        said = F.concat(F.lit(f"contract {contract.name!r}: element "), F.col("_pos").cast("string"), F.lit(" is no object: "), F.to_json("_element"))
        odd = ~is_object & F.col("_pos").isNotNull()
        element = F.when(odd, F.raise_error(said).cast("variant")).otherwise(F.col("_element"))
        rows = rows.withColumn("_element", element)
        # The element is looked at for every row, also where no column of the contract is asked for.
        rows = rows.where(F.col("_element").isNotNull() | F.col("_pos").isNull())
    kept = [F.col(quoted(k)) for k in keep]
    rows = rows.withColumn("_texts", _texts(contract, F.col("_element")))
    typed = [cell(F.col("_texts").getField(c.source), c, policy).alias(c.target) for c in contract.columns]
    if policy == STRICT:
        return rows.select(*kept, "_pos", *typed)
    other = F.when(~is_object & F.col("_element").isNotNull(), F.to_json("_element"))
    return rows.select(*kept, "_pos", *typed, "_status", other.alias("_element"))


def _objects(df: DataFrame, payload: str, path: Sequence[str]) -> tuple[DataFrame, str]:
    """The objects that a payload, or an array in it, consists of, and their column."""
    if path:
        return elements(df, payload, path).where(F.col("_status") == OBJECT), "_element"
    return df.where(_kind(F.col(quoted(payload))) == OBJECT), payload


def merged_schema(df: DataFrame, payload: str, path: Sequence[str] = ()) -> T.StructType:
    """The type all objects of a payload, or of an array in it, share, as Spark merges it; one pass.

    A field of several types is a VARIANT, one that is always null is VOID.
    """
    objects, name = _objects(df, payload, path)
    told = objects.agg(F.schema_of_variant_agg(F.col(quoted(name))).alias("s")).first()["s"]
    if not told.startswith("OBJECT"):  # none was there
        return T.StructType()
    return _told_type(told)


def _told_type(told: str) -> T.DataType:
    return T.DataType.fromDDL("v " + re.sub(r"(^|: |<)OBJECT<", r"\1STRUCT<", told))["v"].dataType


def _fields(df: DataFrame, payload: str, path: Sequence[str]) -> list[tuple[T.StructField, int | None]]:
    """The fields of ``merged_schema`` with the greatest length of each as text; both in one pass over the payloads."""
    held = elements(df, payload, path).select(F.col("_element").alias("held")) if path else df.select(F.col(quoted(payload)).alias("held"))
    each = held.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("held").outer())).where(F.col("key").isNotNull())
    length = F.max(F.length(F.try_variant_get("value", "$", "string")))
    told = each.groupBy("key").agg(F.schema_of_variant_agg("value").alias("s"), length.alias("n")).collect()
    told.sort(key=lambda r: r["key"].encode("utf-16-be"))
    return [(T.StructField(r["key"], _told_type(r["s"])), r["n"]) for r in told]


def proposed_contract(df: DataFrame, payload: str, name: str, path: Sequence[str] = ()) -> Contract:
    """A contract for the objects in a payload, or in an array in it, from the fields they hold.

    Whole numbers and decimals get the digits all rows need, texts the greatest length; nested arrays and objects
    and fields of several types are text. Targets are the names in capitals, with ``_`` for what a
    name may not hold. Nothing is proposed for fields that are always null.
    """
    specs, taken = [], set()
    for field, longest in _fields(df, payload, path):
        if isinstance(field.dataType, T.NullType):
            continue
        if isinstance(field.dataType, T.StringType):
            _step(field.name)
        else:
            longest = None
        target = re.sub(r"\W+", "_", field.name).strip("_").upper() or "FIELD"
        while target in taken:
            target += "_"
        taken.add(target)
        specs.append(_proposed(field, target, longest))
    return Contract(name, tuple(specs))


def _proposed(field: T.StructField, target: str, longest: int | None) -> ColumnSpec:
    kind = field.dataType
    if isinstance(kind, T.LongType | T.IntegerType | T.ShortType | T.ByteType):
        return ColumnSpec(field.name, target, "int", precision=18)
    if isinstance(kind, T.DecimalType):
        if kind.scale == 0 and kind.precision <= 18:
            return ColumnSpec(field.name, target, "int", precision=18)
        return ColumnSpec(field.name, target, "decimal", precision=kind.precision, scale=kind.scale)
    return ColumnSpec(field.name, target, length=longest)
