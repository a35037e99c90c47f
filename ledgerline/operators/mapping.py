"""Rename, select and type the columns of a contract in one projection."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.contract import LENIENT, STRICT, ColumnSpec, Contract, check_policy, quoted
from ledgerline.errors import ContractViolation
from ledgerline.functions import cell, number_cell


def resolve(contract: Contract, names: Sequence[str]) -> dict[str, str | None]:
    """For every target, the incoming column that feeds it, or None when absent.

    The exact source name wins; a column that already carries the target name is
    taken otherwise. Two candidates that differ are a contract violation, as are
    incoming names that differ by case alone.
    """
    folded: dict[str, str] = {}
    for name in names:
        if name.lower() in folded:
            raise ContractViolation(f"duplicate column {name!r} (also {folded[name.lower()]!r})")
        folded[name.lower()] = name
    present = set(names)
    found: dict[str, str | None] = {}
    for spec in contract.columns:
        hits = [n for n in dict.fromkeys((spec.source, spec.target)) if n in present]
        if len(hits) > 1:
            raise ContractViolation(f"{spec.target!r} is fed by both {hits[0]!r} and {hits[1]!r}")
        found[spec.target] = hits[0] if hits else None
    return found


def missing_columns(contract: Contract, names: Sequence[str]) -> list[str]:
    """Source names of the contract that the incoming columns do not provide."""
    found = resolve(contract, names)
    return [spec.source for spec in contract.columns if found[spec.target] is None]


def typed_cell(df: DataFrame, name: str, spec: ColumnSpec, policy: str) -> Column:
    """One contract cell from a column of ``df``, by the column's own type."""
    if isinstance(df.schema[name].dataType, T.NumericType):
        return number_cell(F.col(quoted(name)), spec, policy)
    return cell(F.col(quoted(name)).cast("string"), spec, policy)


def apply_contract(
    raw: DataFrame, contract: Contract, policy: str = LENIENT, keep: Iterable[str | Column] = ()
) -> DataFrame:
    """The typed table of a raw table; its columns are text, or numbers already.

    One ``select``: filters and column choices made on the result reach the scan.
    Absent sources give typed NULL columns under the lenient policy and end in an
    error under the strict one. ``keep`` passes further columns through untouched.
    """
    check_policy(policy)
    found = resolve(contract, raw.columns)
    absent = [spec.source for spec in contract.columns if found[spec.target] is None]
    if absent and policy == STRICT:
        raise ContractViolation(f"contract {contract.name!r}: missing columns {absent}")
    typed = []
    for spec in contract.columns:
        source = found[spec.target]
        if source is None:
            value = F.lit(None).cast(spec.data_type(policy))
        else:
            value = typed_cell(raw, source, spec, policy)
        typed.append(value.alias(spec.target))
    return raw.select(*typed, *keep)


def rename_select(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep the mapped columns that exist, renamed, in mapping order."""
    present = set(df.columns)
    return df.select(
        *[F.col(quoted(old)).alias(new) for old, new in mapping.items() if old in present]
    )
