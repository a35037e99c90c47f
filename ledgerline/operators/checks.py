"""Reports on how incoming data fits its contract."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.contract import LENIENT, Contract, quoted
from ledgerline.functions import cell, violation
from ledgerline.operators.mapping import resolve


def header_drift(names: Column, contract: Contract) -> Column:
    """Array of (column, status) by which one header list departs from a contract.

    ``missing`` and ``extra`` compare the sets; ``duplicate`` marks a name met twice
    (case ignored); ``reordered`` marks shared columns when their order differs.
    """
    sources = F.array(*[F.lit(s) for s in contract.sources])
    shared_here = F.array_intersect(names, sources)
    shared_there = F.array_intersect(sources, names)
    folded = F.transform(names, F.lower)

    def tagged(items: Column, status: str) -> Column:
        return F.transform(items, lambda c: F.struct(c.alias("column"), F.lit(status).alias("status")))

    twice = F.array_distinct(
        F.filter(folded, lambda c: F.size(F.filter(folded, lambda d: d == c)) > 1)
    )
    moved = F.filter(
        shared_here,
        lambda c: F.array_position(shared_here, c) != F.array_position(shared_there, c),
    )
    return F.concat(
        tagged(F.array_except(sources, names), "missing"),
        tagged(F.array_except(names, sources), "extra"),
        tagged(twice, "duplicate"),
        tagged(moved, "reordered"),
    )


def schema_drift(documents: DataFrame, contract: Contract) -> DataFrame:
    """How many documents depart from the contract, per column and status.

    ``documents`` has one header list per row (column ``names``); only that column
    is read, and counts are combined before the shuffle.
    """
    return (
        documents.select(F.inline(header_drift(F.col("names"), contract)))
        .groupBy("column", "status")
        .agg(F.count(F.lit(1)).alias("n_documents"))
    )


def _cells(raw: DataFrame, contract: Contract) -> list[tuple]:
    found = resolve(contract, raw.columns)
    return [
        (spec, F.col(quoted(found[spec.target])))
        for spec in contract.columns
        if found[spec.target] is not None
    ]


def quality_report(raw: DataFrame, contract: Contract) -> DataFrame:
    """Per contract column: rows, NULL cells, failed conversions, limit breaches.

    ``n_bad`` counts cells the lenient conversion turns into NULL, and points that are
    none. A single pass over the raw table: each cell is looked at once, and the counts
    are combined before the shuffle, which moves one row per task.
    """
    present = _cells(raw, contract)
    looked_at = []
    for i, (spec, text) in enumerate(present):
        looked_at.append(text.isNull().alias(f"null_{i}"))
        if spec.kind != "string" or spec.length is not None:
            looked_at.append(violation(text, spec).alias(f"code_{i}"))
        if spec.kind in ("int", "epoch"):
            looked_at.append((text.isNotNull() & cell(text, spec, LENIENT).isNull()).alias(f"bad_{i}"))
    seen = raw.select(*looked_at)

    def counts(i: int, spec) -> list[Column]:
        code, never = F.col(f"code_{i}"), F.lit(0).cast("bigint")
        if spec.kind == "string":
            long = never if spec.length is None else F.count_if(code == "too_long")
            bad = out = never
        else:
            bad = F.count_if(f"bad_{i}") if spec.kind in ("int", "epoch") else F.count_if(code.isNotNull())
            long, out = never, never if spec.kind == "point" else F.count_if(code == "out_of_range")
        return [
            F.count_if(f"null_{i}").alias(f"n_null_{i}"),
            bad.alias(f"n_bad_{i}"),
            long.alias(f"n_long_{i}"),
            out.alias(f"n_out_{i}"),
        ]

    totals = seen.agg(
        F.count(F.lit(1)).alias("n"), *[c for i, (spec, _) in enumerate(present) for c in counts(i, spec)]
    )
    lines = [
        F.struct(
            F.lit(spec.target).alias("column"),
            F.col("n").alias("n_rows"),
            F.col(f"n_null_{i}").alias("n_null"),
            F.col(f"n_bad_{i}").alias("n_bad"),
            F.col(f"n_long_{i}").alias("n_too_long"),
            F.col(f"n_out_{i}").alias("n_out_of_range"),
        )
        for i, (spec, _) in enumerate(present)
    ]
    return totals.select(F.inline(F.array(*lines)))


def over_length(df: DataFrame, limits: dict[str, int], keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per text cell longer than its limit: kept columns, column, length, limit."""
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"),
                F.length(F.col(quoted(name))).alias("length"),
                F.lit(limit).alias("limit"),
            )
            for name, limit in limits.items()
        ]
    )
    kept = [F.col(quoted(k)) for k in keep]
    # The row filter keeps the scan from building entries for rows that fit.
    breach = reduce(
        lambda a, b: a | b, [F.length(F.col(quoted(n))) > limit for n, limit in limits.items()]
    )
    return df.where(breach).select(
        *kept, F.inline(F.filter(entries, lambda e: e["length"] > e["limit"]))
    )


def with_violations(raw: DataFrame, contract: Contract, name: str = "_violations") -> DataFrame:
    """The raw rows plus the codes (``COLUMN: code``) that would end a strict load."""
    codes = [
        F.when(violation(text, spec).isNotNull(), F.concat(F.lit(f"{spec.target}: "), violation(text, spec)))
        for spec, text in _cells(raw, contract)
    ]
    return raw.withColumn(name, F.array_compact(F.array(*codes)))


def split_valid(raw: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(rows a strict load accepts, rows to quarantine with their codes)."""
    checked = with_violations(raw, contract)
    good = checked.where(F.size("_violations") == 0).drop("_violations")
    return good, checked.where(F.size("_violations") > 0)
