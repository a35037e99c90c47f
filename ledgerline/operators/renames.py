"""Columns that came under another name, found by what they hold.

Every column has a signature of bounded size, taken over all its values: the least hash in each of ``BINS`` bins
(one-permutation MinHash, from which the share of common values follows) and how often values have
each shape (digits, letters and what stands between them). A missing column and an extra one are alike by common
values, by shapes and by name; the best assignment of missing to extra columns is reported as renamings where it
is good enough and no other pairing of these columns comes near. Lookalikes (two counters, two codes of the
same form) therefore stay missing and extra, for someone to decide.

Cells are combined inside each task before they are moved; signatures of loads can be stored and compared
later without reading the rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.contract import Contract, quoted
from ledgerline.errors import ContractViolation

BINS = 128
#: Weights of common values, shapes and names; the least score of a renaming, and by how much it must be ahead of
#: other pairings of either column.
WEIGHTS = (0.5, 0.35, 0.15)
LEAST, AHEAD = 0.45, 0.08


def column_signatures(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column, kind (``value`` or ``shape``) and bin: least (hash) and n (cells); NULL cells are left out."""
    names = [c for c in df.columns if columns is None or c in columns]
    schema = "column string, kind string, bin int, least bigint, n bigint"
    if not names:
        return df.sparkSession.createDataFrame([], schema)
    cells = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(quoted(c)).cast("string").alias("cell")) for c in names])).alias("c")
    ).select("c.*").where(F.col("cell").isNotNull())
    shape = F.regexp_replace(F.regexp_replace("cell", r"\p{L}+", "a"), r"\d+", "9")
    entry = lambda kind, text: F.struct(F.lit(kind).alias("kind"), F.xxhash64(text).alias("hash"))
    each = cells.select("column", F.inline(F.array(entry("value", F.col("cell")), entry("shape", shape))))
    found = each.groupBy("column", "kind", F.pmod("hash", F.lit(BINS)).cast("int").alias("bin")).agg(
        F.min("hash").alias("least"), F.count(F.lit(1)).alias("n")
    )
    return found


def _likeness(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Per pair of columns: column, found_as, values (share of common values), shapes (common share)."""
    a = expected.select(F.col("column"), "kind", "bin", F.col("least").alias("least_a"), F.col("n").alias("n_a"))
    b = found.select(F.col("column").alias("found_as"), "kind", "bin", F.col("least").alias("least_b"), F.col("n").alias("n_b"))
    pairs = a.select("column").distinct().join(b.select("found_as").distinct(), F.lit(True))
    size = lambda df, name, n: df.where("kind = 'shape'").groupBy(name).agg(F.sum(n).alias(f"total_{n}"))
    filled = lambda df, name, n: df.where("kind = 'value'").groupBy(name).agg(F.count(F.lit(1)).alias(f"bins_{n}"))
    told = a.join(b, ["kind", "bin"]).join(size(a, "column", "n_a"), "column").join(size(b, "found_as", "n_b"), "found_as")
    common = told.groupBy("column", "found_as").agg(
        F.count_if((F.col("kind") == "value") & (F.col("least_a") == F.col("least_b"))).alias("same"),
        F.count_if(F.col("kind") == "value").alias("both"),
        F.sum(F.when(F.col("kind") == "shape", F.least(F.col("n_a") / F.col("total_n_a"), F.col("n_b") / F.col("total_n_b")))).alias("shapes"),
    )
    either = F.col("bins_n_a") + F.col("bins_n_b") - F.col("both")
    return (
        pairs.join(common, ["column", "found_as"], "left")
        .join(filled(a, "column", "n_a"), "column").join(filled(b, "found_as", "n_b"), "found_as")
        .select("column", "found_as", F.coalesce(F.col("same") / either, F.lit(0.0)).alias("values"),
                F.coalesce("shapes", F.lit(0.0)).alias("shapes"))
    )


def rename_scores(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Per pair of an expected and a found column (rows of :func:`column_signatures`): column, found_as, score (0 to 1)
    and its parts values, shapes, names."""
    plain = lambda c: F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}]+", ""))
    longest = F.greatest(F.length(plain("column")), F.length(plain("found_as")), F.lit(1))
    names = 1 - F.levenshtein(plain("column"), plain("found_as")) / longest
    pairs = _likeness(expected, found).withColumn("names", names)
    score: Column = sum(F.col(c) * w for c, w in zip(("values", "shapes", "names"), WEIGHTS, strict=True))
    return pairs.withColumn("score", score)


def best_assignment(scores: dict[tuple[str, str], float]) -> dict[str, str]:
    """The one-to-one assignment of rows to columns with the greatest sum (the Hungarian method)."""
    rows, columns = sorted({a for a, _ in scores}), sorted({b for _, b in scores})
    if not rows or not columns:
        return {}
    turned = len(rows) > len(columns)
    if turned:
        rows, columns, scores = columns, rows, {(b, a): s for (a, b), s in scores.items()}
    n, m = len(rows), len(columns)
    of_row, of_column = [0.0] * (n + 1), [0.0] * (m + 1)
    taken = [0] * (m + 1)  # the row of each column, from 1; 0 is none
    for i in range(1, n + 1):
        taken[0], at = i, 0
        least, came, seen = [float("inf")] * (m + 1), [0] * (m + 1), [False] * (m + 1)
        while taken[at]:
            seen[at] = True
            row, step, following = taken[at], float("inf"), 0
            for j in range(1, m + 1):
                if not seen[j]:
                    left = -scores.get((rows[row - 1], columns[j - 1]), 0.0) - of_row[row] - of_column[j]
                    if left < least[j]:
                        least[j], came[j] = left, at
                    if least[j] < step:
                        step, following = least[j], j
            for j in range(m + 1):
                if seen[j]:
                    of_row[taken[j]] += step
                    of_column[j] -= step
                else:
                    least[j] -= step
            at = following
        while at:
            taken[at], at = taken[came[at]], came[at]
    found = {rows[taken[j] - 1]: columns[j - 1] for j in range(1, m + 1) if taken[j]}
    return {b: a for a, b in found.items()} if turned else found


def renamed_columns(expected: DataFrame, found: DataFrame, least: float = LEAST, ahead: float = AHEAD) -> dict[str, tuple[str, float]]:
    """Expected columns to what they are called now, and the score.

    Only the scores of column pairs pass the driver.
    """
    scores = {(r["column"], r["found_as"]): r["score"] for r in rename_scores(expected, found).collect()}
    chosen = {}
    for a, b in best_assignment(scores).items():
        score = scores[a, b]
        others = [s for (x, y), s in scores.items() if (x == a) != (y == b)]
        if score >= least and score - max(others, default=0.0) >= ahead:
            chosen[a] = (b, score)
    return chosen


def drift_with_renames(raw: DataFrame, contract: Contract, expected: DataFrame) -> DataFrame:
    """How a raw table departs from the contract: column, status (``missing``, ``extra``, ``renamed``), found_as, score.

    ``expected`` are the signatures of the contract's source columns in an earlier load.
    """
    missing, extra = _apart(raw, contract)
    renamed = _renamed(raw, missing, extra, expected)
    rows = [(c, "renamed", *renamed[c]) if c in renamed else (c, "missing", None, None) for c in missing]
    rows += [(c, "extra", None, None) for c in extra if c not in {b for b, _ in renamed.values()}]
    return raw.sparkSession.createDataFrame(rows, "column string, status string, found_as string, score double")


def _apart(raw: DataFrame, contract: Contract) -> tuple[list[str], list[str]]:
    known = {*contract.sources, *contract.targets}
    missing = [c.source for c in contract.columns if c.source not in raw.columns and c.target not in raw.columns]
    return missing, [c for c in raw.columns if c not in known]


def _renamed(raw: DataFrame, missing: list[str], extra: list[str], expected: DataFrame) -> dict[str, tuple[str, float]]:
    if not missing or not extra:
        return {}
    return renamed_columns(expected.where(F.col("column").isin(missing)), column_signatures(raw, extra))


def with_known_names(raw: DataFrame, contract: Contract, expected: DataFrame, refuse: bool = False) -> DataFrame:
    """The raw table with renamed columns under their source names again.

    With ``refuse`` a renaming ends the load instead (a strict load that is to say what it found).
    """
    missing, extra = _apart(raw, contract)
    renamed = _renamed(raw, missing, extra, expected)
    if refuse and renamed:
        told = ", ".join(f"{a!r} came as {b!r} ({score:.2f})" for a, (b, score) in sorted(renamed.items()))
        raise ContractViolation(f"contract {contract.name!r}: {told}")
    back = {b: a for a, (b, _) in renamed.items()}
    return raw.select(*[F.col(quoted(c)).alias(back.get(c, c)) for c in raw.columns])
