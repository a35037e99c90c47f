"""Columns that came under another name."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from ledgerline import STRICT, ColumnSpec, Contract
from ledgerline.contracts import VEHICLES
from ledgerline.errors import ContractViolation
from ledgerline.operators.renames import (
    best_assignment,
    column_signatures,
    drift_with_renames,
    rename_scores,
    renamed_columns,
    with_known_names,
)
from ledgerline.plans.derived import registrations


def halves(spark, sf):
    rows = registrations(spark, sf)
    first = F.col("DOL Vehicle ID").cast("long") % 2 == 0
    return rows.where(first), rows.where(~first)


def test_vehicle_columns_under_other_names(spark, sf_oracle):
    old, new = halves(spark, sf_oracle)
    names = {"City": "Town", "Model Year": "YEAR_OF_MODEL", "Vehicle Location": "geo", "Electric Utility": "Utility (Electric)"}
    later = new.withColumnsRenamed(names).drop("Make").withColumn("Colour", F.lit("red"))
    found = {(r["column"], r["status"]): r for r in drift_with_renames(later, VEHICLES, column_signatures(old)).collect()}
    assert {k: r["found_as"] for k, r in found.items() if k[1] == "renamed"} == {(a, "renamed"): b for a, b in names.items()}
    assert ("Make", "missing") in found and ("Colour", "extra") in found
    assert all(0.45 <= r["score"] <= 1 for k, r in found.items() if k[1] == "renamed")
    back = with_known_names(later, VEHICLES, column_signatures(old))
    assert set(names) <= set(back.columns) and back.select("City").exceptAll(new.select("City")).count() == 0
    with pytest.raises(ContractViolation, match="'City' came as 'Town'"):
        with_known_names(later, VEHICLES, column_signatures(old), refuse=True)


def test_lookalikes_stay_apart(spark):
    """Two counters with the same values, of which neither can be told from the other."""
    contract = Contract("c", (ColumnSpec("first_count", "A"), ColumnSpec("second_count", "B"), ColumnSpec("k", "K")))
    rows = spark.range(1000).select(
        F.col("id").cast("string").alias("k"), (F.col("id") % 97).cast("string").alias("first_count"),
        ((F.col("id") * 31) % 97).cast("string").alias("second_count"),
    )
    expected = column_signatures(rows)
    later = rows.withColumnsRenamed({"first_count": "x1", "second_count": "x2"})
    statuses = sorted((r["column"], r["status"]) for r in drift_with_renames(later, contract, expected).collect())
    assert statuses == [("first_count", "missing"), ("second_count", "missing"), ("x1", "extra"), ("x2", "extra")]
    one = rows.withColumnsRenamed({"first_count": "first counts"})  # with its name and no other candidate
    told = drift_with_renames(one, contract, expected).collect()
    assert [(r["column"], r["status"], r["found_as"]) for r in told] == [("first_count", "renamed", "first counts")]
    other = rows.drop("first_count").withColumn("first_counts", F.concat(F.lit("n/a "), "k", F.lit(" in all")))
    assert {r["status"] for r in drift_with_renames(other, contract, expected).collect()} == {"missing", "extra"}


def test_shares_of_common_values(spark):
    a = spark.range(0, 6000).select(F.col("id").cast("string").alias("v"))
    b = spark.range(3000, 9000).select(F.col("id").cast("string").alias("w"))
    score = rename_scores(column_signatures(a), column_signatures(b)).first()
    assert abs(score["values"] - 1 / 3) < 0.13 and score["shapes"] == pytest.approx(1)


def test_the_best_assignment_by_trying_all():
    rng = random.Random(1)
    for _ in range(200):
        n, m = rng.randint(1, 5), rng.randint(1, 5)
        scores = {(f"r{i}", f"c{j}"): rng.choice([0.0, rng.random()]) for i in range(n) for j in range(m)}
        got = best_assignment(scores)
        assert len(got) == min(n, m) == len(set(got.values()))
        tries = [sum(scores[f"r{i}", f"c{j}"] for i, j in zip(some, cols, strict=True))
                 for some in itertools.combinations(range(n), min(n, m)) for cols in itertools.permutations(range(m), min(n, m))]
        assert sum(scores[p] for p in got.items()) == pytest.approx(max(tries))
    assert best_assignment({}) == {}


def test_odd_columns(spark):
    contract = Contract("c", (ColumnSpec("a", "A"), ColumnSpec("b", "B")))
    rows = spark.createDataFrame([("x", None), (None, None)], "a string, b string")
    expected = column_signatures(rows)
    assert {r["column"] for r in expected.collect()} == {"a"}  # a column of NULLs has no signature
    none = spark.createDataFrame([], "z string")
    assert {r["status"] for r in drift_with_renames(none, contract, expected).collect()} == {"missing", "extra"}
    assert drift_with_renames(rows, contract, expected).count() == 0
    assert renamed_columns(expected, column_signatures(none)) == {}
    assert with_known_names(rows, contract, expected).columns == ["a", "b"]
    assert STRICT == "strict"
