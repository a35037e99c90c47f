"""Arrays of objects in payloads as child rows, and proposed contracts."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import plan
from ledgerline import LENIENT, STRICT, ColumnSpec, Contract
from ledgerline.errors import ContractViolation
from ledgerline.sources.nested import child_rows, elements, merged_schema, proposed_contract

CONTRACT = Contract("c", (ColumnSpec("x", "X", "int", precision=9), ColumnSpec("it's (y)", "Y")))
ODD = {
    1: '{"l": [{"x": 1, "it\'s (y)": "a"}, {"x": "2.7"}, {"it\'s (y)": {"z": [1]}}]}',
    2: '{"l": [null, 5, "t", [1], {}, true]}',
    3: '{"l": []}',
    4: '{"m": 1}',
    5: '{"l": null}',
    6: '{"l": {"x": 1}}',
    7: "[1]",
    8: None,
}


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(list(ODD.items()), "id int, j string")
    return rows.select("id", F.lit("kept").alias("pos"), F.parse_json("j").alias("p")).repartition(3)


def test_elements_of_every_kind(odd):
    got = child_rows(odd, "p", ["l"], CONTRACT, LENIENT, keep=["id", "pos"], keep_childless=True)
    assert got.columns == ["id", "pos", "_pos", "X", "Y", "_status", "_element"]
    rows = sorted((tuple(r)[:1] + tuple(r)[2:] for r in got.collect()), key=repr)
    assert rows == sorted([
        (1, 0, 1, "a", "object", None), (1, 1, 2, None, "object", None), (1, 2, None, '{"z":[1]}', "object", None),
        (2, 0, None, None, "null", "null"), (2, 1, None, None, "scalar", "5"), (2, 2, None, None, "scalar", '"t"'),
        (2, 3, None, None, "array", "[1]"), (2, 4, None, None, "object", None), (2, 5, None, None, "scalar", "true"),
        (3, None, None, None, "empty", None), (4, None, None, None, "missing", None), (5, None, None, None, "null", None),
        (6, None, None, None, "no array", None), (7, None, None, None, "missing", None), (8, None, None, None, "missing", None),
    ], key=repr)
    assert child_rows(odd, "p", ["l"], CONTRACT, LENIENT, keep=["id"]).count() == 9


def test_strict_elements(spark, odd):
    good = odd.where("id not in (1, 2)")
    assert child_rows(good, "p", ["l"], CONTRACT, STRICT, keep=["id"]).count() == 0
    kept = child_rows(good, "p", ["l"], CONTRACT, STRICT, keep=["id"], keep_childless=True).collect()
    assert {r["id"] for r in kept} == {3, 4, 5, 6, 7, 8} and all(r["X"] is None for r in kept)
    fine = odd.select("id", F.parse_json(F.lit('{"l": [{"x": "2"}, {"x": 3}]}')).alias("p")).where("id = 1")
    assert sorted(int(r["X"]) for r in child_rows(fine, "p", ["l"], CONTRACT, STRICT).collect()) == [2, 3]
    for element in ("null", "5", "[1]"):
        bad = spark.range(1).select(F.parse_json(F.lit('{"l": [{"x": 1}, %s]}' % element)).alias("p"))
        with pytest.raises(Exception, match="element 1 is no object"):
            child_rows(bad, "p", ["l"], CONTRACT, STRICT).count()
    word = spark.range(1).select(F.parse_json(F.lit('{"l": [{"x": "many"}]}')).alias("p"))
    with pytest.raises(Exception, match="X|number"):
        child_rows(word, "p", ["l"], CONTRACT, STRICT).collect()
    with pytest.raises(ContractViolation, match="twice"):
        child_rows(odd.withColumnRenamed("id", "X"), "p", ["l"], CONTRACT, keep=["X"])


def test_arrays_in_arrays(spark):
    rows = spark.range(1).select(F.lit(7).alias("id"), F.parse_json(F.lit('{"a": {"b c": [{"n": 1, "l": [{"x": 1}]}, {"n": 2, "l": [{"x": 2}, {"x": 3}]}]}}')).alias("p"))
    outer = elements(rows, "p", ["a", "b c"], keep=["id"])
    inner = child_rows(outer.withColumnRenamed("_pos", "outer"), "_element", ["l"], CONTRACT, keep=["id", "outer"])
    assert sorted((r["id"], r["outer"], r["_pos"], r["X"]) for r in inner.collect()) == [(7, 0, 0, 1), (7, 1, 0, 2), (7, 1, 1, 3)]
    whole = spark.range(1).select(F.parse_json(F.lit('[{"x": 4}]')).alias("p"))
    assert [r["X"] for r in child_rows(whole, "p", [], CONTRACT).collect()] == [4]
    text = plan(inner)
    assert "Exchange" not in text and "Join" not in text


def test_proposed_contracts(spark):
    rows = spark.createDataFrame([
        ('{"VIN (1-10)": "abc", "year": 2020, "price": 12.55, "mixed": 1, "never": null, "in": {"z": 1}, "big": 12345678901234567890}',),
        ('{"VIN (1-10)": "abcde", "year": null, "price": 100, "mixed": "t", "list": [1, {"OBJECT": 2}], "flag": true, "vin_1_10": "x"}',),
        ("[1]",), ("5",), (None,),
    ], "j string").select(F.parse_json("j").alias("p"))
    found = {c.source: c for c in proposed_contract(rows, "p", "cars").columns}
    assert set(found) == {"VIN (1-10)", "year", "price", "mixed", "in", "big", "list", "flag", "vin_1_10"}
    assert (found["VIN (1-10)"].length, found["VIN (1-10)"].target) == (5, "VIN_1_10") and found["vin_1_10"].target == "VIN_1_10_"
    assert (found["year"].kind, found["mixed"].kind, found["in"].kind, found["list"].length) == ("int", "string", "string", None)
    assert (found["price"].kind, found["price"].scale) == ("decimal", 2) and found["big"].precision >= 20
    listed = rows.select(F.to_variant_object(F.struct(F.array("p").alias("l"))).alias("q"))
    assert [c.source for c in proposed_contract(listed, "q", "c", ["l"]).columns] == [c for c in found]
    assert merged_schema(rows.where("false"), "p") == T.StructType() == merged_schema(rows.where("p is null"), "p")
    # What is proposed reads what it was proposed from.
    typed = child_rows(listed, "q", ["l"], proposed_contract(rows, "p", "cars"), LENIENT).where("_status = 'object'")
    assert sorted((str(r["VIN_1_10"]), r["YEAR"], str(r["PRICE"])) for r in typed.collect()) == [("abc", 2020, "12.55"), ("abcde", None, "100.00")]


def test_one_pass_over_the_payloads(spark):
    """Fields and lengths come together."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(j):
        seen.add(1)
        return j

    said = ['{"a": "xyz", "E": 1, "n": null}', '{"a": "x", "b": [1, 2], "d": "2020"}', '{"b": [{"c": 1}], "d": 12345}', "[1]", "{}", None]
    rows = spark.createDataFrame([(j,) for j in said], "j string").select(F.parse_json(told("j")).alias("p"))
    found = proposed_contract(rows, "p", "c")
    assert seen.value == len(said)
    assert [(c.source, c.target, c.kind, c.length) for c in found.columns] == [("E", "E", "int", None), ("a", "A", "string", 3), ("b", "B", "string", None), ("d", "D", "string", None)]
    assert merged_schema(rows, "p").fieldNames() == ["E", "a", "b", "d", "n"]


def test_odd_names_and_values_as_text(spark):
    names = Contract("c", (ColumnSpec("x", "X"), ColumnSpec("y`.z", "Y"), ColumnSpec("it's, <a>: b", "Z")))
    said = '[{"x": "a", "X": {"q": 1}, "y`.z": 2.50, "it\'s, <a>: b": {"q": [1.10]}}, 3, null, [{"x": 1}], {"X": "b"}, {"x": true}, {"x": null}]'
    rows = spark.createDataFrame([(said,)], "j string").select(F.parse_json("j").alias("p"))
    got = child_rows(rows, "p", [], names, LENIENT).orderBy("_pos").collect()
    assert [tuple(r)[1:] for r in got] == [
        ("a", "2.5", '{"q":[1.1]}', "object", None), (None, None, None, "scalar", "3"), (None, None, None, "null", "null"),
        (None, None, None, "array", '[{"x":1}]'), (None, None, None, "object", None), ("true", None, None, "object", None),
        (None, None, None, "object", None),
    ]
    text = plan(child_rows(rows, "p", [], names, LENIENT))
    assert "schema_of_variant" not in text.lower() and "schemaofvariant" not in text.lower()
