"""Contracts, column resolution and the single typed projection."""

import json
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline import LENIENT, STRICT, ColumnSpec, Contract, ContractViolation, load_contract
from ledgerline.contract import string_schema
from ledgerline.contracts import VEHICLES
from ledgerline.operators.mapping import apply_contract, missing_columns, rename_select, resolve
from ledgerline.operators.summaries import avg_by, count_by, trend_by

SMALL = Contract(
    "small",
    (
        ColumnSpec("sid", "SID", length=5),
        ColumnSpec("Model Year", "MODEL_YEAR", "int", precision=4),
        ColumnSpec("Base MSRP", "BASE_MSRP", "decimal", precision=12, scale=2),
        ColumnSpec("2020 Census Tract", "2020_CENSUS_TRACT", length=20),
    ),
)


def frame(spark, names, rows):
    return spark.createDataFrame(rows, string_schema(names))


def test_vehicle_contract_shape():
    kinds = [c.kind for c in VEHICLES.columns]
    assert len(kinds) == 25
    assert (kinds.count("int"), kinds.count("epoch"), kinds.count("decimal")) == (7, 2, 1)
    assert VEHICLES.schema(LENIENT)["MODEL_YEAR"].dataType.simpleString() == "int"
    assert VEHICLES.schema(STRICT)["MODEL_YEAR"].dataType.simpleString() == "decimal(4,0)"
    assert VEHICLES.schema(LENIENT)["VEHICLE_LOCATION"].dataType.simpleString() == "string"
    assert VEHICLES.schema(STRICT)["CREATED_AT"].dataType.simpleString() == "timestamp_ntz"


def test_contract_as_json(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps(json.loads(VEHICLES.to_json()), indent=1))
    assert load_contract(spark, str(tmp_path / "c.json")) == VEHICLES
    (tmp_path / "d.json").write_text('{"name": "x"}')
    with pytest.raises(ContractViolation, match="not a contract document"):
        load_contract(spark, str(tmp_path / "d.json"))


@pytest.mark.parametrize(
    "columns",
    [
        (ColumnSpec("a", "A"), ColumnSpec("b", "a")),
        (ColumnSpec("a", "A"), ColumnSpec("A", "B")),
    ],
)
def test_contract_refuses_repeated_names(columns):
    with pytest.raises(ContractViolation, match="repeated"):
        Contract("c", columns)


def test_contract_refuses_unknown_kind_and_key():
    with pytest.raises(ContractViolation, match="unknown kind"):
        ColumnSpec("a", "A", "float")
    with pytest.raises(ContractViolation, match="precision"):
        ColumnSpec("a", "A", "decimal")
    with pytest.raises(ContractViolation, match="cluster keys"):
        Contract("c", (ColumnSpec("a", "A"),), cluster_by=("B",))


def test_lenient_types_and_missing(spark):
    raw = frame(spark, ["Model Year", "sid", "more"], [("2020.5", "row-1", "x"), ("n/a", None, "y")])
    typed = apply_contract(raw, SMALL, LENIENT)
    assert typed.schema == SMALL.schema(LENIENT)
    assert [tuple(r) for r in typed.collect()] == [("row-1", 2020, None, None), (None, None, None, None)]
    assert missing_columns(SMALL, raw.columns) == ["Base MSRP", "2020 Census Tract"]


def test_strict_refuses_missing(spark):
    raw = frame(spark, ["sid"], [("row-1",)])
    with pytest.raises(ContractViolation, match="missing columns"):
        apply_contract(raw, SMALL, STRICT)


def test_strict_types(spark):
    raw = frame(spark, SMALL.sources, [("row-1", "2019.5", "39990.505", "53033")])
    typed = apply_contract(raw, SMALL, STRICT)
    assert tuple(typed.first()) == ("row-1", Decimal(2020), Decimal("39990.51"), "53033")
    assert typed.schema == SMALL.schema(STRICT)


def test_strict_refuses_cells(spark):
    for row, message in [
        (("toolong", "2019", "1", "x"), "SID: longer than 5"),
        (("row", "20190", "1", "x"), "MODEL_YEAR: not a number"),
        (("row", "2019", "1,000", "x"), "BASE_MSRP: not a number"),
    ]:
        with pytest.raises(Exception, match=message):
            apply_contract(frame(spark, SMALL.sources, [row]), SMALL, STRICT).collect()


def test_target_names_are_taken_too(spark):
    raw = frame(spark, ["SID", "MODEL_YEAR"], [("row-1", "2019")])
    assert apply_contract(raw, SMALL, LENIENT).first()["MODEL_YEAR"] == 2019


def test_ambiguous_columns_are_refused():
    with pytest.raises(ContractViolation, match="duplicate column"):
        resolve(SMALL, ["sid", "SID"])
    two = Contract("two", (ColumnSpec("Model Year", "MODEL_YEAR"),))
    with pytest.raises(ContractViolation, match="fed by both"):
        resolve(two, ["Model Year", "MODEL_YEAR"])


def test_source_match_is_case_sensitive():
    assert resolve(SMALL, ["model year"])["MODEL_YEAR"] is None


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(order=st.permutations(SMALL.sources))
def test_column_order_does_not_matter(spark, order):
    values = dict(zip(SMALL.sources, ("row-1", "2019", "1.5", "t"), strict=True))
    raw = frame(spark, order, [tuple(values[n] for n in order)])
    assert tuple(apply_contract(raw, SMALL, LENIENT).first()) == ("row-1", 2019, Decimal("1.50"), "t")


def test_rename_select(spark):
    df = frame(spark, ["VIN (1-10)", "b`c", "d"], [("1", "2", "3")])
    out = rename_select(df, {"b`c": "BC", "absent": "X", "VIN (1-10)": "VIN_1_10"})
    assert out.columns == ["BC", "VIN_1_10"] and tuple(out.first()) == ("2", "1")


@pytest.fixture(scope="module")
def mini(spark):
    rows = [
        ("TESLA", "Seattle", "WA", "BEV", 2020, 200),
        ("TESLA", "Seattle", "WA", "BEV", 2021, 0),
        ("TESLA", "Tacoma", "WA", None, None, 301),
        ("NISSAN", "Portland", "OR", "BEV", 2020, 0),
        ("NISSAN", "Portland", "OR", "PHEV", 2019, None),
        ("FORD", "Tacoma", "WA", None, 2021, 20),
    ]
    return spark.createDataFrame(
        rows,
        "MAKE string, CITY string, STATE string, ELECTRIC_VEHICLE_TYPE string, "
        "MODEL_YEAR int, ELECTRIC_RANGE int",
    )


def test_average_leaves_out_zero_and_null(mini):
    got = [tuple(r) for r in avg_by(mini, "MAKE", "ELECTRIC_RANGE", "avg_range").collect()]
    assert got == [("TESLA", 250.5), ("FORD", 20.0)]
    every = avg_by(mini, "MAKE", "ELECTRIC_RANGE", "a", positive_only=False).collect()
    assert [r["MAKE"] for r in every] == ["TESLA", "FORD", "NISSAN"]


def test_counts(mini):
    by_city = count_by(mini, "CITY", "n", F.col("STATE") == "WA", most_frequent_first=True)
    assert [tuple(r) for r in by_city.collect()] == [("Seattle", 2), ("Tacoma", 2)]
    by_type = {r[0]: r[1] for r in count_by(mini, "ELECTRIC_VEHICLE_TYPE").collect()}
    assert by_type == {"BEV": 3, "PHEV": 1, None: 2}


def test_trend(mini):
    got = [tuple(r) for r in trend_by(mini, "MODEL_YEAR", "n").collect()]
    assert got == [(2019, 1), (2020, 2), (2021, 2)]
