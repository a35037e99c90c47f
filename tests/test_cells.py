"""The cell catalogue under both policies, ANSI flags and two time zones."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.contract import LENIENT, STRICT, ColumnSpec
from ledgerline.functions import (
    cell,
    lenient_decimal,
    lenient_epoch,
    lenient_int,
    point,
    strict_epoch,
    strict_number,
    strict_point,
    strict_text,
    violation,
)

SESSIONS = [
    (flag, zone) for flag in ("true", "false") for zone in ("UTC", "America/Los_Angeles")
]

# cell, lenient int, lenient decimal(12,2), strict number(38,0); "error" marks a raise
CELLS = [
    ("12", 12, "12.00", 12),
    (" 12 ", 12, "12.00", 12),
    ("12.7", 12, "12.70", 13),
    ("-12.7", -12, "-12.70", -13),
    ("12.345", 12, "12.35", 12),
    (".5", 0, "0.50", 1),
    (".", 0, None, "error"),
    ("+5", 5, "5.00", 5),
    ("007", 7, "7.00", 7),
    ("1e3", None, "1000.00", 1000),
    ("9999999999", None, "9999999999.00", 9999999999),
    ("99999999999.99", None, None, 100000000000),
    ("2147483648", None, "2147483648.00", 2147483648),
    ("abc", None, None, "error"),
    ("", None, None, "error"),
    ("1,000", None, None, "error"),
    ("0x1A", None, None, "error"),
    ("--5", None, None, "error"),
    ("5 5", None, None, "error"),
    ("12.7.1", None, None, "error"),
    ("\x00 7 \t", 7, "7.00", 7),
    ("7\x7f", 7, None, "error"),
    (None, None, None, None),
]


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "t string").coalesce(1)


@pytest.mark.parametrize("ansi", SESSIONS, indirect=True)
def test_lenient_numbers(spark, ansi):
    got = (
        texts(spark, [c[0] for c in CELLS])
        .select(
            "t", lenient_int(F.col("t")).alias("i"), lenient_decimal(F.col("t"), 12, 2).alias("d")
        )
        .collect()
    )
    want = [(c[0], c[1], None if c[2] is None else Decimal(c[2])) for c in CELLS]
    assert [tuple(r) for r in got] == want


@pytest.mark.parametrize("ansi", SESSIONS, indirect=True)
def test_strict_numbers(spark, ansi):
    fine = [c for c in CELLS if c[3] != "error"]
    got = texts(spark, [c[0] for c in fine]).select(strict_number(F.col("t"))).collect()
    assert [r[0] for r in got] == [c[3] for c in fine]


@pytest.mark.parametrize("flag", ["true", "false"])
@pytest.mark.parametrize("value", [c[0] for c in CELLS if c[3] == "error"])
def test_strict_number_raises(spark, value, flag):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", flag)
    try:
        with pytest.raises(Exception, match="x: not a number"):
            texts(spark, [value]).select(strict_number(F.col("t"), label="x")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_strict_number_raises_beyond_precision(spark):
    df = texts(spark, ["9999999999"])
    assert df.select(strict_number(F.col("t"), 10)).first()[0] == 9999999999
    with pytest.raises(Exception, match="not a number\\(4,0\\)"):
        df.select(strict_number(F.col("t"), 4)).collect()


def test_lenient_bigint_range(spark):
    values = ["9223372036854775807", "9223372036854775808", "-9223372036854775808.9"]
    got = texts(spark, values).select(lenient_int(F.col("t"), "bigint")).collect()
    assert [r[0] for r in got] == [2**63 - 1, None, -(2**63)]


EPOCHS = [
    ("1699171200", datetime(2023, 11, 5, 8)),
    ("1699174800", datetime(2023, 11, 5, 9)),
    ("12.7", datetime(1970, 1, 1, 0, 0, 12)),
    ("-1", datetime(1969, 12, 31, 23, 59, 59)),
    ("253402300799", datetime(9999, 12, 31, 23, 59, 59)),
    ("-62135596800", datetime(1, 1, 1)),
    ("abc", None),
    ("", None),
    ("1e3", None),
    ("253402300800", None),
    ("-62135596801", None),
    ("9999999999999", None),
    ("9223372036854775807", None),
    (None, None),
]


@pytest.mark.parametrize("ansi", SESSIONS, indirect=True)
def test_epoch(spark, ansi):
    got = texts(spark, [e[0] for e in EPOCHS]).select(lenient_epoch(F.col("t"))).collect()
    assert [r[0] for r in got] == [e[1] for e in EPOCHS]


def test_strict_epoch(spark):
    got = texts(spark, ["1699171200", "12.7", None]).select(strict_epoch(F.col("t"))).collect()
    assert [r[0] for r in got] == [datetime(2023, 11, 5, 8), datetime(1970, 1, 1, 0, 0, 13), None]
    for bad in ("abc", "1699171200000"):
        with pytest.raises(Exception, match="not epoch seconds"):
            texts(spark, [bad]).select(strict_epoch(F.col("t"))).collect()


def test_point(spark):
    values = ["POINT (-122.3 47.6)", "point(1 2.5)", " POINT ( 1e2 .5 ) ", "x", "POINT (1)", "", None]
    got = [r[0] for r in texts(spark, values).select(point(F.col("t"))).collect()]
    assert [(p.lon, p.lat) if p else None for p in got] == [
        (-122.3, 47.6), (1.0, 2.5), (100.0, 0.5), None, None, None, None,
    ]
    assert got[0].text == "POINT (-122.3 47.6)"
    with pytest.raises(Exception, match="not a point"):
        texts(spark, ["x"]).select(strict_point(F.col("t"))).collect()
    assert texts(spark, [None]).select(strict_point(F.col("t"))).first()[0] is None


def test_strict_text(spark):
    assert texts(spark, ["WA", None]).select(strict_text(F.col("t"), 2)).collect()[0][0] == "WA"
    with pytest.raises(Exception, match="STATE: longer than 2"):
        texts(spark, ["WAX"]).select(strict_text(F.col("t"), 2, "STATE")).collect()


@pytest.mark.parametrize(
    "spec",
    [
        ColumnSpec("t", "T", "int", precision=4),
        ColumnSpec("t", "T", "decimal", precision=5, scale=2),
        ColumnSpec("t", "T", "epoch"),
        ColumnSpec("t", "T", "point"),
        ColumnSpec("t", "T", length=3),
    ],
    ids=lambda s: s.kind,
)
def test_violation_agrees_with_strict(spark, spec):
    """A cell has a violation code exactly when the strict conversion raises."""
    values = [c[0] for c in CELLS] + ["POINT (1 2)", "9999.4", "9999.5", "999.994", "1699171200000"]
    codes = texts(spark, values).select("t", violation(F.col("t"), spec).alias("v")).collect()
    fine = [t for t, code in codes if code is None]
    strict = cell(F.col("t"), spec, STRICT)
    assert len(texts(spark, fine).select(strict).collect()) == len(fine)
    refused = [t for t, code in codes if code is not None]
    assert refused
    for value in refused[::4] + refused[-1:]:
        with pytest.raises(Exception, match="T: "):
            texts(spark, [value]).select(strict).collect()


def test_violation_codes(spark):
    spec = ColumnSpec("t", "T", "int", precision=4)
    got = texts(spark, ["12345", "x", "12", None]).select(violation(F.col("t"), spec)).collect()
    assert [r[0] for r in got] == ["out_of_range", "not_a_number", None, None]


def test_types(spark):
    for policy in (LENIENT, STRICT):
        for spec in (
            ColumnSpec("t", "T", "int", precision=4),
            ColumnSpec("t", "T", "decimal", precision=5, scale=2),
            ColumnSpec("t", "T", "epoch"),
            ColumnSpec("t", "T", "point"),
            ColumnSpec("t", "T", length=3),
        ):
            field = texts(spark, [None]).select(cell(F.col("t"), spec, policy).alias("c")).schema[0]
            assert field.dataType.simpleString() == spec.data_type(policy).simpleString()
