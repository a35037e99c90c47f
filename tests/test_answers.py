"""Every registered query against its SQL answer in DuckDB."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as registry
from conftest import plan
from ledgerline.plans.answers import ANSWERS
from ledgerline.plans.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def answers(sf_oracle):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf_oracle, name)}.parquet'")
    return con


def settled(value):
    if isinstance(value, decimal.Decimal):
        return (float(value), value.as_tuple().exponent)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def in_order(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(settled(r[i]) for i in order) for r in rows], key=repr)


def kind(type_name):
    """A coarse type both engines share."""
    name = str(type_name).lower()
    return {
        "integer": "int", "int": "int", "bigint": "bigint", "varchar": "string", "string": "string",
        "double": "double", "timestamp": "timestamp", "timestamp_ntz": "timestamp",
        "timestamp_us": "timestamp", "timestamp_ns": "timestamp",
    }.get(name, name)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_answer(spark, answers, sf_oracle, name):
    got = QUERIES[name](spark, sf_oracle)
    for node in ("PythonUDF", "EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan(got)
    want = answers.execute(ANSWERS[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    types = {d[0]: kind(d[1]) for d in want.description}
    assert {f.name: kind(f.dataType.simpleString()) for f in got.schema} == types
    rows = [tuple(r) for r in got.collect()]
    expected = want.fetchall()
    assert len(rows) == len(expected)
    assert in_order(rows, got.columns) == in_order(expected, names)


def test_entry(spark):
    assert registry.entry(spark).count() == 3


def test_every_answer_has_its_query():
    assert set(ANSWERS) == set(QUERIES)
    assert set(QUERIES) <= set(registry.queries())
    assert set(registry.oracle_sql()) <= set(registry.queries())
