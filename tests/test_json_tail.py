"""Text behind the first JSON value of a payload."""

import pytest

from ledgerline.contract import LENIENT, STRICT, ColumnSpec, Contract
from ledgerline.sources import json_rows

GOOD = ['{"a":"1"}', '{"a":"1"} \n ', '{"a":{"b":[1,2]}}', '{"a":"]}"}', '{"a":"}"}']
BAD = [
    '{"a":"1"} junk', '{"a":"2"}{"a":"3"}', '{"a":"1"},{"a":"2"}', '{"a":"1"}]', '{"a":"1"}]}', '{"a":"1"}],"b":["2"',
    '{"a":"1"}]} x', '"x"}', '{"a":"}"} x',
]
CONTRACT = Contract("tail", [ColumnSpec("a", "A", "string")])


def payloads(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, p string")


def test_text_behind_the_value_is_listed(spark):
    rows = json_rows.malformed_rows(payloads(spark, [*GOOD, *BAD, None, " "]), "p").collect()
    assert sorted(r["p"] for r in rows) == sorted(BAD)


def test_lenient_reads_no_part_of_it(spark):
    rows = json_rows.parse_fields(payloads(spark, [*GOOD, *BAD]), "p", CONTRACT, LENIENT, ("i",)).collect()
    got = {r["i"]: r["a"] for r in rows}
    assert [got[i] for i in range(len(GOOD))] == ["1", "1", '{"b":[1,2]}', "]}", "}"]
    assert not any(got[i] for i in range(len(GOOD), len(GOOD) + len(BAD)))


@pytest.mark.parametrize("text", BAD)
def test_strict_raises(spark, text):
    with pytest.raises(Exception, match="text behind the JSON value|MALFORMED|malformed"):
        json_rows.parse_fields(payloads(spark, [text]), "p", CONTRACT, STRICT).collect()
