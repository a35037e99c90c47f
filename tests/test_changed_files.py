"""Loads of new and changed files, and their ledger."""

import os
import re
import shutil

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from ledgerline import LENIENT, STRICT, ColumnSpec, Contract
from ledgerline.plans import changed_files as cf
from ledgerline.plans.changed_files import load_changed_documents, load_changed_files

CONTRACT = Contract("rows", (ColumnSpec("k", "KEY"), ColumnSpec("n", "N", "int", precision=9)), cluster_by=("KEY",))


@pytest.fixture
def place(tmp_path):
    os.makedirs(tmp_path / "in")
    return tmp_path


def put(place, name, rows, text="n"):
    path = place / "in" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table({"k": [k for k, _ in rows], text: [str(n) for _, n in rows]}), path)


def load(spark, place, **options):
    return load_changed_files(spark, str(place / "in"), CONTRACT, str(place / "typed"), str(place / "ledger"), **options)


def rows(spark, place, policy=STRICT):
    found = cf.current_rows(spark, CONTRACT, str(place / "typed"), str(place / "ledger"), policy)
    return sorted((r["KEY"], int(r["N"]), os.path.basename(r["_file"]), r["_load"]) for r in found.collect())


def lines(spark, place):
    found = cf.ledger(spark, str(place / "ledger")).collect()
    return sorted((r["_load"], os.path.basename(r["file"]), r["n_rows"], r["status"]) for r in found)


def written(place):
    return {(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(place / "typed") for f in names if f[0] not in "._"}


def test_changed_and_gone_files(spark, place):
    assert load(spark, place) == [] and rows(spark, place) == []
    put(place, "a.parquet", [("x", 1), ("y", 2)])
    put(place, "b.parquet", [("z", 3)])
    assert load(spark, place) == [1] and load(spark, place) == []
    before = written(place)
    put(place, "b.parquet", [("z", 4), ("w", 5)])
    put(place, "sub/a.parquet", [("v", 6)])  # the same name in another folder is another file
    os.remove(place / "in" / "a.parquet")
    assert load(spark, place) == [2]
    assert rows(spark, place) == [
        ("v", 6, "a.parquet", 2), ("w", 5, "b.parquet", 2), ("x", 1, "a.parquet", 1), ("y", 2, "a.parquet", 1), ("z", 4, "b.parquet", 2),
    ]
    assert load(spark, place, drop_gone=True) == [3] and load(spark, place, drop_gone=True) == []
    assert [r[0] for r in rows(spark, place)] == ["v", "w", "z"]
    assert before.items() <= written(place).items()  # folders once written are not touched
    assert lines(spark, place) == [
        (1, "a.parquet", 2, "new"), (1, "b.parquet", 1, "new"), (2, "a.parquet", 1, "new"), (2, "b.parquet", 2, "changed"),
        (3, "a.parquet", 0, "gone"),
    ]
    put(place, "a.parquet", [("back", 7)])
    assert load(spark, place) == [4] and ("back", 7, "a.parquet", 4) in rows(spark, place)


def test_a_failing_load_adds_no_line(spark, place):
    put(place, "a.parquet", [("x", 1)])
    load(spark, place)
    before, listed = rows(spark, place), lines(spark, place)
    put(place, "a.parquet", [("x", 2)])
    put(place, "b.parquet", [("y", "no number")])
    with pytest.raises(Exception, match="no number|not a number|N"):
        load(spark, place)
    assert rows(spark, place) == before and lines(spark, place) == listed
    put(place, "b.parquet", [("y", 3)])
    assert load(spark, place) == [2]
    assert [r[:2] for r in rows(spark, place)] == [("x", 2), ("y", 3)]


def test_a_load_that_dies_before_its_lines_does_not_count(spark, place, monkeypatch):
    put(place, "a.parquet", [("x", 1)])
    load(spark, place)
    put(place, "a.parquet", [("x", 2)])
    exchange = cf.Replacement._exchange_path

    def dies(self, beside, target, *lists):
        if "/ledger/" in target:
            raise OSError("gone")
        exchange(self, beside, target, *lists)

    monkeypatch.setattr(cf.Replacement, "_exchange_path", dies)
    with pytest.raises(OSError):
        load(spark, place)
    assert rows(spark, place) == [("x", 1, "a.parquet", 1)]  # its folder is there, and passed over
    monkeypatch.undo()
    assert load(spark, place) == [2] and rows(spark, place) == [("x", 2, "a.parquet", 2)]


def test_compaction(spark, place):
    for name in "abcd":
        put(place, f"{name}.parquet", [(name, i) for i in range(10)])
    load(spark, place)
    assert cf.compact(spark, CONTRACT, str(place / "typed"), str(place / "ledger")) is None
    for name in "ab":
        put(place, f"{name}.parquet", [(name, 100)])
    load(spark, place)
    before = [r[:3] for r in rows(spark, place)]
    assert cf.compact(spark, CONTRACT, str(place / "typed"), str(place / "ledger")) == 3
    assert [r[:3] for r in rows(spark, place)] == before and not os.path.exists(place / "typed" / "_load=1")
    assert {r[3] for r in rows(spark, place)} == {2, 3} and load(spark, place) == []
    put(place, "c.parquet", [("c", 7)])  # a moved file that changes
    assert load(spark, place) == [4]
    assert len(rows(spark, place)) == 1 + 1 + 1 + 10
    report = {r["_load"]: r.asDict() for r in cf.load_report(spark, str(place / "ledger")).collect()}
    assert (report[1]["n_rows"], report[1]["n_current"]) == (40, 0) and report[3]["n_current"] == 10


def test_few_files_at_a_time_and_odd_names(spark, place):
    names = ["a b.parquet", "{c}*.parquet", "[d]?.parquet", "é%20.parquet"]
    for i, name in enumerate(names):
        put(place, name, [(name, i)])
    assert load(spark, place, max_files_per_load=3) == [1, 2] and load(spark, place) == []
    assert [r[0] for r in rows(spark, place)] == sorted(names)


def test_payload_rows(spark, place):
    pq.write_table(pa.table({"j": ['{"k": "x", "n": "1"}', "broken"]}), place / "in" / "a.parquet")
    load(spark, place, payload="j", policy=LENIENT)
    found = cf.current_rows(spark, CONTRACT, str(place / "typed"), str(place / "ledger"), LENIENT)
    assert sorted((r["KEY"], r["N"]) for r in found.collect() if r["KEY"]) == [("x", 1)]


def test_changed_documents(spark, place):
    def document(name, rows):
        data = ", ".join(f'["{k}", "{n}"]' for k, n in rows)
        (place / "in" / name).write_text('{"meta": {"view": {"columns": [{"name": "k"}, {"name": "n"}]}}, "data": [%s]}' % data)

    def load():
        return load_changed_documents(
            spark, str(place / "in"), CONTRACT, str(place / "raw"), str(place / "typed"), str(place / "ledger"), drop_gone=True
        )

    document("a.json", [("x", 1), ("y", 2)])
    document("b.json", [("z", 3)])
    assert load() == [1] and load() == []
    document("a.json", [("x", 9)])
    shutil.copy(place / "in" / "b.json", place / "in" / "c.json")
    os.remove(place / "in" / "b.json")
    assert load() == [2] and load() == []
    assert rows(spark, place, LENIENT) == [("x", 9, "a.json", 2), ("z", 3, "c.json", 2)]
    assert spark.read.parquet(str(place / "raw")).count() == 5  # the raw copies of both loads stay


def test_plan_prunes_loads_and_joins_only_what_was_replaced(spark, place):
    from conftest import plan

    put(place, "a.parquet", [("x", 1)])
    load(spark, place)
    text = plan(cf.current_rows(spark, CONTRACT, str(place / "typed"), str(place / "ledger")))
    assert "Join" not in text and re.search(r"PartitionFilters: \[.*_load", text)
