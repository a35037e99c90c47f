"""What a failure while contents are put in place leaves behind: everything as it was."""

import os

import pytest

from ledgerline import STRICT, ColumnSpec, Contract
from ledgerline.plans import load_json_rows
from ledgerline.sinks import replacement
from ledgerline.sinks.replacement import Replacement


class Failing:
    """A session whose statements fail where they match."""

    def __init__(self, spark, *parts):
        self.spark, self.parts = spark, parts

    def __getattr__(self, name):
        return getattr(self.spark, name)

    def sql(self, text, *more, **named):
        if all(p in text for p in self.parts):
            raise RuntimeError("the catalog went away")
        return self.spark.sql(text, *more, **named)


@pytest.fixture
def tables(spark):
    for name in ("swap_one", "swap_two"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.range(3).write.saveAsTable(name)
    yield "swap_one", "swap_two"
    for name in ("swap_one", "swap_two"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def names(spark):
    return sorted(r["tableName"] for r in spark.sql("SHOW TABLES").collect() if r["tableName"].startswith("swap_"))


@pytest.mark.parametrize("place", ["first rename", "second rename", "second table"])
def test_a_failure_leaves_the_old_tables_and_folders(spark, tables, tmp_path, place):
    folder = str(tmp_path / "f")
    spark.range(1).write.parquet(folder)
    at = {"first rename": ("ALTER TABLE swap_one RENAME",), "second rename": ("RENAME TO swap_one", "_new_"),
          "second table": ("RENAME TO swap_two", "_new_")}[place]
    replaced = Replacement(Failing(spark, *at))
    spark.range(9).write.parquet(replaced.path(folder))
    for name in tables:
        spark.range(9).write.saveAsTable(replaced.table(name))
    with pytest.raises(RuntimeError, match="went away"):
        replaced.commit()
    assert names(spark) == list(tables)
    assert [spark.table(t).count() for t in tables] == [3, 3]
    assert spark.read.parquet(folder).count() == 1 and os.listdir(tmp_path) == ["f"]


def test_tables_are_replaced_and_created(spark, tables, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS other")
    try:
        for target in ("swap_one", "`other`.`swap_three`", "other.swap_four"):
            for n in (4, 5):
                with Replacement(spark) as replaced:
                    spark.range(n).write.saveAsTable(replaced.table(target))
                assert spark.table(target).count() == n
        assert names(spark) == ["swap_one", "swap_two"]
    finally:
        spark.sql("DROP DATABASE other CASCADE")


def test_a_failing_table_load_leaves_the_table(spark, tmp_path, monkeypatch):
    contract = Contract("rows", (ColumnSpec("k", "KEY", length=5),))
    spark.createDataFrame([("a",)], "k string").write.parquet(str(tmp_path / "one"))
    spark.createDataFrame([("b",), ("c",)], "k string").write.parquet(str(tmp_path / "two"))
    load_json_rows(spark, str(tmp_path / "one"), contract, table="swap_load", policy=STRICT)
    move = replacement.Replacement._exchange_table

    def dies(self, beside, target, undo, aside):
        self._spark = Failing(spark, "RENAME TO swap_load", "_new_")
        move(self, beside, target, undo, aside)

    monkeypatch.setattr(replacement.Replacement, "_exchange_table", dies)
    with pytest.raises(RuntimeError):
        load_json_rows(spark, str(tmp_path / "two"), contract, table="swap_load", policy=STRICT)
    monkeypatch.undo()
    assert [r["KEY"] for r in spark.table("swap_load").collect()] == ["a"]
    load_json_rows(spark, str(tmp_path / "two"), contract, table="swap_load", policy=STRICT)
    assert spark.table("swap_load").count() == 2
    spark.sql("DROP TABLE swap_load")
    assert names(spark) == []


def test_files_of_a_folder_are_exchanged_or_put_back(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "f")
    spark.range(0, 40, numPartitions=4).write.parquet(folder)
    old = sorted(r[0] for r in spark.read.parquet(folder).select("_metadata.file_path").distinct().collect())
    before = {f: os.path.getmtime(os.path.join(folder, f)) for f in os.listdir(folder)}
    moves = []
    move = Replacement._move

    def dies(self, source, target, undo=None):
        moves.append(target)
        if "part-00001-" in os.path.basename(target) and undo is not None:
            raise OSError("gone")
        move(self, source, target, undo)

    def exchange():
        with Replacement(spark) as replaced:
            rows = spark.range(100, 130, numPartitions=2).selectExpr("id", "0 AS _group")
            rows.write.partitionBy("_group").parquet(replaced.files(folder, old[1:3]))

    monkeypatch.setattr(Replacement, "_move", dies)
    with pytest.raises(OSError):
        exchange()
    assert {f: os.path.getmtime(os.path.join(folder, f)) for f in os.listdir(folder)} == before
    monkeypatch.undo()
    exchange()
    left = {f: t for f, t in before.items() if f.startswith("part") and not any(f in o for o in old[1:3])}
    after = {f: os.path.getmtime(os.path.join(folder, f)) for f in os.listdir(folder)}
    assert left.items() <= after.items() and len([f for f in after if f.startswith("part")]) == 4
    assert sorted(r[0] for r in spark.read.parquet(folder).collect()) == [*range(10), *range(30, 40), *range(100, 130)]
