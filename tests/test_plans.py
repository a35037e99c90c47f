"""What the physical plans read, move and run."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as registry
from conftest import plan
from ledgerline import LENIENT
from ledgerline.contracts import VEHICLES
from ledgerline.operators.incremental import latest_per_key, new_or_modified
from ledgerline.operators.mapping import apply_contract
from ledgerline.operators.summaries import avg_by, count_by
from ledgerline.plans.derived import as_text, registrations
from ledgerline.sources.files import file_summary
from ledgerline.sources.json_rows import extract


def test_summary_reads_two_columns_and_pushes_its_filter(spark, sf_small):
    text = plan(avg_by(spark.read.parquet(f"{sf_small}/lineitem.parquet"), "l_returnflag", "l_quantity", "a"))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,0.0)]" in text
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in text
    assert "partial_avg" in text


def test_filter_reaches_the_scan_through_the_renaming(spark, sf_small, tmp_path):
    registrations(spark, sf_small).write.parquet(str(tmp_path / "raw"))
    typed = apply_contract(spark.read.parquet(str(tmp_path / "raw")), VEHICLES, LENIENT)
    text = plan(count_by(typed, "CITY", "n", F.col("STATE") == "WA"))
    assert "EqualTo(State,WA)" in text
    assert "ReadSchema: struct<City:string,State:string>" in text


def test_typed_layer_pushes_what_the_raw_layer_cannot(spark, sf_small, tmp_path):
    raw = registrations(spark, sf_small)
    apply_contract(raw, VEHICLES, LENIENT).write.parquet(str(tmp_path / "typed"))
    typed = spark.read.parquet(str(tmp_path / "typed"))
    text = plan(avg_by(typed, "MAKE", "ELECTRIC_RANGE", "a"))
    assert "GreaterThan(ELECTRIC_RANGE,0)" in text


def test_partitioned_read_opens_one_partition(spark, sf_small):
    orders = registry.queries()["partitioned_write"](spark, sf_small)
    text = plan(count_by(orders, "o_orderpriority", where=F.col("o_orderstatus") == "F"))
    assert re.search(r"PartitionFilters: \[isnotnull\(o_orderstatus.*= F\)\]", text)


def test_json_is_parsed_once_per_row(spark, sf_small):
    payload = registrations(spark, sf_small).select(F.to_json(F.struct("*")).alias("j"))
    text = plan(extract(payload, "j", VEHICLES, LENIENT))
    assert text.count("from_json(") == 1


def test_latest_record_combines_before_the_shuffle(spark, sf_small):
    events = spark.read.parquet(f"{sf_small}/events.parquet")
    text = plan(latest_per_key(events, ["user_id"], ["ts", "event_id"]))
    assert "partial_max_by" in text and "Window" not in text


def test_change_detection_joins_on_its_key(spark, sf_small):
    orders = spark.read.parquet(f"{sf_small}/orders.parquet")
    text = plan(new_or_modified(orders, orders, ["o_orderkey"], ["o_totalprice"]))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_file_summary_reads_no_data_column(spark, sf_small):
    read = re.findall("ReadSchema: (.*)", plan(file_summary(spark, f"{sf_small}/orders.parquet")))
    assert len(read) == 1 and "o_" not in read[0]


def test_typing_is_one_projection(spark, sf_small):
    raw = as_text(spark.read.parquet(f"{sf_small}/orders.parquet"))
    text = plan(apply_contract(raw, VEHICLES, LENIENT))
    assert text.count("Project") <= 4 and "Exchange" not in text
