"""The registered queries: every operator run over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.contract import LENIENT, STRICT, ColumnSpec, Contract, load_contract
from ledgerline.contracts import VEHICLES
from ledgerline.functions import (
    lenient_decimal,
    lenient_epoch,
    lenient_int,
    point,
    strict_epoch,
    strict_number,
)
from ledgerline.operators import checks, incremental, summaries
from ledgerline.operators.mapping import apply_contract, rename_select
from ledgerline.plans import upkeep
from ledgerline.plans.derived import (
    LINEITEM,
    ORDERS,
    ROWS_PER_DOCUMENT,
    as_text,
    dirty_orders,
    documents,
    given,
    registrations,
    seconds_of,
    write_documents,
)
from ledgerline.plans.loads import envelopes_to_raw, load_envelopes, load_json_rows, refused_beside
from ledgerline.scratch import scratch_path
from ledgerline.sinks.tables import (
    clustered,
    counted,
    create_table,
    insert_by_name,
    range_partitions,
    rebalanced,
    write_raw,
    write_table,
)
from ledgerline.sources import envelope, files, json_rows
from ledgerline.sources.long_documents import cut_documents
from ledgerline.streaming import load_new_documents, load_new_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = dict(upkeep.QUERIES)


def registered(query):
    QUERIES[query.__name__] = query
    return query


# Summaries


@registered
def avg_positive_by_group(spark, sf_dir):
    items = given(spark, sf_dir, "lineitem")
    means = summaries.avg_by(items, "l_returnflag", "l_quantity", "avg_qty")
    return means.withColumn("avg_qty", F.round("avg_qty", 6))


@registered
def typed_average(spark, sf_dir):
    """From text columns through the contract to the grouped mean."""
    raw = as_text(given(spark, sf_dir, "lineitem"))
    typed = apply_contract(raw, LINEITEM, LENIENT)
    means = summaries.avg_by(typed, "RETURN_FLAG", "QUANTITY", "avg_qty")
    return means.withColumn("avg_qty", F.round("avg_qty", 6))


@registered
def count_by_group(spark, sf_dir):
    return summaries.count_by(given(spark, sf_dir, "events"), "event_type")


@registered
def count_filtered_by_group(spark, sf_dir):
    return summaries.count_by(
        given(spark, sf_dir, "customer"),
        "c_nationkey",
        "n",
        where=F.col("c_mktsegment") == "BUILDING",
        most_frequent_first=True,
    )


@registered
def trend_by_year(spark, sf_dir):
    orders = given(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("order_year"))
    return summaries.trend_by(orders, "order_year", "n")


@registered
def row_count(spark, sf_dir):
    return summaries.row_count(given(spark, sf_dir, "orders"))


@registered
def preview_rows(spark, sf_dir):
    return summaries.preview(given(spark, sf_dir, "orders"), 5, ["o_orderkey"])


# Envelope documents


@registered
def envelope_columns(spark, sf_dir):
    texts = documents(given(spark, sf_dir, "supplier"))
    found = envelope.envelope_columns(envelope.parse_envelopes(texts, "value"))
    return found.select("position", "name").distinct()


@registered
def envelope_rows(spark, sf_dir):
    """Supplier documents as files; header orders differ from file to file."""
    texts = documents(given(spark, sf_dir, "supplier"), alternate=True)
    path = write_documents(texts, scratch_path(spark, "suppliers"))
    found = envelope.read_envelopes(spark, path)
    names = envelope.header_names(found)
    return envelope.to_raw(envelope.envelope_rows(found, names), names)


@registered
def raw_all_string(spark, sf_dir):
    events = given(spark, sf_dir, "events")
    found = envelope.parse_envelopes(documents(events, alternate=True), "value")
    return envelope.to_raw(envelope.envelope_rows(found, events.columns), events.columns)


@registered
def raw_roundtrip(spark, sf_dir):
    """Documents in lines to a Parquet copy, read back."""
    orders = given(spark, sf_dir, "orders")
    lines = scratch_path(spark, "order-lines")
    documents(orders).write.text(lines)
    found = envelope.read_envelopes(spark, lines, one_per_line=True)
    path = scratch_path(spark, "orders-raw")
    rows = envelope.envelope_rows(found, orders.columns)
    write_raw(envelope.to_raw(rows, orders.columns), path)
    return spark.read.parquet(path)


@registered
def quarantine_ragged(spark, sf_dir):
    """Rows that miss a cell, or bring one too many, per number of cells."""
    text = [F.col(c).cast("string") for c in ("o_orderkey", "o_custkey", "o_orderstatus")]
    cells = (
        F.when(F.col("o_orderstatus") == "P", F.array(*text[:2]))
        .when(F.col("o_orderpriority") == "1-URGENT", F.array(*text, F.lit("more")))
        .otherwise(F.array(*text))
    )
    texts = documents(
        given(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus"], cells=cells
    )
    rows = envelope.envelope_rows(envelope.parse_envelopes(texts, "value"))
    out = envelope.quarantined_rows(rows)
    return out.select(
        F.col("_row")[0].cast("bigint").alias("o_orderkey"), "reason", "n_names", "n_cells"
    )


@registered
def long_documents(spark, sf_dir):
    """Order documents cut between tasks as if each were too long for one."""
    orders = given(spark, sf_dir, "orders")
    path = write_documents(documents(orders, alternate=True), scratch_path(spark, "long"))
    cut = cut_documents(spark, path, 0)
    return envelope.to_raw(cut.rows(orders.columns), orders.columns)


@registered
def document_tail(spark, sf_dir):
    """A document per order; one in three is followed by text, one by a second document."""
    columns = ["o_orderkey", "o_custkey", "o_orderstatus"]
    row = F.array(*[F.col(c).cast("string") for c in columns])
    header = F.struct(F.struct(F.array(*[F.struct(F.lit(c).alias("name")) for c in columns]).alias("columns")).alias("view"))
    one = F.to_json(F.struct(header.alias("meta"), F.array(row).alias("data")))
    form = F.col("o_orderkey") % 3
    texts = given(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(one, F.when(form == 1, " garbage [").when(form == 2, one).otherwise("\n")).alias("value"),
    )
    found = envelope.parse_envelopes(texts, "value", F.col("o_orderkey").cast("string"))
    rows = envelope.envelope_rows(found, columns)
    return rows.select(
        F.col("_file").cast("bigint").alias("o_orderkey"),
        F.col("_status").alias("status"),
        F.when(F.col("_status") == "ok", F.col("_row")[1]).cast("bigint").alias("o_custkey"),
    )


@registered
def mixed_documents(spark, sf_dir):
    """Order documents of very different sizes; the larger ones are cut between tasks."""
    orders = given(spark, sf_dir, "orders")
    base = scratch_path(spark, "mixed")
    # A document for each range of keys: a tenth of its orders, and the others.
    few, ranges = F.col("o_orderkey") % 10 == 0, F.expr(f"o_orderkey div {ROWS_PER_DOCUMENT}")
    write_documents(documents(orders.where(few), alternate=True, number=ranges), f"{base}/in/few")
    write_documents(documents(orders.where(~few), alternate=True, number=ranges), f"{base}/in/many")
    envelopes_to_raw(spark, f"{base}/in/*", f"{base}/raw", long_file_bytes=200_000)
    return spark.read.parquet(f"{base}/raw")


@registered
def refused_rows(spark, sf_dir):
    """Every order is in the raw copy or among the refused rows of the same load."""
    key, customer = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    cells = F.when(F.col("o_orderstatus") == "P", F.array(key)).otherwise(F.array(key, customer))
    texts = documents(given(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey"], cells=cells)
    base = scratch_path(spark, "refused")
    write_documents(texts, f"{base}/in")
    envelopes_to_raw(spark, f"{base}/in", f"{base}/raw")
    loaded = spark.read.parquet(f"{base}/raw").select("o_orderkey", F.lit("loaded").alias("place"))
    refused = spark.read.parquet(refused_beside(f"{base}/raw"))
    return loaded.unionByName(
        refused.select(F.col("_row")[0].alias("o_orderkey"), F.col("reason").alias("place"))
    )


# Mapping and conversions


@registered
def map_rename_select(spark, sf_dir):
    raw = as_text(given(spark, sf_dir, "lineitem"))
    contract = Contract(
        "lines",
        (
            ColumnSpec("l_orderkey", "ORDER_KEY"),
            ColumnSpec("l_linenumber", "LINE"),
            ColumnSpec("l_shipmode", "SHIP_MODE"),
            ColumnSpec("l_returnflag", "RETURN_FLAG"),
        ),
    )
    return apply_contract(raw, contract, LENIENT)


@registered
def rename_present(spark, sf_dir):
    """A renaming that names a column the table lacks: it is left out."""
    return rename_select(
        given(spark, sf_dir, "part"),
        {"p_partkey": "PART_KEY", "p_colour": "COLOUR", "p_brand": "BRAND"},
    )


@registered
def cast_int_lenient(spark, sf_dir):
    return dirty_orders(spark, sf_dir).select("o_orderkey", lenient_int(F.col("amount")).alias("amount"))


@registered
def cast_decimal_lenient(spark, sf_dir):
    text = F.when(F.col("p_partkey") % 5 == 0, "n/a").otherwise(F.col("p_retailprice").cast("string"))
    return given(spark, sf_dir, "part").select(
        "p_partkey", lenient_decimal(text, 12, 2).alias("price")
    )


@registered
def cast_number_strict(spark, sf_dir):
    text = (F.col("l_quantity") + 0.5).cast("string")
    return given(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", strict_number(text, 38, 0, "QUANTITY").alias("quantity")
    )


@registered
def epoch_to_timestamp(spark, sf_dir):
    text = seconds_of(F.col("ts")).cast("string")
    return given(spark, sf_dir, "events").select(
        "event_id",
        lenient_epoch(text).alias("lenient_ts"),
        strict_epoch(text).alias("strict_ts"),
        lenient_epoch(F.concat(text, F.lit("000"))).alias("milliseconds"),
    )


@registered
def point_parse(spark, sf_dir):
    """Account balances as longitudes: those beyond 180 degrees are no points."""
    longitude = (F.col("s_acctbal") / 50).cast("string")
    text = F.concat(F.lit("POINT ("), longitude, F.lit(" 47.6)"))
    return given(spark, sf_dir, "supplier").select("s_suppkey", point(text).alias("p")).select(
        "s_suppkey", F.col("p.lon").alias("lon"), F.col("p.lat").alias("lat")
    )


# JSON rows

_PROPS = Contract("props", (ColumnSpec("k", "K", "int", precision=18),))


@registered
def json_extract_strict(spark, sf_dir):
    out = json_rows.extract(given(spark, sf_dir, "events"), "props", _PROPS, STRICT, keep=("event_id",))
    return out.select("event_id", F.col("K").cast("bigint").alias("k"))


@registered
def json_extract_lenient(spark, sf_dir):
    cut = F.expr("left(props, length(props) - 1)")
    broken = given(spark, sf_dir, "events").withColumn(
        "props", F.when(F.col("event_id") % 10 == 0, cut).otherwise(F.col("props"))
    )
    out = json_rows.extract(broken, "props", _PROPS, LENIENT, keep=("event_id",))
    return out.select("event_id", F.col("K").cast("bigint").alias("k"))


@registered
def json_malformed(spark, sf_dir):
    """The rows of the lenient case that a strict load would stop at."""
    cut = F.expr("left(props, length(props) - 1)")
    broken = given(spark, sf_dir, "events").withColumn(
        "props", F.when(F.col("event_id") % 10 == 0, cut).otherwise(F.col("props"))
    )
    return json_rows.malformed_rows(broken, "props").select("event_id", "props")


@registered
def json_tail(spark, sf_dir):
    """Payloads followed by text or by a second object: malformed, and NULL in a lenient load."""
    form = F.col("event_id") % 10
    tailed = given(spark, sf_dir, "events").withColumn(
        "props", F.concat("props", F.when(form == 0, " junk").when(form == 1, F.col("props")).otherwise(" "))
    )
    bad = json_rows.malformed_rows(tailed, "props").select("event_id", F.lit("malformed").alias("found"))
    loaded = json_rows.extract(tailed, "props", _PROPS, LENIENT, keep=("event_id",))
    values = loaded.where("K is not null").select("event_id", F.col("K").cast("string").alias("found"))
    return bad.unionByName(values)


@registered
def key_drift(spark, sf_dir):
    """Keys the objects hold beside, or lack of, those declared."""
    contract = Contract("props", (ColumnSpec("absent", "ABSENT"),))
    return json_rows.key_drift(given(spark, sf_dir, "events"), "props", contract)


@registered
def row_as_variant(spark, sf_dir):
    v = json_rows.row_as_variant(given(spark, sf_dir, "part"))
    return v.select(
        json_rows.field("v", "p_partkey", "bigint").alias("p_partkey"),
        json_rows.field("v", "p_name", "string").alias("p_name"),
        json_rows.field("v", "p_retailprice", "double").alias("p_retailprice"),
        json_rows.field("v", "p_absent", "string").alias("p_absent"),
    )


# Files and sinks


@registered
def inspect_files(spark, sf_dir):
    return files.file_summary(spark, f"{sf_dir}/orders.parquet").select("n", "lo", "hi")


@registered
def inspect_rows(spark, sf_dir):
    return files.inspect(spark, f"{sf_dir}/orders.parquet", 5).drop("_file")


@registered
def load_by_name(spark, sf_dir):
    """Into a new table with declared limits, columns matched by name."""
    raw = as_text(given(spark, sf_dir, "orders"))
    typed = apply_contract(raw, ORDERS, STRICT)
    turned = typed.select(*reversed(typed.columns))
    table = _new_table(spark)
    create_table(spark, ORDERS, table, STRICT)
    insert_by_name(turned, table)
    return spark.table(table)


def _new_table(spark):
    return "ledgerline_" + scratch_path(spark, "table").rsplit("-", 1)[1]


def _staged_orders(spark, sf_dir):
    """Orders as text in Parquet files."""
    path = scratch_path(spark, "staged-orders")
    as_text(given(spark, sf_dir, "orders")).drop("o_orderdate").write.parquet(path)
    return path


@registered
def table_count(spark, sf_dir):
    """Rows of a catalog table that a load created, loaded twice over."""
    table = _new_table(spark)
    for _ in range(2):
        load_json_rows(spark, _staged_orders(spark, sf_dir), ORDERS, table=table)
    return summaries.row_count(spark.table(table))


@registered
def table_comment(spark, sf_dir):
    """The comment and the declared limits of a loaded table."""
    table = _new_table(spark)
    load_json_rows(spark, _staged_orders(spark, sf_dir), ORDERS, table=table)
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return described.where(F.col("col_name").isin("STATUS", "PRIORITY", "TOTAL_PRICE", "Comment")).select(
        "col_name", "data_type"
    )


@registered
def load_by_json_contract(spark, sf_dir):
    """A load whose contract is itself read from a document."""
    path = scratch_path(spark, "contract")
    spark.range(1).select(F.lit(ORDERS.to_json())).write.text(path)
    target = scratch_path(spark, "by-contract")
    load_json_rows(spark, _staged_orders(spark, sf_dir), load_contract(spark, path), target)
    return spark.read.parquet(target)


@registered
def load_staged_drift(spark, sf_dir):
    """Two staged files with different columns: a row has NULL where its file lacks one."""
    raw = as_text(given(spark, sf_dir, "orders")).drop("o_orderdate")
    base = scratch_path(spark, "drift")
    older = F.col("o_orderstatus") == "F"
    raw.where(older).drop("o_orderpriority").write.parquet(f"{base}/staged")
    raw.where(~older).write.mode("append").parquet(f"{base}/staged")
    load_json_rows(spark, f"{base}/staged", ORDERS, f"{base}/typed")
    return spark.read.parquet(f"{base}/typed")


_MEASURES = Contract(
    "measures",
    (
        ColumnSpec("o_orderkey", "ORDER_KEY"),
        ColumnSpec("seconds", "ORDERED_AT", "epoch"),
        ColumnSpec("o_totalprice", "TOTAL_PRICE", "decimal", precision=14, scale=2),
        ColumnSpec("large", "LARGE", "int", precision=9),
    ),
)


@registered
def load_double_columns(spark, sf_dir):
    """Epochs, prices and counts held as doubles, by type and not through their text."""
    orders = given(spark, sf_dir, "orders")
    base = scratch_path(spark, "doubles")
    orders.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        seconds_of(F.col("o_orderdate")).cast("double").alias("seconds"),
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
        ((F.col("o_custkey") + 20000000).cast("double") + 0.75).alias("large"),
    ).write.parquet(f"{base}/staged")
    load_json_rows(spark, f"{base}/staged", _MEASURES, f"{base}/typed", policy=LENIENT)
    return spark.read.parquet(f"{base}/typed")


@registered
def load_partitioned_rows(spark, sf_dir):
    """JSON rows into a folder per status; malformed ones are kept apart and counted."""
    base = scratch_path(spark, "partitioned-rows")
    orders = as_text(given(spark, sf_dir, "orders"))
    payload = F.to_json(F.struct(*[c for c in orders.columns if c != "o_orderdate"]))
    broken = F.col("o_orderkey").cast("bigint") % 7 == 0
    orders.select(F.when(broken, F.concat(payload, F.lit("}"))).otherwise(payload).alias("j")).write.parquet(
        f"{base}/staged"
    )
    load_json_rows(
        spark, f"{base}/staged", ORDERS, f"{base}/typed", policy=LENIENT, payload="j",
        quarantine_path=f"{base}/refused", partition_by=["STATUS"],
    )
    typed = spark.read.parquet(f"{base}/typed").where("ORDER_KEY is not null")
    refused = spark.read.parquet(f"{base}/refused")
    key = F.regexp_extract("payload", r'"o_orderkey":"(\d+)"', 1)
    return typed.select("ORDER_KEY", "STATUS", "TOTAL_PRICE").unionByName(
        refused.select(key.alias("ORDER_KEY"), F.lit("refused").alias("STATUS")), allowMissingColumns=True
    )


@registered
def clustered_write(spark, sf_dir):
    path = scratch_path(spark, "clustered")
    n = range_partitions(spark, files.input_bytes(spark, f"{sf_dir}/customer.parquet"))
    rows = clustered(given(spark, sf_dir, "customer"), ["c_mktsegment", "c_nationkey"], partitions=n)
    write_table(rows, path)
    return spark.read.parquet(path)


@registered
def partitioned_write(spark, sf_dir):
    """A folder per order status, read back whole."""
    path = scratch_path(spark, "partitioned")
    rows = rebalanced(given(spark, sf_dir, "orders"), ["o_orderstatus"])
    write_table(rows, path, partition_by=["o_orderstatus"])
    return spark.read.parquet(path)


@registered
def run_metrics(spark, sf_dir):
    """Rows and columns of a load, counted by the write itself."""
    rows, seen = counted(given(spark, sf_dir, "orders"), "orders")
    write_table(rows, scratch_path(spark, "counted"))
    return spark.createDataFrame(
        [(seen.get["n_rows"], len(rows.columns))], "n_rows bigint, n_columns bigint"
    )


# Checks


@registered
def schema_drift(spark, sf_dir):
    contract = Contract(
        "orders",
        tuple(
            ColumnSpec(name, name.upper())
            for name in (
                "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_clerk",
            )
        ),
    )
    texts = documents(given(spark, sf_dir, "orders"))
    found = envelope.parse_envelopes(texts, "value", headers_only=True)
    return checks.schema_drift(found, contract).select("column", "status")


@registered
def quality_report(spark, sf_dir):
    contract = Contract(
        "orders",
        (
            ColumnSpec("o_orderkey", "ORDER_KEY", length=4),
            ColumnSpec("amount", "AMOUNT", "int", precision=9),
        ),
    )
    raw = as_text(dirty_orders(spark, sf_dir))
    return checks.quality_report(raw, contract)


@registered
def length_guard(spark, sf_dir):
    return checks.over_length(given(spark, sf_dir, "documents"), {"text": 500}, keep=("doc_id",))


@registered
def quarantine_cells(spark, sf_dir):
    """Rows a strict load would refuse, with what is wrong in them."""
    contract = Contract("orders", (ColumnSpec("amount", "AMOUNT", "int", precision=9),))
    _, bad = checks.split_valid(dirty_orders(spark, sf_dir), contract)
    return bad.select("o_orderkey", F.array_join("_violations", "; ").alias("violations"))


# New and modified records


@registered
def latest_per_key(spark, sf_dir):
    return incremental.latest_per_key(
        given(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"]
    )


def _older_orders(spark, sf_dir):
    """Orders as a snapshot of 1999-12-31 held them: pending ones at another price."""
    orders = given(spark, sf_dir, "orders")
    price = F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") + 1).otherwise(
        F.col("o_totalprice")
    )
    return orders.where("o_orderdate < TIMESTAMP_NTZ'2000-01-01 00:00:00'").withColumn(
        "o_totalprice", price
    )


@registered
def new_or_modified(spark, sf_dir):
    return incremental.new_or_modified(
        given(spark, sf_dir, "orders"), _older_orders(spark, sf_dir), ["o_orderkey"], ["o_totalprice"]
    )


@registered
def merge_latest(spark, sf_dir):
    """Even orders, some changed later, brought up to date by orders not divisible by three."""
    orders = given(spark, sf_dir, "orders")
    later = F.when(F.col("o_orderkey") % 5 == 0, F.col("o_orderdate") + F.expr("INTERVAL '1' DAY"))
    snapshot = orders.where("o_orderkey % 2 = 0").withColumns(
        {
            "o_totalprice": F.col("o_totalprice") + 1,
            "o_orderdate": F.coalesce(later, F.col("o_orderdate")).cast("timestamp_ntz"),
        }
    )
    incoming = orders.where("o_orderkey % 3 <> 0").withColumn(
        "o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")
    )
    return incremental.merge_latest(snapshot, incoming, ["o_orderkey"], ["o_orderdate"])


@registered
def load_new_rows(spark, sf_dir):
    """Two runs over a growing folder: every order is taken once."""
    raw = as_text(given(spark, sf_dir, "orders"))
    base = scratch_path(spark, "arrivals")
    target, marks = f"{base}/typed", f"{base}/checkpoint"
    older = F.col("o_orderdate") < "2000-01-01"
    for arrived in (raw.where(older), raw.where(~older)):
        arrived.write.mode("append").parquet(f"{base}/in")
        load_new_files(spark, f"{base}/in", ORDERS, target, marks)
    return spark.read.parquet(target)


@registered
def load_new_envelopes(spark, sf_dir):
    """Two runs over a growing folder of documents: every order is loaded once."""
    orders = given(spark, sf_dir, "orders")
    base = scratch_path(spark, "documents")
    older = F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")
    for arrived, rows in (("first", orders.where(older)), ("second", orders.where(~older))):
        write_documents(documents(rows, alternate=True), f"{base}/in/{arrived}")
        load_new_documents(
            spark, f"{base}/in/*", ORDERS, f"{base}/raw", f"{base}/typed", f"{base}/checkpoint",
            f"{base}/refused",
        )
    return spark.read.parquet(f"{base}/typed").drop("load")


# The two loads and the analyses of the table they fill


@registered
def load_vehicle_envelopes(spark, sf_dir):
    """Documents to raw copy to the 25 typed columns, dirty cells to NULL."""
    base = scratch_path(spark, "vehicles")
    write_documents(documents(registrations(spark, sf_dir, dirty=True), alternate=True), f"{base}/in")
    load_envelopes(spark, f"{base}/in", VEHICLES, f"{base}/raw", f"{base}/typed")
    return spark.read.parquet(f"{base}/typed")


@registered
def load_vehicle_json_rows(spark, sf_dir):
    """Staged JSON objects to the 25 typed columns, every cell checked."""
    base = scratch_path(spark, "vehicle-rows")
    payloads = registrations(spark, sf_dir).select(F.to_json(F.struct("*")).alias("payload"))
    payloads.write.option("maxRecordsPerFile", ROWS_PER_DOCUMENT).parquet(f"{base}/staged")
    load_json_rows(spark, f"{base}/staged", VEHICLES, f"{base}/typed", payload="payload")
    return _plain_vehicles(spark.read.parquet(f"{base}/typed"))


@registered
def load_vehicle_raw_rows(spark, sf_dir):
    """The raw copy of the documents into the strict table: each row is the object itself."""
    base = scratch_path(spark, "vehicle-raw")
    write_documents(documents(registrations(spark, sf_dir), alternate=True), f"{base}/in")
    envelopes_to_raw(spark, f"{base}/in", f"{base}/raw")
    load_json_rows(spark, f"{base}/raw", VEHICLES, f"{base}/typed")
    return _plain_vehicles(spark.read.parquet(f"{base}/typed"))


def _plain_vehicles(typed):
    """Strict rows with their point and whole numbers as plain columns."""
    location = F.col("VEHICLE_LOCATION")
    return typed.withColumns(
        {
            "LON": location["lon"],
            "LAT": location["lat"],
            "VEHICLE_LOCATION": location["text"],
            **{c.target: F.col(f"`{c.target}`").cast("bigint") for c in VEHICLES.columns if c.kind == "int"},
        }
    )


def _vehicles(spark, sf_dir):
    return apply_contract(registrations(spark, sf_dir, dirty=True), VEHICLES, LENIENT)


@registered
def avg_range_by_make(spark, sf_dir):
    means = summaries.avg_by(_vehicles(spark, sf_dir), "MAKE", "ELECTRIC_RANGE", "avg_range")
    return means.withColumn("avg_range", F.round("avg_range", 6))


@registered
def vehicles_by_city(spark, sf_dir):
    return summaries.count_by(
        _vehicles(spark, sf_dir),
        "CITY",
        "VEHICLE_COUNT",
        where=F.col("STATE") == "WA",
        most_frequent_first=True,
    )


@registered
def vehicles_by_type(spark, sf_dir):
    return summaries.count_by(_vehicles(spark, sf_dir), "ELECTRIC_VEHICLE_TYPE", "total")


@registered
def registrations_by_model_year(spark, sf_dir):
    return summaries.trend_by(_vehicles(spark, sf_dir), "MODEL_YEAR", "REGISTRATIONS")
