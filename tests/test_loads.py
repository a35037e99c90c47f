"""The two loads, sinks, incremental runs and file lineage, on temporary folders."""

import json
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ledgerline import LENIENT, STRICT, ColumnSpec, Contract, ContractViolation
from ledgerline.contracts import VEHICLES
from ledgerline.operators.checks import quality_report, split_valid
from ledgerline.operators.incremental import latest_per_key, merge_latest, new_or_modified
from ledgerline.operators.summaries import avg_by, count_by, trend_by
from ledgerline.plans.derived import as_text, documents, registrations, write_documents
from ledgerline.plans.loads import load_envelopes, load_json_rows
from ledgerline.scratch import scratch_path, shared_folder
from ledgerline.sinks.tables import clustered, counted, create_table, insert_by_name, rebalanced, write_table
from ledgerline.sources.files import file_summary, inspect, read_staged
from ledgerline.sources.json_rows import extract, malformed_rows
from ledgerline.streaming import load_new_documents, load_new_files

SMALL = Contract(
    "small",
    (
        ColumnSpec("id", "ID", length=10),
        ColumnSpec("Model Year", "MODEL_YEAR", "int", precision=4),
        ColumnSpec("State", "STATE", length=2),
        ColumnSpec("at", "AT", "epoch"),
    ),
    cluster_by=("STATE",),
    comment="It's small",
)


def document(names, rows):
    return json.dumps({"meta": {"view": {"columns": [{"name": n} for n in names]}}, "data": rows})


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_load_envelopes(spark, tmp_path):
    (tmp_path / "in").mkdir()
    names = ["id", "Model Year", "State", "at", "extra"]
    (tmp_path / "in" / "a.json").write_text(
        document(names, [[1, "2020", "WA", 0, "x"], [2, "n/a", "OR", None, "y"], [3]])
    )
    (tmp_path / "in" / "b.json").write_text(document(["State", "id"], [["WAX", 4]]))
    metrics = load_envelopes(
        spark, str(tmp_path / "in"), SMALL, str(tmp_path / "raw"), str(tmp_path / "typed"),
        quarantine_path=str(tmp_path / "bad"),
    )
    assert (metrics.n_rows, metrics.n_ragged, metrics.n_corrupt) == (3, 1, 0)
    assert (metrics.n_source_columns, metrics.n_columns, metrics.missing) == (5, 4, ())
    typed = spark.read.parquet(str(tmp_path / "typed"))
    assert [(r["ID"], r["MODEL_YEAR"], r["STATE"]) for r in typed.orderBy("ID").collect()] == [
        ("1", 2020, "WA"), ("2", None, "OR"), ("4", None, "WAX"),
    ]
    raw = spark.read.parquet(str(tmp_path / "raw"))
    assert raw.columns == names and raw.count() == 3
    assert spark.read.parquet(str(tmp_path / "bad")).first()["_row"] == ["3"]
    assert metrics.as_dataframe(spark).first()["n_rows"] == 3


def test_load_envelopes_reports_missing(spark, tmp_path):
    (tmp_path / "a.json").write_text(document(["id"], [[1]]))
    run = dict(raw_path=str(tmp_path / "raw"), target_path=str(tmp_path / "typed"))
    metrics = load_envelopes(spark, str(tmp_path / "a.json"), SMALL, **run)
    assert metrics.missing == ("Model Year", "State", "at")
    assert spark.read.parquet(str(tmp_path / "typed")).schema == SMALL.schema(LENIENT)
    with pytest.raises(Exception, match="missing columns in .*a.json: Model Year, State, at"):
        load_envelopes(spark, str(tmp_path / "a.json"), SMALL, policy=STRICT, **run)


def test_strict_envelopes_refuse_one_drifted_document(spark, tmp_path):
    """Each document must bring every contract column, long documents too."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(document(SMALL.sources, [[1, 2020, "WA", 0]]))
    (tmp_path / "in" / "b.json").write_text(document(["ID", "State", "at"], [[2, "WA", 0]]))
    run = dict(raw_path=str(tmp_path / "raw"), target_path=str(tmp_path / "typed"))
    for size in (0, 10000):
        with pytest.raises(Exception, match="missing columns in .*b.json: Model Year"):
            load_envelopes(
                spark, str(tmp_path / "in"), SMALL, policy=STRICT, long_file_bytes=size, **run
            )
    metrics = load_envelopes(spark, str(tmp_path / "in" / "a.json"), SMALL, policy=STRICT, **run)
    assert metrics.n_rows == 1


def tree(folder):
    return {p.relative_to(folder).as_posix(): p.read_bytes() for p in folder.rglob("*.parquet")}


def test_failing_loads_leave_everything_as_it_was(spark, tmp_path):
    """Raw copy, quarantine, folder and table; nothing half written stays behind."""
    (tmp_path / "good.json").write_text(document(SMALL.sources, [[1, 2020, "WA", 0], [2]]))
    (tmp_path / "cell.json").write_text(document(SMALL.sources, [[1, "n/a", "WA", 0]]))
    (tmp_path / "row.json").write_text(document(SMALL.sources, [[1, 2020, "WA", 0], [1]]))
    out = tmp_path / "out"
    run = dict(raw_path=str(out / "raw"), target_path=str(out / "typed"))
    load_envelopes(spark, str(tmp_path / "good.json"), SMALL, **run)
    before = tree(out)
    assert {k.split("/")[0] for k in before} == {"raw", "raw-refused", "typed"}
    load_envelopes(spark, str(tmp_path / "good.json"), SMALL, str(tmp_path / "r"), table="kept_small")
    for name in ("cell", "row"):
        for target in (run, {"raw_path": run["raw_path"], "table": "kept_small"}):
            with pytest.raises(Exception, match="MODEL_YEAR: not a number|does not match its header"):
                load_envelopes(spark, str(tmp_path / f"{name}.json"), SMALL, policy=STRICT, **target)
    with pytest.raises(ContractViolation, match="undeclared"):
        (tmp_path / "more.json").write_text(document([*SMALL.sources, "new"], [[1, 2020, "WA", 0, 0]]))
        load_envelopes(spark, str(tmp_path / "more.json"), SMALL, refuse_extra=True, **run)
    spark.createDataFrame([('{"id": 1, "State": "WAX"}',)], "j string").write.parquet(str(tmp_path / "rows"))
    for target in ({"target_path": run["target_path"]}, {"table": "kept_small"}):
        with pytest.raises(Exception, match="STATE: longer than 2"):
            load_json_rows(spark, str(tmp_path / "rows"), SMALL, payload="j", **target)
    assert tree(out) == before and len(list(out.iterdir())) == 3
    assert spark.table("kept_small").count() == 1
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("kept_small")] == ["kept_small"]


def test_refused_rows_are_those_of_the_last_load(spark, tmp_path):
    (tmp_path / "bad.json").write_text(document(["id"], [[1], [2, 3]]))
    (tmp_path / "good.json").write_text(document(["id"], [[1]]))
    for given, place in ((str(tmp_path / "q"), "q"), (None, "raw-refused")):
        for name, n in (("bad", 1), ("good", 0)):
            metrics = load_envelopes(
                spark, str(tmp_path / f"{name}.json"), SMALL, str(tmp_path / "raw"), str(tmp_path / "typed"),
                quarantine_path=given,
            )
            assert metrics.quarantine_path == str(tmp_path / place)
            assert metrics.n_ragged == n == spark.read.parquet(metrics.quarantine_path).count()


def test_number_of_files_follows_the_bytes(spark, tmp_path):
    """Ten times the input gives about ten times the files, whatever the session says."""
    names = SMALL.sources
    files = {}
    for n in (2000, 20000):
        rows = [[i, 2000 + i % 20, "W" + chr(65 + i % 20), i] for i in range(n)]
        (tmp_path / f"{n}.json").write_text(document(names, rows))
        metrics = load_envelopes(
            spark, str(tmp_path / f"{n}.json"), SMALL, str(tmp_path / f"raw{n}"), str(tmp_path / f"t{n}"),
            bytes_per_file=4000,
        )
        assert metrics.n_rows == n
        files[n] = len(list((tmp_path / f"t{n}").glob("*.parquet")))
    assert files[2000] > 2 and 5 < files[20000] / files[2000] < 15


def test_staged_files_with_different_columns(spark, tmp_path):
    whole = "id string, `Model Year` string, State string, at string"
    spark.createDataFrame([("1", "2020", "WA")], "id string, `Model Year` string, State string").write.parquet(
        str(tmp_path / "in")
    )
    run = dict(path=str(tmp_path / "in"), contract=SMALL, target_path=str(tmp_path / "t"))
    with pytest.raises(ContractViolation, match="missing columns .'at'"):
        load_json_rows(spark, **run)
    assert load_json_rows(spark, policy=LENIENT, **run).missing == ("at",)
    spark.createDataFrame([("2", "2021", "OR", "86400")], whole).withColumn("more", F.lit(1)).write.mode(
        "append"
    ).parquet(str(tmp_path / "in"))
    metrics = load_json_rows(spark, **run)
    assert (metrics.missing, metrics.extra, metrics.n_rows) == ((), ("more",), 2)
    got = {r["ID"]: str(r["AT"]) for r in spark.read.parquet(str(tmp_path / "t")).collect()}
    assert got == {"1": "None", "2": "1970-01-02 00:00:00"}
    with pytest.raises(ContractViolation, match="undeclared"):
        load_json_rows(spark, refuse_extra=True, **run)


def test_new_files_bring_new_columns(spark, tmp_path):
    spark.createDataFrame([("1",)], "id string").write.parquet(str(tmp_path / "in"))
    run = (str(tmp_path / "in"), SMALL, str(tmp_path / "t"), str(tmp_path / "c"))
    with pytest.raises(ContractViolation, match="missing columns"):
        load_new_files(spark, *run, policy=STRICT)
    load_new_files(spark, *run)
    later = spark.createDataFrame([("2", "2021", "WA", "0")], "id string, `Model Year` string, State string, at string")
    later.write.mode("append").parquet(str(tmp_path / "in"))
    load_new_files(spark, *run)
    got = rows_of(spark.read.parquet(str(tmp_path / "t")).select("ID", "MODEL_YEAR", "STATE"))
    assert got == [("1", None, None), ("2", 2021, "WA")]


def test_numbers_convert_by_type(spark, tmp_path):
    schema = "id string, `Model Year` double, State string, at double"
    rows = [("1", 2020.9, "WA", 1699171200.0), ("2", 12345678.0, "OR", float("nan")), ("3", None, None, 1e300)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    load_json_rows(spark, str(tmp_path / "in"), SMALL, str(tmp_path / "t"), policy=LENIENT)
    got = rows_of(spark.read.parquet(str(tmp_path / "t")).select("ID", "MODEL_YEAR", F.col("AT").cast("string")))
    assert got == [("1", 2020, "2023-11-05 08:00:00"), ("2", 12345678, None), ("3", None, None)]
    with pytest.raises(Exception, match="not a number|not epoch seconds"):
        load_json_rows(spark, str(tmp_path / "in"), SMALL, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3


def test_json_rows_partitioned_with_refused_payloads(spark, tmp_path):
    lines = [('{"id": 1, "State": "WA"}',), ('{"id": 2, "State": "OR"} tail',), ('{"id"',), ("",)]
    spark.createDataFrame(lines, "j string").coalesce(1).write.parquet(str(tmp_path / "in"))
    metrics = load_json_rows(
        spark, str(tmp_path / "in"), SMALL, str(tmp_path / "t"), policy=LENIENT, payload="j",
        quarantine_path=str(tmp_path / "bad"), partition_by=["STATE"], fmt="orc", options={"compression": "zlib"},
    )
    assert (metrics.n_rows, metrics.n_corrupt) == (4, 2)
    assert rows_of(spark.read.orc(str(tmp_path / "t")).where("STATE = 'WA'").select("ID")) == [("1",)]
    bad = spark.read.parquet(str(tmp_path / "bad")).select("_row_number", "payload")
    assert rows_of(bad) == [(2, lines[1][0]), (3, lines[2][0])]


def test_undeclared_columns_can_be_refused(spark, tmp_path):
    (tmp_path / "a.json").write_text(document([*SMALL.sources, "new"], [[1, 2020, "WA", 0, 0]]))
    run = dict(raw_path=str(tmp_path / "raw"), target_path=str(tmp_path / "typed"))
    assert load_envelopes(spark, str(tmp_path / "a.json"), SMALL, **run).extra == ("new",)
    with pytest.raises(ContractViolation, match="undeclared columns .'new'"):
        load_envelopes(spark, str(tmp_path / "a.json"), SMALL, refuse_extra=True, **run)


def test_strict_envelopes_refuse_long_text(spark, tmp_path):
    (tmp_path / "a.json").write_text(document(SMALL.sources, [[1, 2020, "WAX", 0]]))
    with pytest.raises(Exception, match="STATE: longer than 2"):
        load_envelopes(
            spark, str(tmp_path / "a.json"), SMALL, str(tmp_path / "raw"), str(tmp_path / "t"), policy=STRICT
        )


def test_vehicle_loads_agree(spark, sf_small, tmp_path):
    """Raw rows as the object, and the object as JSON text, give one strict table."""
    source = registrations(spark, sf_small)
    source.write.parquet(str(tmp_path / "rows"))
    source.select(F.to_json(F.struct("*")).alias("j")).write.parquet(str(tmp_path / "json"))
    first = load_json_rows(spark, str(tmp_path / "rows"), VEHICLES, str(tmp_path / "t1"))
    second = load_json_rows(spark, str(tmp_path / "json"), VEHICLES, str(tmp_path / "t2"), payload="j")
    assert first.n_rows == second.n_rows == source.count()
    one, two = (spark.read.parquet(str(tmp_path / t)) for t in ("t1", "t2"))
    assert one.schema == VEHICLES.schema(STRICT)
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_load_into_table(spark, tmp_path):
    spark.createDataFrame(
        [('{"id": 7, "Model Year": "2020", "State": "WA", "at": 86400}',), ('{"id": "8"}',)], "j string"
    ).write.parquet(str(tmp_path / "in"))
    load_json_rows(spark, str(tmp_path / "in"), SMALL, table="small_loaded", payload="j")
    table = spark.table("small_loaded")
    got = {r["ID"]: (r["MODEL_YEAR"], r["STATE"], str(r["AT"])) for r in table.collect()}
    assert got == {"7": (Decimal(2020), "WA", "1970-01-02 00:00:00"), "8": (None, None, "None")}
    load_json_rows(spark, str(tmp_path / "in"), SMALL, table="small_loaded", payload="j", mode="append")
    assert spark.table("small_loaded").count() == 4
    detail = {r[0]: r[1] for r in spark.sql("DESCRIBE EXTENDED small_loaded").collect()}
    assert detail["STATE"] == "varchar(2)" and detail["Comment"] == "It's small"


def test_analysis_queries_as_sql(spark, sf_small, tmp_path):
    """The table a load fills answers the analysts' SQL as the summaries do."""
    write_documents(documents(registrations(spark, sf_small, dirty=True)), str(tmp_path / "in"))
    load_envelopes(spark, str(tmp_path / "in"), VEHICLES, str(tmp_path / "raw"), table="vehicles_wa")
    vehicles = spark.table("vehicles_wa")
    assert vehicles.schema == VEHICLES.schema(LENIENT)
    pairs = {
        "SELECT MAKE, AVG(ELECTRIC_RANGE) AS avg_range FROM vehicles_wa WHERE ELECTRIC_RANGE > 0 "
        "GROUP BY MAKE ORDER BY avg_range DESC": avg_by(vehicles, "MAKE", "ELECTRIC_RANGE", "avg_range"),
        "SELECT CITY, COUNT(*) AS n FROM vehicles_wa WHERE STATE = 'WA' GROUP BY CITY ORDER BY n DESC, CITY":
            count_by(vehicles, "CITY", "n", F.col("STATE") == "WA", most_frequent_first=True),
        "SELECT ELECTRIC_VEHICLE_TYPE, COUNT(*) AS total FROM vehicles_wa GROUP BY ELECTRIC_VEHICLE_TYPE":
            count_by(vehicles, "ELECTRIC_VEHICLE_TYPE"),
        "SELECT MODEL_YEAR, COUNT(*) AS n FROM vehicles_wa WHERE MODEL_YEAR IS NOT NULL "
        "GROUP BY MODEL_YEAR ORDER BY MODEL_YEAR": trend_by(vehicles, "MODEL_YEAR", "n"),
    }
    for sql, summary in pairs.items():
        want = [tuple(r) for r in spark.sql(sql).collect()]
        got = [tuple(r) for r in summary.collect()]
        assert want and (got == want if "ORDER BY" in sql else sorted(got) == sorted(want))


def test_table_limits_are_enforced(spark):
    create_table(spark, SMALL, "small_limits")
    row = spark.createDataFrame([("WAX", "1", Decimal(2020))], "STATE string, ID string, MODEL_YEAR decimal(10,0)")
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        insert_by_name(row.withColumn("AT", F.lit(None).cast("timestamp_ntz")), "small_limits")
    wide = row.withColumns({"STATE": F.lit("WA"), "MODEL_YEAR": F.lit(20200), "AT": F.lit(None).cast("timestamp_ntz")})
    with pytest.raises(Exception, match="CAST_OVERFLOW_IN_TABLE_INSERT"):
        insert_by_name(wide, "small_limits")


JSON_CASES = [
    ('{"id":"1","State":"WA"}', "1", "WA"),
    ('{"id":1.50,"State":null}', "1.5", None),
    ('{"id":{"a":[1,2]}}', '{"a":[1,2]}', None),
    ("{}", None, None),
    ("[1]", None, None),
    ("5", None, None),
    ("", None, None),
    (None, None, None),
]


def test_json_fields(spark):
    contract = Contract("c", (ColumnSpec("id", "ID"), ColumnSpec("State", "STATE")))
    df = spark.createDataFrame([(c[0],) for c in JSON_CASES], "j string").coalesce(1)
    for policy in (LENIENT, STRICT):
        got = [tuple(r) for r in extract(df, "j", contract, policy).collect()]
        assert got == [c[1:] for c in JSON_CASES]
    broken = spark.createDataFrame([('{"id":1',), ("{",), ('{"id":1}',), ("",)], "j string").coalesce(1)
    assert [tuple(r) for r in extract(broken, "j", contract, LENIENT).collect()] == [
        (None, None), (None, None), ("1", None), (None, None),
    ]
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        extract(broken, "j", contract, STRICT).collect()
    assert malformed_rows(broken, "j").count() == 2


def test_clustered_files_have_separate_ranges(spark, sf_oracle, tmp_path):
    customer = spark.read.parquet(f"{sf_oracle}/customer.parquet")
    keys = ["c_mktsegment", "c_nationkey"]
    write_table(clustered(customer, keys, partitions=4), str(tmp_path / "t"))
    spans = (
        spark.read.parquet(str(tmp_path / "t"))
        .groupBy(F.col("_metadata.file_name").alias("f"))
        .agg(F.min(F.struct(*keys)).alias("lo"), F.max(F.struct(*keys)).alias("hi"))
        .orderBy("lo")
        .collect()
    )
    assert len(spans) == 4
    for left, right in zip(spans, spans[1:], strict=False):
        assert tuple(left["hi"]) <= tuple(right["lo"])


def test_clustered_splits_one_hot_key(spark, tmp_path):
    """One key, and even one row repeated, is written by several tasks."""
    hot = spark.range(40000).select(F.lit("WA").alias("s"), F.col("id"))
    sizes = clustered(hot, ["s"], partitions=4).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 20000
    copies = spark.range(40000).select(F.lit("WA").alias("s"), F.col("id").alias("row"))
    spread = clustered(copies, ["s"], spread=["row"], partitions=4).drop("row")
    sizes = spread.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 20000


def test_partitioned_write_splits_a_hot_key(spark, tmp_path):
    """The partition of a hot key is written by several tasks, that of a rare one by one."""
    rows = spark.range(300000).select(
        F.when(F.col("id") % 100 == 0, "rare").otherwise("hot").alias("k"), F.sha2(F.col("id").cast("string"), 256)
        .alias("v"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "2MB")
    try:
        write_table(rebalanced(rows, ["k"]), str(tmp_path / "t"), partition_by=["k"])
    finally:
        spark.conf.set(size, before)
    assert len(list((tmp_path / "t" / "k=hot").glob("*.parquet"))) > 2
    assert len(list((tmp_path / "t" / "k=rare").glob("*.parquet"))) == 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 300000


def test_counts_are_exact_after_a_range_shuffle(spark, sf_oracle, tmp_path):
    orders = spark.read.parquet(f"{sf_oracle}/orders.parquet")
    rows, seen = counted(clustered(orders, ["o_orderstatus"]), "orders")
    write_table(rows, str(tmp_path / "t"))
    assert seen.get["n_rows"] == orders.count()


def test_write_modes(spark, tmp_path):
    df = spark.range(3)
    for mode, n in (("overwrite", 3), ("append", 6), ("overwrite", 3)):
        write_table(df, str(tmp_path / "t"), fmt="orc", mode=mode, options={"compression": "zlib"})
        assert spark.read.orc(str(tmp_path / "t")).count() == n


def test_file_lineage(spark, tmp_path):
    spark.range(10).repartitionByRange(2, "id").write.parquet(str(tmp_path / "t"))
    got = file_summary(spark, str(tmp_path / "t")).collect()
    assert sorted((r["n"], r["lo"], r["hi"]) for r in got) == [(5, 1, 5), (5, 1, 5)]
    first = inspect(spark, str(tmp_path / "t"), 7).collect()
    assert [(r["_row_number"], r["id"]) for r in first] == [(i % 5 + 1, i) for i in range(7)]
    assert read_staged(spark, str(tmp_path / "t"), lineage=True).columns == ["_file", "_row_number", "id"]
    assert inspect(spark, str(tmp_path / "t"), 0).count() == 0


def test_quality_and_split(spark):
    raw = spark.createDataFrame(
        [("1", "2020", "WA", "0"), ("2", "x", "WAX", None), ("3", "20200", "OR", "1e99"), ("4", None, None, "")],
        "id string, `Model Year` string, State string, at string",
    )
    got = {r["column"]: tuple(r)[1:] for r in quality_report(raw, SMALL).collect()}
    assert got == {
        "ID": (4, 0, 0, 0, 0),
        "MODEL_YEAR": (4, 1, 1, 0, 1),
        "STATE": (4, 1, 0, 1, 0),
        "AT": (4, 1, 2, 0, 1),
    }
    good, bad = split_valid(raw, SMALL)
    assert rows_of(good) == [("1", "2020", "WA", "0")]
    assert {r["id"]: r["_violations"] for r in bad.collect()} == {
        "2": ["MODEL_YEAR: not_a_number", "STATE: too_long"],
        "3": ["MODEL_YEAR: out_of_range", "AT: out_of_range"],
        "4": ["AT: not_a_number"],
    }


def test_latest_and_merge(spark):
    schema = "k int, at int, n int, v string"
    old = spark.createDataFrame([(1, 5, 0, "a"), (2, 5, 0, "b"), (None, 1, 0, "n")], schema)
    new = spark.createDataFrame(
        [(1, 6, 0, "A"), (1, 6, 1, "A2"), (2, 4, 0, "late"), (3, None, 0, "c"), (None, 1, 0, "N")], schema
    )
    latest = rows_of(latest_per_key(new, ["k"], ["at", "n"]))
    assert latest == [(1, 6, 1, "A2"), (2, 4, 0, "late"), (3, None, 0, "c"), (None, 1, 0, "N")]
    merged = rows_of(merge_latest(old, new, ["k"], ["at", "n"]))
    assert merged == [(1, 6, 1, "A2"), (2, 5, 0, "b"), (3, None, 0, "c"), (None, 1, 0, "N")]
    assert latest_per_key(new, ["k"], ["at", "n"]).columns == ["k", "at", "n", "v"]


def test_new_or_modified(spark):
    schema = "k int, at int, v string"
    old = spark.createDataFrame([(1, 5, "a"), (2, 5, "b"), (3, None, "c")], schema)
    new = spark.createDataFrame([(1, 5, "a"), (2, 6, "b"), (3, None, "c"), (4, 1, "d"), (4, 1, "d")], schema)
    got = rows_of(new_or_modified(new, old, ["k"], ["at", "v"]))
    assert got == [(2, 6, "b", "modified"), (4, 1, "d", "new"), (4, 1, "d", "new")]


def test_change_detection_splits_a_hot_key(spark):
    """One key holds a third of the incoming rows: adaptive execution splits its join."""
    incoming = spark.range(300000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"),
        F.sha2(F.col("id").cast("string"), 256).alias("t"),
    )
    held = spark.range(300000).select(F.col("id").alias("k"), (F.col("id") + 1).alias("v"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        changed = new_or_modified(incoming, held, ["k"], ["v"])
        total = changed.groupBy("change").agg(F.count(F.lit(1)), F.max("t"))
        assert [tuple(r)[:2] for r in total.collect()] == [("modified", 300000)]
        assert "skew=true" in total._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_new_files_are_taken_once(spark, tmp_path):
    folder, target, marks = (str(tmp_path / n) for n in ("in", "typed", "marks"))

    def arrive(*ids):
        rows = [(str(i), "2020", "WA", "0") for i in ids]
        spark.createDataFrame(rows, "id string, `Model Year` string, State string, at string").write.mode(
            "append"
        ).parquet(folder)

    arrive(*range(5))
    for _ in range(2):
        load_new_files(spark, folder, SMALL, target, marks, partition_by=["STATE"], max_files_per_batch=1)
        assert spark.read.parquet(target).count() == 5
    arrive(5, 6, 7)
    load_new_files(spark, folder, SMALL, target, marks, partition_by=["STATE"])
    assert sorted(r["ID"] for r in spark.read.parquet(target).collect()) == [str(i) for i in range(8)]


def test_new_payload_files(spark, tmp_path):
    folder, target, marks = (str(tmp_path / n) for n in ("in", "typed", "marks"))
    spark.createDataFrame([('{"id":"1","Model Year":"2020"}',)], "j string").write.parquet(folder)
    load_new_files(spark, folder, SMALL, target, marks, STRICT, payload="j")
    assert spark.read.parquet(target).first()["MODEL_YEAR"] == Decimal(2020)


def test_new_documents(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    raw, typed, marks, bad = (str(tmp_path / n) for n in ("raw", "typed", "marks", "bad"))

    def run():
        load_new_documents(spark, str(folder), SMALL, raw, typed, marks, bad, long_file_bytes=2000)

    (folder / "a.json").write_text(document(SMALL.sources, [[1, 2020, "WA", 0], [2]]))
    run()
    run()
    assert spark.read.parquet(typed).count() == 1
    (folder / "b c.json").write_text(document(["State", "id", "more"], [["OR", 3, "x"]]))
    (folder / "c.json").write_text('{"meta"')
    (folder / "long.json").write_text(document(["id", "State"], [[f"L{i}", "CA"] for i in range(300)]))
    run()
    got = spark.read.parquet(typed)
    assert rows_of(got.where("STATE <> 'CA'").select("ID", "STATE")) == [("1", "WA"), ("3", "OR")]
    assert got.where("STATE = 'CA'").select("ID").distinct().count() == 300
    assert sorted(r["reason"] for r in spark.read.parquet(bad).collect()) == ["corrupt", "ragged"]
    assert "more" in spark.read.parquet(f"{raw}/load=1").columns
    (folder / "d[1]{x}.json").write_text("[")
    run()
    assert got.count() == 302 and spark.read.parquet(bad).count() == 3


def test_scratch_is_the_shared_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_scratch_without_a_named_folder():
    """A local session falls back to this machine; a cluster must name its folder."""

    def session(master):
        context = SimpleNamespace(master=master, applicationId=f"app-{master}")
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context)

    assert shared_folder(session("local[4]")) == shared_folder(session("local[4]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"))


def test_raw_round_trip_equals_input(spark, sf_small, tmp_path):
    raw = as_text(spark.read.parquet(f"{sf_small}/lineitem.parquet"))
    raw.write.parquet(str(tmp_path / "raw"))
    back = spark.read.parquet(str(tmp_path / "raw"))
    assert back.schema == raw.schema
    assert back.exceptAll(raw).isEmpty() and raw.exceptAll(back).isEmpty()
