"""Queries that keep tables up to date, each with its SQL answer: changed files, merges, layout, summaries."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.contract import LENIENT, STRICT, ColumnSpec, Contract
from ledgerline.operators import summaries
from ledgerline.operators.kept_summaries import Measure, add_changes, arriving, fold, read_summary, signed_changes
from ledgerline.operators.mapping import apply_contract
from ledgerline.operators.places import nearest, pairs_within, rounded
from ledgerline.operators.profiles import column_value, described, drift, drifted, merged, read_profiles, store_profile
from ledgerline.operators.renames import column_signatures, drift_with_renames, with_known_names
from ledgerline.plans import changed_files
from ledgerline.plans.derived import ORDERS, arrive, as_text, given, leave, registrations
from ledgerline.scratch import scratch_path
from ledgerline.sinks.bucketed import MergeMetrics, bucket_report, create_snapshot, merge_into_snapshot, read_snapshot
from ledgerline.sinks.curve import curve_clustered, file_ranges, files_left
from ledgerline.sinks.partitions import MONTH, replace_partitions, within
from ledgerline.sinks.tables import clustered, write_table
from ledgerline.sinks.upkeep import depth_report, recluster
from ledgerline.sources.nested import child_rows, proposed_contract
from ledgerline.streaming.latest import keep_latest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ANSWERS: dict[str, str] = {}


def answered(sql: str):
    """Register a query and its answer."""

    def keep(query):
        QUERIES[query.__name__], ANSWERS[query.__name__] = query, sql
        return query

    return keep


# New and changed files

_PER_FILE = 2000


def _two_arrivals(spark: SparkSession, sf_dir: str) -> tuple[str, list[int]]:
    """Files of orders loaded twice: of every four files one stays, one changes, one goes, one comes later."""
    base = scratch_path(spark, "changed-files")
    raw = as_text(given(spark, sf_dir, "orders")).drop("o_orderdate")
    slot = F.expr(f"cast(o_orderkey as bigint) div {_PER_FILE}")
    load = lambda: changed_files.load_changed_files(
        spark, f"{base}/in", ORDERS, f"{base}/typed", f"{base}/ledger", drop_gone=True
    )
    arrive(raw.where(slot % 4 != 3), slot, f"{base}/in")
    loads = load()
    arrive(raw.where(slot % 4 == 3), slot, f"{base}/in")
    dearer = F.format_string("%.2f", F.col("o_totalprice").cast("double") + 1)
    arrive(raw.where((slot % 4 == 1) & (F.col("o_orderstatus") != "P")).withColumn("o_totalprice", dearer), slot, f"{base}/in")
    gone = raw.select(slot.alias("slot")).where("slot % 4 = 2").distinct().collect()
    leave(spark, f"{base}/in", [r["slot"] for r in gone])
    loads += load()
    if again := load():
        raise RuntimeError(f"loads {again} found nothing new")
    return base, loads


_ARRIVALS = f"""
SELECT *, o_orderkey // {_PER_FILE} AS slot, o_orderkey // {_PER_FILE} % 4 AS turn FROM orders"""


@answered(f"""
SELECT o_orderkey::VARCHAR AS "ORDER_KEY", o_custkey::VARCHAR AS "CUSTOMER_KEY", o_orderstatus AS "STATUS",
       (o_totalprice + CASE WHEN turn = 1 THEN 1 ELSE 0 END)::DECIMAL(14,2) AS "TOTAL_PRICE",
       o_orderpriority AS "PRIORITY", 'orders-' || slot || '.parquet' AS file,
       CASE WHEN turn = 0 THEN 1 ELSE 2 END::BIGINT AS load
FROM ({_ARRIVALS}) WHERE turn IN (0, 3) OR (turn = 1 AND o_orderstatus <> 'P')""")
def load_changed_files(spark, sf_dir):
    """Changed files' rows take the place of their old ones, the rows of files that went are gone."""
    base, _ = _two_arrivals(spark, sf_dir)
    rows = changed_files.current_rows(spark, ORDERS, f"{base}/typed", f"{base}/ledger")
    name = F.element_at(F.split("_file", "/"), -1)
    return rows.select(*ORDERS.targets, name.alias("file"), F.col("_load").alias("load"))


@answered(f"""
WITH rows AS ({_ARRIVALS}), lines AS (
  SELECT 1 AS load, slot, 'new' AS status, count(*) AS n, 0 AS n_current FROM rows WHERE turn <> 3 GROUP BY slot
  UNION ALL SELECT 2, slot, 'new', count(*), count(*) FROM rows WHERE turn = 3 GROUP BY slot
  UNION ALL SELECT 2, slot, 'changed', count(*) FILTER (o_orderstatus <> 'P'), count(*) FILTER (o_orderstatus <> 'P')
            FROM rows WHERE turn = 1 GROUP BY slot
  UNION ALL SELECT 2, slot, 'gone', 0, 0 FROM rows WHERE turn = 2 GROUP BY slot
  UNION ALL SELECT 3, slot, 'moved', count(*), count(*) FROM rows WHERE turn = 0 GROUP BY slot)
SELECT load::BIGINT AS load, count(*) FILTER (status = 'new') AS n_new, count(*) FILTER (status = 'changed') AS n_changed,
       count(*) FILTER (status = 'gone') AS n_gone, count(*) FILTER (status = 'moved') AS n_moved,
       sum(n)::BIGINT AS n_rows, sum(n_current)::BIGINT AS n_current
FROM lines GROUP BY load""")
def load_ledger(spark, sf_dir):
    """What every load took and how much of it still counts, after the first was compacted."""
    base, _ = _two_arrivals(spark, sf_dir)
    changed_files.compact(spark, ORDERS, f"{base}/typed", f"{base}/ledger", STRICT)
    return changed_files.load_report(spark, f"{base}/ledger").withColumnRenamed("_load", "load")


# Merges


def _merged(spark: SparkSession, sf_dir: str) -> tuple[str, MergeMetrics]:
    """A snapshot of most orders, merged with late, changed and outdated ones."""
    path = scratch_path(spark, "buckets")
    key = F.col("o_orderkey")
    orders = given(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))
    older = F.when(key % 100 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    create_snapshot(
        orders.where(key % 50 != 0).withColumn("o_totalprice", older), path, ["o_orderkey"], ["o_orderdate"], n_buckets=64
    )
    outdated = orders.where(key % 100 == 9).withColumns(
        {"o_totalprice": F.lit(0.0), "o_orderdate": (F.col("o_orderdate") - F.expr("INTERVAL '1' DAY")).cast("timestamp_ntz")}
    )
    incoming = orders.where((key % 100 == 7) | (key % 50 == 0)).unionByName(outdated)
    return path, merge_into_snapshot(spark, path, incoming)


@answered("SELECT * FROM orders")
def merge_buckets(spark, sf_dir):
    """The snapshot after the merge: every order as it is given."""
    path, _ = _merged(spark, sf_dir)
    return read_snapshot(spark, path)


@answered("""
SELECT count(*) FILTER (o_orderkey % 50 = 0) AS n_new, count(*) FILTER (o_orderkey % 100 = 7) AS n_modified,
       count(*) FILTER (o_orderkey % 100 = 9) AS n_stale, count(*) AS n_rows FROM orders""")
def merge_metrics(spark, sf_dir):
    """What the merge met, and the rows its buckets then hold."""
    path, met = _merged(spark, sf_dir)
    held = bucket_report(spark, path).agg(F.sum("n_rows").alias("n_rows"))
    return held.select(*[F.lit(n).cast("bigint").alias(name) for name, n in met.counts().items()], "n_rows")


# The latest record per key, from a stream


def _streamed(spark: SparkSession, sf_dir: str, late: str) -> DataFrame:
    """Events in three arrivals that overlap in time; the stream stops after each and starts again."""
    events = given(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    base = scratch_path(spark, "latest")
    for turn in range(3):
        events.where(F.col("event_id") % 3 == turn).write.mode("append").parquet(f"{base}/in")
        arrived = spark.readStream.schema(events.schema).parquet(f"{base}/in")
        keep_latest(arrived, ["user_id"], ["ts", "event_id"], f"{base}/snapshot", f"{base}/checkpoint", late=late, n_buckets=8)
    return read_snapshot(spark, f"{base}/snapshot").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


_NEWEST = """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM ({}))
WHERE rn = 1"""


@answered(_NEWEST.format("SELECT * FROM events"))
def stream_latest(spark, sf_dir):
    """Nothing is too late: the answer of the batch aggregate."""
    return _streamed(spark, sf_dir, "60 days")


@answered(
    """WITH one AS (SELECT * FROM events WHERE event_id % 3 = 0), two AS (
  SELECT * FROM one UNION ALL SELECT * FROM events
  WHERE event_id % 3 = 1 AND ts > (SELECT max(ts) FROM one) - INTERVAL 2 HOUR)"""
    + _NEWEST.format("""
  SELECT * FROM two UNION ALL SELECT * FROM events
  WHERE event_id % 3 = 2 AND ts > (SELECT max(ts) FROM two) - INTERVAL 2 HOUR""")
)
def stream_late_rows(spark, sf_dir):
    """Records over two hours behind what earlier arrivals held are left out."""
    return _streamed(spark, sf_dir, "2 hours")


# Layout along a curve, and its upkeep

_PLACES = ["State", "County", "City"]
_FILES = 48


def _by_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registrations(spark, sf_dir).select("DOL Vehicle ID", *_PLACES)


@answered("""
SELECT o_orderkey::VARCHAR AS "DOL Vehicle ID", CASE WHEN o_custkey % 10 < 9 THEN 'WA' ELSE 'OR' END AS "State",
       CASE WHEN o_orderkey % 13 <> 0 THEN 'County ' || (o_custkey % 39) END AS "County",
       'City ' || (o_custkey % 281) AS "City" FROM orders""")
def curve_write(spark, sf_dir):
    """Registrations laid out along the curve of state, county and city."""
    path = scratch_path(spark, "curve")
    write_table(curve_clustered(_by_place(spark, sf_dir), _PLACES, _FILES), path)
    return spark.read.parquet(path)


@answered("""
SELECT * FROM (VALUES ('State', true, true), ('County', true, true), ('City', false, true))
  AS t("key", sorted_leaves_out_half, curve_leaves_out_half) WHERE (SELECT count(*) FROM orders) > 0""")
def curve_pruning(spark, sf_dir):
    """Filters on one key: whether, by the files' ranges, half of the files are left out in either layout.

    For state the rarer value is asked for; no layout helps the one that nine tenths of the rows have.
    """
    rows = _by_place(spark, sf_dir)
    base = scratch_path(spark, "layouts")
    write_table(clustered(rows, _PLACES, partitions=_FILES), f"{base}/sorted")
    write_table(curve_clustered(rows, _PLACES, _FILES), f"{base}/curve")
    asked = {
        "State": ["OR"],
        **{k: [r[0] for r in rows.select(k).distinct().orderBy(k).limit(20).collect() if r[0]] for k in _PLACES[1:]},
    }
    parts = []
    for layout in ("sorted", "curve"):
        ranges = file_ranges(spark, f"{base}/{layout}", _PLACES)
        for key, values in asked.items():
            half = F.avg("n_left") <= F.max("n_files") / 2
            left = files_left(ranges, key, values)
            parts.append(left.agg(half.alias("half")).select(F.lit(key).alias("key"), F.lit(layout).alias("layout"), "half"))
    told = lambda layout: F.bool_or(F.when(F.col("layout") == layout, F.col("half"))).alias(f"{layout}_leaves_out_half")
    return reduce(DataFrame.unionByName, parts).groupBy("key").agg(told("sorted"), told("curve"))


_KEPT_BY = ["o_orderpriority", "o_custkey"]


def _kept_up(spark: SparkSession, sf_dir: str) -> tuple[str, list[DataFrame]]:
    """Orders clustered, late ones of one priority appended, and what overlaps clustered again."""
    path = scratch_path(spark, "kept-up")
    orders = given(spark, sf_dir, "orders")
    late = (F.col("o_orderpriority") == "3-MEDIUM") & (F.col("o_orderkey") % 10 == 0)
    reports = []

    def report(step: str) -> None:
        told = depth_report(spark, path, _KEPT_BY).withColumn("step", F.lit(step))
        reports.append(written_rows(told))

    write_table(clustered(orders.where(~late), _KEPT_BY, partitions=16), path)
    report("written")
    write_table(clustered(orders.where(late), _KEPT_BY, partitions=2), path, mode="append")
    report("appended")
    recluster(spark, path, _KEPT_BY)
    report("kept up")
    return path, reports


@answered("SELECT * FROM orders")
def cluster_upkeep(spark, sf_dir):
    """All orders, after the files that the appended ones overlap were written again."""
    path, _ = _kept_up(spark, sf_dir)
    return spark.read.parquet(path)


@answered("""
SELECT * FROM (VALUES ('written', false, false), ('appended', true, true), ('kept up', false, false))
  AS t(step, files_overlap, others_apart) WHERE (SELECT count(*) FROM orders) > 0""")
def cluster_depth(spark, sf_dir):
    """Whether files overlap after each step, and whether then some still lie apart."""
    _, reports = _kept_up(spark, sf_dir)
    found = reports[0].unionByName(reports[1]).unionByName(reports[2])
    deep = F.col("max_depth") > 1
    apart = deep & (F.col("n_overlapping") < F.col("n_files"))
    return found.select("step", deep.alias("files_overlap"), apart.alias("others_apart"))


def written_rows(df: DataFrame) -> DataFrame:
    """The rows as they are now, before the files they describe change."""
    path = scratch_path(df.sparkSession, "report")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Summaries kept up with changes

_MEASURES = [
    Measure("orders"),
    Measure("finished", where="o_orderstatus = 'F'"),
    Measure("price", "o_totalprice"),
    Measure("large", "o_totalprice", where="o_totalprice > 200000"),
]


@answered("""
WITH now AS (SELECT *, CASE WHEN o_orderkey % 10 = 3 THEN 'moved' ELSE o_orderpriority END AS priority,
                    o_totalprice::DECIMAL(14,2) AS price FROM orders WHERE o_orderkey % 7 <> 0)
SELECT priority AS o_orderpriority, count(*) AS orders, count(*) FILTER (o_orderstatus = 'F') AS finished,
       sum(price)::DECIMAL(38,2) AS price_sum, round(sum(price)::DOUBLE / count(*), 6) AS price_mean,
       (sum(price) FILTER (price > 200000))::DECIMAL(38,2) AS large_sum,
       round((sum(price) FILTER (price > 200000))::DOUBLE / count(*) FILTER (price > 200000), 6) AS large_mean
FROM now GROUP BY priority""")
def kept_summary(spark, sf_dir):
    """Orders per priority after a first load, later and dearer orders, orders that change priority, and deletions."""
    path = scratch_path(spark, "summary")
    by, key = ["o_orderpriority"], ["o_orderkey"]
    orders = given(spark, sf_dir, "orders")
    columns = [*by, "o_orderstatus", "o_totalprice"]
    first = _older(orders)
    add_changes(arriving(first.select(*columns)), path, by, _MEASURES, 1)
    # Later and corrected orders; then some change their group; then some go.
    add_changes(signed_changes(orders, first, key, columns), path, by, _MEASURES, 2)
    third = F.col("o_orderkey") % 10 == 3
    moved = orders.withColumn("o_orderpriority", F.when(third, "moved").otherwise(F.col("o_orderpriority")))
    add_changes(signed_changes(moved.where(third), orders, key, columns), path, by, _MEASURES, 3)
    fold(spark, path, by)
    gone = orders.where("o_orderkey % 7 = 0").select(*key)
    add_changes(signed_changes(moved.limit(0), moved, key, columns, deleted=gone), path, by, _MEASURES, 4)
    found = read_summary(spark, path, by, _MEASURES)
    return found.withColumns({c: F.round(c, 6) for c in found.columns if c.endswith("_mean")})


def _older(orders: DataFrame) -> DataFrame:
    """Orders as they were known at the end of 1999, the pending ones cheaper."""
    known = orders.where("o_orderdate < TIMESTAMP_NTZ'2000-01-01 00:00:00'")
    return known.withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") - 1).otherwise(F.col("o_totalprice")))


# Profiles over loads

_PROFILED = ["o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority", "clerk"]


def _loads(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Orders in three loads; in the last, prices are higher and a clerk is often not known."""
    orders = given(spark, sf_dir, "orders").withColumn("clerk", F.concat(F.lit("Clerk "), F.col("o_custkey") % 1000))
    turn = F.col("o_orderkey") % 3
    unknown = F.when(F.col("o_orderkey") % 4 != 0, F.col("clerk"))
    last = orders.where(turn == 2).withColumns({"o_totalprice": F.col("o_totalprice") * 1.5, "clerk": unknown})
    return [orders.where(turn == 0), orders.where(turn == 1), last]


@answered("""
WITH held AS (SELECT *, o_orderkey % 3 AS turn FROM orders WHERE o_orderkey % 3 > 0),
rows AS (SELECT o_orderkey, o_totalprice * CASE WHEN turn = 2 THEN 1.5::DOUBLE ELSE 1 END AS price, o_orderdate, o_orderpriority,
                CASE WHEN turn = 1 OR o_orderkey % 4 <> 0 THEN 'Clerk ' || (o_custkey % 1000) END AS clerk FROM held)
SELECT 'o_orderkey' AS "column", count(*) AS n_rows, 0::BIGINT AS n_null, min(o_orderkey)::DOUBLE AS low,
       max(o_orderkey)::DOUBLE AS high, NULL::VARCHAR AS low_text, NULL::VARCHAR AS high_text, true AS within_bounds FROM rows
UNION ALL SELECT 'o_totalprice', count(*), 0, min(price), max(price), NULL, NULL, true FROM rows
UNION ALL SELECT 'o_orderdate', count(*), 0, epoch(min(o_orderdate)), epoch(max(o_orderdate)), NULL, NULL, true FROM rows
UNION ALL SELECT 'o_orderpriority', count(*), 0, min(length(o_orderpriority)), max(length(o_orderpriority)),
                 min(o_orderpriority), max(o_orderpriority), true FROM rows
UNION ALL SELECT 'clerk', count(*), count(*) - count(clerk), min(length(clerk)), max(length(clerk)), min(clerk), max(clerk), true
          FROM rows""")
def profile_span(spark, sf_dir):
    """The profile of the last two of three loads, merged; whether its estimates are within the sketches' bounds
    of the exact values, which a pass over the rows gives here."""
    path = scratch_path(spark, "profiles")
    loads = _loads(spark, sf_dir)
    for number, rows in enumerate(loads, 1):
        store_profile(rows, path, number, _PROFILED)
    told = described(merged(read_profiles(spark, path, [2, 3])), ranks=[0.5])
    rows = loads[1].unionByName(loads[2])
    exact = rows.agg(
        F.array(*[
            F.struct(F.lit(c).alias("name"), F.count_distinct(c).alias("distinct"),
                     F.percentile(column_value(rows, c), F.array(F.lit(0.47), F.lit(0.53))).alias("middle"))
            for c in _PROFILED
        ]).alias("columns")
    ).select(F.inline("columns"))
    near = F.abs(F.col("n_distinct") / F.col("distinct") - 1) <= 0.08
    middle = F.col("quantiles")[0].between(F.col("middle")[0], F.col("middle")[1])
    return told.join(exact, F.col("column") == F.col("name")).select(
        "column", "n_rows", "n_null", "low", "high", "low_text", "high_text", (near & middle).alias("within_bounds")
    )


@answered("""
SELECT * FROM (VALUES ('o_orderkey', false, false), ('o_totalprice', false, true), ('o_orderdate', false, false),
  ('o_orderpriority', false, false), ('clerk', false, true)) AS t("column", second_drifted, third_drifted)
WHERE (SELECT count(*) FROM orders) > 0""")
def profile_drift(spark, sf_dir):
    """Whether the second and the third load's columns are unlike those of the first."""
    path = scratch_path(spark, "profiles")
    for number, rows in enumerate(_loads(spark, sf_dir), 1):
        store_profile(rows, path, number, _PROFILED)
    first, second, third = (merged(read_profiles(spark, path, [n])) for n in (1, 2, 3))
    told = lambda later, name: drift(first, later).select("column", drifted(rank_distance=0.12, value_distance=0.35).alias(name))
    return told(second, "second_drifted").join(told(third, "third_drifted"), "column")


# Renamed columns


@answered("""
SELECT * FROM (VALUES ('o_custkey', 'renamed', 'Customer No'), ('o_orderpriority', 'renamed', 'urgency'),
  ('o_totalprice', 'missing', NULL), ('clerk', 'extra', NULL)) AS t("column", status, found_as)
WHERE (SELECT count(*) FROM orders) > 0""")
def schema_renames(spark, sf_dir):
    """Later orders come with two columns renamed, one gone and one that is new."""
    raw = as_text(given(spark, sf_dir, "orders")).drop("o_orderdate")
    expected = written_rows(column_signatures(raw.where("o_orderkey % 2 = 0")))
    later = raw.where("o_orderkey % 2 = 1").select(
        "o_orderkey", "o_orderstatus", F.col("o_custkey").alias("Customer No"), F.col("o_orderpriority").alias("urgency"),
        F.concat(F.lit("Clerk#"), F.col("o_orderkey") % 10).alias("clerk"),
    )
    return drift_with_renames(later, ORDERS, expected).drop("score")


@answered("""
SELECT o_orderkey::VARCHAR AS "ORDER_KEY", o_custkey::VARCHAR AS "CUSTOMER_KEY", o_orderstatus AS "STATUS",
       o_totalprice::DECIMAL(14,2) AS "TOTAL_PRICE", o_orderpriority AS "PRIORITY"
FROM orders WHERE o_orderkey % 2 = 1""")
def load_renamed(spark, sf_dir):
    """The same columns under new names, loaded under the contract."""
    raw = as_text(given(spark, sf_dir, "orders")).drop("o_orderdate")
    expected = written_rows(column_signatures(raw.where("o_orderkey % 2 = 0")))
    later = raw.where("o_orderkey % 2 = 1").withColumnsRenamed({"o_custkey": "Customer No", "o_orderpriority": "urgency"})
    return apply_contract(with_known_names(later, ORDERS, expected), ORDERS, STRICT)


# Nested payloads

_LINES = Contract(
    "lines",
    (
        ColumnSpec("l_linenumber", "LINE", "int", precision=9),
        ColumnSpec("l_quantity", "QUANTITY", "decimal", precision=10, scale=2),
        ColumnSpec("return flag", "RETURN_FLAG"),
        ColumnSpec("absent", "ABSENT"),
    ),
)


def _nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An object for each order with its lines; of every tenth the lines end in a null and a number."""
    line = F.struct("l_linenumber", "l_quantity", F.col("l_returnflag").alias("return flag"))
    lines = given(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    text = F.transform("lines", lambda line: F.to_json(line))
    tail = F.when(F.col("l_orderkey") % 10 == 0, F.array(F.lit("null"), F.lit("7"))).otherwise(F.array().cast("array<string>"))
    head = F.concat(F.lit('{"key": '), F.col("l_orderkey").cast("string"), F.lit(', "of": {"lines": ['))
    json = F.concat(head, F.array_join(F.concat(text, tail), ", "), F.lit("]}}"))
    return lines.select("l_orderkey", F.parse_json(json).alias("payload"))


@answered("""
WITH lines AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity, l_returnflag) - 1 AS pos
               FROM lineitem),
ends AS (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey % 10 = 0 GROUP BY l_orderkey)
SELECT l_orderkey, pos::INT AS "_pos", l_linenumber::INT AS "LINE", l_quantity::DECIMAL(10,2) AS "QUANTITY",
       l_returnflag AS "RETURN_FLAG", NULL::VARCHAR AS "ABSENT", 'object' AS "_status", NULL::VARCHAR AS "_element" FROM lines
UNION ALL SELECT l_orderkey, n::INT, NULL, NULL, NULL, NULL, 'null', 'null' FROM ends
UNION ALL SELECT l_orderkey, n::INT + 1, NULL, NULL, NULL, NULL, 'scalar', '7' FROM ends""")
def nested_children(spark, sf_dir):
    """Each order's lines as rows with the order's key; what is no line is kept and told."""
    return child_rows(_nested(spark, sf_dir), "payload", ["of", "lines"], _LINES, LENIENT, keep=["l_orderkey"])


@answered("""
SELECT * FROM (VALUES ('l_linenumber', 'L_LINENUMBER', 'int', NULL), ('l_quantity', 'L_QUANTITY', 'int', NULL),
  ('return flag', 'RETURN_FLAG', 'string', (SELECT max(length(l_returnflag))::BIGINT FROM lineitem))) AS t(source, target, kind, length)
WHERE (SELECT count(*) FROM lineitem) > 0""")
def nested_contract(spark, sf_dir):
    """The contract that the lines themselves suggest."""
    found = proposed_contract(_nested(spark, sf_dir), "payload", "lines", ["of", "lines"])
    rows = [(c.source, c.target, c.kind, c.length) for c in found.columns]
    return spark.createDataFrame(rows, "source string, target string, kind string, length bigint")


# Points in use

_PLACES_IN_SQL = """
WITH s AS (SELECT s_suppkey, s_suppkey * 37 % 3600 / 10.0::DOUBLE - 180 AS lon, s_suppkey * 53 % 1800 / 10.0::DOUBLE - 90 AS lat FROM supplier),
c AS (SELECT c_custkey, c_custkey * 71 % 3600 / 10.0::DOUBLE - 180 AS lon, c_custkey * 29 % 1800 / 10.0::DOUBLE - 90 AS lat FROM customer),
pairs AS (
  SELECT s_suppkey, c_custkey, 2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(c.lat - s.lat) / 2), 2)
         + cos(radians(s.lat)) * cos(radians(c.lat)) * pow(sin(radians(c.lon - s.lon) / 2), 2)))) AS km FROM s, c)
"""


def _placed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Suppliers and customers all over the globe, poles and date line included."""
    at = lambda key, step, size: (F.col(key) * step % size) / F.lit(10.0) - size / 20
    suppliers = given(spark, sf_dir, "supplier").select("s_suppkey", at("s_suppkey", 37, 3600).alias("lon"), at("s_suppkey", 53, 1800).alias("lat"))
    customers = given(spark, sf_dir, "customer").select("c_custkey", at("c_custkey", 71, 3600).alias("lon"), at("c_custkey", 29, 1800).alias("lat"))
    return suppliers, customers


@answered(_PLACES_IN_SQL + "SELECT s_suppkey, c_custkey, round(km, 3) AS km FROM pairs WHERE km <= 700")
def points_within(spark, sf_dir):
    """Suppliers and customers at most 700 km apart."""
    pairs = pairs_within(*_placed(spark, sf_dir), 700)
    return pairs.select("left.s_suppkey", "right.c_custkey", rounded("km", 3).alias("km"))


@answered(_PLACES_IN_SQL + """
SELECT s_suppkey, c_custkey, round(km, 3) AS km, rank::INT AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY round(km, 6), c_custkey) AS rank FROM pairs)
WHERE rank <= 3""")
def points_nearest(spark, sf_dir):
    """The three customers nearest to each supplier."""
    found = nearest(*_placed(spark, sf_dir), 3, ["c_custkey"])
    return found.select("left.s_suppkey", "right.c_custkey", F.round("km", 3).alias("km"), "rank")


# Partitions loaded again


@answered("""
SELECT o_orderkey, o_orderdate::TIMESTAMP AS o_orderdate, strftime(o_orderdate, '%Y-%m') AS month,
       o_totalprice + CASE WHEN year(o_orderdate) = 1998 THEN 0 ELSE 1 END AS o_totalprice
FROM orders WHERE NOT (year(o_orderdate) = 1998 AND o_orderstatus = 'P')""")
def reload_months(spark, sf_dir):
    """The months of 1998 are loaded again, at other prices and without pending orders; the others stay."""
    path = scratch_path(spark, "months")
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"))
    derived = {"month": ("o_orderdate", MONTH)}
    replace_partitions(orders.withColumn("o_totalprice", F.col("o_totalprice") + 1), path, ["month"], derived)
    again = orders.where((F.year("o_orderdate") == 1998) & (F.col("o_orderstatus") != "P"))
    replace_partitions(again, path, ["month"], derived)
    return spark.read.parquet(path).withColumn("month", F.col("month").cast("string")).drop("o_orderstatus")


@answered("""
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-11-15' AND o_orderdate < TIMESTAMP '1997-03-02' GROUP BY month""")
def pruned_months(spark, sf_dir):
    """Orders of some weeks, read from the folders of their months alone."""
    path = scratch_path(spark, "months")
    orders = given(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))
    replace_partitions(orders, path, ["month"], {"month": ("o_orderdate", MONTH)})
    stored = spark.read.schema(orders.schema.add("month", "string")).parquet(path)
    some = within(stored, "o_orderdate", "month", "1996-11-15 00:00:00", "1997-03-02 00:00:00")
    return summaries.count_by(some, "month", "n")
