"""The same answers as plain SQL over the given tables, in closed form.

None of these goes through text: dirty cells are known from the clean columns they
were derived from.
"""

from ledgerline.plans import upkeep

_VEHICLE_COLUMNS = """
  'row-' || o_orderkey AS "SID",
  '00000000-0000-0000-' || o_orderkey AS "ID",
  {position} AS "POSITION",
  o_orderdate::TIMESTAMP AS "CREATED_AT",
  (o_orderdate + to_days((o_custkey % 30)::INT))::TIMESTAMP AS "UPDATED_AT",
  lpad((o_custkey % 1000000)::VARCHAR, 10, '0') AS "VIN_1_10",
  {year} AS "MODEL_YEAR",
  o_orderpriority AS "MAKE",
  'Model ' || (o_custkey % 17) AS "MODEL",
  CASE WHEN o_orderstatus = 'F' THEN 'Battery Electric Vehicle (BEV)'
       ELSE 'Plug-in Hybrid Electric Vehicle (PHEV)' END AS "ELECTRIC_VEHICLE_TYPE",
  {range} AS "ELECTRIC_RANGE",
  {msrp} AS "BASE_MSRP",
  CASE WHEN o_orderkey % 13 <> 0 THEN 'County ' || (o_custkey % 39) END AS "COUNTY",
  'City ' || (o_custkey % 281) AS "CITY",
  CASE WHEN o_custkey % 10 < 9 THEN 'WA' ELSE 'OR' END AS "STATE",
  (98000 + o_custkey % 1000)::VARCHAR AS "POSTAL_CODE",
  'POINT (-122.' || (10 + o_custkey % 90) || ' 47.' || (10 + o_custkey % 80) || ')' AS "VEHICLE_LOCATION",
  'Status ' || o_orderstatus AS "CLEAN_ALTERNATIVE_FUEL_VEHICLE_CAFV_ELIGIBILITY",
  {legislative} AS "LEGISLATIVE_DISTRICT",
  o_orderkey::VARCHAR AS "DOL_VEHICLE_ID",
  'UTILITY ' || (o_custkey % 12) || '||CITY OF TACOMA - (WA)' AS "ELECTRIC_UTILITY",
  (53033000000 + o_custkey % 1000)::VARCHAR AS "2020_CENSUS_TRACT",
  {counties} AS "COUNTIES",
  {congressional} AS "CONGRESSIONAL_DISTRICTS",
  {legislative} AS "WAOFM___GIS___LEGISLATIVE_DISTRICT_BOUNDARY"
"""


def _vehicles(whole: str, dirty: bool) -> str:
    odd = "o_orderkey % 11 = 0" if dirty else "FALSE"
    return _VEHICLE_COLUMNS.format(
        position=f"0::{whole}",
        year=f"year(o_orderdate)::{whole}",
        range=f"CASE WHEN {odd} THEN NULL WHEN o_custkey % 7 = 0 THEN 0 ELSE o_custkey % 300 END::{whole}",
        msrp=f"CASE WHEN {odd} THEN NULL ELSE o_totalprice::DECIMAL(12,2) END",
        legislative=f"(1 + o_custkey % 49)::{whole}",
        counties=f"CASE WHEN o_orderkey % 13 <> 0 THEN o_custkey % 3000 END::{whole}",
        congressional=f"(1 + o_custkey % 10)::{whole}",
    )


_STRICT_VEHICLES = f"""
SELECT {_vehicles('BIGINT', False)},
       -((122 * 100 + 10 + o_custkey % 90) / 100.0)::DOUBLE AS "LON",
       ((47 * 100 + 10 + o_custkey % 80) / 100.0)::DOUBLE AS "LAT"
FROM orders"""

_EVENTS_TEXT = """
SELECT event_id::VARCHAR AS event_id, ts::VARCHAR AS ts, user_id::VARCHAR AS user_id,
       event_type, value::VARCHAR AS value, props FROM events"""

_ORDERS_TEXT = """
SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderstatus,
       o_totalprice::VARCHAR AS o_totalprice, o_orderdate::VARCHAR AS o_orderdate, o_orderpriority
FROM orders"""

_ORDERS_TYPED = """
SELECT o_orderkey::VARCHAR AS "ORDER_KEY", o_custkey::VARCHAR AS "CUSTOMER_KEY",
       o_orderstatus AS "STATUS", o_totalprice::DECIMAL(14,2) AS "TOTAL_PRICE",
       o_orderpriority AS "PRIORITY" FROM orders"""

ANSWERS: dict[str, str] = {
    "avg_positive_by_group": """
SELECT l_returnflag, round(avg(l_quantity), 6) AS avg_qty FROM lineitem
WHERE l_quantity > 0 GROUP BY l_returnflag""",
    "typed_average": """
SELECT l_returnflag AS "RETURN_FLAG", round(avg(trunc(l_quantity)), 6) AS avg_qty FROM lineitem
WHERE trunc(l_quantity) > 0 GROUP BY l_returnflag""",
    "count_by_group": "SELECT event_type, count(*) AS total FROM events GROUP BY event_type",
    "count_filtered_by_group": """
SELECT c_nationkey, count(*) AS n FROM customer WHERE c_mktsegment = 'BUILDING'
GROUP BY c_nationkey ORDER BY n DESC, c_nationkey""",
    "trend_by_year": """
SELECT year(o_orderdate)::INT AS order_year, count(*) AS n FROM orders
WHERE o_orderdate IS NOT NULL GROUP BY 1 ORDER BY 1""",
    "row_count": "SELECT count(*) AS n FROM orders",
    "preview_rows": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
    "envelope_columns": """
SELECT * FROM (VALUES (0, 's_suppkey'), (1, 's_name'), (2, 's_nationkey'), (3, 's_acctbal'))
  AS t("position", name) WHERE (SELECT count(*) FROM supplier) > 0""",
    "envelope_rows": """
SELECT s_suppkey::VARCHAR AS s_suppkey, s_name, s_nationkey::VARCHAR AS s_nationkey,
       s_acctbal::VARCHAR AS s_acctbal FROM supplier""",
    "raw_all_string": _EVENTS_TEXT,
    "raw_roundtrip": _ORDERS_TEXT,
    "quarantine_ragged": """
SELECT o_orderkey, 'ragged' AS reason, 3::INT AS n_names,
       CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 4 END::INT AS n_cells
FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority = '1-URGENT'""",
    "long_documents": _ORDERS_TEXT,
    "mixed_documents": _ORDERS_TEXT,
    "document_tail": """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'ok' ELSE 'corrupt' END AS status,
       CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END AS o_custkey FROM orders""",
    "refused_rows": """
SELECT o_orderkey::VARCHAR AS o_orderkey,
       CASE WHEN o_orderstatus = 'P' THEN 'ragged' ELSE 'loaded' END AS place FROM orders""",
    "map_rename_select": """
SELECT l_orderkey::VARCHAR AS "ORDER_KEY", l_linenumber::VARCHAR AS "LINE",
       NULL::VARCHAR AS "SHIP_MODE", l_returnflag AS "RETURN_FLAG" FROM lineitem""",
    "rename_present": 'SELECT p_partkey AS "PART_KEY", p_brand AS "BRAND" FROM part',
    "cast_int_lenient": """
SELECT o_orderkey, CASE WHEN o_orderkey % 6 IN (0, 1, 4) THEN NULL ELSE o_custkey END::INT AS amount
FROM orders""",
    "cast_decimal_lenient": """
SELECT p_partkey,
       CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_retailprice::DECIMAL(12,2) END AS price
FROM part""",
    "cast_number_strict": """
SELECT l_orderkey, l_linenumber, (l_quantity + 0.5)::DECIMAL(38,0) AS quantity FROM lineitem""",
    "epoch_to_timestamp": """
SELECT event_id, date_trunc('second', ts)::TIMESTAMP AS lenient_ts,
       date_trunc('second', ts)::TIMESTAMP AS strict_ts, NULL::TIMESTAMP AS milliseconds
FROM events""",
    "point_parse": """
SELECT s_suppkey, CASE WHEN s_acctbal / 50 BETWEEN -180 AND 180 THEN s_acctbal / 50 END AS lon,
       CASE WHEN s_acctbal / 50 BETWEEN -180 AND 180 THEN 47.6::DOUBLE END AS lat FROM supplier""",
    "json_extract_strict": """
SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events""",
    "json_extract_lenient": """
SELECT event_id,
       CASE WHEN event_id % 10 = 0 THEN NULL ELSE json_extract_string(props, '$.k')::BIGINT END AS k
FROM events""",
    "json_malformed": """
SELECT event_id, left(props, length(props) - 1) AS props FROM events WHERE event_id % 10 = 0""",
    "json_tail": """
SELECT event_id, CASE WHEN event_id % 10 IN (0, 1) THEN 'malformed'
                      ELSE json_extract_string(props, '$.k') END AS found
FROM events WHERE event_id % 10 IN (0, 1) OR json_extract_string(props, '$.k') IS NOT NULL""",
    "key_drift": """
SELECT key AS "column", 'extra' AS status, count(DISTINCT event_id) AS n_rows
FROM (SELECT event_id, unnest(json_keys(props)) AS key FROM events) GROUP BY key
UNION ALL SELECT 'absent', 'missing', count(*) FROM events HAVING count(*) > 0""",
    "row_as_variant": """
SELECT p_partkey, p_name, p_retailprice, NULL::VARCHAR AS p_absent FROM part""",
    "inspect_files": "SELECT count(*) AS n, 1::BIGINT AS lo, count(*) AS hi FROM orders",
    # The file holds the orders by rising key.
    "inspect_rows": """
SELECT row_number() OVER (ORDER BY o_orderkey) AS _row_number, * FROM orders
ORDER BY o_orderkey LIMIT 5""",
    "load_by_name": _ORDERS_TYPED,
    "table_count": "SELECT count(*) AS n FROM orders",
    "table_comment": """
SELECT * FROM (VALUES ('STATUS', 'varchar(1)'), ('PRIORITY', 'varchar(20)'),
  ('TOTAL_PRICE', 'decimal(14,2)'), ('Comment', 'Orders')) AS t(col_name, data_type)""",
    "load_by_json_contract": _ORDERS_TYPED,
    "load_staged_drift": """
SELECT o_orderkey::VARCHAR AS "ORDER_KEY", o_custkey::VARCHAR AS "CUSTOMER_KEY",
       o_orderstatus AS "STATUS", o_totalprice::DECIMAL(14,2) AS "TOTAL_PRICE",
       CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS "PRIORITY" FROM orders""",
    "load_double_columns": """
SELECT o_orderkey::VARCHAR AS "ORDER_KEY", o_orderdate::TIMESTAMP AS "ORDERED_AT",
       o_totalprice::DECIMAL(14,2) AS "TOTAL_PRICE", (o_custkey + 20000000)::INT AS "LARGE" FROM orders""",
    "load_partitioned_rows": """
SELECT o_orderkey::VARCHAR AS "ORDER_KEY",
       CASE WHEN o_orderkey % 7 = 0 THEN 'refused' ELSE o_orderstatus END AS "STATUS",
       CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice::DECIMAL(14,2) END AS "TOTAL_PRICE" FROM orders""",
    "clustered_write": "SELECT * FROM customer",
    "partitioned_write": "SELECT * FROM orders",
    "run_metrics": "SELECT count(*) AS n_rows, 6::BIGINT AS n_columns FROM orders",
    "schema_drift": """
SELECT * FROM (VALUES ('o_clerk', 'missing'), ('o_orderpriority', 'extra'),
  ('o_custkey', 'reordered'), ('o_orderkey', 'reordered')) AS t("column", status)
WHERE (SELECT count(*) FROM orders) > 0""",
    "quality_report": """
SELECT 'ORDER_KEY' AS "column", count(*) AS n_rows, 0::BIGINT AS n_null, 0::BIGINT AS n_bad,
       count(*) FILTER (length(o_orderkey::VARCHAR) > 4) AS n_too_long, 0::BIGINT AS n_out_of_range
FROM orders
UNION ALL
SELECT 'AMOUNT', count(*), 0::BIGINT, count(*) FILTER (o_orderkey % 6 IN (0, 1, 4)), 0::BIGINT,
       count(*) FILTER (o_orderkey % 6 = 4)
FROM orders""",
    "length_guard": """
SELECT doc_id, 'text' AS "column", length(text)::INT AS length, 500::INT AS "limit"
FROM documents WHERE length(text) > 500""",
    "quarantine_cells": """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 6 = 4 THEN 'AMOUNT: out_of_range' ELSE 'AMOUNT: not_a_number' END AS violations
FROM orders WHERE o_orderkey % 6 IN (0, 1, 4)""",
    "latest_per_key": """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""",
    "new_or_modified": """
SELECT *, CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 'new' ELSE 'modified' END AS change
FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' OR o_orderstatus = 'P'""",
    "merge_latest": """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN held THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       CASE WHEN held AND o_orderkey % 5 = 0 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END::TIMESTAMP
         AS o_orderdate, o_orderpriority
FROM (SELECT *, o_orderkey % 2 = 0 AND (o_orderkey % 3 = 0 OR o_orderkey % 5 = 0) AS held FROM orders)
WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 <> 0""",
    "load_new_rows": _ORDERS_TYPED,
    "load_new_envelopes": _ORDERS_TYPED,
    "load_vehicle_envelopes": f"SELECT {_vehicles('INT', True)} FROM orders",
    "load_vehicle_json_rows": _STRICT_VEHICLES,
    "load_vehicle_raw_rows": _STRICT_VEHICLES,
    "avg_range_by_make": f"""
SELECT "MAKE", round(avg("ELECTRIC_RANGE"), 6) AS avg_range FROM (SELECT {_vehicles('INT', True)} FROM orders)
WHERE "ELECTRIC_RANGE" > 0 GROUP BY "MAKE" ORDER BY avg_range DESC""",
    "vehicles_by_city": f"""
SELECT "CITY", count(*) AS "VEHICLE_COUNT" FROM (SELECT {_vehicles('INT', True)} FROM orders)
WHERE "STATE" = 'WA' GROUP BY "CITY" ORDER BY "VEHICLE_COUNT" DESC""",
    "vehicles_by_type": f"""
SELECT "ELECTRIC_VEHICLE_TYPE", count(*) AS total FROM (SELECT {_vehicles('INT', True)} FROM orders)
GROUP BY "ELECTRIC_VEHICLE_TYPE" """,
    "registrations_by_model_year": f"""
SELECT "MODEL_YEAR", count(*) AS "REGISTRATIONS" FROM (SELECT {_vehicles('INT', True)} FROM orders)
WHERE "MODEL_YEAR" IS NOT NULL GROUP BY "MODEL_YEAR" ORDER BY "MODEL_YEAR" """,
} | upkeep.ANSWERS
