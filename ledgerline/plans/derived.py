"""Inputs of the registered queries, derived by Spark from the given tables.

The given tables are typed and clean, so their text forms (documents, JSON rows,
dirty cells) are built here, in closed form from the clean columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.contract import ColumnSpec, Contract, quoted
from ledgerline.scratch import discard, scratch_path

ROWS_PER_DOCUMENT = 5000


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_text(df: DataFrame) -> DataFrame:
    """Every column as a string column of the same name."""
    return df.select(*[F.col(quoted(c)).cast("string").alias(c) for c in df.columns])


def documents(
    df: DataFrame, names: Sequence[str] | None = None, alternate: bool = False, cells: Column | None = None,
    number: Column | None = None,
) -> DataFrame:
    """The rows of a table as envelope documents, one text each (column ``value``).

    Documents take a bounded number of neighbouring rows, whatever keys these hold, or the rows of
    one ``number``. With ``alternate`` every other document has its columns in reverse order.
    """
    names = list(names or df.columns)
    row = F.array(*[F.col(quoted(c)).cast("string") for c in names]) if cells is None else cells
    if number is None:
        number = F.expr(f"monotonically_increasing_id() div {ROWS_PER_DOCUMENT}")
    numbered = df.select(number.alias("document"), row.alias("row"))
    if alternate:
        turned = F.col("document") % 2 == 1
        numbered = numbered.withColumn("row", F.when(turned, F.reverse("row")).otherwise(F.col("row")))
    header = F.array(*[F.struct(F.lit(n).alias("name")) for n in names])
    if alternate:
        header = F.when(F.col("document") % 2 == 1, F.reverse(header)).otherwise(header)
    return (
        numbered.groupBy("document")
        .agg(F.collect_list("row").alias("data"))
        .select(
            F.to_json(
                F.struct(
                    F.struct(F.struct(header.alias("columns")).alias("view")).alias("meta"), "data"
                )
            ).alias("value")
        )
    )


def write_documents(df: DataFrame, path: str) -> str:
    """Documents (column ``value``) as files of their own."""
    df.write.option("maxRecordsPerFile", 1).text(path)
    return path


def seconds_of(ts: Column) -> Column:
    """Whole epoch seconds of a timestamp without zone, whatever the session zone."""
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.floor(F.second(ts))


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with ``amount``: the customer key as text in six forms, by order key."""
    key = F.col("o_custkey").cast("string")
    form = F.col("o_orderkey") % 6
    amount = (
        F.when(form == 0, "n/a")
        .when(form == 1, "")
        .when(form == 2, F.concat(key, F.lit(".7")))
        .when(form == 3, F.concat(F.lit(" "), key, F.lit(" ")))
        .when(form == 4, "9999999999")
        .otherwise(key)
    )
    return given(spark, sf_dir, "orders").select("o_orderkey", amount.alias("amount"))


def registrations(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """Orders told as vehicle registrations: the source keys, all text.

    One line per order. With ``dirty`` some ranges and prices are no numbers.
    """
    n = F.col("o_custkey")
    text = lambda c: c.cast("string")
    join = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else text(p) for p in parts])
    created = seconds_of(F.col("o_orderdate"))
    electric_range = text(F.when(n % 7 == 0, 0).otherwise(n % 300))
    msrp = text(F.col("o_totalprice").cast("decimal(12,2)"))
    if dirty:
        odd = F.col("o_orderkey") % 11 == 0
        electric_range = F.when(odd, "unknown").otherwise(F.concat(electric_range, F.lit(".9")))
        msrp = F.when(odd, "n/a").otherwise(msrp)
    columns = {
        "sid": join("row-", F.col("o_orderkey")),
        "id": join("00000000-0000-0000-", F.col("o_orderkey")),
        "position": F.lit("0"),
        "created_at": text(created),
        "created_meta": F.lit(None).cast("string"),
        "updated_at": text(created + 86400 * (n % 30)),
        "updated_meta": F.lit(None).cast("string"),
        "meta": F.lit("{ }"),
        "VIN (1-10)": F.lpad(text(n % 1000000), 10, "0"),
        "County": F.when(F.col("o_orderkey") % 13 != 0, join("County ", n % 39)),
        "City": join("City ", n % 281),
        "State": F.when(n % 10 < 9, "WA").otherwise("OR"),
        "Postal Code": text(98000 + n % 1000),
        "Model Year": text(F.year("o_orderdate")),
        "Make": F.col("o_orderpriority"),
        "Model": join("Model ", n % 17),
        "Electric Vehicle Type": F.when(
            F.col("o_orderstatus") == "F", "Battery Electric Vehicle (BEV)"
        ).otherwise("Plug-in Hybrid Electric Vehicle (PHEV)"),
        "Clean Alternative Fuel Vehicle (CAFV) Eligibility": join("Status ", F.col("o_orderstatus")),
        "Electric Range": electric_range,
        "Base MSRP": msrp,
        "Legislative District": text(1 + n % 49),
        "DOL Vehicle ID": text(F.col("o_orderkey")),
        "Vehicle Location": join("POINT (-122.", 10 + n % 90, " 47.", 10 + n % 80, ")"),
        "Electric Utility": join("UTILITY ", n % 12, "||CITY OF TACOMA - (WA)"),
        "2020 Census Tract": text(53033000000 + n % 1000),
        "Counties": F.when(F.col("o_orderkey") % 13 != 0, text(n % 3000)),
        "Congressional Districts": text(1 + n % 10),
        "WAOFM - GIS - Legislative District Boundary": text(1 + n % 49),
    }
    return given(spark, sf_dir, "orders").select(*[c.alias(k) for k, c in columns.items()])


# The given tables as contracts: source and target names differ so that renaming shows.
LINEITEM = Contract(
    "lineitem",
    (
        ColumnSpec("l_returnflag", "RETURN_FLAG", length=1),
        ColumnSpec("l_quantity", "QUANTITY", "int", precision=10),
        ColumnSpec("l_extendedprice", "PRICE", "decimal", precision=12, scale=2),
    ),
)
ORDERS = Contract(
    "orders",
    (
        ColumnSpec("o_orderkey", "ORDER_KEY", length=20),
        ColumnSpec("o_custkey", "CUSTOMER_KEY", length=20),
        ColumnSpec("o_orderstatus", "STATUS", length=1),
        ColumnSpec("o_totalprice", "TOTAL_PRICE", "decimal", precision=14, scale=2),
        ColumnSpec("o_orderpriority", "PRIORITY", length=20),
    ),
    cluster_by=("STATUS", "PRIORITY"),
    comment="Orders",
)


def arrive(df: DataFrame, slot: Column, folder: str) -> None:
    """Rows as one Parquet file for each slot, under a name of its own that a later arrival replaces."""
    spark = df.sparkSession
    written = scratch_path(spark, "arrival")
    df.withColumn("_slot", slot).repartition("_slot").write.partitionBy("_slot").parquet(written)
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(path(folder))
    for found in system.globStatus(path(f"{written}/_slot=*/part-*")) or ():
        name = found.getPath().getParent().getName().removeprefix("_slot=")
        target = path(f"{folder}/orders-{name}.parquet")
        system.delete(target, False)
        system.rename(found.getPath(), target)


def leave(spark: SparkSession, folder: str, slots: Sequence[int]) -> None:
    """Remove the files of some slots."""
    discard(spark, *[f"{folder}/orders-{slot}.parquet" for slot in slots])
