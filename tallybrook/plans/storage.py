"""Sinks written and read back, and physical layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.functions import Addend, Span, spans
from tallybrook.operators import join_shared_key, partition_count, physical_partitions, rows_per_partition, spread
from tallybrook.operators.discovery import discover_fields, typed_documents
from tallybrook.plans import tables
from tallybrook.plans.tables import EXACT
from tallybrook.scratch import scratch_folder
from tallybrook.sinks import join_buckets, write_bucketed, write_files, write_partitioned_json, write_two_formats
from tallybrook.sources import read_checked, read_files, read_partitioned_json

PARTITIONS = 5
#: Bytes of a file in the two queries with folders; small enough for several files of the
#: given tables. A table of many terabytes takes the sink's own ``TARGET_BYTES``.
FILE_BYTES = 4 * 1024 * 1024


def _round_trip(df: DataFrame, fmt: str, inferred: bool = False) -> DataFrame:
    spark = df.sparkSession
    path = scratch_folder(spark, f"{fmt}-round-trip")
    write_files(df, path, fmt)
    return read_files(spark, path, fmt, None if inferred else df.schema)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders through CSV with a header, read with their schema."""
    return _round_trip(tables.table(spark, sf_dir, "orders"), "csv")


def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers through CSV, read without a schema."""
    found = _round_trip(tables.table(spark, sf_dir, "customer"), "csv", inferred=True)
    return _typed_customers(found)


def json_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers through JSON lines, read without a schema."""
    found = _round_trip(tables.table(spark, sf_dir, "customer"), "json", inferred=True)
    return _typed_customers(found)


def _typed_customers(found: DataFrame) -> DataFrame:
    # The types as inferred are part of the result; how wide a whole number is, is not.
    whole = {name: F.col(name).cast("bigint") for name, kind in found.dtypes if kind in ("int", "bigint")}
    return found.withColumns(whole).select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"
    )


def columnar_roundtrip(spark: SparkSession, sf_dir: str, fmt: str = "orc") -> DataFrame:
    """Orders through ORC, or ``avro`` where Spark's module for it is loaded."""
    return _round_trip(tables.table(spark, sf_dir, "orders"), fmt)


def json_dir_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two JSON folders with different columns of the same rows, joined."""
    first, second = tables.flight_halves(spark, sf_dir)
    return join_shared_key(_round_trip(first, "json"), _round_trip(second, "json"), "id")


#: Buckets of the given tables; large ones take their bytes over what suits a task.
BUCKETS = 8


def join_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two halves of ``json_dir_scan`` stored by buckets of their key and joined in place."""
    names = []
    for half in tables.flight_halves(spark, sf_dir):
        path = scratch_folder(spark, "buckets")
        names.append(path.rsplit("/", 1)[1].replace("-", "_"))
        write_bucketed(half, names[-1], path, "id", BUCKETS)
    return join_buckets(spark, *names, "id")


def documents_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON documents of unlike fields, and the columns found for them.

    ``big`` has 20 digits, ``mark`` is a number or a text, ``seldom`` stands in every 500th.
    """
    events = tables.table(spark, sf_dir, "events")
    number = F.col("event_id").cast("string")
    mark = F.when(F.col("event_id") % 2 == 0, number).otherwise(F.concat(F.lit('"'), "event_type", F.lit('"')))
    more = [
        F.lit(',"big":'), F.lpad(number, 20, "9"), F.lit(',"mark":'), mark,
        F.when(F.col("event_id") % 500 == 0, F.lit(',"seldom":{"a":[1,null]}')).otherwise(""), F.lit("}"),
    ]
    text = F.concat(F.regexp_replace("props", r"\}\s*$", ""), *more)
    docs = events.select("event_id", text.alias("value"))
    fields = discover_fields(docs)
    kinds = F.lit(", ".join(f"{field.name} {field.type.split('(')[0]}" for field in fields))
    found = typed_documents(docs, fields)
    return found.select(
        "event_id", "k", F.col("big").cast("string").alias("big"), F.to_json("mark").alias("mark"),
        F.col("rest")["seldom"].alias("seldom"), F.size("rest").alias("num_rest"), kinds.alias("kinds"),
    )


_FOLDERS = ["l_returnflag", "l_linestatus"]


def _price(spark: SparkSession, sf_dir: str) -> Span | None:
    return spans(tables.table(spark, sf_dir, "lineitem"), {"price": "l_extendedprice"})["price"]


def _per_folder(stored: DataFrame, target: int, price: Span | None) -> DataFrame:
    """Totals per folder, files over the target, and whether there are files enough to keep it."""
    per_file = stored.groupBy(*_FOLDERS, F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows_in_file"),
        F.max("_metadata.file_size").alias("bytes"),
        Addend.of("l_extendedprice", price).partial().alias("price"),
    )
    return per_file.groupBy(*_FOLDERS).agg(
        F.sum("rows_in_file").alias("num_rows"),
        F.round(Addend.again(per_file, "price").total(), 2).alias("total_price"),
        F.count_if(F.col("bytes") > target).alias("files_over_cap"),
        (F.count(F.lit(1)) * target >= F.sum("bytes")).alias("files_enough"),
    )


def partitioned_json_roundtrip(
    spark: SparkSession, sf_dir: str, target: int = FILE_BYTES, rebalance: bool = False
) -> DataFrame:
    """Lines in JSON folders by two columns: totals per folder and files over the target."""
    lines = tables.table(spark, sf_dir, "lineitem")
    path = scratch_folder(spark, "partitioned-json")
    write_partitioned_json(lines, path, _FOLDERS, target_bytes=target, rebalance=rebalance)
    stored = read_partitioned_json(spark, path, lines.schema, _FOLDERS)
    return _per_folder(stored, target, _price(spark, sf_dir)).drop("files_enough")


def two_formats_roundtrip(
    spark: SparkSession, sf_dir: str, columnar: str = "orc", target: int = FILE_BYTES
) -> DataFrame:
    """Lines as columnar files and JSON folders made from them: both read back."""
    lines = tables.table(spark, sf_dir, "lineitem")
    path = scratch_folder(spark, "two-formats")
    write_two_formats(lines, f"{path}/columnar", f"{path}/json", _FOLDERS, None, columnar, target_bytes=target)
    first = read_files(spark, f"{path}/columnar", columnar, lines.schema)
    price = _price(spark, sf_dir)
    totals = first.groupBy(*_FOLDERS).agg(
        F.count(F.lit(1)).alias("columnar_rows"),
        F.round(Addend.of("l_extendedprice", price).total(), 2).alias("columnar_price"),
    )
    second = read_partitioned_json(spark, f"{path}/json", lines.schema, _FOLDERS)
    totals = totals.withColumnsRenamed({name: f"{name}_c" for name in _FOLDERS})
    same = [F.col(name).eqNullSafe(F.col(f"{name}_c")) for name in _FOLDERS]
    return _per_folder(second, target, price).join(totals, same).drop(*[f"{name}_c" for name in _FOLDERS])


_BY_PRIORITY = ["o_orderpriority"]
#: Priorities whose orders are stored anew, and what the empty one and NULL are made of.
_AGAIN, _BLANK, _MISSING = "1-URGENT", "2-HIGH", "3-MEDIUM"


def json_folder_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in folders by priority, of which one is replaced; one name is empty and one NULL."""
    priority = F.col("o_orderpriority")
    named = F.when(priority == _BLANK, "").when(priority == _MISSING, None).otherwise(priority)
    orders = tables.table(spark, sf_dir, "orders").withColumn("o_orderpriority", named)
    path = scratch_folder(spark, "json-folders")
    write_partitioned_json(orders, path, _BY_PRIORITY)
    changed = orders.filter(priority == _AGAIN).withColumn("o_orderstatus", F.lit("R"))
    write_partitioned_json(changed, path, _BY_PRIORITY, only_these=True)
    stored = read_partitioned_json(spark, path, orders.schema, _BY_PRIORITY)
    return stored.groupBy("o_orderpriority", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("num_rows"), F.sum("o_orderkey").alias("keys")
    )


#: Every so many customers has a record that is cut short, or a key that is no number.
_CUT, _WRONG = 11, 7


def _spoilt(customers: DataFrame, text, wrong) -> DataFrame:
    number = F.col("c_custkey")
    cut = F.left(text, F.floor(F.length(text) / 2).cast("int"))
    return customers.select(
        F.when(number % _CUT == 0, cut).when(number % _WRONG == 0, wrong).otherwise(text).alias("value")
    )


def _spoilt_json(spark: SparkSession, sf_dir: str):
    customers = tables.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    text = F.concat(
        F.lit('{"c_custkey":'), F.col("c_custkey"), F.lit(',"c_name":"'), F.col("c_name"), F.lit('","c_nationkey":'),
        F.coalesce(F.col("c_nationkey").cast("string"), F.lit("null")), F.lit("}"),
    )
    path = scratch_folder(spark, "spoilt-json")
    _spoilt(customers, text, F.replace(text, F.lit('"c_custkey":'), F.lit('"c_custkey":"no"+'))).write.text(path)
    return read_checked(spark, path, "json", customers.schema)


def json_good_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of JSON lines of which some are damaged: those that are whole."""
    return _spoilt_json(spark, sf_dir).good


def json_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged lines as they stand in the files."""
    return _spoilt_json(spark, sf_dir).damaged.select("record")


def _spoilt_csv(spark: SparkSession, sf_dir: str):
    customers = tables.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = F.coalesce(F.col("c_nationkey").cast("string"), F.lit(r"\N"))
    text = F.concat_ws(",", "c_custkey", "c_name", nation)
    path = scratch_folder(spark, "spoilt-csv")
    _spoilt(customers, text, F.concat(F.lit("no."), text)).write.text(path)
    return read_checked(spark, path, "csv", customers.schema, {"header": "false"})


def csv_good_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of CSV lines of which some are damaged: those that are whole."""
    return _spoilt_csv(spark, sf_dir).good


def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged lines as they stand in the files."""
    return _spoilt_csv(spark, sf_dir).damaged.select("record")


def partition_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders spread over a number of partitions: rows, and whether they lie as asked.

    ``num_partitions`` is measured, empty ones included. ``as_asked`` says that no more of
    them hold rows, ``even`` that they differ by no more than one row for each task that
    dealt them out.
    """
    orders = tables.table(spark, sf_dir, "orders").select("o_orderkey")
    writers = max(1, partition_count(orders))
    dealt = spread(orders, PARTITIONS)
    there = physical_partitions(dealt)
    parts = rows_per_partition(dealt)
    # A partition without rows has no row here, but counts as one of 0 rows.
    least = F.when(F.count(F.lit(1)) < there, 0).otherwise(F.min("num_rows"))
    return parts.agg(
        F.lit(there).cast("bigint").alias("num_partitions"),
        F.coalesce(F.sum("num_rows"), F.lit(0)).alias("num_rows"),
        (F.count(F.lit(1)) <= PARTITIONS).alias("as_asked"),
        F.coalesce(F.max("num_rows") - least <= writers, F.lit(True)).alias("even"),
    )


_ORDERS_SQL = "SELECT * FROM orders"
_CUSTOMERS_SQL = """
    SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment
    FROM customer
"""
_PRICE_SQL = f"round(CAST(sum(CAST(l_extendedprice AS {EXACT})) AS DOUBLE), 2)"

_GOOD_SQL = f"""
    SELECT c_custkey, c_name, c_nationkey FROM customer
    WHERE c_custkey % {_CUT} <> 0 AND c_custkey % {_WRONG} <> 0
"""
_JSON_SQL = """('{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":' || coalesce(c_nationkey::VARCHAR, 'null') || '}')"""
_CSV_SQL = r"concat_ws(',', c_custkey, c_name, coalesce(c_nationkey::VARCHAR, '\N'))"


def _damaged_sql(text: str, wrong: str) -> str:
    return f"""
        SELECT CASE WHEN c_custkey % {_CUT} = 0 THEN left({text}, length({text}) // 2) ELSE {wrong} END AS record
        FROM customer WHERE c_custkey % {_CUT} = 0 OR c_custkey % {_WRONG} = 0
    """


ORACLES = {
    "csv_roundtrip": _ORDERS_SQL,
    "csv_inferred": _CUSTOMERS_SQL,
    "json_inferred": _CUSTOMERS_SQL,
    "columnar_roundtrip": _ORDERS_SQL,
    "join_bucketed": """
        SELECT o_orderkey AS id, o_orderpriority AS DEST,
               substr(o_orderpriority, 3, 20) AS DEST_CITY_NAME,
               strftime(o_orderdate, '%-d/%-m/%Y') AS FL_DATE, o_custkey AS ORIGIN,
               CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS CANCELLED
        FROM orders
    """,
    "documents_typed": """
        SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
               lpad(CAST(event_id AS VARCHAR), 20, '9') AS big,
               CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS VARCHAR)
                    ELSE '"' || event_type || '"' END AS mark,
               CASE WHEN event_id % 500 = 0 THEN '{"a":[1,null]}' END AS seldom,
               CASE WHEN event_id % 500 = 0 THEN 1 ELSE 0 END AS num_rest,
               'big DECIMAL, k BIGINT, mark VARIANT' AS kinds
        FROM events
    """,
    "json_dir_scan": """
        SELECT o_orderkey AS id, o_orderpriority AS DEST,
               substr(o_orderpriority, 3, 20) AS DEST_CITY_NAME,
               strftime(o_orderdate, '%-d/%-m/%Y') AS FL_DATE, o_custkey AS ORIGIN,
               CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS CANCELLED
        FROM orders
    """,
    "two_formats_roundtrip": f"""
        SELECT l_returnflag, l_linestatus, count(*) AS num_rows, {_PRICE_SQL} AS total_price,
               CAST(0 AS BIGINT) AS files_over_cap, true AS files_enough,
               count(*) AS columnar_rows, {_PRICE_SQL} AS columnar_price
        FROM lineitem GROUP BY l_returnflag, l_linestatus
    """,
    "partitioned_json_roundtrip": f"""
        SELECT l_returnflag, l_linestatus, count(*) AS num_rows,
               {_PRICE_SQL} AS total_price,
               CAST(0 AS BIGINT) AS files_over_cap
        FROM lineitem GROUP BY l_returnflag, l_linestatus
    """,
    "json_folder_replace": f"""
        SELECT CASE WHEN o_orderpriority = '{_BLANK}' THEN '' WHEN o_orderpriority = '{_MISSING}' THEN NULL
                    ELSE o_orderpriority END AS o_orderpriority,
               CASE WHEN o_orderpriority = '{_AGAIN}' THEN 'R' ELSE o_orderstatus END AS o_orderstatus,
               count(*) AS num_rows, CAST(sum(o_orderkey) AS BIGINT) AS keys
        FROM orders GROUP BY 1, 2
    """,
    "json_good_rows": _GOOD_SQL,
    "json_quarantine": _damaged_sql(_JSON_SQL, f"replace({_JSON_SQL}, '\"c_custkey\":', '\"c_custkey\":\"no\"+')"),
    "csv_good_rows": _GOOD_SQL,
    "csv_quarantine": _damaged_sql(_CSV_SQL, f"'no.' || {_CSV_SQL}"),
    "partition_balance": f"""
        SELECT CAST({PARTITIONS} AS BIGINT) AS num_partitions, count(*) AS num_rows,
               true AS as_asked, true AS even
        FROM orders
    """,
}
