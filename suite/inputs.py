"""Inputs derived from the given tables, as a DataFrame and as SQL.

The tables hold no missing or malformed values, so these are put in by the meaning of a row (its
type, status or amount). All rows of a table are kept.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suite.registry import table
from tidemark.operators.clean import add_technical_columns
from tidemark.sources.extract import extract
from tidemark.spec import ColumnSpec, TableSpec

AS_OF = datetime(2024, 1, 31)
FIRST_LOAD = datetime(2001, 12, 31, 6, 0, 0)
SECOND_LOAD = datetime(2002, 1, 1, 6, 0, 0)

# --- orders as a replicated table -----------------------------------------------------------

ORDERS = TableSpec(
    name="orders",
    primary_key=("o_orderkey",),
    modified_col="o_orderdate",
    filter_clause="o_orderpriority <> '5-LOW'",
)
ORDER_COLUMNS = [
    ColumnSpec("o_orderkey", "bigint"),
    ColumnSpec("o_custkey", "bigint"),
    ColumnSpec("o_orderstatus", "varchar", 1),
    ColumnSpec("o_totalprice", "numeric", 15, 2),
    ColumnSpec("o_orderdate", "datetime"),
    ColumnSpec("o_orderpriority", "varchar", 20),
]
ORDER_NAMES = "o_custkey, o_orderdate, o_orderkey, o_orderpriority, o_orderstatus, o_totalprice"

# The state of the last load: orders up to 2000, those pending then stood 100 lower.
EARLIER_ORDERS = f"""
SELECT o_custkey, o_orderdate, o_orderkey, o_orderpriority, o_orderstatus,
       CASE WHEN o_orderstatus = 'P' THEN o_totalprice - 100 ELSE o_totalprice END AS o_totalprice
FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01 00:00:00'"""


def order_hash(prefix: str = "") -> str:
    p = prefix
    return (
        f"sha1(concat_ws('|', CAST({p}o_custkey AS VARCHAR), "
        f"strftime({p}o_orderdate, '%Y-%m-%d %H:%M:%S'), CAST({p}o_orderkey AS VARCHAR), "
        f"{p}o_orderpriority, {p}o_orderstatus, CAST({p}o_totalprice AS VARCHAR)))"
    )


# Source (all but low-priority orders) and target, both hashed.
CHANGE_SQL = f"""
WITH source AS (
  SELECT {ORDER_NAMES}, {order_hash()} AS hashdiff, o_orderdate AS ts_source,
         TIMESTAMP '2002-01-01 06:00:00' AS load_ts
  FROM orders WHERE o_orderpriority <> '5-LOW'),
target AS (
  SELECT e.*, {order_hash('e.')} AS hashdiff, o_orderdate AS ts_source,
         TIMESTAMP '2001-12-31 06:00:00' AS load_ts
  FROM ({EARLIER_ORDERS}) e)
"""


def earlier_orders(spark: SparkSession, sf: str) -> DataFrame:
    pending = F.col("o_orderstatus") == "P"
    price = F.when(pending, F.col("o_totalprice") - 100).otherwise(F.col("o_totalprice"))
    orders = table(spark, sf, "orders").filter("o_orderdate < timestamp_ntz'2001-01-01'")
    return orders.withColumn("o_totalprice", price)


def change_source(spark: SparkSession, sf: str) -> DataFrame:
    rows = extract(table(spark, sf, "orders"), ORDERS, ORDER_COLUMNS, "full")
    return add_technical_columns(rows, ORDERS, SECOND_LOAD)


def change_target(spark: SparkSession, sf: str) -> DataFrame:
    plain = TableSpec("orders", ("o_orderkey",), modified_col="o_orderdate")
    rows = extract(earlier_orders(spark, sf), plain, ORDER_COLUMNS, "full")
    return add_technical_columns(rows, plain, FIRST_LOAD)


# --- customers with gaps --------------------------------------------------------------------

CUSTOMER_GAPS_SQL = """
SELECT c_custkey,
       CASE WHEN c_acctbal >= -500 THEN c_name END AS c_name,
       CASE WHEN c_nationkey <> 7 THEN c_nationkey END AS c_nationkey,
       CASE WHEN c_acctbal <= 9000 THEN c_acctbal END AS c_acctbal,
       CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS c_mktsegment
FROM customer"""


def customer_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= -500, F.col("c_name")).alias("c_name"),
        F.when(F.col("c_nationkey") != 7, F.col("c_nationkey")).alias("c_nationkey"),
        F.when(F.col("c_acctbal") <= 9000, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).alias("c_mktsegment"),
    )


# --- events as text of mixed quality --------------------------------------------------------

EVENT_TEXT_SQL = """
SELECT event_id,
       CASE event_type WHEN 'click' THEN 'True' WHEN 'view' THEN '0' WHEN 'purchase' THEN '1'
            WHEN 'signup' THEN 'None' ELSE 'maybe' END AS flag_text,
       CASE event_type WHEN 'error' THEN 'nan' WHEN 'signup' THEN ''
            WHEN 'view' THEN 'v' || CAST(user_id AS VARCHAR)
            ELSE CAST(user_id AS VARCHAR) END AS number_text,
       CASE event_type WHEN 'error' THEN 'not a date' WHEN 'signup' THEN '2024-13-45'
            WHEN 'view' THEN strftime(ts, '%Y-%m-%d')
            ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS date_text,
       CASE event_type WHEN 'error' THEN '<NA>' WHEN 'signup' THEN '' ELSE props END AS note_text,
       CASE WHEN event_type = 'error' THEN CAST('NaN' AS DOUBLE) ELSE value END AS amount
FROM events"""


def event_text(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    user = F.col("user_id").cast("string")
    seconds = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf, "events").select(
        "event_id",
        F.when(kind == "click", "True")
        .when(kind == "view", "0")
        .when(kind == "purchase", "1")
        .when(kind == "signup", "None")
        .otherwise("maybe")
        .alias("flag_text"),
        F.when(kind == "error", "nan")
        .when(kind == "signup", "")
        .when(kind == "view", F.concat(F.lit("v"), user))
        .otherwise(user)
        .alias("number_text"),
        F.when(kind == "error", "not a date")
        .when(kind == "signup", "2024-13-45")
        .when(kind == "view", F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(seconds)
        .alias("date_text"),
        F.when(kind == "error", "<NA>").when(kind == "signup", "").otherwise(F.col("props")).alias(
            "note_text"
        ),
        F.when(kind == "error", float("nan")).otherwise(F.col("value")).alias("amount"),
    )


EVENT_TEXT_COLUMNS = [
    ColumnSpec("event_id", "bigint"),
    ColumnSpec("flag_text", "bit"),
    ColumnSpec("number_text", "bigint"),
    ColumnSpec("date_text", "datetime"),
    ColumnSpec("note_text", "varchar", 6),
    ColumnSpec("amount", "numeric", 12, 2),
]

# --- events as run log ----------------------------------------------------------------------

RUN_LOG_SQL = """
SELECT CAST(event_id AS VARCHAR) AS run_id, 'table_' || CAST(user_id AS VARCHAR) AS table_name,
       'flow_complete' AS step_name,
       CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
       CAST(round(value * 100) AS BIGINT) AS rows_processed,
       CASE WHEN event_type = 'error' THEN props END AS error_message,
       value AS duration_seconds, ts AS log_ts
FROM events"""


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    failed = F.col("event_type") == "error"
    return table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        F.concat(F.lit("table_"), F.col("user_id").cast("string")).alias("table_name"),
        F.lit("flow_complete").alias("step_name"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.round(F.col("value") * 100).cast("bigint").alias("rows_processed"),
        F.when(failed, F.col("props")).alias("error_message"),
        F.col("value").alias("duration_seconds"),
        F.col("ts").alias("log_ts"),
    )


# One run per user and day; the type of an event names the step.
STEP_LOG_SQL = """
SELECT CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y-%m-%d') AS run_id,
       CASE event_type WHEN 'view' THEN 'extract' WHEN 'click' THEN 'transform'
            WHEN 'signup' THEN 'load_staging' WHEN 'purchase' THEN 'merge_ods'
            ELSE 'flow_start' END AS step_name,
       CAST(round(value * 100) AS BIGINT) AS rows_processed, value AS duration_seconds
FROM events"""


def step_log(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    day = F.date_format("ts", "yyyy-MM-dd")
    return table(spark, sf, "events").select(
        F.concat(F.col("user_id").cast("string"), F.lit("_"), day).alias("run_id"),
        F.when(kind == "view", "extract")
        .when(kind == "click", "transform")
        .when(kind == "signup", "load_staging")
        .when(kind == "purchase", "merge_ods")
        .otherwise("flow_start")
        .alias("step_name"),
        F.round(F.col("value") * 100).cast("bigint").alias("rows_processed"),
        F.col("value").alias("duration_seconds"),
    )


# --- events as metrics ----------------------------------------------------------------------

METRICS_SQL = """
SELECT event_id, event_type AS metric_name, value AS metric_value, ts AS metric_ts,
       '{"k":"' || json_extract_string(props, '$.k') || '"}' AS tags
FROM events"""


def metrics(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.operators.metrics import encode_tags

    tags = F.create_map(F.lit("k"), F.get_json_object("props", "$.k"))
    return encode_tags(
        table(spark, sf, "events").select(
            "event_id",
            F.col("event_type").alias("metric_name"),
            F.col("value").alias("metric_value"),
            F.col("ts").alias("metric_ts"),
            tags.alias("tags"),
        )
    )


# --- orders as table registry ---------------------------------------------------------------

REGISTRY_SQL = """
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'critical table'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'priority table' END AS notes,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_dimension,
       CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS is_fact
FROM orders"""


def registry(spark: SparkSession, sf: str) -> DataFrame:
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(priority == "1-URGENT", "critical table")
        .when(priority == "3-MEDIUM", "priority table")
        .alias("notes"),
        F.when(status == "F", 1).otherwise(0).alias("is_dimension"),
        F.when(status == "O", 1).otherwise(0).alias("is_fact"),
    )


# --- line items with columns that carry next to nothing -------------------------------------

SPARSE_SQL = """
SELECT *, 'EUR' AS l_currency,
       CASE WHEN l_quantity = 50 THEN 'bulk' ELSE ' ' END AS l_note,
       CASE WHEN l_quantity = 50 THEN l_returnflag END AS l_memo,
       CAST(NULL AS BIGINT) AS l_obsolete
FROM lineitem"""


def sparse_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    bulk = F.col("l_quantity") == 50
    return table(spark, sf, "lineitem").select(
        "*",
        F.lit("EUR").alias("l_currency"),
        F.when(bulk, "bulk").otherwise(" ").alias("l_note"),
        F.when(bulk, F.col("l_returnflag")).alias("l_memo"),
        F.lit(None).cast("bigint").alias("l_obsolete"),
    )
