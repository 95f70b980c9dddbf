"""Change detection, upsert and the whole load."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from suite.inputs import (
    CHANGE_SQL,
    EARLIER_ORDERS,
    EVENT_TEXT_COLUMNS,
    FIRST_LOAD,
    ORDER_COLUMNS,
    ORDERS,
    SECOND_LOAD,
    change_source,
    change_target,
    earlier_orders,
    event_text,
)
from suite.registry import query, table
from tidemark.operators import upsert as up
from tidemark.operators.quality import timestamp_inconsistencies
from tidemark.plans.load import load_table
from tidemark.sources import logs, target
from tidemark.sources.scratch import scratch_path
from tidemark.spec import TableSpec

KEYS = ["o_orderkey"]

_CLASSIFY_SQL = f"""{CHANGE_SQL},
changes AS (
  SELECT s.o_orderkey, CASE WHEN t.o_orderkey IS NULL THEN 'insert'
                            WHEN t.hashdiff <> s.hashdiff THEN 'update'
                            ELSE 'unchanged' END AS change_type
  FROM source s LEFT JOIN target t ON s.o_orderkey = t.o_orderkey)
"""
_MERGED_SQL = f"""{CHANGE_SQL}
SELECT t.* FROM target t LEFT JOIN source s ON s.o_orderkey = t.o_orderkey
WHERE s.o_orderkey IS NULL OR s.hashdiff = t.hashdiff
UNION ALL
SELECT s.* FROM source s LEFT JOIN target t ON s.o_orderkey = t.o_orderkey
WHERE t.o_orderkey IS NULL OR s.hashdiff <> t.hashdiff"""


@query("cdc_classify", f"{_CLASSIFY_SQL} SELECT * FROM changes")
def cdc_classify(spark, sf):
    return up.classify(change_source(spark, sf), change_target(spark, sf), KEYS)


@query(
    "cdc_counts",
    f"{_CLASSIFY_SQL} SELECT change_type, count(*) AS n_rows FROM changes GROUP BY change_type",
)
def cdc_counts(spark, sf):
    return up.change_counts(up.classify(change_source(spark, sf), change_target(spark, sf), KEYS))


@query(
    "cdc_rows_affected",
    f"""{_CLASSIFY_SQL} SELECT count(*) AS rows_affected FROM changes
        WHERE change_type <> 'unchanged'""",
)
def cdc_rows_affected(spark, sf):
    return up.rows_affected(up.classify(change_source(spark, sf), change_target(spark, sf), KEYS))


@query("upsert_merge", _MERGED_SQL)
def upsert_merge(spark, sf):
    return up.upsert(change_source(spark, sf), change_target(spark, sf), KEYS)


# A target whose fulfilled orders were never hashed: those rows count as unchanged.
_NULL_HASH_SQL = CHANGE_SQL.replace("target AS (", "hashed AS (") + """, target AS (
  SELECT * REPLACE (CASE WHEN o_orderstatus <> 'F' THEN hashdiff END AS hashdiff) FROM hashed)
"""


def _target_with_gaps(spark, sf):
    hashed = F.when(F.col("o_orderstatus") != "F", F.col("hashdiff"))
    return change_target(spark, sf).withColumn("hashdiff", hashed)


@query(
    "upsert_null_hash",
    f"""{_NULL_HASH_SQL}
SELECT t.* FROM target t LEFT JOIN source s ON s.o_orderkey = t.o_orderkey
WHERE s.o_orderkey IS NULL OR t.hashdiff IS NULL OR s.hashdiff = t.hashdiff
UNION ALL
SELECT s.* FROM source s LEFT JOIN target t ON s.o_orderkey = t.o_orderkey
WHERE t.o_orderkey IS NULL OR s.hashdiff <> t.hashdiff""",
)
def upsert_null_hash(spark, sf):
    return up.upsert(change_source(spark, sf), _target_with_gaps(spark, sf), KEYS)


@query(
    "cdc_null_hash",
    f"""{_NULL_HASH_SQL}
SELECT change_type, count(*) AS n_rows FROM (
  SELECT CASE WHEN t.o_orderkey IS NULL THEN 'insert' WHEN t.hashdiff <> s.hashdiff THEN 'update'
              ELSE 'unchanged' END AS change_type
  FROM source s LEFT JOIN target t ON s.o_orderkey = t.o_orderkey) c GROUP BY change_type""",
)
def cdc_null_hash(spark, sf):
    return up.change_counts(
        up.classify(change_source(spark, sf), _target_with_gaps(spark, sf), KEYS)
    )


# The batch no longer loads the customer (ruled out by a profile): updates keep the old one.
@query(
    "upsert_fewer_columns",
    f"""WITH merged AS ({_MERGED_SQL}),
        old AS (SELECT o_orderkey, o_custkey FROM ({EARLIER_ORDERS}) e)
        SELECT m.* REPLACE (old.o_custkey AS o_custkey)
        FROM merged m LEFT JOIN old ON m.o_orderkey = old.o_orderkey""",
)
def upsert_fewer_columns(spark, sf):
    source = change_source(spark, sf).drop("o_custkey")
    return up.upsert(source, change_target(spark, sf), KEYS)


_TYPED = "* REPLACE (CAST(o_totalprice AS DECIMAL(15,2)) AS o_totalprice)"


def _load_twice(spark, sf, second_mode, part=None, **options):
    """First load of the earlier state, then a load of today's source; the root of both."""
    root = scratch_path(spark, "load")
    first = replace(ORDERS, filter_clause=None, partition_expr=part)
    second = replace(ORDERS, partition_expr=part, lookback=options.pop("lookback", None))
    load_table(earlier_orders(spark, sf), first, ORDER_COLUMNS, root, FIRST_LOAD)
    load_table(
        table(spark, sf, "orders"),
        second,
        ORDER_COLUMNS,
        root,
        SECOND_LOAD,
        mode=second_mode,
        **options,
    )
    return root


def _orders(spark, root):
    return target.read_current(spark, f"{root}/tables/orders")


@query("load_incremental", f"SELECT {_TYPED} FROM ({_MERGED_SQL}) m")
def load_incremental(spark, sf):
    return _orders(spark, _load_twice(spark, sf, "incremental"))


@query("load_incremental_parts", f"SELECT {_TYPED} FROM ({_MERGED_SQL}) m")
def load_incremental_parts(spark, sf):
    return _orders(spark, _load_twice(spark, sf, "incremental", "year(o_orderdate)"))


@query(
    "full_replace",
    f"""{CHANGE_SQL} SELECT {_TYPED} FROM source""",
)
def full_replace(spark, sf):
    return _orders(spark, _load_twice(spark, sf, "full"))


# The second load goes on from the start of the first (2001-12-31 06:00) less a lookback.
_RESUMED_SQL = _MERGED_SQL.replace(
    "FROM orders WHERE o_orderpriority <> '5-LOW'",
    """FROM orders WHERE o_orderpriority <> '5-LOW'
       AND o_orderdate >= TIMESTAMP '2001-12-31 06:00:00' - INTERVAL 600 DAY""",
)


@query("load_resumed", f"SELECT {_TYPED} FROM ({_RESUMED_SQL}) m")
def load_resumed(spark, sf):
    return _orders(spark, _load_twice(spark, sf, "incremental", resume=True, lookback="600d"))


_RULES = {"not_null": ["o_custkey"], "ranges": {"o_totalprice": {"min": 50_000}}}


def _logged(spark, sf):
    return f"{_load_twice(spark, sf, 'incremental', rules=_RULES)}/logs"


_STEPS = ["flow_start", "extract", "transform", "load_staging", "quality", "merge_ods", "flow_complete"]
_FIRST_ROWS = f"(SELECT count(*) FROM ({EARLIER_ORDERS}) e)"
_SECOND_ROWS = "(SELECT count(*) FROM orders WHERE o_orderpriority <> '5-LOW')"
_CHANGED_ROWS = f"({_CLASSIFY_SQL} SELECT count(*) FROM changes WHERE change_type <> 'unchanged')"


def _log_rows(load, loaded, changed):
    figures = {"load_staging": loaded, "merge_ods": changed, "flow_complete": loaded}
    return " UNION ALL ".join(
        f"""SELECT {load} AS n_load, 'orders' AS table_name, '{step}' AS step_name,
                   '{'started' if step == 'flow_start' else 'success'}' AS status,
                   CAST({figures.get(step, 'NULL')} AS BIGINT) AS rows_processed"""
        for step in _STEPS
    )


@query(
    "load_log",
    f"{_log_rows(1, _FIRST_ROWS, _FIRST_ROWS)} UNION ALL {_log_rows(2, _SECOND_ROWS, _CHANGED_ROWS)}",
)
def load_log(spark, sf):
    log = logs.read_log(spark, _logged(spark, sf), logs.RUN_LOG)
    second = F.col("log_ts") >= F.lit(SECOND_LOAD.isoformat(sep=" ")).cast("timestamp_ntz")
    return log.select(
        F.when(second, 2).otherwise(1).alias("n_load"),
        "table_name",
        "step_name",
        "status",
        "rows_processed",
    )


@query(
    "load_quality_log",
    f"""SELECT 'orders' AS table_name, 'not_null_o_custkey' AS check_name, true AS passed,
               0 AS failed_rows, {_SECOND_ROWS} AS total_rows
        UNION ALL
        SELECT 'orders', 'range_o_totalprice', n = 0, n, {_SECOND_ROWS}
        FROM (SELECT count(*) AS n FROM orders
              WHERE o_orderpriority <> '5-LOW' AND o_totalprice < 50000) f""",
)
def load_quality_log(spark, sf):
    log = logs.read_log(spark, _logged(spark, sf), logs.QUALITY_LOG)
    return log.select("table_name", "check_name", "passed", "failed_rows", "total_rows")


@query(
    "load_metrics",
    f"""SELECT 'rows_processed' AS metric_name, CAST({_FIRST_ROWS} AS DOUBLE) AS metric_value,
               'count' AS unit, '{{"table":"orders"}}' AS tags
        UNION ALL SELECT 'rows_processed', {_SECOND_ROWS}, 'count', '{{"table":"orders"}}'
        UNION ALL SELECT 'etl_success', 1, 'count', '{{"table":"orders"}}'
        UNION ALL SELECT 'etl_success', 1, 'count', '{{"table":"orders"}}'""",
)
def load_metrics(spark, sf):
    log = logs.read_log(spark, _logged(spark, sf), logs.METRICS)
    return log.filter("unit = 'count'").select("metric_name", "metric_value", "unit", "tags")


# Values of mixed quality: a strict load refuses them, a lenient one loads NULL and counts them.
@query(
    "load_rejects",
    r"""SELECT '{"column":"flag_text","table":"events"}' AS tags,
               CAST(count(*) FILTER (event_type = 'error') AS DOUBLE) AS metric_value FROM events
        UNION ALL
        SELECT '{"column":"number_text","table":"events"}',
               count(*) FILTER (event_type = 'view') FROM events
        UNION ALL
        SELECT '{"column":"date_text","table":"events"}',
               count(*) FILTER (event_type IN ('error', 'signup')) FROM events""",
)
def load_rejects(spark, sf):
    root = scratch_path(spark, "rejects")
    spec = TableSpec("events", ("event_id",), has_timestamps=False)
    rows = event_text(spark, sf)
    load_table(rows, spec, EVENT_TEXT_COLUMNS, root, SECOND_LOAD, strict=False)
    log = logs.read_log(spark, f"{root}/logs", logs.METRICS)
    return log.filter("metric_name = 'rejected_values'").select("tags", "metric_value")


@query("report_csv", "SELECT event_type, count(*) AS n, max(props) AS last_props FROM events GROUP BY event_type")
def report_csv(spark, sf):
    path = scratch_path(spark, "report")
    report = table(spark, sf, "events").groupBy("event_type").agg(
        F.count("*").alias("n"), F.max("props").alias("last_props")
    )
    logs.write_report(report, path)
    return spark.read.option("header", True).schema(report.schema).option("escape", "\\").csv(path)


_LINE_ORDER = """l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
    l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC"""


@query(
    "dedupe_latest",
    f"""SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                       ORDER BY {_LINE_ORDER}) AS rn FROM lineitem) t
        WHERE rn = 1""",
)
def dedupe_latest(spark, sf):
    return up.latest_per_key(
        table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"]
    )


@query(
    "pk_duplicates",
    """SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def pk_duplicates(spark, sf):
    return up.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "pk_nulls",
    """SELECT 'c_custkey' AS column_name, count(*) FILTER (c_custkey IS NULL) AS null_rows
       FROM customer
       UNION ALL SELECT 'c_nationkey', count(*) FILTER (c_nationkey = 7) FROM customer""",
)
def pk_nulls(spark, sf):
    from suite.inputs import customer_gaps

    return up.null_keys(customer_gaps(spark, sf), ["c_custkey", "c_nationkey"])


# Shipping as load, ordering as source time: lines shipped before they were ordered.
@query(
    "ts_consistency",
    """SELECT count(*) FILTER (l_shipdate < o_orderdate) AS invalid_rows, count(*) AS total_rows
       FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
)
def ts_consistency(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("ts_source")
    )
    lines = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_shipdate").alias("load_ts"))
    return timestamp_inconsistencies(lines.join(orders, "l_orderkey", "left"))


