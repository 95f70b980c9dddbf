"""Run-log, service level and metrics reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from suite.inputs import (
    AS_OF,
    METRICS_SQL,
    REGISTRY_SQL,
    RUN_LOG_SQL,
    STEP_LOG_SQL,
    metrics,
    registry,
    run_log,
    step_log,
)
from suite.registry import ORACLES, query, table
from tidemark.operators import metrics as met
from tidemark.operators import runlog as rl
from tidemark.sources import logs
from tidemark.sources.scratch import scratch_path

_NOW = "TIMESTAMP '2024-01-31 00:00:00'"
_LOG = f"({RUN_LOG_SQL}) l"
_RECENT = f"log_ts >= {_NOW} - INTERVAL 24 HOUR"
_WEEK = f"log_ts >= {_NOW} - INTERVAL 7 DAY"


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


_SLA_SQL = f"""SELECT *, CASE WHEN hours_since_success IS NULL OR hours_since_success > 36 THEN 'CRITICAL'
                              WHEN hours_since_success > 24 THEN 'WARNING' ELSE 'OK' END AS sla_status
  FROM (SELECT table_name, max(log_ts) FILTER (status = 'success') AS last_success_ts,
               date_diff('hour', max(log_ts) FILTER (status = 'success'), {_NOW}) AS hours_since_success
        FROM {_LOG} GROUP BY table_name) a"""


@query("sla_status", _SLA_SQL)
def sla_status(spark, sf):
    return rl.sla_status(run_log(spark, sf), AS_OF)


_SLO_SQL = f"""
WITH week AS (SELECT * FROM {_LOG} WHERE {_WEEK}),
figures AS (
  SELECT count(*) FILTER (status = 'success') / count(*) AS availability,
         quantile_cont(duration_seconds, 0.95) FILTER (status = 'success') AS latency,
         count(*) FILTER (status = 'failed') / count(*) AS error_rate FROM week),
age AS (SELECT CAST(max(hours_since_success) AS DOUBLE) AS freshness FROM ({_SLA_SQL}) s)
SELECT 'availability' AS objective, 0.999::DOUBLE AS target, round(availability, 6) AS actual,
       availability >= 0.999 AS compliant,
       round((availability - 0.999) / (1 - 0.999), 6)::DOUBLE AS error_budget_remaining,
       CAST(NULL AS VARCHAR) AS unit FROM figures
UNION ALL SELECT 'latency_p95', 120, round(latency, 6), latency <= 120, NULL, 'seconds' FROM figures
UNION ALL SELECT 'error_rate', 0.01, round(error_rate, 6), error_rate <= 0.01, NULL, NULL FROM figures
UNION ALL SELECT 'data_freshness', 24, freshness, freshness <= 24, NULL, 'hours' FROM age"""


@query("slo_compliance", _SLO_SQL)
def slo_compliance(spark, sf):
    return _rounded(rl.slo_compliance(run_log(spark, sf), AS_OF), "actual", "error_budget_remaining")


# Customers as the registry of tables: most never ran, the even ones have no timestamps.
_REGISTERED = """(SELECT 'table_' || c_custkey AS table_name, c_custkey % 2 = 1 AS has_timestamps
                  FROM customer WHERE c_nationkey < 20)"""


def _registered(spark, sf):
    customers = table(spark, sf, "customer").filter("c_nationkey < 20")
    return customers.select(
        F.concat(F.lit("table_"), F.col("c_custkey").cast("string")).alias("table_name"),
        (F.col("c_custkey") % 2 == 1).alias("has_timestamps"),
    )


@query(
    "sla_status_registered",
    f"""SELECT r.table_name, s.last_success_ts, s.hours_since_success,
               coalesce(s.sla_status, 'CRITICAL') AS sla_status
        FROM {_REGISTERED} r LEFT JOIN ({_SLA_SQL}) s ON s.table_name = r.table_name""",
)
def sla_status_registered(spark, sf):
    return rl.sla_status(run_log(spark, sf), AS_OF, _registered(spark, sf))


@query(
    "freshness_registered",
    f"""SELECT CASE WHEN count(*) FILTER (s.hours_since_success IS NULL) > 0 THEN 'Infinity'::DOUBLE
                    ELSE max(s.hours_since_success) END AS actual,
               count(*) FILTER (coalesce(s.hours_since_success, 25) > 24) = 0 AS compliant
        FROM {_REGISTERED} r LEFT JOIN ({_SLA_SQL}) s ON s.table_name = r.table_name
        WHERE r.has_timestamps""",
)
def freshness_registered(spark, sf):
    found = rl.slo_compliance(run_log(spark, sf), AS_OF, registry=_registered(spark, sf))
    return found.filter("objective = 'data_freshness'").select("actual", "compliant")


@query(
    "recent_failures",
    f"""SELECT run_id, table_name, log_ts, substr(error_message, 1, 7) AS error_message
        FROM {_LOG} WHERE status = 'failed' AND {_RECENT}""",
)
def recent_failures(spark, sf):
    return rl.recent_failures(run_log(spark, sf), AS_OF, text=7)


@query(
    "recent_failures_whole",
    f"""SELECT run_id, table_name, log_ts, error_message
        FROM {_LOG} WHERE status = 'failed' AND {_RECENT}""",
)
def recent_failures_whole(spark, sf):
    return rl.recent_failures(run_log(spark, sf), AS_OF)


@query(
    "alert_candidates",
    f"""SELECT table_name, 'sla_breach' AS alert_type, lower(sla_status) AS severity,
               coalesce(CAST(hours_since_success AS VARCHAR), 'no') || ' hours since success' AS message
        FROM ({_SLA_SQL}) s WHERE sla_status <> 'OK'
        UNION ALL
        SELECT NULL, 'multiple_failures', 'critical', CAST(n AS VARCHAR) || ' runs failed'
        FROM (SELECT count(*) AS n FROM {_LOG} WHERE status = 'failed' AND {_RECENT}) f WHERE n > 5""",
)
def alert_candidates(spark, sf):
    return rl.alert_rows(run_log(spark, sf), AS_OF)


_PERFORMANCE_SQL = f"""
SELECT table_name, count(*) AS total_runs, count(*) FILTER (status = 'success') AS success_count,
       count(*) FILTER (status = 'failed') AS fail_count,
       round(avg(duration_seconds), 6) AS avg_duration,
       round(count(*) FILTER (status = 'success') / count(*) * 100, 6) AS success_pct
FROM {_LOG} WHERE {_WEEK} GROUP BY table_name"""


@query("table_performance", _PERFORMANCE_SQL)
def table_performance(spark, sf):
    report = rl.table_performance(run_log(spark, sf), AS_OF)
    return _rounded(report, "avg_duration", "success_pct")


@query("slowest_tables", f"SELECT * FROM ({_PERFORMANCE_SQL}) p ORDER BY avg_duration DESC, table_name LIMIT 5")
def slowest_tables(spark, sf):
    report = rl.table_performance(run_log(spark, sf), AS_OF)
    return rl.slowest_tables(_rounded(report, "avg_duration", "success_pct"))


@query(
    "volume_24h",
    f"""SELECT CAST(sum(rows_processed) AS BIGINT) AS total_rows,
               count(DISTINCT table_name) AS tables_processed, count(*) AS total_runs,
               round(avg(duration_seconds), 6) AS avg_duration
        FROM {_LOG} WHERE status = 'success' AND {_RECENT}""",
)
def volume_24h(spark, sf):
    return _rounded(rl.volume(run_log(spark, sf), AS_OF), "avg_duration")


@query(
    "last_runs",
    f"""SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY log_ts DESC, run_id DESC) AS rn
          FROM {_LOG}) t WHERE rn = 1""",
)
def last_runs(spark, sf):
    return rl.last_runs(run_log(spark, sf))


def _rolled(spark, sf):
    """The log stored in day folders and rolled up twice, as the daily report does: what is known
    of the last runs without the days before."""
    root = scratch_path(spark, "rolled")
    rows = run_log(spark, sf)
    logs.append_log(rows, root)
    for upto in (date(2024, 1, 12), date(2024, 1, 29)):
        logs.roll_up(spark, root, upto)
    return logs.history(spark, root)


@query("sla_status_rolled", _SLA_SQL)
def sla_status_rolled(spark, sf):
    return rl.sla_status(_rolled(spark, sf), AS_OF)


@query("last_runs_rolled", ORACLES["last_runs"])
def last_runs_rolled(spark, sf):
    return rl.last_runs(_rolled(spark, sf))


# The alerts of a report, appended to the log of alerts and read back by day.
@query(
    "alerts_appended",
    f"""SELECT table_name, alert_type, severity, message, TIMESTAMP '2024-01-31 00:00:00' AS alert_ts,
               DATE '2024-01-31' AS alert_date FROM ({ORACLES["alert_candidates"]}) a""",
)
def alerts_appended(spark, sf):
    root = scratch_path(spark, "alerts")
    logs.append_alerts(rl.alert_rows(run_log(spark, sf), AS_OF), root, AS_OF)
    return logs.read_log(spark, root, logs.ALERTS).filter(F.col("alert_date") == AS_OF.date())


_RESULTS_SQL = f"""SELECT CAST(r.o_orderkey AS VARCHAR) AS table_name,
       CASE WHEN notes LIKE '%critical%' THEN 'critical' WHEN is_dimension = 1 OR is_fact = 1 THEN 'high'
            ELSE 'normal' END AS priority,
       CASE WHEN is_fact = 1 THEN 'failed' ELSE 'success' END AS status,
       o_totalprice AS duration_seconds
   FROM ({REGISTRY_SQL}) r JOIN orders o ON o.o_orderkey = r.o_orderkey"""


def _results(spark, sf):
    price = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    rows = rl.with_priority(registry(spark, sf)).join(price, "o_orderkey")
    return rows.select(
        F.col("o_orderkey").cast("string").alias("table_name"),
        "priority",
        F.when(F.col("is_fact") == 1, "failed").otherwise("success").alias("status"),
        F.col("o_totalprice").alias("duration_seconds"),
    )


@query(
    "run_report",
    f"""SELECT priority, status, count(*) AS n_tables,
               round(avg(duration_seconds), 6) AS avg_duration, max(duration_seconds) AS max_duration,
               first(table_name ORDER BY duration_seconds DESC, table_name DESC) AS slowest_table
        FROM ({_RESULTS_SQL}) r GROUP BY priority, status""",
)
def run_report(spark, sf):
    return _rounded(rl.run_report(_results(spark, sf)), "avg_duration")


@query(
    "run_totals",
    f"""SELECT x.priority, count(*) AS n_tables,
               count(*) FILTER (status = 'success') AS success_count,
               count(*) FILTER (status = 'failed') AS fail_count,
               round(sum(duration_seconds), 2) AS total_duration
        FROM (SELECT unnest([r.priority, 'all']) AS priority, status, duration_seconds
              FROM ({_RESULTS_SQL}) r) x GROUP BY x.priority""",
)
def run_totals(spark, sf):
    totals = rl.run_totals(_results(spark, sf))
    return totals.withColumn("total_duration", F.round("total_duration", 2))


@query(
    "slowest_top5",
    f"SELECT * FROM {_LOG} ORDER BY duration_seconds DESC, run_id LIMIT 5",
)
def slowest_top5(spark, sf):
    return rl.slowest_runs(run_log(spark, sf))


_STEPS = ["extract", "transform", "load_staging", "merge_ods"]
_STEP_SUMS = ", ".join(
    f"coalesce(sum(duration_seconds) FILTER (step_name = '{s}'), 0) AS {s}_s" for s in _STEPS
)


@query(
    "throughput",
    f"""SELECT run_id, {", ".join(f"round({s}_s, 6) AS {s}_seconds" for s in _STEPS)},
               round(total_s, 6) AS total_seconds, rows_loaded,
               round(CASE WHEN total_s > 0 THEN rows_loaded / total_s ELSE 0 END, 6) AS rows_per_second
        FROM (SELECT run_id, {_STEP_SUMS}, sum(duration_seconds) AS total_s,
                     CAST(coalesce(sum(rows_processed) FILTER (step_name = 'load_staging'), 0) AS BIGINT)
                       AS rows_loaded
              FROM ({STEP_LOG_SQL}) s GROUP BY run_id) t""",
)
def throughput(spark, sf):
    columns = [f"{s}_seconds" for s in _STEPS] + ["total_seconds", "rows_per_second"]
    return _rounded(rl.throughput(step_log(spark, sf)), *columns)


_WATERMARK_SQL = f"""SELECT table_name, max(log_ts - to_microseconds(CAST(round(duration_seconds * 1000000) AS BIGINT)))
                 AS last_success_ts
        FROM {_LOG} WHERE status = 'success' GROUP BY table_name"""


@query("watermarks_rolled", _WATERMARK_SQL)
def watermarks_rolled(spark, sf):
    return rl.watermarks(_rolled(spark, sf))


@query(
    "watermark_lookup",
    f"""SELECT table_name, max(log_ts - to_microseconds(CAST(round(duration_seconds * 1000000) AS BIGINT)))
                 AS last_success_ts
        FROM {_LOG} WHERE status = 'success' GROUP BY table_name""",
)
def watermark_lookup(spark, sf):
    return rl.watermarks(run_log(spark, sf))


# --- metrics --------------------------------------------------------------------------------

_METRICS = f"({METRICS_SQL}) m"


@query(
    "metrics_summary",
    f"""SELECT metric_name, tags, round(sum(metric_value), 6) AS total FROM {_METRICS}
        GROUP BY metric_name, tags""",
)
def metrics_summary(spark, sf):
    return _rounded(met.counter_totals(metrics(spark, sf)), "total")


@query(
    "metrics_gauge_last",
    f"""SELECT metric_name, tags, first(metric_value ORDER BY metric_ts DESC, event_id DESC) AS last_value,
               max(metric_ts) AS last_ts
        FROM {_METRICS} GROUP BY metric_name, tags""",
)
def metrics_gauge_last(spark, sf):
    return met.last_gauges(metrics(spark, sf), "event_id")


def _histogram_sql(source):
    return f"""SELECT metric_name, tags, count(*) AS n, min(metric_value) AS min, max(metric_value) AS max,
               round(avg(metric_value), 6) AS mean,
               round(quantile_cont(metric_value, 0.5), 6) AS median,
               round(quantile_cont(metric_value, 0.95), 6) AS p95,
               round(quantile_cont(metric_value, 0.99), 6) AS p99
        FROM {source} GROUP BY metric_name, tags"""


@query("metrics_histogram", _histogram_sql(_METRICS))
def metrics_histogram(spark, sf):
    summary = met.histogram_summary(metrics(spark, sf))
    return _rounded(summary, "mean", "median", "p95", "p99")


# Views without a value stand for infinity; some quantiles fall among them.
_INFINITE_SQL = f"""(SELECT * REPLACE (CASE WHEN metric_name = 'view' AND metric_value > 100
                       THEN 'Infinity'::DOUBLE ELSE metric_value END AS metric_value) FROM {_METRICS}) i"""


@query(
    "percentile_infinite",
    f"""SELECT metric_name, tags, max(metric_value) AS max,
               round(quantile_cont(metric_value, 0.5), 6) AS median,
               round(quantile_cont(metric_value, 0.99), 6) AS p99
        FROM {_INFINITE_SQL} GROUP BY metric_name, tags""",
)
def percentile_infinite(spark, sf):
    infinite = (F.col("metric_name") == "view") & (F.col("metric_value") > 100)
    value = F.when(infinite, float("inf")).otherwise(F.col("metric_value"))
    summary = met.histogram_summary(metrics(spark, sf).withColumn("metric_value", value))
    return _rounded(summary.select("metric_name", "tags", "max", "median", "p99"), "median", "p99")


# Quantities as one untagged series: a group of all rows with many equal values.
@query(
    "metrics_percentile",
    "SELECT round(quantile_cont(l_extendedprice, 0.95), 6) AS percentile_value FROM lineitem",
)
def metrics_percentile(spark, sf):
    return _rounded(met.metric_percentile(_prices(spark, sf), "price", 95), "percentile_value")


def _prices(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.lit("price").alias("metric_name"),
        F.lit("{}").alias("tags"),
        F.col("l_extendedprice").alias("metric_value"),
    )


@query(
    "metrics_tags",
    f"""SELECT json_extract_string(tags, '$.k') AS k, metric_name, count(*) AS n
        FROM {_METRICS} GROUP BY 1, 2""",
)
def metrics_tags(spark, sf):
    decoded = met.decode_tags(metrics(spark, sf))
    return decoded.groupBy(F.col("tags")["k"].alias("k"), "metric_name").agg(
        F.count(F.lit(1)).alias("n")
    )
