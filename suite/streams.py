"""Streaming jobs run over the given files until all is taken; the SQL is the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.inputs import EVENT_TEXT_SQL, RUN_LOG_SQL, event_text, run_log
from suite.registry import query, table
from tidemark.functions.hashing import row_hash
from tidemark.sources import logs, target
from tidemark.sources.scratch import scratch_path
from tidemark.spec import ColumnSpec, TableSpec
from tidemark.streaming import jobs

USERS = TableSpec("users", ("user_id",), modified_col="ts")
USER_COLUMNS = [
    ColumnSpec("user_id", "bigint"),
    ColumnSpec("event_type", "varchar", 20),
    ColumnSpec("ts", "datetime"),
    ColumnSpec("value", "numeric", 12, 2),
]


def _events(spark, sf):
    schema = table(spark, sf, "events").schema
    return jobs.read_files(spark, sf, schema, glob="events.parquet", files_per_batch=1)


def _landed(spark, sf, files=4):
    """The events as they land: several files, in the order of time."""
    events = table(spark, sf, "events")
    folder = scratch_path(spark, "landed")
    for k in range(files):
        # A file per week, written one after the other; a stream takes one at a time.
        day = F.dayofmonth("ts")
        own = (day > 8 * k) & (day <= 8 * (k + 1) if k + 1 < files else F.lit(True))
        events.filter(own).coalesce(1).write.mode("append").parquet(folder)
    return jobs.read_files(spark, folder, events.schema, files_per_batch=1)


_LAST_SQL = """SELECT user_id, event_type, ts, CAST(value AS DECIMAL(12,2)) AS value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events) t
       WHERE rn = 1"""


# Several micro-batches: later ones go through the upsert into the published table.
@query("stream_upsert_batches", _LAST_SQL)
def stream_upsert_batches(spark, sf):
    root = scratch_path(spark, "stream-batches")
    stream = _landed(spark, sf)
    jobs.upsert_stream(stream, USERS, USER_COLUMNS, root, f"{root}/checkpoint").awaitTermination()
    rows = target.read_current(spark, f"{root}/tables/users")
    return rows.select("user_id", "event_type", "ts", "value")


@query(
    "stream_upsert",
    """SELECT user_id, event_type, ts, CAST(value AS DECIMAL(12,2)) AS value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events) t
       WHERE rn = 1""",
)
def stream_upsert(spark, sf):
    root = scratch_path(spark, "stream-upsert")
    stream = _events(spark, sf)
    jobs.upsert_stream(stream, USERS, USER_COLUMNS, root, f"{root}/checkpoint").awaitTermination()
    rows = target.read_current(spark, f"{root}/tables/users")
    return rows.select("user_id", "event_type", "ts", "value")


# Events as text with bad values, and errors of odd users without a key, in several files.
_REJECT_SQL = f"""
WITH source AS (
  SELECT t.* REPLACE (CASE WHEN e.event_type = 'error' AND e.user_id % 2 = 1 THEN NULL
                           ELSE t.event_id END AS event_id), e.event_id AS id, e.ts
  FROM ({EVENT_TEXT_SQL}) t JOIN events e ON t.event_id = e.event_id),
judged AS (
  SELECT *, list_filter([
              CASE WHEN event_id IS NULL THEN 'event_id: missing key' END,
              CASE WHEN flag_text = 'maybe' THEN 'flag_text: not a valid bit' END,
              CASE WHEN number_text LIKE 'v%' THEN 'number_text: not a valid bigint' END],
              lambda r: r IS NOT NULL) AS reasons
  FROM source)"""
REJECTING = TableSpec("texts", ("event_id",), modified_col="ts")
REJECTING_COLUMNS = [
    ColumnSpec("event_id", "bigint"),
    ColumnSpec("flag_text", "bit"),
    ColumnSpec("number_text", "bigint"),
    ColumnSpec("ts", "datetime"),
]


def _rejecting(spark, sf):
    """The root of a table after a stream over files with bad values and missing keys."""
    root, folder = scratch_path(spark, "stream-rejects"), scratch_path(spark, "landed-texts")
    events = table(spark, sf, "events").select("event_id", "event_type", "user_id", "ts")
    lost = (F.col("event_type") == "error") & (F.col("user_id") % 2 == 1)
    texts = event_text(spark, sf).join(events, "event_id").select(
        F.when(~lost, F.col("event_id")).alias("event_id"), "flag_text", "number_text", "date_text", "ts"
    )
    for half in (F.dayofmonth("ts") <= 15, F.dayofmonth("ts") > 15):
        texts.filter(half).coalesce(1).write.mode("append").parquet(folder)
    stream = jobs.read_files(spark, folder, texts.schema, files_per_batch=1)
    columns = [*REJECTING_COLUMNS, ColumnSpec("date_text", "datetime")]
    jobs.upsert_stream(stream, REJECTING, columns, root, f"{root}/checkpoint").awaitTermination()
    return root


@query(
    "stream_rejects_published",
    f"""{_REJECT_SQL}
        SELECT event_id, CASE WHEN flag_text IN ('True', '1') THEN true WHEN flag_text = '0' THEN false
                         END AS flag_text,
               TRY_CAST(nullif(number_text, 'nan') AS BIGINT) AS number_text,
               TRY_CAST(date_text AS TIMESTAMP) AS date_text, ts
        FROM judged WHERE len(reasons) = 0""",
)
def stream_rejects_published(spark, sf):
    rows = target.read_current(spark, f"{_rejecting(spark, sf)}/tables/texts")
    return rows.select("event_id", "flag_text", "number_text", "date_text", "ts")


# The row as it came can be read back with its reasons.
@query(
    "stream_rejects_quarantined",
    f"""{_REJECT_SQL}
        SELECT event_id, flag_text, number_text, date_text, ts, array_to_string(reasons, '; ') AS reasons
        FROM judged WHERE len(reasons) > 0""",
)
def stream_rejects_quarantined(spark, sf):
    schema = "event_id bigint, flag_text string, number_text string, date_text string, ts timestamp_ntz"
    rows = jobs.read_quarantine(spark, _rejecting(spark, sf), "texts", schema)
    return rows.select("row.*", F.concat_ws("; ", "reasons").alias("reasons"))


@query(
    "stream_rejects_logged",
    f"""{_REJECT_SQL},
        batches AS (SELECT *, dayofmonth(ts) <= 15 AS early FROM judged),
        counts AS (
          SELECT early, count(*) AS n, count(*) FILTER (len(reasons) > 0) AS aside,
                 count(*) FILTER (flag_text = 'maybe') AS flags,
                 count(*) FILTER (number_text LIKE 'v%') AS numbers,
                 count(*) FILTER (date_text IN ('not a date', '2024-13-45')) AS dates
          FROM batches GROUP BY early)
        SELECT 'rows_processed' AS metric_name, '{{"table":"texts"}}' AS tags, n::DOUBLE AS metric_value FROM counts
        UNION ALL SELECT 'quarantined_rows', '{{"table":"texts"}}', aside FROM counts
        UNION ALL SELECT 'rejected_values', '{{"column":"flag_text","table":"texts"}}', flags FROM counts WHERE flags > 0
        UNION ALL SELECT 'rejected_values', '{{"column":"number_text","table":"texts"}}', numbers FROM counts WHERE numbers > 0
        UNION ALL SELECT 'rejected_values', '{{"column":"date_text","table":"texts"}}', dates FROM counts WHERE dates > 0""",
)
def stream_rejects_logged(spark, sf):
    log = logs.read_log(spark, f"{_rejecting(spark, sf)}/logs", logs.METRICS)
    return log.select("metric_name", "tags", "metric_value")


# Every event arrives twice, as after a lookback.
@query("stream_dedup", "SELECT event_id, ts, user_id, value FROM events")
def stream_dedup(spark, sf):
    root = scratch_path(spark, "stream-dedup")
    twice = _events(spark, sf).unionByName(_events(spark, sf))
    hashed = twice.select(
        "event_id", "ts", "user_id", "value", row_hash(twice).alias("hashdiff")
    )
    once = jobs.drop_repeats(hashed, ["event_id"], "ts", "hashdiff", "40 days")
    jobs.append_rows(once, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    rows = spark.read.parquet(f"{root}/out")
    return rows.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "value")


@query(
    "stream_window_stats",
    f"""SELECT w AS window_start, w + INTERVAL 24 HOUR AS window_end, table_name,
               count(*) AS total_runs, count(*) FILTER (status = 'failed') AS fail_count,
               CAST(sum(rows_processed) AS BIGINT) AS total_rows,
               round(avg(duration_seconds), 6) AS avg_duration
        FROM (SELECT *, unnest([time_bucket(INTERVAL 6 HOUR, log_ts) - h * INTERVAL 6 HOUR
                                for h in range(4)]) AS w
              FROM ({RUN_LOG_SQL}) l) x
        GROUP BY w, table_name""",
)
def stream_window_stats(spark, sf):
    root = scratch_path(spark, "stream-windows")
    log = jobs.window_stats(run_log_of(_landed(spark, sf)), slide="6 hours")
    jobs.write_updates(log, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    state = jobs.latest_state(spark, f"{root}/out", ["window_start", "window_end", "table_name"])
    return state.withColumn("avg_duration", F.round("avg_duration", 6))


# A fourth of the first days' events arrives after all others, beyond the watermark: no window that
# had ended then may count them. Those of the last day are late but within it, and count.
_LATE = "user_id % 4 = 0 AND dayofmonth(ts) <= 3"
_TARDY = "user_id % 4 = 1 AND ts >= TIMESTAMP '2024-01-30 18:00:00'"


@query(
    "stream_window_late",
    f"""SELECT w AS window_start, w + INTERVAL 24 HOUR AS window_end, table_name,
               count(*) AS total_runs, count(*) FILTER (status = 'failed') AS fail_count,
               CAST(sum(rows_processed) AS BIGINT) AS total_rows,
               round(avg(duration_seconds), 6) AS avg_duration
        FROM (SELECT *, unnest([time_bucket(INTERVAL 6 HOUR, log_ts) - h * INTERVAL 6 HOUR
                                for h in range(4)]) AS w
              FROM ({RUN_LOG_SQL} WHERE NOT ({_LATE})) l) x
        GROUP BY w, table_name""",
)
def stream_window_late(spark, sf):
    root, folder = scratch_path(spark, "stream-late"), scratch_path(spark, "landed-late")
    events = table(spark, sf, "events")
    late, tardy = F.expr(_LATE), F.expr(_TARDY.replace("TIMESTAMP", "timestamp_ntz"))
    # Spark tells late rows by the watermark that the batch before had, so two batches come first.
    last_day = F.dayofmonth("ts") >= 30
    for part in (~late & ~last_day, ~late & last_day & ~tardy, late | tardy):
        events.filter(part).coalesce(1).write.mode("append").parquet(folder)
    stream = jobs.read_files(spark, folder, events.schema, files_per_batch=1)
    stats = jobs.window_stats(run_log_of(stream), slide="6 hours", delay="12 hours")
    jobs.write_updates(stats, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    state = jobs.latest_state(spark, f"{root}/out", ["window_start", "window_end", "table_name"])
    return state.withColumn("avg_duration", F.round("avg_duration", 6))


def run_log_of(events):
    """The run-log view of events, also for a stream."""
    failed = F.col("event_type") == "error"
    return events.select(
        F.concat(F.lit("table_"), F.col("user_id").cast("string")).alias("table_name"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.round(F.col("value") * 100).cast("bigint").alias("rows_processed"),
        F.col("value").alias("duration_seconds"),
        F.col("ts").alias("log_ts"),
    )


@query(
    "batch_window_stats",
    f"""SELECT time_bucket(INTERVAL 24 HOUR, log_ts) AS window_start,
               time_bucket(INTERVAL 24 HOUR, log_ts) + INTERVAL 24 HOUR AS window_end, table_name,
               count(*) AS total_runs, count(*) FILTER (status = 'failed') AS fail_count,
               CAST(sum(rows_processed) AS BIGINT) AS total_rows,
               round(avg(duration_seconds), 6) AS avg_duration
        FROM ({RUN_LOG_SQL}) l GROUP BY 1, 2, 3""",
)
def batch_window_stats(spark, sf):
    found = jobs.window_stats(run_log(spark, sf), slide="24 hours")
    return found.withColumn("avg_duration", F.round("avg_duration", 6))
