"""Append-only log tables and report files."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.functions.measures import at
from tidemark.operators.runlog import telling_rows
from tidemark.sources import folders

RUN_LOG_SCHEMA = (
    "run_id string, table_name string, step_name string, status string, rows_processed bigint, "
    "error_message string, duration_seconds double, log_ts timestamp_ntz"
)
METRICS_SCHEMA = (
    "metric_name string, metric_value double, unit string, tags string, metric_ts timestamp_ntz"
)
ALERTS_SCHEMA = "table_name string, alert_type string, severity string, message string"

RUN_LOG = "run_log"
METRICS = "metrics"
QUALITY_LOG = "quality_log"
ALERTS = "alerts"
ROLLUP = "last_runs"
#: The column that names the day folders of each log.
DAY_COLUMNS = {
    RUN_LOG: "log_date",
    METRICS: "metric_date",
    QUALITY_LOG: "check_date",
    ALERTS: "alert_date",
}
KEPT_ROLLUPS = 3


def log_path(root: str, log: str) -> str:
    return f"{root.rstrip('/')}/{log}"


def append_rows(
    spark: SparkSession, root: str, log: str, schema: str, rows: Iterable[tuple]
) -> None:
    """Append the few rows a job writes about itself, in the folder of their day (`log_date`).

    Reports of the last days filter by the folder too, so they never open older files.
    """
    written = few_rows(spark, rows, schema)
    _append_by_day(written, root, log, "log_ts", DAY_COLUMNS[RUN_LOG])


def few_rows(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """The few rows of a job as a table of one task, without a Python worker."""
    named = T.StructType.fromDDL(schema)
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, named, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, named.names), named).coalesce(1)


def append_log(rows: DataFrame, root: str) -> None:
    """Append many run-log rows, such as a log kept elsewhere before, in the folders of their days."""
    by_day = rows.repartition(F.to_date("log_ts"))
    _append_by_day(by_day, root, RUN_LOG, "log_ts", DAY_COLUMNS[RUN_LOG])


def append_quality(results: DataFrame, root: str, table: str, check_ts: datetime) -> None:
    """Append the result rows of a rule set, in the folder of their day (`check_date`)."""
    rows = results.select(
        F.lit(table).alias("table_name"),
        "check_name",
        "passed",
        "severity",
        "failed_rows",
        "total_rows",
        "message",
        "details",
        at(check_ts).alias("check_ts"),
    )
    _append_by_day(rows, root, QUALITY_LOG, "check_ts", "check_date")


def _append_by_day(rows: DataFrame, root: str, log: str, moment: str, day: str) -> None:
    dated = rows.withColumn(day, F.to_date(moment))
    dated.write.mode("append").partitionBy(day).parquet(log_path(root, log))


def append_metrics(metrics: DataFrame, root: str) -> None:
    """Append metrics, one folder per day so that old days are skipped when reading."""
    _append_by_day(metrics, root, METRICS, "metric_ts", "metric_date")


def append_alerts(alerts: DataFrame, root: str, alert_ts: datetime) -> None:
    """Append alert rows, in the folder of their day (`alert_date`)."""
    _append_by_day(alerts.withColumn("alert_ts", at(alert_ts)), root, ALERTS, "alert_ts", "alert_date")


def read_log(spark: SparkSession, root: str, log: str) -> DataFrame:
    return spark.read.parquet(log_path(root, log))


def history(spark: SparkSession, root: str) -> DataFrame:
    """What is known of the last runs of every table: the newest rollup and the log of the days
    after it. Enough for `last_successes`, `sla_status`, `last_runs` and `watermarks`, whatever the
    age of the log; reports of a span of days read the log itself."""
    log = read_log(spark, root, RUN_LOG)
    upto = newest_rollup(spark, root)
    if upto is None:
        return log
    rolled = spark.read.schema(RUN_LOG_SCHEMA).parquet(f"{log_path(root, ROLLUP)}/upto={upto}")
    later = log.filter(_after(log, date.fromisoformat(upto)))
    return rolled.unionByName(later.drop("log_date"))


def _after(log: DataFrame, day: date) -> Column:
    """Rows later than a day: by the folder where the log has folders, else by the time alone."""
    later = F.col("log_ts") >= F.lit(day + timedelta(days=1)).cast("timestamp_ntz")
    return later & (F.col("log_date") > F.lit(day)) if "log_date" in log.columns else later


def newest_rollup(spark: SparkSession, root: str) -> str | None:
    """The last day that a complete rollup covers."""
    path = log_path(root, ROLLUP)
    for name in reversed(folders.children(spark, path)):
        if folders.complete(spark, f"{path}/{name}"):
            return name.removeprefix("upto=")
    return None


def roll_up(spark: SparkSession, root: str, upto: date) -> None:
    """Reduce the log through a closed day to the rows that tell the last runs of every table.

    Goes on from the newest rollup, so each day of the log is read once; then the rollups before
    the last KEPT_ROLLUPS are removed. A rollup that covers the day already is left as it is. Days
    must be closed: a run logged later for a day that is rolled up is not seen any more.
    """
    before = newest_rollup(spark, root)
    if before is not None and before >= upto.isoformat():
        return
    known = history(spark, root)
    if "log_date" in known.columns:
        known = known.filter(F.col("log_date") <= F.lit(upto)).drop("log_date")
    known = known.filter(F.col("log_ts") < F.lit(upto + timedelta(days=1)).cast("timestamp_ntz"))
    path = log_path(root, ROLLUP)
    telling_rows(known).write.mode("overwrite").parquet(f"{path}/upto={upto}")
    for name in folders.children(spark, path)[:-KEPT_ROLLUPS]:
        folders.remove(spark, f"{path}/{name}")


def compact(spark: SparkSession, root: str, log: str, day: date) -> None:
    """Write the many small files of a closed day of a log as few files.

    The rows are written beside the log first and then replace the day's folder; what a job that
    died left there is brought in before anything else.
    """
    beside = log_path(root, f"{log}_compacting")
    if folders.complete(spark, beside):
        _bring_in(spark, root, log, beside)
    column = DAY_COLUMNS[log]
    rows = spark.read.parquet(log_path(root, log)).filter(F.col(column) == F.lit(day))
    rows.hint("rebalance").write.mode("overwrite").partitionBy(column).parquet(beside)
    _bring_in(spark, root, log, beside)


def _bring_in(spark: SparkSession, root: str, log: str, beside: str) -> None:
    if folders.children(spark, beside):
        writer = spark.read.parquet(beside).write.mode("overwrite")
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(DAY_COLUMNS[log])
        writer.parquet(log_path(root, log))
    folders.remove(spark, beside)


def write_report(df: DataFrame, path: str) -> None:
    """A report as CSV with a header."""
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)
