"""Profiling of loaded tables: when it is due, the report, and the columns to leave out."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import profiling
from tidemark.plans.run import RunLog
from tidemark.sources import logs

COMPLETE = "profiling_complete"
DUE_DAYS = 14


@dataclass(frozen=True)
class ProfileResult:
    status: str
    total_columns: int = 0
    excluded: tuple[str, ...] = ()
    report: str | None = None


def profile_log(spark: SparkSession, log_root: str, tables: Iterable[str]) -> DataFrame:
    """`table_name` and `profiled_ts` of every profile in the run log; a registered table without
    one has a row with NULL."""
    listed = spark.createDataFrame([(t,) for t in tables], "table_name string").withColumn(
        "profiled_ts", F.lit(None).cast("timestamp_ntz")
    )
    try:
        log = logs.read_log(spark, log_root, logs.RUN_LOG)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return listed
    done = log.filter((F.col("step_name") == COMPLETE) & (F.col("status") == "success"))
    return listed.unionByName(done.select("table_name", F.col("log_ts").alias("profiled_ts")))


def tables_due(
    spark: SparkSession,
    log_root: str,
    tables: Iterable[str],
    as_of: datetime,
    threshold_days: int = DUE_DAYS,
    force: bool = False,
    max_tables: int | None = None,
) -> list[str]:
    """Registered tables to profile, longest without a profile first."""
    known = list(tables)
    ages = profile_log(spark, log_root, known).filter(F.col("table_name").isin(known))
    due = profiling.profiling_due(ages, as_of, threshold_days, force, max_tables)
    return [r["table_name"] for r in due.collect()]


def profile_table(
    df: DataFrame,
    table: str,
    root: str,
    as_of: datetime,
    keys: Sequence[str] = (),
    force: bool = False,
    threshold_days: int = DUE_DAYS,
    min_empty_pct: float = 90.0,
    approximate: bool = False,
) -> ProfileResult:
    """Profile a table when it is due: write the report, log the run, name the columns to leave out.

    An empty table cannot be profiled and counts as failed.
    """
    spark, log_root = df.sparkSession, f"{root}/logs"
    log = RunLog(table, as_of)
    log.step("profiling_start", "started")
    try:
        if not tables_due(spark, log_root, [table], as_of, threshold_days, force):
            log.step("profiling_skipped", "success")
            return ProfileResult("skipped")
        profile = profiling.column_profile(df, approximate)
        advice = profiling.with_advice(profile, min_empty_pct).orderBy("ordinal")
        report = f"{root}/profiles/{table}_{as_of:%Y%m%d_%H%M%S}"
        logs.write_report(advice, report)
        # The report holds one row per column; it is read back instead of profiling twice.
        rows = spark.read.option("header", True).schema(advice.schema).csv(report).collect()
        if not rows:
            log.step("profiling_failed", "failed", error="the table is empty")
            return ProfileResult("failed")
        out = sorted(
            r["column_name"] for r in rows if r["recommend_exclude"] and r["column_name"] not in keys
        )
        log.step(COMPLETE, "success", seconds=log.elapsed())
        return ProfileResult("success", len(rows), tuple(out), report)
    except Exception as error:
        log.step("profiling_failed", "failed", error=str(error))
        raise
    finally:
        log.save(spark, log_root)
