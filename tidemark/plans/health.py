"""The daily health report: the run-log reports of one moment, written as CSV, and the alerts."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import runlog
from tidemark.sources import logs


def health_report(
    spark: SparkSession,
    log_root: str,
    out: str,
    as_of: datetime,
    registry: DataFrame | None = None,
) -> bool:
    """Write the reports and append the alerts; True when no table is critical and no run failed.

    The last runs before yesterday are rolled up, so a report opens the rollup and the last days only.
    `registry` lists the tables that ought to run (`table_name`, `has_timestamps`).
    """
    logs.roll_up(spark, log_root, (as_of - timedelta(days=1)).date())
    log = logs.read_log(spark, log_root, logs.RUN_LOG)
    history = logs.history(spark, log_root)
    status = runlog.sla_status(history, as_of, registry)
    failures = runlog.recent_failures(log, as_of)
    reports = {
        "sla_status": status.orderBy("hours_since_success", ascending=False),
        "recent_failures": failures,
        "slowest_tables": runlog.slowest_tables(runlog.table_performance(log, as_of)),
        "volume": runlog.volume(log, as_of),
        "slo": runlog.slo_compliance(log, as_of, registry=registry, history=history),
    }
    for name, report in reports.items():
        logs.write_report(report, f"{out}/{name}")
    logs.append_alerts(runlog.alert_rows(log, as_of, registry=registry, history=history), log_root, as_of)
    return status.filter("sla_status = 'CRITICAL'").isEmpty() and failures.isEmpty()
