"""Reports over the run log: service levels, failures, volumes, last runs.

The log has one row per step of a run: `run_id`, `table_name`, `step_name`, `status`,
`rows_processed`, `error_message`, `duration_seconds`, `log_ts`. No report reads the clock; the
moment it is made for is a parameter.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.measures import at, hours_since, ratio
from tidemark.functions.text import clip
from tidemark.operators.percentiles import counted_values, percentiles_of
from tidemark.operators.upsert import latest_per_key

# Step and status names of the log.
COMPLETE = "flow_complete"
SUCCESS = "success"
FAILED = "failed"

# Hours without success from which a table is late, and very late.
WARNING_HOURS = 24
CRITICAL_HOURS = 36

# Service level targets.
TARGETS = {"availability": 0.999, "latency_p95": 120.0, "error_rate": 0.01, "data_freshness": 24.0}

# Texts that mark a table as critical.
CRITICAL_WORDS = ("critical", "critique")
PRIORITY_WORDS = ("priority", "critique")


def _succeeded() -> Column:
    return F.col("status") == SUCCESS


def _failed() -> Column:
    return F.col("status") == FAILED


def _started() -> Column:
    seconds = F.make_dt_interval(secs=F.col("duration_seconds").cast("decimal(18,6)"))
    return F.col("log_ts") - seconds


def _completed_since(log: DataFrame, as_of: datetime, span: timedelta) -> DataFrame:
    recent = F.col("log_ts") >= at(as_of - span)
    if "log_date" in log.columns:  # a stored log has a folder per day
        recent &= F.col("log_date") >= F.lit((as_of - span).date())
    return log.filter((F.col("step_name") == COMPLETE) & recent)


# --- registry -------------------------------------------------------------------------------


def _mentions(notes: str, words: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | F.coalesce(F.col(notes).contains(word), F.lit(False))
    return found


def select_tables(
    registry: DataFrame, subset: str = "all", notes: str = "notes", name: str | None = None
) -> DataFrame:
    """Registry rows of all tables, the dimensions, the facts or those noted as important; in the
    order of `name`, the column that names the table, where given."""
    conditions = {
        "all": F.lit(True),
        "dimensions": F.col("is_dimension") == 1,
        "facts": F.col("is_fact") == 1,
        "priority": _mentions(notes, PRIORITY_WORDS),
    }
    chosen = registry.filter(conditions[subset])
    return chosen.orderBy(name) if name else chosen


def with_priority(
    registry: DataFrame, notes: str = "notes", name: str | None = None
) -> DataFrame:
    """Class of a table: critical by its notes, high for dimensions and facts, else normal; in the
    order of class and `name` where given."""
    priority = (
        F.when(_mentions(notes, CRITICAL_WORDS), F.lit("critical"))
        .when((F.col("is_dimension") == 1) | (F.col("is_fact") == 1), F.lit("high"))
        .otherwise(F.lit("normal"))
    )
    classed = registry.withColumn("priority", priority)
    if name is None:
        return classed
    place = F.array_position(F.array(*map(F.lit, ("critical", "high", "normal"))), F.col("priority"))
    return classed.orderBy(place, name)


# --- service levels -------------------------------------------------------------------------


def last_successes(log: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Last success of every table of the registry (`table_name`), without one of every table of
    the log; NULL where there is none."""
    done = log.filter(F.col("step_name") == COMPLETE).select(
        "table_name", F.when(_succeeded(), F.col("log_ts")).alias("success_ts")
    )
    if registry is not None:
        never = F.lit(None).cast("timestamp_ntz").alias("success_ts")
        listed = registry.select("table_name")
        done = listed.select("table_name", never).unionByName(
            done.join(listed.distinct(), "table_name", "left_semi")
        )
    return done.groupBy("table_name").agg(F.max("success_ts").alias("last_success_ts"))


def sla_status(
    log: DataFrame, as_of: datetime, registry: DataFrame | None = None
) -> DataFrame:
    """Hours since the last success of every table, and what they mean. With a registry a table
    that never ran is listed too, as critical."""
    last = last_successes(log, registry)
    hours = hours_since(F.col("last_success_ts"), as_of)
    status = (
        F.when(hours.isNull() | (hours > CRITICAL_HOURS), F.lit("CRITICAL"))
        .when(hours > WARNING_HOURS, F.lit("WARNING"))
        .otherwise(F.lit("OK"))
    )
    return last.select(
        "table_name", "last_success_ts", hours.alias("hours_since_success"), status.alias("sla_status")
    )


def slo_compliance(
    log: DataFrame,
    as_of: datetime,
    days: int = 7,
    registry: DataFrame | None = None,
    history: DataFrame | None = None,
) -> DataFrame:
    """One row per objective: target, actual, whether it is met, and the error budget left.

    `history` (`logs.history`) tells the last successes without the whole log.

    Without any run availability counts as met and nothing as failed. With a registry (`table_name`,
    `has_timestamps`) freshness is that of its tables with timestamps, and a table that never ran
    is infinitely old.
    """
    recent = _completed_since(log, as_of, timedelta(days=days))
    # The window is read once: durations counted by status are written, all figures come from them.
    counted = counted_values(recent, ["status"], "duration_seconds")
    runs = counted.agg(
        F.sum("_n").cast("double").alias("n"),
        F.sum(F.when(_succeeded(), F.col("_n"))).cast("double").alias("ok"),
        F.sum(F.when(_failed(), F.col("_n"))).cast("double").alias("bad"),
    ).unpivot([], ["n", "ok", "bad"], "figure", "v")
    latency = percentiles_of(counted.filter(_succeeded()), ["status"], {"v": 0.95}).select(
        F.lit("latency").alias("figure"), "v"
    )
    timed = None if registry is None else registry.filter("has_timestamps")
    age = F.col("hours_since_success").cast("double")
    if registry is not None:
        age = F.coalesce(age, F.lit(float("inf")))
    freshness = sla_status(log if history is None else history, as_of, timed).agg(F.max(age).alias("v")).select(F.lit("freshness").alias("figure"), "v")
    figures = runs.unionByName(latency).unionByName(freshness)
    one = figures.agg(
        *(
            F.coalesce(F.max(F.when(F.col("figure") == f, F.col("v"))), F.lit(0.0)).alias(f)
            for f in ("n", "ok", "bad", "latency", "freshness")
        )
    )
    availability = F.when(F.col("n") > 0, F.col("ok") / F.col("n")).otherwise(F.lit(1.0))
    error_rate = ratio(F.col("bad"), F.col("n"))
    up = TARGETS["availability"]

    def objective(name: str, actual: Column, met: Column, budget: Column, unit: str | None) -> Column:
        return F.struct(
            F.lit(name).alias("objective"),
            F.lit(TARGETS[name]).alias("target"),
            actual.alias("actual"),
            met.alias("compliant"),
            budget.cast("double").alias("error_budget_remaining"),
            F.lit(unit).cast("string").alias("unit"),
        )

    none = F.lit(None)
    rows = [
        objective("availability", availability, availability >= up, (availability - up) / (1 - up), None),
        objective(
            "latency_p95", F.col("latency"), F.col("latency") <= TARGETS["latency_p95"], none, "seconds"
        ),
        objective("error_rate", error_rate, error_rate <= TARGETS["error_rate"], none, None),
        objective(
            "data_freshness", F.col("freshness"), F.col("freshness") <= TARGETS["data_freshness"], none, "hours"
        ),
    ]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


# --- what happened lately -------------------------------------------------------------------


def recent_failures(
    log: DataFrame, as_of: datetime, hours: int = 24, text: int | None = None
) -> DataFrame:
    """Failed runs, newest first; `text` cuts their error texts for a report that asks for it."""
    message = F.col("error_message") if text is None else clip(F.col("error_message"), text)
    return (
        _completed_since(log, as_of, timedelta(hours=hours))
        .filter(_failed())
        .select("run_id", "table_name", "log_ts", message.alias("error_message"))
        .orderBy(F.desc("log_ts"), "run_id")
    )


def alert_rows(
    log: DataFrame,
    as_of: datetime,
    many: int = 5,
    registry: DataFrame | None = None,
    history: DataFrame | None = None,
) -> DataFrame:
    """Rows for the alert table: one per late table, one when more than `many` runs failed."""
    late = sla_status(log if history is None else history, as_of, registry).filter("sla_status <> 'OK'")
    hours = F.coalesce(F.col("hours_since_success").cast("string"), F.lit("no"))
    breaches = late.select(
        "table_name",
        F.lit("sla_breach").alias("alert_type"),
        F.lower("sla_status").alias("severity"),
        F.concat(hours, F.lit(" hours since success")).alias("message"),
    )
    failures = _completed_since(log, as_of, timedelta(hours=24)).filter(_failed())
    multiple = failures.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > many)
    return breaches.unionByName(
        multiple.select(
            F.lit(None).cast("string").alias("table_name"),
            F.lit("multiple_failures").alias("alert_type"),
            F.lit("critical").alias("severity"),
            F.concat(F.col("n").cast("string"), F.lit(" runs failed")).alias("message"),
        )
    )


def table_performance(log: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Runs, successes, failures and mean duration per table."""
    total, good = F.count(F.lit(1)), F.count_if(_succeeded())
    return (
        _completed_since(log, as_of, timedelta(days=days))
        .groupBy("table_name")
        .agg(
            total.alias("total_runs"),
            good.alias("success_count"),
            F.count_if(_failed()).alias("fail_count"),
            F.avg("duration_seconds").alias("avg_duration"),
            (ratio(good, total) * 100).alias("success_pct"),
        )
    )


def slowest_tables(performance: DataFrame, n: int = 5) -> DataFrame:
    """The `n` tables with the longest mean run."""
    return performance.orderBy(F.desc("avg_duration"), "table_name").limit(n)


def volume(log: DataFrame, as_of: datetime, hours: int = 24) -> DataFrame:
    """Rows, tables and runs of the successful loads, one row."""
    done = _completed_since(log, as_of, timedelta(hours=hours)).filter(_succeeded())
    # Tables first: the distinct count then needs no second copy of the log rows.
    by_table = done.groupBy("table_name").agg(
        F.sum("rows_processed").alias("rows"),
        F.count(F.lit(1)).alias("runs"),
        F.sum("duration_seconds").alias("seconds"),
        F.count("duration_seconds").alias("timed"),
    )
    return by_table.agg(
        F.sum("rows").alias("total_rows"),
        F.count("table_name").alias("tables_processed"),
        F.coalesce(F.sum("runs"), F.lit(0)).alias("total_runs"),
        (F.sum("seconds") / F.nullif(F.sum("timed"), F.lit(0))).alias("avg_duration"),
    )


def last_runs(log: DataFrame) -> DataFrame:
    """The last finished run of every table."""
    finished = log.filter(F.col("step_name") == COMPLETE)
    return latest_per_key(finished, ["table_name"], ["log_ts", "run_id"])


def telling_rows(log: DataFrame) -> DataFrame:
    """The rows of a log that tell the last runs of every table: the last finished one, the last
    successful one and the successful one that started last; three rows a table at most.

    `last_successes`, `last_runs` and `watermarks` give the same on these rows as on the whole log,
    also together with later rows.
    """
    row = F.struct(*(c for c in log.columns if c != "log_date"))
    good, order = _succeeded(), F.struct("log_ts", "run_id", row)
    started = F.struct(_started().alias("started"), order)
    picked = log.filter(F.col("step_name") == COMPLETE).groupBy("table_name").agg(
        F.array_distinct(
            F.array(
                F.max_by(row, order),
                F.max_by(row, F.when(good, order)),
                F.max_by(row, F.when(good & _started().isNotNull(), started)),
            )
        ).alias("rows")
    )
    return picked.select(F.explode("rows").alias("r")).filter("r IS NOT NULL").select("r.*")


# --- results of one round over many tables --------------------------------------------------


def run_report(results: DataFrame) -> DataFrame:
    """Tables, mean, longest duration and slowest table per priority and status.

    `results` has `table_name`, `priority`, `status` and `duration_seconds`.
    """
    return results.groupBy("priority", "status").agg(
        F.count(F.lit(1)).alias("n_tables"),
        F.avg("duration_seconds").alias("avg_duration"),
        F.max("duration_seconds").alias("max_duration"),
        F.max_by("table_name", F.struct("duration_seconds", "table_name")).alias("slowest_table"),
    )


def run_totals(results: DataFrame) -> DataFrame:
    """Tables, successes, failures and seconds per priority, and over all (priority `all`)."""
    both = F.explode(F.array("priority", F.lit("all"))).alias("priority")
    return results.select(both, "status", "duration_seconds").groupBy("priority").agg(
        F.count(F.lit(1)).alias("n_tables"),
        F.count_if(_succeeded()).alias("success_count"),
        F.count_if(_failed()).alias("fail_count"),
        F.sum("duration_seconds").alias("total_duration"),
    )


def slowest_runs(results: DataFrame, n: int = 5, tie_break: str = "run_id") -> DataFrame:
    """The `n` longest finished runs."""
    finished = results.filter(F.col("duration_seconds").isNotNull())
    return finished.orderBy(F.desc("duration_seconds"), tie_break).limit(n)


def throughput(log: DataFrame) -> DataFrame:
    """Seconds per step, rows and rows per second of every run."""
    steps = ["extract", "transform", "load_staging", "merge_ods"]

    def seconds(step: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("step_name") == step, F.col("duration_seconds"))), F.lit(0.0))

    runs = log.groupBy("run_id").agg(
        *(seconds(s).alias(f"{s}_seconds") for s in steps),
        F.sum("duration_seconds").alias("total_seconds"),
        F.coalesce(
            F.sum(F.when(F.col("step_name") == "load_staging", F.col("rows_processed"))), F.lit(0)
        ).alias("rows_loaded"),
    )
    return runs.select(
        "*", ratio(F.col("rows_loaded"), F.col("total_seconds")).alias("rows_per_second")
    )


def watermarks(log: DataFrame) -> DataFrame:
    """Start of the last successful extract of every table: where the next one continues."""
    done = log.filter((F.col("step_name") == COMPLETE) & _succeeded())
    return done.groupBy("table_name").agg(F.max(_started()).alias("last_success_ts"))
