"""The load of one table: extract, clean, type, check, upsert, log."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import clean, quality, runlog, upsert
from tidemark.plans.profile import profile_table
from tidemark.plans.run import RunLog
from tidemark.sources import extract as ex
from tidemark.sources import logs, stage, target
from tidemark.spec import ColumnSpec, TableSpec, included


# Step, stage and metric names below are fixed values: the vocabulary of the logs.
_WAS_PART = f"was_{target.PART}"


@dataclass(frozen=True)
class LoadResult:
    run_id: str
    rows_loaded: int
    rows_changed: int
    version: int
    excluded: tuple[str, ...] = ()


class RejectedValues(ValueError):
    """Values of the batch do not fit their declared types."""


def prepare(
    rows: DataFrame,
    spec: TableSpec,
    columns: Sequence[ColumnSpec],
    load_ts: datetime,
    strict: bool = False,
    rejected: Observation | None = None,
    beside: Sequence[str] = (),
) -> DataFrame:
    """Extracted rows made ready to load: stripped, hashed, stamped and typed.

    The hash covers the stripped values before typing, so a value cut to its length still counts
    as changed. `rejected` counts, on the way, the values that do not fit, by column. Columns of
    `beside` pass through and are no part of the row.
    """
    stamped = clean.add_technical_columns(clean.normalize(rows), spec, load_ts, beside=beside)
    if rejected is not None:
        stamped = stamped.observe(rejected, *clean.reject_counts(stamped, included(columns)))
    return clean.typed_select(stamped, included(columns), strict, beside=beside)


def publish_batch(
    batch: DataFrame,
    spec: TableSpec,
    root: str,
    n_rows: int,
    mode: str = ex.INCREMENTAL,
    source_batch: tuple[str, int] | None = None,
) -> tuple[int, target.Target]:
    """Bring a batch (`n_rows` rows of unique keys, already written to a stage) into the table.

    Reads only the parts that the batch can touch where a key has one part for good, and rewrites
    only the parts that hold a changed row, before or after the change. Rows are counted by the
    writes themselves.
    """
    spark = batch.sparkSession
    keys = list(spec.primary_key)
    before = target.current(spark, root)
    if before is None or mode == ex.FULL:
        part_expr = spec.part_expr(n_rows)
        rows = _by_part(target.with_part(batch, part_expr))
        return target.publish(rows, root, part_expr, before, None, source_batch)
    before = target.settle(spark, root, before)
    loaded = clean.in_target_order(batch, before.schema.names)
    found = changed_rows(loaded, spec, root, before)
    path = f"{root.rstrip('/')}/changes"
    seen = Observation()
    counted = found.observe(
        seen,
        F.count(F.lit(1)).alias("n"),
        F.collect_set(_WAS_PART).alias("was"),
        F.collect_set(target.PART).alias("becomes"),
    )
    stage.write_stage(counted, path, spec.name, "changed")
    n_changed = seen.get["n"]
    if n_changed == 0:
        return 0, before
    touched = None
    if _names_part(loaded, before):
        touched = target.few_parts([*seen.get["was"], *seen.get["becomes"]])
    changed = stage.read_stage(spark, path, spec.name, "changed")
    old = target.read(spark, root, before, touched).drop(target.PART)
    merged = upsert.replace_rows(old, changed.drop(_WAS_PART, target.PART), keys)
    rows = _by_part(target.with_part(merged, before.part_expr))
    _, after = target.publish(rows, root, before.part_expr, before, touched, source_batch)
    return n_changed, after


def changed_rows(
    loaded: DataFrame, spec: TableSpec, root: str, before: target.Target
) -> DataFrame:
    """Rows that are new or differ, with the part they were in and the one they get (NULL where the
    batch lacks a column that tells)."""
    keys = list(spec.primary_key)
    if _names_part(loaded, before):
        placed = target.with_part(loaded, before.part_expr)
    else:
        placed = loaded.withColumn(target.PART, F.lit(None).cast("string"))
    known = published_beside(loaded, spec, root, before)
    return upsert.changed_rows(placed, known, keys, [target.PART])


def published_beside(
    batch: DataFrame, spec: TableSpec, root: str, before: target.Target
) -> DataFrame:
    """The published rows of the parts that can hold a key of the batch; of all parts where a key
    may change its part."""
    parts = None
    if spec.parts_follow_key and _names_part(batch, before):
        named = target.with_part(batch, before.part_expr).select(target.PART)
        found = named.distinct().limit(target.MAX_PARTS + 1).collect()
        parts = target.few_parts([r[target.PART] for r in found])
    return target.read(batch.sparkSession, root, before, parts)


def _names_part(rows: DataFrame, before: target.Target) -> bool:
    """Whether the rows have all columns that the part follows from; a profile may rule one out."""
    named = [
        c for c in before.schema.names if re.search(rf"(?<!\w){re.escape(c)}(?!\w)", before.part_expr)
    ]
    return all(c in rows.columns for c in named)


def _by_part(rows: DataFrame) -> DataFrame:
    """Bring the rows of a part together so that it is written in few files; a part that holds
    much of the table is spread over several tasks."""
    return rows.hint("rebalance", F.col(target.PART))


def resumed(spark: SparkSession, spec: TableSpec, log_root: str) -> TableSpec:
    """The table with the start of its last successful load, from the run log of the job."""
    try:
        log = logs.history(spark, log_root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spec
    own = runlog.watermarks(log.filter(F.col("table_name") == spec.name)).first()
    return spec.with_last_success(own["last_success_ts"]) if own else spec


def load_table(
    source: DataFrame,
    spec: TableSpec,
    columns: Sequence[ColumnSpec],
    root: str,
    load_ts: datetime,
    mode: str = ex.INCREMENTAL,
    rules: Mapping | None = None,
    on_duplicate: str = "error",
    strict: bool = True,
    keep_raw: bool = False,
    profile: bool = False,
    resume: bool = False,
) -> LoadResult:
    """Load one table into `root` and append what happened to the logs under it.

    `mode` decides whether the target is emptied first; a table without change timestamps is read
    in full but still upserted when `mode` is incremental. A failed critical check stops the load
    before the target is touched, and so does a value that is no valid number or bit, unless
    `strict` is off: it then becomes NULL. Either way such values are counted per column (dates too)
    and logged. With `resume` the table is read from its last success in the run log on. With
    `profile` the batch is profiled when that is due; the columns it rules out are returned for the
    next load.
    """
    spark = source.sparkSession
    log_root, target_root = f"{root}/logs", f"{root}/tables/{spec.name}"
    stage_root = f"{root}/stage"
    log = RunLog(spec.name, load_ts)
    log.step("flow_start", "started")
    rejected = Observation()
    try:
        if resume and spec.last_success is None:
            spec = resumed(spark, spec, log_root)
        with log.timed("extract") as info:
            rows = ex.extract(source, spec, columns, mode)
            if keep_raw:
                info["rows"] = stage.write_stage(rows, stage_root, spec.name, stage.RAW)
                rows = stage.read_stage(spark, stage_root, spec.name, stage.RAW)
        with log.timed("transform"):
            ready = prepare(rows, spec, columns, load_ts, rejected=rejected)
            if on_duplicate == "latest":
                ready = upsert.latest_per_key(ready, spec.primary_key, ["ts_source"])
        with log.timed("load_staging") as info:
            n_rows = stage.write_stage(ready, stage_root, spec.name, stage.STAGING)
            info["rows"] = n_rows
        batch = stage.read_stage(spark, stage_root, spec.name, stage.STAGING)
        log.metric("rows_processed", n_rows, "count")
        log_rejects(log, rejected.get, columns, strict)
        with log.timed("quality"):
            upsert.require_keys(batch, spec.primary_key)
            if rules:
                results = quality.run_with_samples(batch, rules)
                logs.append_quality(results, log_root, spec.name, log.now())
                quality.gate(results)
        excluded = _profiled(batch, spec, root, load_ts, log) if profile else ()
        with log.timed("merge_ods") as info:
            n_changed, state = publish_batch(batch, spec, target_root, n_rows, mode)
            info["rows"] = n_changed
        total = log.finish("success", n_rows)
        log.metric("total_duration", total, "histogram")
        log.metric("throughput", n_rows / total if total else 0, "gauge")
        log.metric("etl_success", 1, "count")
        return LoadResult(log.run_id, n_rows, n_changed, state.version, excluded)
    except Exception as error:
        log.metric("etl_failed", 1, "count")
        log.finish("failed", None, str(error))
        raise
    finally:
        log.save(spark, log_root)


def log_rejects(
    log: RunLog, counts: Mapping[str, int], columns: Sequence[ColumnSpec], strict: bool
) -> None:
    """Log how many values of each column do not fit, and stop a strict load."""
    kinds = {c.sql_name: c.data_type.lower() for c in columns}
    bad = {name: n for name, n in counts.items() if n}
    for name, n in bad.items():
        log.metric("rejected_values", n, "count", column=name)
    fatal = {c: n for c, n in bad.items() if kinds[c] not in ("date", "datetime")}
    if strict and fatal:
        what = ", ".join(f"{c}: {n} not a valid {kinds[c]}" for c, n in sorted(fatal.items()))
        raise RejectedValues(what)


def _profiled(
    batch: DataFrame, spec: TableSpec, root: str, as_of: datetime, log: RunLog
) -> tuple[str, ...]:
    """Columns ruled out by a profile of the batch. A profile that fails does not stop the load; it
    is a failed step of the run."""
    try:
        with log.timed("profile"):
            return profile_table(batch, spec.name, root, as_of, spec.primary_key).excluded
    except PySparkException:
        return ()


def exclude(columns: Sequence[ColumnSpec], names: Sequence[str]) -> list[ColumnSpec]:
    """Column list for the next load without the columns a profile ruled out."""
    return [replace(c, excluded=c.excluded or c.sql_name in names) for c in columns]
