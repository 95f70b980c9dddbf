"""Streaming jobs over sources that land files.

Each runs with `availableNow`: it takes what has arrived and stops, so it can be started as often
as the batch load was. The checkpoint remembers what was taken.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.measures import as_instant, at, wall_time
from tidemark.operators import clean, upsert
from tidemark.plans.load import (
    RejectedValues,
    log_rejects,
    prepare,
    publish_batch,
    published_beside,
)
from tidemark.plans.run import RunLog
from tidemark.sources import stage, target
from tidemark.spec import ColumnSpec, TableSpec, included

#: What becomes of rows that can't be loaded.
QUARANTINE, FAIL = "quarantine", "fail"
#: The step that ends a micro-batch; watermarks of loads don't follow from it.
BATCH_STEP = "batch_complete"
_REASONS, _SOURCE = "_reasons", "_source"
# Timestamps in full: by default JSON keeps milliseconds.
_JSON = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def read_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    glob: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def _event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need a timestamp with zone: the wall time is taken as UTC in any session."""
    return df.withColumn(column, as_instant(F.col(column)))


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that the checkpoint gives its stream; a new checkpoint has a new one."""
    return spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def upsert_stream(
    stream: DataFrame,
    spec: TableSpec,
    columns: Sequence[ColumnSpec],
    root: str,
    checkpoint: str,
    on_reject: str = QUARANTINE,
) -> StreamingQuery:
    """Upsert every micro-batch into the published table.

    Rows without a value in their key, or with a value that is no valid number or bit, are not
    published: they go to the quarantine of the table with their reasons and the row as it came, or
    stop the stream with `on_reject="fail"`. They are counted in the pass that types the batch, and
    every batch leaves its rows in the run log and the metrics, like a load.

    A micro-batch may hold several versions of a key; the latest wins, and an older version than
    the published one is dropped. A batch seen before (replayed after a failure) does nothing,
    because the table's state carries the stream's id with its batch; batches of another checkpoint
    are another stream's and are taken.
    """
    if on_reject not in (QUARANTINE, FAIL):
        raise ValueError(f"on_reject must be {QUARANTINE} or {FAIL}, got {on_reject!r}")

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream_ = stream_id(spark, checkpoint)
        before = target.current(spark, f"{root}/tables/{spec.name}")
        if before and before.batches.get(stream_, -1) >= batch_id:
            return
        log = RunLog(spec.name, datetime.now(timezone.utc).replace(tzinfo=None))
        try:
            _load_batch(batch, spec, columns, root, (stream_, batch_id), log, on_reject)
        except Exception as error:
            log.step(BATCH_STEP, "failed", None, str(error), log.elapsed())
            raise
        finally:
            log.save(spark, f"{root}/logs")

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _load_batch(
    batch: DataFrame,
    spec: TableSpec,
    columns: Sequence[ColumnSpec],
    root: str,
    source: tuple[str, int],
    log: RunLog,
    on_reject: str,
) -> None:
    """Type a micro-batch, set its rejects aside and publish the rest."""
    spark, keys = batch.sparkSession, list(spec.primary_key)
    stage_root, target_root = f"{root}/stage", f"{root}/tables/{spec.name}"
    whole = F.struct(*(F.col(f"`{c}`") for c in batch.columns))
    as_it_came = F.to_json(whole, _JSON).alias(_SOURCE)
    rows = clean.normalize(
        batch.select(*(F.expr(c.expression).alias(c.sql_name) for c in included(columns)), as_it_came)
    )
    flagged = rows.withColumn(_REASONS, clean.reject_reasons(rows, included(columns), keys))
    values, found = Observation(), Observation()
    beside = (_REASONS, _SOURCE)
    ready = prepare(flagged, spec, columns, log.started, rejected=values, beside=beside)
    set_aside = F.size(_REASONS) > 0
    ready = ready.withColumn(_SOURCE, F.when(set_aside, F.col(_SOURCE))).observe(
        found, F.count_if(set_aside).alias("set_aside")
    )
    n_rows = stage.write_stage(ready, stage_root, spec.name, stage.TRANSFORMED)
    n_aside = found.get["set_aside"]
    log.metric("rows_processed", n_rows, "count")
    log.metric("quarantined_rows", n_aside, "count")
    log_rejects(log, values.get, columns, strict=False)
    typed = stage.read_stage(spark, stage_root, spec.name, stage.TRANSFORMED)
    if n_aside:
        rejects = typed.filter(set_aside)
        if on_reject == FAIL:
            first = rejects.select(F.explode(_REASONS)).first()[0]
            raise RejectedValues(f"{n_aside} rows can't be loaded, one of them: {first}")
        stream_, batch_id = source
        rejects.select(
            F.col(_REASONS).alias("reasons"), F.col(_SOURCE).alias("source"), at(log.started).alias("rejected_ts")
        ).write.mode("overwrite").parquet(
            f"{quarantine_path(root, spec.name)}/stream={stream_}/batch_id={batch_id}"
        )
    good = typed.filter(~set_aside).drop(*beside)
    unique = upsert.latest_per_key(good, keys, ["ts_source"])
    n_unique = stage.write_stage(unique, stage_root, spec.name, stage.STAGING)
    staged = stage.read_stage(spark, stage_root, spec.name, stage.STAGING)
    before = target.current(spark, target_root)
    if before:
        staged = drop_outdated(staged, published_beside(staged, spec, target_root, before), keys)
    n_changed, _ = publish_batch(staged, spec, target_root, n_unique, source_batch=source)
    log.step("load_staging", "success", n_rows)
    log.step("quarantine", "success", n_aside)
    log.step("merge_ods", "success", n_changed)
    log.step(BATCH_STEP, "success", n_rows, None, log.elapsed())


def quarantine_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/quarantine/{table}"


def read_quarantine(
    spark: SparkSession, root: str, table: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Rows set aside, with reasons and the row as JSON; with the schema of the source also as
    `row`, to be mended and sent again."""
    rows = spark.read.parquet(quarantine_path(root, table))
    return rows if schema is None else rows.withColumn("row", F.from_json("source", schema, _JSON))


def drop_outdated(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows without those older than the row the target has."""
    old = target.select(*keys, F.col("ts_source").alias("old_ts"))
    both = batch.join(old, list(keys), "left")
    outdated = F.coalesce(F.col("ts_source") < F.col("old_ts"), F.lit(False))
    return both.filter(~outdated).select(*batch.columns)


def drop_repeats(
    stream: DataFrame, keys: Sequence[str], ts: str, hash_col: str, lookback: str
) -> DataFrame:
    """Drop rows that a lookback has read again: same key, time and hash within the lookback.

    The time is part of the comparison, otherwise a change there and back would be lost.
    """
    return (
        _event_time(stream, ts)
        .withWatermark(ts, lookback)
        .dropDuplicatesWithinWatermark([*keys, ts, hash_col])
    )


def window_stats(
    stream: DataFrame, length: str = "24 hours", slide: str = "1 hour", delay: str = "1 hour"
) -> DataFrame:
    """Runs, failures, rows and mean seconds per table and trailing window.

    A row that is later than `delay` counts in those of its windows that have not ended at the
    watermark of the batch before (the latest time seen by then less `delay`), and in no others.
    """
    return (
        _event_time(stream, "log_ts")
        .withWatermark("log_ts", delay)
        .groupBy(F.window("log_ts", length, slide).alias("w"), "table_name")
        .agg(
            F.count(F.lit(1)).alias("total_runs"),
            F.count_if(F.col("status") == "failed").alias("fail_count"),
            F.sum("rows_processed").alias("total_rows"),
            F.avg("duration_seconds").alias("avg_duration"),
        )
        .select(
            wall_time(F.col("w.start")).alias("window_start"),
            wall_time(F.col("w.end")).alias("window_end"),
            "table_name",
            "total_runs",
            "fail_count",
            "total_rows",
            "avg_duration",
        )
    )


_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB: on the disks of the executors and in the
    checkpoint, not in their memory. A store that the session names itself stays."""
    before = spark.conf.get(_STATE_STORE, None)
    chosen = before is not None and not before.endswith("HDFSBackedStateStoreProvider")
    if not chosen:
        spark.conf.set(_STATE_STORE, _ROCKSDB)
    try:
        yield
    finally:
        if not chosen:
            spark.conf.unset(_STATE_STORE) if before is None else spark.conf.set(_STATE_STORE, before)


def write_updates(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep what every micro-batch changed in a folder of its own; a replay rewrites the folder."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = stream.writeStream.outputMode("update").foreachBatch(save)
    with state_on_disk(stream.sparkSession):
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_state(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The last update of every key."""
    return upsert.latest_per_key(spark.read.parquet(path), keys, ["batch_id"]).drop("batch_id")


def append_rows(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the rows of a stream to a Parquet folder, each exactly once."""
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", path)
    with state_on_disk(stream.sparkSession):
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
