"""The published table: one Parquet folder partitioned by `part`.

A load writes the rows of the parts it touches to a staged folder and then lets Spark replace these
partitions (dynamic partition overwrite). What that does not give is kept in a small state file: the
schema, what a part follows from, the last batch of every stream, and which parts a staged folder is
about to replace. While that is pending, readers take those parts from the staged folder, and the
next load replaces them again first; so a load that fails leaves the old rows or the new ones, never
some of both. The state takes turns in two small files. One writer at a time.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import folders

PART = "part"
# Most parts of a table: those of a batch are listed on the driver and in the state.
MAX_PARTS = 10_000


@dataclass(frozen=True)
class Target:
    """The state of a published table."""

    step: int
    version: int  # loads that changed the table
    schema: T.StructType
    part_expr: str
    batches: dict[str, int]  # last batch taken of each stream
    pending: bool = False
    replaced: tuple[str, ...] | None = None  # parts that the staged folder replaces; None: all


def _folder(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def current(spark: SparkSession, root: str) -> Target | None:
    """The state of the table, None before its first load."""
    texts = (folders.read_text(spark, _folder(root, f"state/turn{turn}.json")) for turn in (0, 1))
    found = [json.loads(text) for text in texts if text]
    if not found:
        return None
    last = max(found, key=lambda state: state["step"])
    schema = T.StructType.fromJson(last.pop("schema"))
    replaced = last.pop("replaced")
    return Target(schema=schema, replaced=None if replaced is None else tuple(replaced), **last)


def _save(spark: SparkSession, root: str, state: Target) -> Target:
    row = asdict(replace(state, schema=None)) | {"schema": state.schema.jsonValue()}
    path = _folder(root, f"state/turn{state.step % 2}.json")
    folders.write_text(spark, path, json.dumps(row, sort_keys=True))
    return state


def _rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField(PART, T.StringType())])
    return spark.read.schema(full).parquet(path)


def read(
    spark: SparkSession, root: str, target: Target, parts: set[str] | None = None
) -> DataFrame:
    """The rows (of the given parts only, no others are opened), with their `part`."""
    rows = _rows(spark, _folder(root, "rows"), target.schema)
    if target.pending:
        staged = _rows(spark, _folder(root, "staged"), target.schema)
        if target.replaced is None:
            rows = staged
        else:
            rows = rows.filter(~F.col(PART).isin(*target.replaced)).unionByName(staged)
    return rows if parts is None else rows.filter(F.col(PART).isin(*sorted(parts)))


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The published table; fails when there is none."""
    target = current(spark, root)
    if target is None:
        raise FileNotFoundError(f"no table published under {root}")
    return read(spark, root, target).drop(PART)


def with_part(rows: DataFrame, part_expr: str) -> DataFrame:
    """Add the name of the part a row belongs to.

    Characters unfit for a folder name become `_`. Two values may then share a part, which is
    harmless: a part only says what is rewritten together.
    """
    text = F.coalesce(F.expr(part_expr).cast("string"), F.lit("null"))
    name = F.concat(F.lit("p_"), F.regexp_replace(text, "[^A-Za-z0-9_.-]", "_"))
    return rows.withColumn(PART, name)


def few_parts(parts: list[str]) -> set[str]:
    """The parts given; fails when the part expression has too many values."""
    found = set(parts)
    if len(found) > MAX_PARTS:
        raise ValueError(f"the part expression gives more than {MAX_PARTS} parts; choose a coarser one")
    return found


def _write(rows: DataFrame, path: str, mode: str) -> None:
    # Static mode leaves nothing of an attempt that failed before; dynamic mode replaces the
    # partitions that occur when all rows are written.
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", mode)
    writer.partitionBy(PART).parquet(path)


def publish(
    rows: DataFrame,
    root: str,
    part_expr: str,
    before: Target | None = None,
    touched: set[str] | None = None,
    batch: tuple[str, int] | None = None,
) -> tuple[int, Target]:
    """Publish `rows` (with `part`): the rows of the `touched` parts after the load, or of the whole
    table (None). Returns their number and the new state.

    `batch` names a stream and its batch; the last batches of other streams are carried on, so that
    loads and streams may alternate.
    """
    spark = rows.sparkSession
    seen = Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("n"), F.collect_set(PART).alias("parts"))
    schema = rows.drop(PART).schema
    batches = (before.batches if before else {}) | dict([batch] if batch else [])
    if before is None:
        _write(counted, _folder(root, "rows"), "static")
        few_parts(seen.get["parts"])
        return seen.get["n"], _save(spark, root, Target(1, 1, schema, part_expr, batches))
    _write(counted, _folder(root, "staged"), "static")
    few_parts(seen.get["parts"])
    replaced = None if touched is None else tuple(sorted(touched))
    state = Target(
        before.step + 1, before.version + 1, schema, part_expr, batches, True, replaced
    )
    return seen.get["n"], settle(spark, root, _save(spark, root, state), set(seen.get["parts"]))


def settle(
    spark: SparkSession, root: str, state: Target, staged_parts: set[str] | None = None
) -> Target:
    """Bring the staged parts into the table, if any are pending; doing it twice does no harm."""
    if not state.pending:
        return state
    staged = _rows(spark, _folder(root, "staged"), state.schema)
    if state.replaced is None:
        _write(staged, _folder(root, "rows"), "static")
    else:
        _write(staged, _folder(root, "rows"), "dynamic")
        if staged_parts is None:
            staged_parts = {r[PART] for r in staged.select(PART).distinct().collect()}
        for part in set(state.replaced) - staged_parts:  # all its rows have moved
            folders.remove(spark, f"{_folder(root, 'rows')}/{PART}={part}")
    return _save(spark, root, replace(state, step=state.step + 1, pending=False, replaced=()))

