"""Change detection by row hash and the upsert built on it.

A key of the batch is new when the target lacks it, and changed when both hashes are known and
differ; a target row without a hash counts as unchanged. There is one join for every size: whether
a side is broadcast is left to Spark, which knows the sizes when the job runs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

class KeyViolation(ValueError):
    """The batch has missing or repeated keys."""


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one highest in `order`, then in the other columns.

    An aggregate, not a window: versions of a key are reduced before the shuffle, so a key that
    holds a large share of the rows never lands in one task as a whole. Columns that have no order
    (maps, variants) come last and are settled by their JSON text.
    """
    if not order:
        raise ValueError("the latest row needs columns that give an order")
    rest = [c for c in df.columns if c not in keys and c not in order]
    unordered = [c for c in rest if _has_no_order(df.schema[c].dataType)]
    if unordered:
        ranked = F.struct(
            *order,
            *(c for c in rest if c not in unordered),
            *(F.to_json(F.struct(c)).alias(f"as_json_{c}") for c in unordered),
        )
        best = df.groupBy(*keys).agg(
            F.max_by(F.struct(*order, *rest), ranked).alias("best")
        )
    else:
        best = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("best"))
    return best.select(
        *(F.col(c) if c in keys else F.col(f"best.`{c}`").alias(c) for c in df.columns)
    )


def _has_no_order(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return any(_has_no_order(f.dataType) for f in data_type)
    if isinstance(data_type, T.ArrayType):
        return _has_no_order(data_type.elementType)
    return isinstance(data_type, (T.MapType, T.VariantType))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1")


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key column the number of rows without a value, in one scan."""
    counts = df.agg(*(F.count_if(F.col(k).isNull()).alias(k) for k in keys))
    return counts.unpivot([], list(keys), "column_name", "null_rows")


def require_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Fail when a key is missing or repeated; one pass over the key columns."""
    missing = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))
    found = counts.agg(
        F.sum(F.when(missing, F.col("cnt"))).alias("without"),
        F.count_if(F.col("cnt") > 1).alias("repeated"),
        F.sum(F.when(F.col("cnt") > 1, F.col("cnt"))).alias("repeated_rows"),
    ).first()
    if found["without"]:
        raise KeyViolation(f"{found['without']} rows lack a value in their key {tuple(keys)}")
    if found["repeated"]:
        raise KeyViolation(
            f"{found['repeated']} keys occur more than once ({found['repeated_rows']} rows)"
        )


def _beside_old(source: DataFrame, target: DataFrame, keys: Sequence[str], carry=()) -> DataFrame:
    """Batch rows with `known` (the target has the key) and the old hash."""
    was = [F.col(c).alias(f"was_{c}") for c in carry]
    old = target.select(
        *keys, F.col("hashdiff").alias("old_hash"), F.lit(True).alias("known"), *was
    )
    return source.join(old, list(keys), "left")


def _changed(new_hash: Column) -> Column:
    return F.coalesce(F.col("old_hash") != new_hash, F.lit(False))


def classify(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key and `change_type` (insert, update or unchanged) of every batch row.

    Reads only key and hash of either side.
    """
    both = _beside_old(source.select(*keys, "hashdiff"), target, keys)
    kind = (
        F.when(F.col("known").isNull(), F.lit("insert"))
        .when(_changed(F.col("hashdiff")), F.lit("update"))
        .otherwise(F.lit("unchanged"))
    )
    return both.select(*keys, kind.alias("change_type"))


def changed_rows(
    source: DataFrame, target: DataFrame, keys: Sequence[str], carry: Sequence[str] = ()
) -> DataFrame:
    """Batch rows that are new or differ from the target, by one join on key and hash.

    `carry` names target columns to add as `was_...` (NULL for a new row).
    """
    both = _beside_old(source, target, keys, carry)
    changed = both.filter(F.col("known").isNull() | _changed(F.col("hashdiff")))
    return changed.select(*source.columns, *(f"was_{c}" for c in carry))


def replace_rows(target: DataFrame, changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target without the keys of `changed`, plus the rows of `changed`; columns these lack keep
    their old values. One full outer join that takes each row from one side."""
    return _merge_all(target, changed, keys, F.lit(True))


def _merge_all(
    target: DataFrame, source: DataFrame, keys: Sequence[str], differs: Column
) -> DataFrame:
    """One pass over either side; rows of both sides come from the source where they differ."""
    loaded = [c for c in target.columns if c in source.columns]
    old = target.select(*keys, F.struct(*target.columns).alias("old"))
    new = source.select(*keys, F.struct(*loaded).alias("new"))
    take_new = F.col("new").isNotNull() & (F.col("old").isNull() | differs)

    def pick(name: str) -> Column:
        before = F.col(f"old.`{name}`")
        after = F.when(take_new, F.col(f"new.`{name}`")).otherwise(before) if name in loaded else before
        return after.alias(name)

    return old.join(new, list(keys), "full_outer").select(*(pick(c) for c in target.columns))


def upsert(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after the batch: new keys added, rows with another hash replaced, all others (also
    those the batch does not mention) kept as they are. A column the batch does not load keeps
    its value. Keys of the batch must be unique; `require_keys` checks that."""
    differs = F.coalesce(F.col("old.hashdiff") != F.col("new.hashdiff"), F.lit(False))
    return _merge_all(target, source, keys, differs)


def change_counts(changes: DataFrame) -> DataFrame:
    """Rows per change type."""
    return changes.groupBy("change_type").agg(F.count(F.lit(1)).alias("n_rows"))


def rows_affected(changes: DataFrame) -> DataFrame:
    """Inserts plus updates, one row."""
    return changes.agg(F.count_if(F.col("change_type") != "unchanged").alias("rows_affected"))
