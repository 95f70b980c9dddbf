"""Cleaning, typing and the technical columns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.hashing import row_hash
from tidemark.functions.measures import at
from tidemark.functions.text import safe_name, strip
from tidemark.functions.typing import coerce, is_bad
from tidemark.spec import ColumnSpec, TableSpec

TECHNICAL_COLUMNS = ("hashdiff", "ts_source", "load_ts")

# Whole-number types from narrow to wide with their limits.
_WHOLE_TYPES = (
    ("tinyint", 2**7),
    ("smallint", 2**15),
    ("int", 2**31),
)


def safe_names(df: DataFrame) -> DataFrame:
    """Rename columns so that none needs quoting."""
    return df.withColumnsRenamed({c: safe_name(c) for c in df.columns})


def normalize(df: DataFrame) -> DataFrame:
    """Strip white space at both ends of every text column."""
    return df.select(
        *(
            strip(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        )
    )


def add_technical_columns(
    df: DataFrame,
    spec: TableSpec,
    load_ts: datetime,
    strict_hash: bool = False,
    beside: Sequence[str] = (),
) -> DataFrame:
    """Add the row hash (not over columns of `beside`), the source timestamp and the one load
    instant of the batch."""
    modified = safe_name(spec.modified_col) if spec.is_incremental else None
    if modified in df.columns:
        ts_source = F.col(f"`{modified}`").try_cast("timestamp_ntz")
    else:
        ts_source = F.lit(None).cast("timestamp_ntz")
    return df.select(
        "*",
        row_hash(df.drop(*beside), strict=strict_hash).alias("hashdiff"),
        ts_source.alias("ts_source"),
        at(load_ts).alias("load_ts"),
    )


def in_target_order(df: DataFrame, target_columns: Sequence[str]) -> DataFrame:
    """Keep the columns the target has too, in the order of the target."""
    return df.select(*(f"`{c}`" for c in target_columns if c in df.columns))


def typed_select(
    df: DataFrame,
    columns: Sequence[ColumnSpec],
    strict: bool = False,
    formats: tuple[str, ...] = (),
    beside: Sequence[str] = (),
) -> DataFrame:
    """Bring the declared columns to their types; technical columns and `beside` pass through."""
    out = [
        coerce(F.col(f"`{c.sql_name}`"), df.schema[c.sql_name].dataType, c, strict, formats).alias(
            c.sql_name
        )
        for c in columns
        if c.sql_name in df.columns
    ]
    return df.select(*out, *(c for c in (*TECHNICAL_COLUMNS, *beside) if c in df.columns))


def reject_counts(df: DataFrame, columns: Sequence[ColumnSpec]) -> list[Column]:
    """Per declared column an aggregate that counts the present values that do not fit its type."""
    return [
        F.count_if(is_bad(F.col(f"`{c.sql_name}`"), df.schema[c.sql_name].dataType, c)).alias(c.sql_name)
        for c in columns
        if c.sql_name in df.columns
    ]


def reject_reasons(df: DataFrame, columns: Sequence[ColumnSpec], keys: Sequence[str]) -> Column:
    """Why a row can't be loaded, as `column: reason`: missing values in the key, and present values
    that are no valid number or bit. Dates that are none become NULL, as in a load."""
    reasons = []
    for c in columns:
        if c.sql_name not in df.columns:
            continue
        col, kind = F.col(f"`{c.sql_name}`"), df.schema[c.sql_name].dataType
        if c.sql_name in keys:
            lost = coerce(col, kind, c).isNull() & ~is_bad(col, kind, c)
            reasons.append(F.when(lost, F.lit(f"{c.sql_name}: missing key")))
        if c.data_type.lower() not in ("date", "datetime") or c.sql_name in keys:
            what = F.lit(f"{c.sql_name}: not a valid {c.data_type.lower()}")
            reasons.append(F.when(is_bad(col, kind, c), what))
    return F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")


def bad_values(df: DataFrame, columns: Sequence[ColumnSpec]) -> DataFrame:
    """Per column the number of present values that do not fit their type, in one scan."""
    known = [c for c in columns if c.sql_name in df.columns]
    counts = df.agg(*reject_counts(df, known))
    return counts.unpivot([], [f"`{c.sql_name}`" for c in known], "column_name", "bad_rows")


def scrub_nan(df: DataFrame) -> DataFrame:
    """NaN to NULL in the floating columns."""
    floating = (T.DoubleType, T.FloatType)
    return df.select(
        *(
            F.when(~F.isnan(f"`{f.name}`"), F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, floating)
            else F.col(f"`{f.name}`")
            for f in df.schema
        )
    )


def dtype_limits(df: DataFrame) -> DataFrame:
    """Lowest and highest value of every 64-bit whole-number column, one row."""
    longs = [f.name for f in df.schema if isinstance(f.dataType, T.LongType)]
    bounds: list[Column] = []
    for name in longs:
        bounds += [F.min(f"`{name}`").alias(f"min_{name}"), F.max(f"`{name}`").alias(f"max_{name}")]
    return df.agg(*bounds) if bounds else df.sparkSession.range(1).select()


def narrow_type(low: int | None, high: int | None) -> str:
    """Narrowest whole-number type whose limits lie strictly outside low and high."""
    if low is not None and high is not None:
        for name, limit in _WHOLE_TYPES:
            if low > -limit and high < limit - 1:
                return name
    return "bigint"


def optimize_dtypes(df: DataFrame) -> DataFrame:
    """Narrow 64-bit whole numbers by their range (one aggregate) and doubles to floats."""
    limits = dtype_limits(df).first()

    def narrowed(field: T.StructField) -> Column:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.LongType):
            target = narrow_type(limits[f"min_{field.name}"], limits[f"max_{field.name}"])
            return col.cast(target).alias(field.name)
        if isinstance(field.dataType, T.DoubleType):
            return col.cast("float").alias(field.name)
        return col

    return df.select(*(narrowed(f) for f in df.schema))
