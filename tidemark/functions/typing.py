"""Declared column types and the coercions that lead to them.

Lenient coercion yields NULL for a value that does not fit; strict coercion fails the job.
Spark runs in ANSI mode, so every lenient cast is a `try_cast`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import clip, null_tokens_to_null
from tidemark.spec import ColumnSpec

# Texts accepted as a bit.
TRUE_TOKENS = ("True", "true", "1")
FALSE_TOKENS = ("False", "false", "0")

# Limits of the declared types.
MAX_PRECISION = 38
DEFAULT_PRECISION = 18


def text_limit(spec: ColumnSpec) -> int | None:
    """Longest text the declared type holds, None when no width is declared: nothing is cut then."""
    return spec.width or None if spec.data_type.lower() == "varchar" else None


def spark_type(spec: ColumnSpec) -> T.DataType:
    """Spark type of a declared column."""
    simple = {
        "integer": T.IntegerType(),
        "bigint": T.LongType(),
        "bit": T.BooleanType(),
        "date": T.DateType(),
        "datetime": T.TimestampNTZType(),
    }
    kind = spec.data_type.lower()
    if kind in simple:
        return simple[kind]
    if kind == "numeric":
        asked = spec.width if spec.width and spec.width > 0 else DEFAULT_PRECISION
        scale = min(spec.scale or 0, asked, MAX_PRECISION)
        return T.DecimalType(min(asked, MAX_PRECISION), scale)
    return T.StringType()


def _is_missing(col: Column, data_type: T.DataType, empty_is_null: bool = True) -> Column:
    """True where the input stands for a missing value."""
    missing = col.isNull()
    if isinstance(data_type, T.StringType):
        return missing | null_tokens_to_null(col, empty_is_null).isNull()
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return missing | F.isnan(col)
    return missing


def to_bit(col: Column, data_type: T.DataType) -> Column:
    """Boolean from the accepted bit texts or from the numbers 0 and 1."""
    if isinstance(data_type, T.BooleanType):
        return col
    if isinstance(data_type, T.NumericType):
        return F.when(col == 1, F.lit(True)).when(col == 0, F.lit(False))
    text = col.cast("string")
    return F.when(text.isin(*TRUE_TOKENS), F.lit(True)).when(text.isin(*FALSE_TOKENS), F.lit(False))


def _whole(col: Column, data_type: T.DataType, target: str) -> Column:
    if isinstance(data_type, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.when(col == F.floor(col), col.try_cast(target))
    return col.try_cast(target)


def to_datetime(col: Column, target: str, formats: tuple[str, ...] = ()) -> Column:
    """ISO texts (or any of the given formats) to a date or timestamp; others give NULL."""
    iso = col.try_cast(target)
    parsed = [F.try_to_timestamp(col, F.lit(f)).cast("timestamp_ntz").cast(target) for f in formats]
    return F.coalesce(iso, *parsed) if parsed else iso


def coerce(
    col: Column,
    data_type: T.DataType,
    spec: ColumnSpec,
    strict: bool = False,
    formats: tuple[str, ...] = (),
) -> Column:
    """Bring one column to its declared type."""
    target = spark_type(spec)
    if isinstance(target, T.StringType):
        text = null_tokens_to_null(col.cast("string"), empty_is_null=False)
        limit = text_limit(spec)
        return text if limit is None else clip(text, limit)
    if isinstance(target, (T.DateType, T.TimestampNTZType)):
        return to_datetime(col, target.simpleString(), formats)
    missing = _is_missing(col, data_type)
    value = F.when(~missing, _convert(col, data_type, target))
    if strict:
        problem = F.concat(
            F.lit(f"column {spec.sql_name}: not a valid {spec.data_type}: "), col.cast("string")
        )
        value = F.when(missing | value.isNotNull(), value).otherwise(F.raise_error(problem))
    return value


def _convert(col: Column, data_type: T.DataType, target: T.DataType) -> Column:
    if isinstance(target, T.BooleanType):
        return to_bit(col, data_type)
    if isinstance(target, T.DecimalType):
        return col.try_cast(target)
    return _whole(col, data_type, target.simpleString())


def is_bad(col: Column, data_type: T.DataType, spec: ColumnSpec, formats: tuple[str, ...] = ()) -> Column:
    """True where a present value does not fit its declared type."""
    if isinstance(spark_type(spec), T.StringType):
        return F.lit(False)
    return ~_is_missing(col, data_type) & coerce(col, data_type, spec, False, formats).isNull()
