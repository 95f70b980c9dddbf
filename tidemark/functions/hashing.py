"""Row hash: one SHA-1 over the rendered values of a row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.measures import wall_time

NULL_TEXT = "None"


def _render_float(col: Column) -> Column:
    """Shortest exact decimal text: plain from 1e-4 up to 1e16, else like `1.5e-07`."""
    size = F.abs(col)
    usual = ((size >= 1e-3) & (size < 1e7)) | (size == 0)
    # The other sizes go through a lambda: their code stays out of the generated method, which
    # would otherwise grow past what the JVM compiles when a table has many such columns.
    unusual = F.transform(F.array(col), _render_unusual)[0]
    return F.when(usual, col.cast("string")).otherwise(unusual)


def _render_unusual(col: Column) -> Column:
    """Sizes that Spark writes with an exponent, and the values that are no number."""
    text, size = col.cast("string"), F.abs(col)
    plain = F.rtrim(text.try_cast("decimal(38,20)").cast("string"), F.lit("0"))
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    exponent = F.substring_index(text, "E", -1).try_cast("int")
    digits = F.when(F.abs(exponent) < 10, F.lpad(F.abs(exponent).cast("string"), 2, "0")).otherwise(
        F.abs(exponent).cast("string")
    )
    scientific = F.concat(mantissa, F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")), digits)
    return (
        F.when(F.isnan(col), F.lit("nan"))
        .when(size == float("inf"), F.when(col > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when(
            (size >= 1e-4) & (size < 1e16),
            F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain),
        )
        .otherwise(scientific)
    )


def _render_time(col: Column, data_type: T.DataType) -> Column:
    """`2024-01-31 06:00:00`, with six digits of a second where there is a fraction.

    A moment with zone is written in UTC, whatever the zone of the session.
    """
    text = (wall_time(col) if isinstance(data_type, T.TimestampType) else col).cast("string")
    return F.when(F.instr(text, ".") == 0, text).otherwise(F.rpad(text, 26, "0"))


def render(col: Column, data_type: T.DataType) -> Column:
    """Canonical text of a value; NULL stays NULL."""
    if isinstance(data_type, T.StringType):
        return col
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return _render_float(col)
    if isinstance(data_type, T.BooleanType):
        return F.when(col, F.lit("True")).when(~col, F.lit("False"))
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return _render_time(col, data_type)
    if isinstance(data_type, T.BinaryType):
        return F.hex(col)
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(col)
    return col.cast("string")


def row_hash(df: DataFrame, columns: Sequence[str] | None = None, strict: bool = False) -> Column:
    """SHA-1 hex over the values of `columns` joined by a bar.

    Without `strict` a bar inside a value and a missing value (text `None`) are not told apart
    from their look-alikes. With `strict` bars are escaped and NULL has a mark of its own.
    """
    parts = []
    for name in columns if columns is not None else df.columns:
        text = render(F.col(f"`{name}`"), df.schema[name].dataType)
        if strict:
            text = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
        parts.append(F.coalesce(text, F.lit("\\N" if strict else NULL_TEXT)))
    return F.sha1(F.concat_ws("|", *parts))


# Starts the second half of a digest, so that the halves are independent.
_SECOND = 0x5DEECE66D


def digest(df: DataFrame, columns: Sequence[str]) -> tuple[Column, Column]:
    """128 bits in two halves that stand for the values of `columns` in groupings and shuffles.

    Of fixed width whatever the values. NULL equals NULL and nothing else; numbers that compare as
    equal have one digest. Values that have no order of their own go by their JSON text.
    """
    parts: list[Column] = []
    for name in columns:
        col = F.col(f"`{name}`")
        if isinstance(df.schema[name].dataType, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
            col = F.to_json(F.struct(col))
        parts += [col.isNull(), col]
    return F.xxhash64(*parts), F.xxhash64(F.lit(_SECOND), *parts)


def unpivoted(cells: Sequence[Sequence[Column]], df: DataFrame, names: Sequence[str]) -> DataFrame:
    """A row per row of `df` and cell: `id` (the place of the cell) and the values of the cell under
    `names`. One generated projection per cell, with plain columns instead of arrays of structs."""
    columns, groups = [], []
    for place, cell in enumerate(cells):
        own = [f"c{place}_{i}" for i in range(len(cell))]
        columns += [value.alias(n) for value, n in zip(cell, own, strict=True)]
        groups.append(f"({', '.join(own)}) AS `{place}`")
    return df.sparkSession.sql(
        f"SELECT CAST(id AS INT) AS id, {', '.join(names)} FROM {{cells}} "
        f"UNPIVOT INCLUDE NULLS (({', '.join(names)}) FOR id IN ({', '.join(groups)}))",
        cells=df.select(*columns),
    )
