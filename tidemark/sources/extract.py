"""Reading a source table: projection, business filter, incremental filter."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.measures import at
from tidemark.spec import ColumnSpec, TableSpec, included

INCREMENTAL = "incremental"
FULL = "full"


def effective_mode(spec: TableSpec, mode: str) -> str:
    """Full for a table without a change timestamp, whatever was asked."""
    if mode not in (INCREMENTAL, FULL):
        raise ValueError(f"mode must be {INCREMENTAL} or {FULL}, got {mode!r}")
    return mode if spec.is_incremental else FULL


def predicates(spec: TableSpec, mode: str = INCREMENTAL) -> list[Column]:
    """Filters for one read. The timestamp column stands alone, so the bound reaches the scan."""
    found = [F.expr(spec.filter_clause)] if spec.filter_clause else []
    bound = spec.lower_bound()
    if effective_mode(spec, mode) == INCREMENTAL and bound is not None:
        found.append(F.col(f"`{spec.modified_col}`") >= at(bound))
    return found


def filtered(df: DataFrame, spec: TableSpec, mode: str = INCREMENTAL) -> DataFrame:
    for condition in predicates(spec, mode):
        df = df.filter(condition)
    return df


def extract(
    df: DataFrame, spec: TableSpec, columns: Iterable[ColumnSpec], mode: str = INCREMENTAL
) -> DataFrame:
    """The rows to load, each column through its source expression and under its safe name."""
    return filtered(df, spec, mode).select(
        *(F.expr(c.expression).alias(c.sql_name) for c in included(columns))
    )


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    partitions: int = 16,
    fetch_size: int = 50_000,
    single_task: bool = False,
    **options: str,
) -> dict[str, str]:
    """Options of a JDBC read in parallel ranges of the partition column.

    A table without such a column is read by one connection, which has to be asked for.
    """
    if single_task == bool(partition_column):
        raise ValueError("give a partition column with bounds, or ask for a single task")
    result = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **options}
    if partition_column:
        if not bounds or partitions < 2:
            raise ValueError("a parallel read needs bounds and at least two partitions")
        low, high = bounds
        result |= {
            "partitionColumn": partition_column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(partitions),
        }
    return result


#: Error of the quantiles that ranges are taken from, as a share of all rows.
RANGE_ERROR = 0.002


def even_bounds(known: DataFrame, column: str, ranges: int) -> list:
    """Inner bounds that cut the values of a column into ranges of about equal numbers of rows.

    From one quantile sketch over `known`: the published table of the last load, or any table with
    the same spread of values. Bounds are values that occur, so a value that fills several ranges
    gives one; there may be fewer bounds than asked for.
    """
    shares = [i / ranges for i in range(1, ranges)]
    picked = known.agg(
        F.percentile_approx(F.col(f"`{column}`"), shares, int(1 / RANGE_ERROR)).alias("bounds")
    ).first()["bounds"]
    return sorted(set(picked or ()))


def _literal(value) -> str:
    return str(value) if isinstance(value, (int, float, Decimal)) else "'" + str(value).replace("'", "''") + "'"


def range_predicates(column: str, bounds: Sequence) -> list[str]:
    """SQL conditions that divide all rows by bounds, each row in exactly one; NULLs in the first."""
    if not bounds:
        return ["1 = 1"]
    texts = [_literal(b) for b in bounds]
    found = [f"{column} < {texts[0]} OR {column} IS NULL"]
    found += [f"{column} >= {a} AND {column} < {b}" for a, b in zip(texts, texts[1:])]
    return [*found, f"{column} >= {texts[-1]}"]


def read_in_ranges(
    spark: SparkSession, url: str, table: str, conditions: Sequence[str], fetch_size: int = 50_000, **options: str
) -> DataFrame:
    """A JDBC table read by one task per condition (see `range_predicates`), so that a skewed
    column gives even tasks."""
    properties = {"fetchsize": str(fetch_size), **options}
    return spark.read.jdbc(url, table, predicates=list(conditions), properties=properties)


def jdbc_reader(spark: SparkSession, **options) -> DataFrameReader:
    """JDBC source; projections and filters put on top are pushed to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(**options))
