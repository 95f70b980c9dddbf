"""Column profiles over the full data, and the advice drawn from them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.hashing import digest, unpivoted
from tidemark.functions.measures import days_since, ratio, rounded
from tidemark.operators.clean import TECHNICAL_COLUMNS

# Columns unpivoted together: bounds the size of the generated code on wide tables.
CHUNK = 64

def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _profiled(df: DataFrame) -> list[T.StructField]:
    return [f for f in df.schema if f.name not in TECHNICAL_COLUMNS]


# What a cell is, beside the digest of its value.
_NULL, _BLANK, _VALUE = 0, 1, 2


def _kind(field: T.StructField) -> Column:
    col = _q(field.name)
    kind = F.when(col.isNull(), _NULL)
    if isinstance(field.dataType, T.StringType):
        kind = kind.when(F.trim(col) == "", _BLANK)
    return kind.otherwise(_VALUE).cast("tinyint")


def _exact_counts(df: DataFrame) -> DataFrame:
    """Per column its rows, NULLs, blanks and distinct values, in one scan and one shuffle of cells.

    A cell is the number of its column, its kind and a digest of fixed width, so no text is ever
    shuffled; a value that fills a large part of a column is reduced to one row per task before.
    """
    fields = _profiled(df)
    parts = []
    for start in range(0, len(fields), CHUNK):
        some = fields[start : start + CHUNK]
        cells = [(_kind(f), *digest(df, [f.name])) for f in some]
        rows = unpivoted(cells, df, ["kind", "d1", "d2"])
        parts.append(rows.withColumn("id", F.col("id") + start))
    counts = reduce(DataFrame.unionByName, parts).groupBy("id", "kind", "d1", "d2").agg(
        F.count(F.lit(1)).alias("n")
    )
    label = F.element_at(F.array(*(F.lit(f.name) for f in fields)), F.col("id") + 1)
    return (
        counts.groupBy("id")
        .agg(
            F.sum("n").alias("total_rows"),
            F.sum(F.when(F.col("kind") == _NULL, F.col("n")).otherwise(0)).alias("null_count"),
            F.sum(F.when(F.col("kind") == _BLANK, F.col("n")).otherwise(0)).alias("empty_count"),
            F.count_if(F.col("kind") != _NULL).alias("distinct_count"),
        )
        .withColumn("column_name", label)
        .drop("id")
    )


def _approximate_counts(df: DataFrame, rsd: float) -> DataFrame:
    fields = _profiled(df)
    total = F.count(F.lit(1))
    row = df.agg(
        *(
            F.struct(
                total.alias("total_rows"),
                F.count_if(_q(f.name).isNull()).alias("null_count"),
                (
                    F.count_if(F.trim(_q(f.name)) == "")
                    if isinstance(f.dataType, T.StringType)
                    else F.lit(0).cast("bigint")
                ).alias("empty_count"),
                F.approx_count_distinct(_q(f.name), rsd).alias("distinct_count"),
            ).alias(f.name)
            for f in fields
        )
    )
    listed = row.unpivot([], [f"`{f.name}`" for f in fields], "column_name", "c")
    return listed.select("column_name", "c.*").filter("total_rows > 0")


# Sketches of 2**SKETCH_BITS registers: a relative standard error of 0.65% at any size.
SKETCH_BITS = 14
SKETCH_ERROR = 0.83 / 2 ** (SKETCH_BITS / 2)


def sketch_columns(df: DataFrame) -> DataFrame:
    """One row per column that can be merged with those of other batches: rows, NULLs, blanks and a
    sketch of the distinct values, in one scan without a shuffle of the data."""
    fields = _profiled(df)
    row = df.agg(
        *(
            F.struct(
                F.count(F.lit(1)).alias("total_rows"),
                F.count_if(_kind(f) == _NULL).alias("null_count"),
                F.count_if(_kind(f) == _BLANK).alias("empty_count"),
                F.hll_sketch_agg(
                    F.when(_q(f.name).isNotNull(), digest(df, [f.name])[0]), F.lit(SKETCH_BITS)
                ).alias("sketch"),
            ).alias(str(i))
            for i, f in enumerate(fields)
        )
    )
    listed = row.unpivot([], [f"`{i}`" for i in range(len(fields))], "place", "c")
    place = F.col("place").cast("int") + 1
    names = F.array(*(F.lit(f.name) for f in fields))
    types = F.array(*(F.lit(f.dataType.simpleString()) for f in fields))
    return listed.select(
        F.element_at(names, place).alias("column_name"),
        place.alias("ordinal"),
        F.element_at(types, place).alias("data_type"),
        "c.*",
    )


def profile_of_sketches(sketches: DataFrame) -> DataFrame:
    """The profile of all batches whose sketches are given, without reading their rows again.

    As `column_profile`, with distinct values estimated (`SKETCH_ERROR`); a column takes its type
    and place from the latest batch by `sketch_ts` where there is such a column.
    """
    last = "sketch_ts" if "sketch_ts" in sketches.columns else "total_rows"
    merged = sketches.groupBy("column_name").agg(
        F.max_by("ordinal", last).alias("ordinal"),
        F.max_by("data_type", last).alias("data_type"),
        F.sum("total_rows").alias("total_rows"),
        F.sum("null_count").alias("null_count"),
        F.sum("empty_count").alias("empty_count"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_count"),
    )
    return _described(merged.filter("total_rows > 0"))


def column_profile(df: DataFrame, approximate: bool = False, rsd: float = 0.01) -> DataFrame:
    """One row per column: rows, NULLs, blank texts, their share, distinct values and their ratio.

    Technical columns are skipped and an empty table gives no rows. Distinct values are exact;
    `approximate` estimates them in a single scan without a shuffle of the data.
    """
    fields = _profiled(df)
    counts = _approximate_counts(df, rsd) if approximate else _exact_counts(df)
    types = F.create_map(*(F.lit(x) for f in fields for x in (f.name, f.dataType.simpleString())))
    places = F.create_map(*(F.lit(x) for i, f in enumerate(fields, 1) for x in (f.name, i)))
    named = counts.withColumns(
        {"ordinal": places[F.col("column_name")], "data_type": types[F.col("column_name")]}
    )
    return _described(named)


def _described(counts: DataFrame) -> DataFrame:
    empty_total = F.col("null_count") + F.col("empty_count")
    return counts.select(
        "column_name",
        "ordinal",
        "data_type",
        "total_rows",
        "null_count",
        "empty_count",
        empty_total.alias("empty_total"),
        rounded(empty_total / F.col("total_rows") * 100, 2).alias("empty_pct"),
        "distinct_count",
        rounded(F.col("distinct_count") / F.col("total_rows"), 4).alias("distinct_ratio"),
    )


# Shares of empty values and numbers of distinct ones that rule a column out.
ALL_EMPTY_PCT = 99.9
MOSTLY_EMPTY_PCT = 90.0
MOSTLY_EMPTY_VALUES = 2
STATIC_VALUES = 1


def with_advice(profile: DataFrame, min_empty_pct: float = MOSTLY_EMPTY_PCT) -> DataFrame:
    """Mark the columns that carry next to nothing, with the rule that fired (NULL if none did);
    the figures it went by are in the other columns."""
    # Judged on the exact share, not on the rounded one that is reported.
    empty_pct = F.col("empty_total") / F.col("total_rows") * 100
    distinct = F.col("distinct_count")
    few = distinct <= MOSTLY_EMPTY_VALUES
    rule = (
        F.when(distinct <= STATIC_VALUES, F.lit("static"))
        .when(empty_pct >= ALL_EMPTY_PCT, F.lit("all_empty"))
        .when((empty_pct >= min_empty_pct) & few, F.lit("mostly_empty"))
    )
    return profile.select("*", rule.isNotNull().alias("recommend_exclude"), rule.alias("rule"))


def excluded_names(advice: DataFrame, keys: Sequence[str] = ()) -> list[str]:
    """Names of the columns to leave out; key columns are never among them."""
    rows = advice.filter("recommend_exclude").select("column_name").collect()
    return sorted(r["column_name"] for r in rows if r["column_name"] not in keys)


def apply_exclusions(df: DataFrame, advice: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The table without the columns the advice rules out."""
    return df.drop(*excluded_names(advice, keys))


def profiling_age(log: DataFrame, as_of: datetime, threshold_days: int = 14) -> DataFrame:
    """Days since the last profile of every table, and whether it is never, obsolete or recent.

    `log` has `table_name` and `profiled_ts` (NULL for a table without a profile).
    """
    last = log.groupBy("table_name").agg(F.max("profiled_ts").alias("last_profiling_ts"))
    age = days_since(F.col("last_profiling_ts"), as_of)
    status = (
        F.when(F.col("last_profiling_ts").isNull(), F.lit("never"))
        .when(age >= threshold_days, F.lit("obsolete"))
        .otherwise(F.lit("recent"))
    )
    return last.select("*", age.alias("days_since_profiling"), status.alias("profile_status"))


def profiling_due(
    log: DataFrame,
    as_of: datetime,
    threshold_days: int = 14,
    force: bool = False,
    max_tables: int | None = None,
) -> DataFrame:
    """Tables to profile, oldest profile first; `max_tables` keeps the first ones."""
    ages = profiling_age(log, as_of, threshold_days)
    due = ages if force else ages.filter(F.col("profile_status") != "recent")
    ordered = due.orderBy(F.desc("days_since_profiling"), "table_name")
    return ordered.limit(max_tables) if max_tables else ordered


def profile_summary(advice: DataFrame) -> DataFrame:
    """Columns in all, kept and left out, one row."""
    total, out = F.count(F.lit(1)), F.count_if("recommend_exclude")
    return advice.agg(
        total.alias("total_columns"),
        (total - out).alias("active_columns"),
        out.alias("excluded_columns"),
        (ratio(out, total) * 100).alias("excluded_pct"),
    )
