"""Exact percentiles with linear interpolation, for groups of any size.

Spark's `percentile` keeps all distinct values of a group in the memory of one task. Here values are
counted first, range-partitioned and ranked piece by piece, so a group may hold any number of rows.
There is one way at every size, so a series never changes its figures by growing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.scratch import materialize

def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    return reduce(
        lambda a, b: a & b,
        (F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`")) for c in columns),
    )


def counted_values(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The values of each group counted, in written pieces of a range partitioning: `_v`, `_n` and
    `_piece` (rows without a value too). One pass over the data, from which counts and percentiles
    both follow."""
    counts = df.groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    # The piece numbers must stay the same for all uses, so the pieces are written.
    return materialize(
        counts.repartitionByRange(*keys, "_v").withColumn("_piece", F.spark_partition_id()),
        "percentile",
    )


def percentiles_of(
    counted: DataFrame, keys: Sequence[str], percentages: Mapping[str, float]
) -> DataFrame:
    """The percentiles of groups from their `counted_values`; NULL values do not count."""
    pieces = counted.filter(F.col("_v").isNotNull())
    by_piece = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = pieces.groupBy(*keys, "_piece").agg(F.sum("_n").alias("_size")).select(
        *keys,
        "_piece",
        "_size",
        F.coalesce(F.sum("_size").over(by_piece), F.lit(0)).alias("_before"),
        F.sum("_size").over(Window.partitionBy(*keys)).alias("_total"),
    )

    def position(p: float) -> Column:
        return F.lit(p) * (F.col("_total") - 1)

    ranks = [f(position(p)) for p in percentages.values() for f in (F.floor, F.ceil)]
    holds_rank = reduce(
        lambda a, b: a | b,
        ((r >= F.col("_before")) & (r < F.col("_before") + F.col("_size")) for r in ranks),
    )
    wanted = sizes.filter(holds_rank)
    joined = (
        pieces.alias("p")
        .join(wanted.alias("w"), _same("p", "w", [*keys, "_piece"]))
        .select("p.*", "w._before", "w._total")
    )
    up_to = Window.partitionBy(*keys, "_piece").orderBy("_v")
    placed = joined.withColumn("_end", F.col("_before") + F.sum("_n").over(up_to))
    start = F.col("_end") - F.col("_n")

    def at_rank(rank: Column) -> Column:
        return F.max(F.when((rank >= start) & (rank < F.col("_end")), F.col("_v")))

    picked = [F.max("_total").alias("_total")]
    for i, p in enumerate(percentages.values()):
        picked += [
            at_rank(F.floor(position(p))).alias(f"_lo{i}"),
            at_rank(F.ceil(position(p))).alias(f"_hi{i}"),
        ]

    def between(i: int, p: float) -> Column:
        # Equal ranks and equal values are taken as they are: infinities stay what they are.
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        step = position(p) - F.floor(position(p))
        return F.when((step == 0) | (low == high), low).otherwise(low + (high - low) * step)

    return placed.groupBy(*keys).agg(*picked).select(
        *keys,
        *(between(i, p).alias(n) for i, (n, p) in enumerate(percentages.items())),
    )


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    percentages: Mapping[str, float],
    others: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per group with a column per percentage (0 to 1); NULL values do not count.

    `others` are further aggregates of the groups.
    """
    others = [c.alias(n) for n, c in (others or {}).items()]
    ranked = percentiles_of(counted_values(df, keys, value), keys, percentages)
    # Put together by a grouping, which takes NULL keys as equal and needs no join.
    groups = df.groupBy(*keys).agg(*others) if others else df.select(*keys).distinct()
    both = groups.unionByName(ranked, allowMissingColumns=True)
    values = [c for c in both.columns if c not in keys]
    return both.groupBy(*keys).agg(*(F.any_value(c, True).alias(c) for c in values))
