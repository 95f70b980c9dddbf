"""Counters, gauges and histograms over the metrics table.

The table has `metric_name`, `metric_value`, `unit`, `tags` (JSON text, sorted keys) and
`metric_ts`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.measures import tags_json
from tidemark.operators.percentiles import exact_percentiles

SERIES = ["metric_name", "tags"]
# The shares a histogram is summarised by.
SUMMARY_PERCENTILES = {"median": 0.5, "p95": 0.95, "p99": 0.99}


def encode_tags(df: DataFrame, column: str = "tags") -> DataFrame:
    """Tags from a map to JSON text."""
    return df.withColumn(column, tags_json(F.col(column)))


def decode_tags(df: DataFrame, column: str = "tags") -> DataFrame:
    """Tags from JSON text to a map."""
    return df.withColumn(column, F.from_json(F.col(column), "map<string,string>"))


def counter_totals(metrics: DataFrame) -> DataFrame:
    """Sum per series."""
    return metrics.groupBy(*SERIES).agg(F.sum("metric_value").alias("total"))


def last_gauges(metrics: DataFrame, tie_break: str | None = None) -> DataFrame:
    """Last value per series; equal times are settled by `tie_break`."""
    order = F.struct("metric_ts", tie_break) if tie_break else F.col("metric_ts")
    return metrics.groupBy(*SERIES).agg(
        F.max_by("metric_value", order).alias("last_value"), F.max("metric_ts").alias("last_ts")
    )


def histogram_summary(metrics: DataFrame) -> DataFrame:
    """Count, limits, mean, median and upper percentiles per series."""
    basics = {
        "n": F.count("metric_value"),
        "min": F.min("metric_value"),
        "max": F.max("metric_value"),
        "mean": F.avg("metric_value"),
    }
    return exact_percentiles(metrics, SERIES, "metric_value", SUMMARY_PERCENTILES, basics)


def metric_percentile(metrics: DataFrame, name: str, percentile: float) -> DataFrame:
    """One percentile (0 to 100) of the untagged series of a metric, one row; NULL without data."""
    series = metrics.filter(
        (F.col("metric_name") == name) & (F.col("tags").isNull() | (F.col("tags") == "{}"))
    )
    found = exact_percentiles(series, ["metric_name"], "metric_value", {"value": percentile / 100})
    return found.agg(F.max("value").alias("percentile_value"))


def approximate_percentile(metrics: DataFrame, percentile: float, accuracy: int = 10_000) -> DataFrame:
    """Estimate per series in one pass, for dashboards that need no exact figure."""
    return metrics.groupBy(*SERIES).agg(
        F.percentile_approx("metric_value", percentile / 100, accuracy).alias("percentile_value")
    )
