"""Stage tables: one Parquet folder per table and stage, replaced by every load."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

RAW = "raw"
TRANSFORMED = "transformed"
STAGING = "staging"


def stage_path(root: str, table: str, stage: str) -> str:
    return f"{root.rstrip('/')}/{table}_{stage}.parquet"


def write_stage(df: DataFrame, root: str, table: str, stage: str = RAW) -> int:
    """Replace the stage; returns the rows written, counted on the way."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n"))
    counted.write.mode("overwrite").option("compression", "snappy").parquet(
        stage_path(root, table, stage)
    )
    return seen.get["n"]


def read_stage(spark: SparkSession, root: str, table: str, stage: str = RAW) -> DataFrame:
    """The stage as a table; fails when it was never written."""
    return spark.read.parquet(stage_path(root, table, stage))
