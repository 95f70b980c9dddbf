"""Intermediate tables in the folder shared by the cluster.

A written table cuts the lineage and survives the loss of an executor. The folder is the one that
`spark.checkpoint.dir` names; a session without that setting names its own in `tidemark.scratch.dir`
(see `use_local_scratch` for tests and single-machine runs). There is no silent fallback.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = ("spark.checkpoint.dir", "tidemark.scratch.dir")


def _configured(spark: SparkSession) -> str | None:
    for name in _SETTINGS:
        root = spark.conf.get(name, None) or spark.sparkContext.getConf().get(name)
        if root:
            return root.rstrip("/")
    return None


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables."""
    root = _configured(spark)
    if root is None:
        raise RuntimeError(f"{_SETTINGS[0]} must name a folder that all executors share")
    return root


def use_local_scratch(spark: SparkSession) -> SparkSession:
    """Give a session on one machine a folder of its own, unless a folder is set already."""
    if _configured(spark) is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"{_SETTINGS[0]} must name a folder that all executors share")
        spark.conf.set(_SETTINGS[1], tempfile.mkdtemp(prefix="tidemark-"))
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name that no other run uses."""
    return f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write the rows once and go on from the written table."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Let Spark delete the shuffle files of a job at its end, for the jobs that are run inside.

    Spark before 4.1 doesn't know the setting and keeps the files until the driver collects garbage.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
