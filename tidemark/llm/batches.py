"""Arrow batches of texts in pieces of bounded size, and caches of bounded size."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows of an Arrow batch, where the session leaves Spark's own number.
ROWS = 500
_SPARKS_ROWS = "10000"
#: Bytes of text that are taken apart at a time; a longer text comes alone.
PIECE = 1 << 20
#: Entries of a cache; a full one starts anew, which changes the time and nothing else.
CACHE = 150_000
#: Words longer than this are worked out each time.
CACHED_LENGTH = 64


def small_batches(df: DataFrame) -> DataFrame:
    """Let the session send rows to Python in batches of ROWS, unless it names another number.

    Spark's own 10,000 rows of long texts cost every worker and its executor tens of megabytes.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(name) == _SPARKS_ROWS:
        conf.set(name, str(ROWS))
    return df


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of this many rows for what is run inside; the session's own number after."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def pieces(
    batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = PIECE
) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Slices of the batches with their texts as UTF-8."""
    for batch in batches:
        column = batch.column(text).cast(pa.binary())
        sizes = pa.compute.binary_length(column).fill_null(0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start), column.slice(start, i - start).to_pylist()
                start, held = i, 0
            held += size + 16
        if start < len(sizes):
            yield batch.slice(start), column.slice(start).to_pylist()
