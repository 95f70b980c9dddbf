"""Token ids in ORC files: run-length encoded integers, row indexes, Bloom filters on document ids.

Rows are dealt out by ranges of the document id before they are encoded, so each file holds a range
of ids in ascending order, stripes can be read side by side, and a search for an id skips files and
stripes by their statistics and Bloom filters. ORC stores integer lists with its run-length encoding.

Defined results: a null text has the end id alone; null ids come first; rows with the same id are
ordered by a hash of the text, and equal rows are all kept; an empty table gives a file set without
rows. Ids are stored as 32-bit integers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import pieces, small_batches
from tidemark.llm.spread import running_totals, text_key
from tidemark.llm.tokens import word_tokenizer
from tidemark.sources.scratch import materialize

#: Entries of the word cache of a Python worker: a word costs more to work out than to hold.
WORDS = 800_000
#: Options of the files; see the ORC specification. 64 MB stripes, an index entry per 1,000 rows.
ORC_OPTIONS = {
    "orc.stripe.size": str(64 << 20),
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "compression": "lz4",
}


def encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id, text_key and `ids`, the token ids of the text and the end id."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokenizer(tokenizer, WORDS)
        end = np.array([end_id], "<u4").tobytes()
        for rows, texts in pieces(batches):
            found = [ids + end for ids in words.ids(texts)]
            ends = np.cumsum([0, *(len(f) // 4 for f in found)])
            flat = pa.array(np.frombuffer(b"".join(found), "<i4"))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("text_key"), lists],
                names=["doc_id", "text_key", "ids"],
            )

    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("text_key", T.LongType()),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
        ]
    )
    return small_batches(docs.select("doc_id", "text_key", "text")).mapInArrow(encode, schema)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Write the ids of all documents (doc_id, text) in ascending order of doc_id."""
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_key")]
    rows = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    encoded(dealt, tokenizer, end_id).write.options(**ORC_OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def token_index(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document of the files."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            lists = rows.column("ids")
            offsets = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            spans = zip(offsets[:-1], offsets[1:], strict=True)
            sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in spans]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("text_key"),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                names=["doc_id", "text_key", "n_tokens", "ids_crc32"],
            )

    schema = T.StructType(
        [
            *[tokens.schema[c] for c in ("doc_id", "text_key")],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )
    found = tokens.select("doc_id", "text_key", "ids").mapInArrow(digest, schema)
    # Written once, as dealing them out by ranges reads the rows twice.
    digests = materialize(found, "digests")
    placed = running_totals(digests, ["doc_id", "text_key"], "n_tokens", "start")
    return placed.select("doc_id", "start", "n_tokens", "ids_crc32")
