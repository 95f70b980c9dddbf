"""Exact duplicates by progressive refinement: length, then a hash of the prefix, then of the whole.

The first scan takes only the length and a hash of the first characters of each text. Lengths and
then (length, prefix hash) pairs that occur once are settled; the pairs that occur again go into a
sieve of fixed size. In the second scan the whole content is hashed for rows of surviving pairs
alone. Texts never pass a shuffle.

Defined results: a null text is empty, and empty texts equal each other. Texts are equal when the
same after lower-casing A-Z. Null ids rank below all others. Of equal rows with the same id one
stays, the one written last. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.spread import Sieve, join_groups, keep_decided, normal_text, text_key
from tidemark.sources.scratch import materialize

#: Characters of a text that the prefix hash takes.
PREFIX = 64


def full_hash(text: Column) -> Column:
    return F.sha2(normal_text(text), 256)


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Mapping[str, Column] | None = None,
    prefix: int = PREFIX,
) -> DataFrame:
    """For each row: the id, what `carry` asks for, keep_id, group_size and kept.

    `carry` are expressions over `docs`, computed in the second scan and handed through.
    """
    carry = carry or {}
    text = F.coalesce(F.col(text_col), F.lit(""))
    length = F.octet_length(text)
    start = F.xxhash64(normal_text(F.substring(text, 1, prefix)))
    sized = docs.select(length.alias("len"), start.alias("start"))
    pairs = materialize(sized.groupBy("len", "start").agg(F.count("*").alias("n")), "pairs")
    lengths = pairs.groupBy("len").agg(F.sum("n").alias("of_len")).filter("of_len > 1")
    alive = pairs.join(lengths, "len", "left_semi").filter("n > 1")
    sieve = Sieve(alive.select(F.xxhash64("len", "start").alias("h")), "h")

    marked = sieve.mark(docs, F.xxhash64(length, start), "_tm_alive")
    whole = F.when(F.col("_tm_alive"), full_hash(F.col(text_col)))
    hashed = materialize(
        marked.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias(id_col),
            *[c.alias(name) for name, c in carry.items()],
            whole.alias("whole"),
        ),
        "hashed",
    )
    last = F.max(F.struct(F.col(id_col).alias("id"), F.col("row").alias("row"))).alias("last")
    again = hashed.filter(F.col("whole").isNotNull())
    groups = materialize(
        again.groupBy("whole").agg(last, F.count("*").alias("group_size")), "groups"
    )
    single = hashed.filter(F.col("whole").isNull()).select(
        id_col,
        *carry,
        F.col(id_col).alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"),
    )
    joined = join_groups(again, groups, "whole", "group_size").select(
        id_col,
        *carry,
        F.col("last.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("last.row")).alias("kept"),
    )
    return single.unionByName(joined)


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text, any others) with one row of each group of equal texts."""
    decided = exact_groups(docs, carry={"text_key": text_key(F.col("text"))})
    return keep_decided(docs, materialize(decided, "exact"))
