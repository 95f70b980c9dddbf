"""Helpers that keep work spread out: joins on hot keys, running totals, row filters.

All of them are DataFrame operations. Nothing here depends on the size of the input but through
figures that are counted first, and no step is left out at any size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.scratch import materialize

#: A key that holds more than 1/SHARES of all rows is hot, so there are at most SHARES hot keys.
SHARES = 1000


def normal_text(text: Column) -> Column:
    """The text with A-Z lower-cased and nothing else changed; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    # lower() is the fast way and the same on pure ASCII; elsewhere it would change more letters.
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, upper, lower))


def text_key(text: Column) -> Column:
    """64 bits that tell the exact texts of one document id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """Inner join of rows to one row per key, where `size` is the number of rows of that key.

    Keys with more than 1/SHARES of the rows are joined by broadcast; as they are more than that
    large there are at most SHARES of them, whatever the input. The others go through a shuffle, in
    which no key is large. Both tables are read twice, so give written ones.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    limit = max(1, total // SHARES)
    hot = groups.filter(F.col(size) > limit)
    cold = groups.filter(F.col(size) <= limit)
    by_broadcast = rows.join(F.broadcast(hot), key)
    others = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return by_broadcast.unionByName(others.join(cold, key))


def running_totals(
    df: DataFrame, order: Sequence[str], value: str, into: str, within: Sequence[str] = ()
) -> DataFrame:
    """Add the sum of `value` over all earlier rows (of the same `within`) in the given order.

    The rows are dealt out by ranges of (within, order) and written, each range is summed up, and
    the sums of the ranges before are added to a window inside each range: no task ever holds more
    than a range, and a hot value of `within` spans many. The order should be total but for rows
    that are equal in all columns that matter. A row's own value is not part of its total.
    """
    part = "_tm_part"
    cols = [*within, *order]
    dealt = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in cols])
    ranges = materialize(dealt.withColumn(part, F.spark_partition_id()), "ranges")
    keys = [f"_tm_k{i}" for i in range(len(within))]
    sums = ranges.groupBy(part, *[F.col(c).alias(k) for c, k in zip(within, keys)]).agg(
        F.sum(value).alias("_tm_sum")
    )
    earlier = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col(part).alias("_tm_at"),
        *keys,
        F.coalesce(F.sum("_tm_sum").over(earlier), F.lit(0)).alias("_tm_offset"),
    )
    match = F.col(part) == F.col("_tm_at")
    for c, k in zip(within, keys):
        match &= F.col(c).eqNullSafe(F.col(k))
    inside = (
        Window.partitionBy(part, *within)
        .orderBy(*[F.col(c).asc_nulls_first() for c in order])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        ranges.join(offsets, match)
        .withColumn(into, F.coalesce(F.sum(value).over(inside), F.lit(0)) + F.col("_tm_offset"))
        .select(*df.columns, into)
    )


class Sieve:
    """A bitmap of fixed size over 64-bit hashes: a clear bit proves that a hash was not put in.

    It holds 2**bits bits in words of 64, so the broadcast is at most 2**(bits-6) rows of two longs
    (4 MB of payload at 24 bits) at any size of the input. When it fills up it lets more rows
    through; it never holds back one that was put in. So it only ever saves work.
    """

    def __init__(self, hashes: DataFrame, column: str, bits: int = 24) -> None:
        self._slots = 1 << bits
        slot = F.pmod(F.col(column), F.lit(self._slots))
        words = hashes.select(slot.alias("_tm_slot")).groupBy(
            F.shiftright("_tm_slot", 6).alias("_tm_word")
        )
        one_bit = F.expr("shiftleft(1L, CAST(_tm_slot & 63 AS INT))")
        self._words = materialize(words.agg(F.bit_or(one_bit).alias("_tm_bits")), "sieve")

    def mark(self, df: DataFrame, hashed: Column, into: str) -> DataFrame:
        """Add a boolean that is true for each hash that was put in and may be true for others."""
        slot = F.pmod(hashed, F.lit(self._slots))
        marked = df.withColumn("_tm_at", slot).join(
            F.broadcast(self._words), F.shiftright("_tm_at", 6) == F.col("_tm_word"), "left"
        )
        bit = F.expr("shiftright(_tm_bits, CAST(_tm_at & 63 AS INT)) & 1L")
        return marked.withColumn(into, F.coalesce(bit == 1, F.lit(False))).drop(
            "_tm_at", "_tm_word", "_tm_bits"
        )


def keep_decided(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The documents without those decided against; all columns as they are.

    `decisions` has doc_id, text_key and kept, one row for each row of `docs`. Equal rows of `docs`
    (same id, same text) share a decision: if one of them is kept, one row stays. Only documents
    that a sieve can't clear are shuffled with their texts, so the texts of most never move.
    """
    per_row = decisions.groupBy("doc_id", "text_key").agg(
        F.max("kept").alias("_tm_kept"), F.count("*").alias("_tm_rows")
    )
    touched = materialize(
        per_row.filter(~F.col("_tm_kept") | (F.col("_tm_rows") > 1)).select(
            F.col("doc_id").alias("_tm_id"), F.col("text_key").alias("_tm_key"), "_tm_kept"
        ),
        "decided",
    )
    both = touched.select(F.xxhash64("_tm_id", "_tm_key").alias("h"))
    columns = docs.columns
    keyed = docs.withColumn("_tm_text", text_key(F.col("text")))
    marked = Sieve(both, "h").mark(keyed, F.xxhash64("doc_id", "_tm_text"), "_tm_maybe")
    clear = marked.filter(~F.col("_tm_maybe"))
    match = F.col("doc_id").eqNullSafe(F.col("_tm_id")) & (F.col("_tm_text") == F.col("_tm_key"))
    maybe = marked.filter("_tm_maybe")
    untouched = maybe.join(touched, match, "left_anti")
    stays = maybe.join(touched.filter("_tm_kept"), match, "left_semi")
    one_each = stays.groupBy("doc_id", "_tm_text").agg(F.first(F.struct(*columns)).alias("_tm_row"))
    return (
        clear.select(*columns)
        .unionByName(untouched.select(*columns))
        .unionByName(one_each.select("_tm_row.*"))
    )
