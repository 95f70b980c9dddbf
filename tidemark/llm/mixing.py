"""Mixing sources to target weights by Pareto order sampling.

Every document has an expected number of copies. The whole part of it is certain. The fraction is
the document's inclusion probability p for one more copy, and these are drawn by Pareto order
sampling: each document gets a uniform number u from its id and text, its rank value is
(u / (1 - u)) / (p / (1 - p)), and the documents with the smallest values are taken until the words
missing in the source are reached. The sample has a fixed size in words, and the chances are p.

The order is never sorted in one place: ranges of (source, rank value) are summed up one by one, and
only the threshold of each source, one row, goes back to the documents. Reruns agree, as u is a hash.

Defined results: a null text has size 0 and is taken zero times over; a null source is a source of
its own, the last; equal rows (same id and text) have the same rank and are taken together; sources
without words have target 0; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.spread import running_totals
from tidemark.sources.scratch import materialize

#: No document is taken more often than this.
MOST_COPIES = 2
#: All targets together as a share of all words.
TOTAL = 1.5
#: Weights of the sources in order of their names, again from the start when used up.
WEIGHTS = (3, 1, 2)


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def uniform_key(doc_id: Column, text: Column) -> Column:
    """A hash of id and text; its first 52 bits are the uniform number."""
    empty = F.lit("")
    return F.md5(
        F.concat_ws(":", F.coalesce(doc_id.cast("string"), empty), F.coalesce(text, empty))
    )


def targets(sizes: DataFrame, weights: Sequence[int], total: float, most: int) -> DataFrame:
    """One row per source of `sizes` (source, source_size) with its target in words.

    Sources share the total by weight. One whose share is above `most` times its size gets that,
    and the rest is shared anew among the others until none is above. Only sums leave the executors.
    """
    placed = running_totals(
        sizes.withColumn("one", F.lit(1)).withColumn("last", F.col("source").isNull()),
        ["last", "source"],
        "one",
        "place",
    )
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")
    )
    weighted = materialize(
        placed.select("source", "source_size", weight.cast("double").alias("weight")), "weighted"
    )
    cap = F.lit(most) * F.col("source_size")
    whole = weighted.agg(F.sum("source_size")).first()[0] or 0
    left, shared = total * whole, float(weighted.agg(F.sum("weight")).first()[0] or 0)
    capped = F.lit(False)
    n_capped = 0
    while shared:
        share = F.lit(left) * F.col("weight") / F.lit(shared)
        capped = share > cap
        row = weighted.agg(
            F.count_if(capped), F.sum(F.when(capped, cap)), F.sum(F.when(~capped, F.col("weight")))
        ).first()
        if row[0] == n_capped:
            break
        n_capped, left, shared = row[0], total * whole - row[1], float(row[2] or 0)
    share = F.lit(left) * F.col("weight") / F.lit(shared or 1.0)
    return weighted.select(
        "source",
        "source_size",
        F.when(capped, cap.cast("double")).otherwise(share).alias("target"),
    )


def sized_rows(docs: DataFrame, inclusion: Column | None = None, keep: str = "doc_id") -> DataFrame:
    """What the sampling needs of each row, and `keep`: a column, or "*" for the row as a struct.

    `inclusion` is a positive weight of a document within its source (default: all alike).
    """
    liked = F.lit(1.0) if inclusion is None else inclusion.cast("double")
    return docs.select(
        F.struct(*docs.columns).alias("_tm_row") if keep == "*" else F.col(keep),
        "source",
        n_words(F.col("text")).alias("size"),
        uniform_key(F.col("doc_id"), F.col("text")).alias("key"),
        liked.alias("liked"),
    )


def thresholds(
    sized: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    total: float = TOTAL,
    most: int = MOST_COPIES,
) -> DataFrame:
    """One row per source: target, sums, and the rank value at which its sample ends."""
    sums = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("liked")).alias("liked_size")
    )
    sums = materialize(sums, "sources")
    aims = targets(sums.select("source", "source_size"), weights, total, most)
    plan = materialize(
        _beside(aims, sums.select("source", "liked_size")).withColumnRenamed(
            "source", "_tm_source"
        ),
        "targets",
    )
    ranked = materialize(_ranked(sized, plan, most), "ranked")
    rest = ranked.groupBy("source").agg(
        (F.first("target") - F.sum(F.col("certain") * F.col("size"))).alias("rest")
    )
    drawn = ranked.filter("p > 0").groupBy("source", "rank", "key").agg(
        F.sum("size").alias("size")
    )
    summed = running_totals(drawn, ["rank", "key"], "size", "before", within=["source"])
    # The nearest place to stop: after a document, or before the first.
    off = F.abs(F.col("rest") - F.col("before") - F.col("size")).alias("off")
    ends = _beside(summed, rest).groupBy("source").agg(
        F.min(F.struct(off, "rank", "key")).alias("stop"), F.first(F.abs("rest")).alias("none")
    )
    ends = ends.filter(F.col("stop.off") < F.col("none")).select(
        F.col("source").alias("_tm_ends"),
        F.col("stop.rank").alias("stop_rank"),
        F.col("stop.key").alias("stop_key"),
    )
    found = plan.join(ends, F.col("_tm_source").eqNullSafe(F.col("_tm_ends")), "left")
    return materialize(found.drop("_tm_ends"), "thresholds")


def _beside(left: DataFrame, right: DataFrame) -> DataFrame:
    """Join on the source, null included."""
    right = right.withColumnRenamed("source", "_tm_right")
    return left.join(right, F.col("source").eqNullSafe(F.col("_tm_right"))).drop("_tm_right")


def _ranked(rows: DataFrame, plan: DataFrame, most: int) -> DataFrame:
    """Add expected copies, their certain part, the chance p of one more and the rank value."""
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("_tm_source"))).drop("_tm_source")
    expected = F.when(
        F.col("liked_size") > 0, F.col("target") * F.col("liked") / F.col("liked_size")
    ).otherwise(0.0)
    u = (F.conv(F.substring("key", 1, 13), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(2.0**52)
    random_odds = F.col("u") / (1 - F.col("u"))
    inclusion_odds = F.col("p") / (1 - F.col("p"))
    return (
        joined.withColumn("expected", F.least(expected, F.lit(float(most))))
        .withColumn("certain", F.floor("expected"))
        .withColumn("p", F.col("expected") - F.col("certain"))
        .withColumn("u", u)
        .withColumn("rank", F.when(F.col("p") > 0, random_odds / inclusion_odds))
    )


def with_copies(rows: DataFrame, ends: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """Add `copies`, how often the mix takes each row, from the thresholds of the sources."""
    ranked = _ranked(rows, ends, most)
    within = F.struct("rank", "key") <= F.struct(
        F.col("stop_rank").alias("rank"), F.col("stop_key").alias("key")
    )
    drawn = F.col("stop_rank").isNotNull() & (F.col("p") > 0) & within
    return ranked.withColumn("copies", F.col("certain") + F.when(drawn, 1).otherwise(0))


def mixed(docs: DataFrame, inclusion: Column | None = None, **options) -> DataFrame:
    """doc_id, size, source, source_size, target, copies and taken words of every document."""
    sized = materialize(sized_rows(docs, inclusion), "sized")
    found = with_copies(sized, thresholds(sized, **options), options.get("most", MOST_COPIES))
    return found.select(
        "doc_id",
        "size",
        "source",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mix_sources(docs: DataFrame, inclusion: Column | None = None, **options) -> DataFrame:
    """The documents as often as the mix takes them; all columns as they are.

    The threshold of its source decides on a document, so texts meet one row per source and no more.
    """
    ends = thresholds(materialize(sized_rows(docs, inclusion), "sized"), **options)
    rows = sized_rows(docs, inclusion, keep="*")
    taken = with_copies(rows, ends, options.get("most", MOST_COPIES)).filter("copies > 0")
    copies = F.array_repeat(F.lit(1), F.col("copies").cast("int"))
    return taken.select("_tm_row", F.explode(copies)).select("_tm_row.*")
