"""Near duplicates by SimHash: an inverted index over positional bytes with count filtering.

Two 64-bit fingerprints that differ in at most 3 bits differ in at most 3 of their 8 bytes, so they
share at least 5 (byte position, value) entries. Lists of single bytes would hold a 256th of all
fingerprints each, so the lists are kept per set of four positions: the 14 sets {a, b, c, a^b^c}
contain a full match for any pair that shares 5 positions. Pairs of a list are tallied (how many of
the 8 positional bytes agree), those with 5 or more are verified bit by bit.

Lists hold different fingerprints only, so copies cost nothing. A list that is still long is split
by each of the four other positions; a pair to be found shares one of them too. What is left of a
fingerprint then is 24 bits, and a task links such a list through a table of these 2**24 values, in
time and memory proportional to the list; it gives one link per member and never all pairs.

Defined results: null and empty texts, and those of white space, have fingerprint zero and are
linked like any other; a text shorter than a shingle is one shingle; a group with null ids only has
a null component; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import pieces, small_batches
from tidemark.llm.components import components
from tidemark.llm.spread import join_groups, keep_decided, text_key
from tidemark.sources.scratch import materialize

#: Words of a shingle.
WIDTH = 3
#: Fingerprints are linked up to this many different bits.
MAX_BITS = 3
#: Positional bytes that linked fingerprints share at least.
LEAST_SHARED = 8 - MAX_BITS
#: Lists up to this length are paired by a join, so an entry meets at most as many others.
PAIRED = 64
#: Lists up to this length are compared in blocks inside a task, longer ones through a table.
COMPARED = 4096

QUADS = [q for q in combinations(range(8), 4) if q[0] ^ q[1] ^ q[2] ^ q[3] == 0]


def _mask(positions) -> int:
    """The bits of these bytes, as a signed 64-bit number."""
    value = sum(0xFF << (8 * p) for p in positions)
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: bytes | None, width: int = WIDTH) -> int:
    """SimHash of a text as a signed 64-bit number."""
    words = (text or b"").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    n = max(1, len(words) - width + 1)
    spans = zip((ends - lengths)[:n].tolist(), ends[-n:].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in spans), np.uint64, n)
    bits = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):
        some = hashes[at : at + (1 << 14)].view(np.uint8)
        bits += np.unpackbits(some).reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(bits * 2 > n).view(np.int64)[0])


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, text_key and fp of every row."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in pieces(batches):
            fps = pa.array([fingerprint(t, width) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("text_key"), fps],
                names=["doc_id", "text_key", "fp"],
            )

    rows = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("text_key", T.LongType()),
            T.StructField("fp", T.LongType()),
        ]
    )
    return small_batches(rows).mapInArrow(hashed, schema)


def _listed(fps: DataFrame, masks: list[int], label: str) -> DataFrame:
    """Entries (list, key, fp, n) of all lists with two fingerprints or more."""
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])
    entries = fps.select("fp", F.posexplode(keys).alias("list", "key"))
    sizes = entries.groupBy("list", "key").agg(F.count("*").alias("n")).filter("n > 1")
    return materialize(entries.join(sizes, ["list", "key"]), label)


def _tally(a: str, b: str):
    """How many positional bytes two fingerprints share."""
    other = F.col(a).bitwiseXOR(F.col(b))
    same = [F.when(other.bitwiseAND(F.lit(_mask([p]))) == 0, 1).otherwise(0) for p in range(8)]
    return sum(same[1:], same[0])


def _lowest(labels: np.ndarray, values: np.ndarray) -> np.ndarray:
    """One round over all pairs in blocks: each member takes the lowest label it is linked to."""
    found = labels.copy()
    for at in range(0, len(values), 512):
        near = np.bitwise_count(values[at : at + 512, None] ^ values[None, :]) <= MAX_BITS
        found[at : at + 512] = np.where(near, labels[None, :], len(values)).min(1)
    return found


def _through_table(labels: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The same through a table of the 2**24 values of the three free bytes.

    Members are linked at up to 3 bits when a value is within 1 bit of one and 2 of the other, and
    all members within 1 bit of the same value are linked. So a value with a member within 1 bit
    joins all members within 2.
    """
    ones = [0, *(1 << i for i in range(24))]
    twos = [a | b for a, b in combinations(ones[1:], 2)]
    table = np.full(1 << 24, len(values), np.int32)
    found = labels.astype(np.int32)
    for bit in ones:
        table[values ^ bit] = np.minimum(table[values ^ bit], found)
    centre = table < len(values)
    for bits in twos:
        at = values ^ bits
        joined = centre[at]
        table[at[joined]] = np.minimum(table[at[joined]], found[joined])
    for bits in (*ones, *twos):
        found = np.minimum(found, table[values ^ bits])
    return found


def _linked(values: np.ndarray) -> np.ndarray:
    """For each of the different values (the free 24 bits) the index of the first it reaches."""
    labels = np.arange(len(values))
    one_round = _lowest if len(values) <= COMPARED else _through_table
    while True:
        found = one_round(labels, values)
        found = found[found]
        if (found == labels).all():
            return labels
        labels = found


def _list_links(masks: list[int]):
    free = {m: [p for p in range(8) if not (m >> (8 * p)) & 0xFF] for m in masks}

    def links(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        fps = np.sort(rows["fp"].to_numpy(np.int64))
        as_bytes = fps.view(np.uint8).reshape(-1, 8)
        values = sum(as_bytes[:, p].astype(np.int32) << (8 * i) for i, p in enumerate(free[masks[key[0]]]))
        first = _linked(values)
        return pd.DataFrame({"u": fps, "v": fps[first]})[first != np.arange(len(fps))]

    return links


def links(fps: DataFrame, paired: int = PAIRED) -> DataFrame:
    """Edges (u, v) between different fingerprints that connect what 3 bits or fewer connect."""
    quads = _listed(fps, [_mask(q) for q in QUADS], "lists")
    short = quads.filter(F.col("n") <= paired)
    pairs = short.withColumnRenamed("fp", "u").join(
        short.select("list", "key", F.col("fp").alias("v")), ["list", "key"]
    )
    pairs = pairs.filter((F.col("u") < F.col("v")) & (_tally("u", "v") >= LEAST_SHARED))
    close = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= MAX_BITS
    fives = [_mask(p) for p in combinations(range(8), LEAST_SHARED)]
    long = quads.filter(F.col("n") > paired).select("fp").distinct()
    split = _listed(long, fives, "long_lists")
    schema = "u bigint, v bigint"
    hubs = split.groupBy("list", "key").applyInPandas(_list_links(fives), schema)
    return pairs.filter(close).select("u", "v").unionByName(hubs)


def near_groups(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, text_key, fp and `first` (doc_id and text_key of the group's first document)."""
    hashed = materialize(fingerprints(docs, width), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    fps = materialize(
        hashed.groupBy("fp").agg(first.alias("first"), F.count("*").alias("n")), "fps"
    )
    edges = links(fps.select("fp"))
    linked = components(edges).withColumnRenamed("node", "fp").join(fps, "fp")
    linked = materialize(linked.select("fp", "root", "first"), "linked")
    groups = materialize(
        linked.groupBy("root").agg(
            F.min("first").alias("group_first"), F.count("*").alias("members")
        ),
        "components",
    )
    regrouped = join_groups(linked.drop("first"), groups, "root", "members")
    labels = fps.join(regrouped.select("fp", "group_first"), "fp", "left").select(
        "fp", "n", F.coalesce("group_first", "first").alias("first")
    )
    labelled = join_groups(hashed, materialize(labels, "labels"), "fp", "n")
    return labelled.select("doc_id", "text_key", "fp", "first")


def drop_near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Documents (doc_id, text, any others) with the first of each group."""
    grouped = near_groups(docs, width)
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (
        F.col("text_key") == F.col("first.text_key")
    )
    decided = grouped.select("doc_id", "text_key", same.alias("kept"))
    return keep_decided(docs, materialize(decided, "near"))
