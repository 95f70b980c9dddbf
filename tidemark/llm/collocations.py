"""Phrase collocation mining: the best scored phrases of each language, by branch and bound.

Every text is taken apart once: tasks write chunks of about CHUNK words, each with its own
dictionary, the hashes of its words and the text as numbers. From then on passes over the chunks
count phrases in numpy, and Spark adds up the partial counts. Phrases are told apart by the 64-bit
hashes of their words; that no two words share a hash is checked, and otherwise another seed is
taken, so all counts are exact.

The search grows phrases from their prefixes. For a phrase with prefix p and first word w, cutting
after w gives a score of at most SCALE * f(p) / (f(w) + f(p)), as no count exceeds that of a part;
the same holds from the right for the suffix and the last word. Each language has a threshold,
first the score of its pair in place FRONTIER. The frontier, all phrases whose bound reaches the
threshold, is expanded with the phrases that may shadow a candidate. A language is settled when
TOP surviving phrases reach the threshold, since all that reach it are then known, ties included;
otherwise its threshold falls to a place GROWTH times as far down, and after the last place to
zero, where the frontier is everything. So the best branches are expanded first, and only as far
as needed.

Bounds: a chunk, the bitmaps (2**BITS bits each, which only save work: a phrase let through in
error is counted and dropped by its count) and the TOP rows of each language. Words and phrases
themselves are never collected nor broadcast. Rows of a hot word or pair are joined by broadcast of
that one row, see `join_groups`.

Defined results: a null text is empty, a null language is `und`; repeated rows count each time;
other columns are never read. A language without a phrase of LEAST occurrences has no rows, and so
has an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.batches import batch_rows, pieces
from tidemark.llm.spread import join_groups
from tidemark.sources.scratch import materialize

TOP = 2000
#: Occurrences of a candidate, and its longest form in words.
LEAST = 30
LONGEST = 4
SCALE = 2_000_000
#: A phrase is dropped when a longer one has this percentage of its occurrences.
SHADOW = 80
#: Place of the pair whose score is the first threshold, and the factor to the next place.
FRONTIER = 2 * TOP
GROWTH = 4
#: Words of a chunk, bits of a bitmap, rows sent on at a time, bytes of text split at a time.
CHUNK = 1 << 21
BITS = 24
SENT = 1 << 17
SLICE = 1 << 20
#: Languages up to this number are broadcast with their thresholds.
LANGUAGES = 100_000

_TABLE = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r",
    b"abcdefghijklmnopqrstuvwxyz " + b"\xff" * 10,
)
_END = b"\xff"
_CHUNKS = "lang string, words array<string>, hashes array<bigint>, counts array<bigint>, ids binary"


class _Dictionary(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class _Held:
    """Texts of one language as numbers; 0 ends a piece."""

    def __init__(self):
        self.words = _Dictionary({_END: 0})
        self.ids: list[np.ndarray] = []

    def add(self, text: bytes) -> int:
        """Take a text in slices that end between two words; the number of tokens added."""
        data, at, added = text.translate(_TABLE), 0, 0
        while at < len(data):
            cut = data.find(b" ", at + SLICE)
            cut = len(data) if cut < 0 else cut
            found = data[at:cut].replace(_END, b" \xff ").split()
            self.ids.append(np.fromiter(map(self.words.__getitem__, found), np.int32, len(found)))
            added += len(found)
            at = cut
        self.ids.append(np.zeros(1, np.int32))
        return added + 1

    def chunk(self, lang: str, seed: int) -> pa.RecordBatch:
        ids = np.concatenate(self.ids)
        words = list(self.words)[1:]
        prefix = lang.encode() + b"\0"
        hashes = [xxhash.xxh64_intdigest(prefix + w, seed) for w in words]
        counts = np.bincount(ids, minlength=len(words) + 1)[1:]
        ends = pa.array([0, len(words)], pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang]),
                pa.ListArray.from_arrays(ends, pa.array(words, pa.binary()).cast(pa.string())),
                pa.ListArray.from_arrays(ends, pa.array(np.array(hashes, np.uint64).view(np.int64))),
                pa.ListArray.from_arrays(ends, pa.array(counts.astype(np.int64))),
                pa.array([ids.tobytes()], pa.binary()),
            ],
            names=[c.split()[0] for c in _CHUNKS.split(", ")],
        )


def _encoder(seed: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Held] = {}
        tokens = 0
        for rows, texts in pieces(batches):
            for lang, text in zip(rows.column("lang").to_pylist(), texts, strict=True):
                if lang not in held:
                    held[lang] = _Held()
                tokens += held[lang].add(text or b"")
                if tokens >= CHUNK:
                    for name in list(held):
                        yield held.pop(name).chunk(name, seed)
                    tokens = 0
        for name in list(held):
            yield held.pop(name).chunk(name, seed)

    return encode


def chunks_and_words(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The encoded texts, and (lang, h, word, f) of every word with its 64-bit hash."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    seed = 0
    while True:
        with batch_rows(docs.sparkSession, 500):
            chunks = materialize(rows.mapInArrow(_encoder(seed), _CHUNKS), "chunks")
        entry = F.explode(F.arrays_zip("words", "hashes", "counts")).alias("e")
        words = (
            chunks.select("lang", entry)
            .select("lang", F.col("e.hashes").alias("h"), F.col("e.words").alias("word"), "e.counts")
            .groupBy("lang", "h", "word")
            .agg(F.sum("counts").alias("f"))
        )
        words = materialize(words, "words")
        if words.groupBy("h").count().filter("count > 1").isEmpty():
            return chunks, words
        seed += 1


# --- bitmaps ------------------------------------------------------------------------------------


def _turn(value: Column, by: int) -> Column:
    return F.shiftleft(value, by).bitwiseOR(F.shiftrightunsigned(value, 64 - by)) if by else value


def _mixed(columns: list[str]) -> Column:
    """One number for a phrase; different phrases may share it."""
    return reduce(
        lambda a, b: a.bitwiseXOR(b), (_turn(F.col(c), 21 * k) for k, c in enumerate(columns))
    )


def _mixed_array(hashes: list[np.ndarray]) -> np.ndarray:
    """The same for arrays of unsigned hashes."""
    total = hashes[0].copy()
    for k, h in enumerate(hashes[1:], 1):
        total ^= (h << np.uint64(21 * k)) | (h >> np.uint64(64 - 21 * k))
    return total


def bitmap(phrases: DataFrame, columns: list[str], bits: int = BITS) -> np.ndarray:
    """2**bits bits that are set for the phrases given: at most 2**(bits - 6) rows are collected."""
    slot = _mixed(columns).bitwiseAND(F.lit((1 << bits) - 1))
    one = F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")
    found = (
        phrases.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("at"))
        .agg(F.bit_or(one).alias("value"))
        .toPandas()
    )
    words = np.zeros(1 << (bits - 6), np.int64)
    words[found["at"].to_numpy(np.int64)] = found["value"].to_numpy(np.int64)
    return words.view(np.uint64)


def _has(words: np.ndarray, mixed: np.ndarray) -> np.ndarray:
    slot = mixed & np.uint64(len(words) * 64 - 1)
    return (words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


# --- counting -----------------------------------------------------------------------------------


def _unique_rows(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Different rows of local word numbers and how often each occurs."""
    first = columns[0].astype(np.int64) << 32 | columns[1]
    if len(columns) == 2:
        found, n = np.unique(first, return_counts=True)
        return [found >> 32, found & 0xFFFFFFFF], n
    pairs, at = np.unique(first, return_inverse=True)
    rest, n = _unique_rows([at.astype(np.int64), *columns[2:]])
    return [pairs[rest[0]] >> 32, pairs[rest[0]] & 0xFFFFFFFF, *rest[1:]], n


def _counter(length: int, wanted):
    """Counts the phrases of a length for which `wanted(hashes of the words by place)` holds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                own = batch.column("hashes")[row].values.to_numpy(zero_copy_only=False)
                hashes = np.concatenate([np.zeros(1, np.int64), own])
                ids = np.frombuffer(batch.column("ids")[row].as_buffer(), np.int32)
                at = np.flatnonzero(ids[: len(ids) - length + 1])
                for k in range(1, length):
                    at = at[ids[at + k] != 0]
                places = [ids[at + k] for k in range(length)]
                unsigned = hashes.view(np.uint64)
                keep = wanted([unsigned[p] for p in places])
                places = [p[keep] for p in places]
                if not len(places[0]):
                    continue
                found, n = _unique_rows(places)
                arrays = [hashes[p] for p in found] + [n.astype(np.int64)]
                for start in range(0, len(n), SENT):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a[start : start + SENT]) for a in arrays],
                        names=[*_places(length), "n"],
                    )

    return count


def _places(length: int) -> list[str]:
    return [f"h{k}" for k in range(1, length + 1)]


def _counted(chunks: DataFrame, length: int, wanted, label: str) -> DataFrame:
    """(h1, ..., a) of the wanted phrases that occur LEAST times."""
    names = _places(length)
    schema = ", ".join(f"{c} bigint" for c in [*names, "n"])
    with batch_rows(chunks.sparkSession, 1):
        partial = chunks.select("hashes", "ids").mapInArrow(_counter(length, wanted), schema)
        counts = partial.groupBy(*names).agg(F.sum("n").alias("a"))
        return materialize(counts.filter(F.col("a") >= LEAST), label)


def _share(numerator: str, denominator: str) -> Column:
    """floor(SCALE * numerator / denominator), exactly."""
    return F.expr(f"CAST({SCALE} * CAST({numerator} AS DECIMAL(24,0)) AS DECIMAL(38,0)) div ({denominator})")


def _beside(rows: DataFrame, facts: DataFrame, on: list[str], label: str) -> DataFrame:
    """Rows with the columns of the one fact of their key, hot keys by broadcast."""
    keyed = rows.withColumn("key", F.struct(*on))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("size"))
    groups = facts.withColumn("key", F.struct(*on)).drop(*on).join(sizes, "key")
    return join_groups(keyed, materialize(groups, label), "key", "size").drop("key", "size")


def _scored(phrases: DataFrame, cuts: list[tuple[str, str]], first: str, last: str) -> DataFrame:
    """Score with l and r of the lowest cut (the first of equal ones), and both bounds."""
    ways = [
        F.struct(_share("a", f"{l} + {r}").alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"), F.col(r).alias("r"))
        for k, (l, r) in enumerate(cuts, 1)
    ]
    low = F.least(*ways) if len(ways) > 1 else ways[0]
    return (
        phrases.withColumn("low", low)
        .withColumns({c: F.col(f"low.{c}") for c in ("score", "l", "r")})
        .drop("low")
        .withColumn("prefix_bound", _share("a", f"{first} + a"))
        .withColumn("suffix_bound", _share("a", f"{last} + a"))
    )


def _pairs(chunks: DataFrame, words: DataFrame) -> DataFrame:
    frequent = materialize(words.filter(F.col("f") >= LEAST), "frequent")
    sieve = chunks.sparkSession.sparkContext.broadcast(bitmap(frequent, ["h"]))

    def both_frequent(hashes: list[np.ndarray]) -> np.ndarray:
        return _has(sieve.value, hashes[0]) & _has(sieve.value, hashes[1])

    found = _counted(chunks, 2, both_frequent, "pairs")
    first = frequent.select(F.col("h").alias("h1"), F.col("f").alias("f1"), "lang")
    second = frequent.select(F.col("h").alias("h2"), F.col("f").alias("f2"))
    found = _beside(_beside(found, first, ["h1"], "firsts"), second, ["h2"], "seconds")
    return materialize(_scored(found, [("f1", "f2")], "f1", "f2"), "scored_pairs")


def _with_threshold(phrases: DataFrame, thresholds: DataFrame, small: bool) -> DataFrame:
    return phrases.join(F.broadcast(thresholds) if small else thresholds, "lang")


def _triples(chunks: DataFrame, pairs: DataFrame) -> DataFrame:
    """Triples of which the first pair is in the frontier, or from the right the last."""
    on = ["h1", "h2"]
    send = chunks.sparkSession.sparkContext.broadcast
    known = send(bitmap(pairs, on))
    prefixes = send(bitmap(pairs.filter("prefix_bound >= threshold"), on))
    suffixes = send(bitmap(pairs.filter("suffix_bound >= threshold"), on))

    def wanted(hashes: list[np.ndarray]) -> np.ndarray:
        left, right = _mixed_array(hashes[:2]), _mixed_array(hashes[1:])
        grown = _has(prefixes.value, left) & _has(known.value, right)
        return grown | (_has(known.value, left) & _has(suffixes.value, right))

    found = _counted(chunks, 3, wanted, "triples")
    left = pairs.select("h1", "h2", F.col("a").alias("a12"), "f1", "f2", "lang", "threshold")
    right = pairs.select(
        F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("a23"), F.col("f2").alias("f3")
    )
    found = _beside(_beside(found, left, on, "lefts"), right, ["h2", "h3"], "rights")
    return materialize(_scored(found, [("f1", "a23"), ("a12", "f3")], "f1", "f3"), "scored_triples")


def _quads(chunks: DataFrame, triples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Quads that may reach the threshold, with their scores, and all that may shadow a triple."""
    on = ["h1", "h2", "h3"]
    send = chunks.sparkSession.sparkContext.broadcast
    prefixes = send(bitmap(triples.filter("prefix_bound >= threshold"), on))
    suffixes = send(bitmap(triples.filter("suffix_bound >= threshold"), on))
    reached = send(bitmap(triples.filter("score >= threshold"), on))

    def wanted(hashes: list[np.ndarray]) -> np.ndarray:
        left, right = _mixed_array(hashes[:3]), _mixed_array(hashes[1:])
        grown = _has(prefixes.value, left) & _has(suffixes.value, right)
        return grown | _has(reached.value, left) | _has(reached.value, right)

    counted = _counted(chunks, 4, wanted, "quads")
    grows = triples.filter("prefix_bound >= threshold")
    left = grows.select(*on, F.col("a").alias("a123"), "a12", "f1", "lang", "threshold")
    grows = triples.filter("suffix_bound >= threshold")
    right = grows.select(
        *(F.col(f"h{k}").alias(f"h{k + 1}") for k in (1, 2, 3)),
        F.col("a").alias("a234"),
        F.col("a23").alias("a34"),
        F.col("f3").alias("f4"),
    )
    found = _beside(_beside(counted, left, on, "lefts"), right, ["h2", "h3", "h4"], "rights")
    cuts = [("f1", "a234"), ("a12", "a34"), ("a123", "f4")]
    return materialize(_scored(found, cuts, "f1", "f4"), "scored_quads"), counted


def _unshadowed(phrases: DataFrame, longer: DataFrame, length: int) -> DataFrame:
    """Phrases at their threshold that no phrase with one word more, on either side, shadows."""
    names = _places(length)
    after = longer.select(*names, F.col("a").alias("by"))
    before = longer.select(
        *(F.col(f"h{k + 1}").alias(f"h{k}") for k in range(1, length + 1)), F.col("a").alias("by")
    )
    most = after.unionByName(before).groupBy(*names).agg(F.max("by").alias("by"))
    shadowed = F.coalesce(100 * F.col("by") >= SHADOW * F.col("a"), F.lit(False))
    return phrases.filter("score >= threshold").join(most, names, "left").filter(~shadowed)


def _best(phrases: DataFrame) -> DataFrame:
    """What may be among the first TOP of its language by score and count."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    return phrases.withColumn("place", F.rank().over(order)).filter(F.col("place") <= TOP).drop("place")


def _thresholds(pairs: DataFrame, place: int) -> DataFrame:
    """Per language the score of the pair in a place, 0 where there are fewer."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"))
    ranked = pairs.select("lang", "score").withColumn("place", F.row_number().over(order))
    found = ranked.filter(F.col("place") <= place).groupBy("lang")
    at = F.when(F.max("place") == place, F.min("score")).otherwise(0)
    return found.agg(at.cast("long").alias("threshold"))


def _survivors(chunks: DataFrame, pairs: DataFrame, thresholds: DataFrame, small: bool) -> DataFrame:
    """All surviving phrases at the threshold of their language, with those in the first places."""
    pairs = materialize(_with_threshold(pairs, thresholds, small), "frontier")
    triples = _triples(chunks, pairs)
    quads, longer = _quads(chunks, triples)
    common = ["lang", "a", "l", "r", "score", "threshold"]
    levels = [
        (_unshadowed(pairs, triples, 2), 2),
        (_unshadowed(triples, longer, 3), 3),
        (quads.filter("score >= threshold"), 4),
    ]
    parts = [
        rows.select(*common, *(F.col(h) if h in _places(k) else F.lit(None).cast("long").alias(h) for h in _places(4)))
        for rows, k in levels
    ]
    return materialize(reduce(DataFrame.unionByName, parts), "survivors")


def collocations(docs: DataFrame) -> DataFrame:
    """The first TOP phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    spark: SparkSession = docs.sparkSession
    chunks, words = chunks_and_words(docs)
    totals = materialize(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    small = totals.count() <= LANGUAGES
    pairs = _pairs(chunks, words)
    found, place = [], FRONTIER
    open_ = totals.select("lang")
    while not open_.isEmpty():
        marks = materialize(_thresholds(pairs, place).join(open_, "lang"), "thresholds")
        some = chunks.join(F.broadcast(marks.select("lang")) if small else marks.select("lang"), "lang", "left_semi")
        alive = _survivors(some, pairs, marks, small)
        reached = alive.groupBy("lang").count()
        left = marks.join(reached, "lang", "left").filter("threshold > 0")
        open_ = materialize(left.filter(F.coalesce("count", F.lit(0)) < TOP).select("lang"), "open")
        found.append(materialize(_best(alive.join(open_, "lang", "left_anti")), "settled"))
        place *= GROWTH
    settled = reduce(DataFrame.unionByName, found) if found else None
    if settled is None:
        empty = "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint"
        return spark.createDataFrame([], empty)
    named = settled
    for k, h in enumerate(_places(4), 1):
        one = words.filter(F.col("f") >= LEAST).select(F.col("h").alias(h), F.col("word").alias(f"w{k}"))
        named = named.join(one, h, "left")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        named.withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3", "w4"))
        .withColumn("rank", F.row_number().over(order).cast("long"))
        .filter(F.col("rank") <= TOP)
        .join(F.broadcast(totals) if small else totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
