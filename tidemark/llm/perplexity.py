"""Perplexity of texts under a word model of the whole corpus.

The model is an interpolated modified Kneser-Ney model of word pairs: pairs back off to the number of
words that a word follows, and these to the spelling of the word, a model of 3 symbols that is learned
from the different words. Spark counts the pairs of all documents; words are told apart by 32-bit
hashes, a pair by both. What is counted grows with the corpus and is never collected or broadcast
but for the spelling, which has 64**3 entries at most.

Texts are read once, in blocks of a bounded number of words, and kept as numbers into the words of
their block. A block sends each of its different pairs once, so that neither a frequent word nor a
copied text makes a key hot: sorted, as packed differences, dealt out by the hashes of both words to a
square of cells. A word stands in one row and one column of that square, so a frequent one is shared by
many tasks. A cell counts its pairs and answers each block in the order of its question. What a cell
knows of single words goes to the class of the word, where the rows and columns meet, and from there to
the blocks that hold the word. A document is measured by what the other texts hold: its own pairs, and
those of its exact copies, are taken off the counts.

Pairs, and later documents, pass their shuffle in parts, of which Spark deletes the files one after
the other, so that no disk holds them all at a time.

Defined results: a null text is empty; a text without words has no perplexity; equal texts have equal
figures; an empty table gives no rows. Words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import pieces, small_batches
from tidemark.llm.spelling import KneserNey, discounts, grams
from tidemark.sources.scratch import materialize, short_shuffles

#: Words of a block (a text counts one more), and different words of it, at which it ends; a longer
#: text is a block alone.
BLOCK_WORDS = 3_000_000
BLOCK_TYPES = 400_000
#: Words of the corpus for each cell of the square that pairs are dealt to.
CELL_WORDS = 2_000_000
#: Parts in which pairs, and documents with what is known of them, pass their shuffles.
PAIR_ROUNDS = 2
TEXT_ROUNDS = 4
#: Symbols of the spelling model: at most 64**3 different grams, which are broadcast.
SPELLING = 3
#: Different words that are spelled at a time, and words of texts that are scored at a time.
SPELLED = 20_000
SCORED = 200_000
#: Kinds of rows of a block.
BLOCK, DOCUMENT, COPIES, PAIRS, WORDS = range(5)
#: Kinds of rows of a class of words.
FIRST, SECOND, ASKED, TOTALS = range(10, 14)
_HIGH, _LOW = np.uint64(32), np.uint64(0xFFFFFFFF)


def pack(values: np.ndarray) -> bytes:
    """Numbers of a fixed width, compressed byte place by byte place, after how many there are."""
    places = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize)
    return len(values).to_bytes(8, "little") + pa.Codec("zstd").compress(places.T.tobytes(), asbytes=True)


def unpack(packed: bytes, dtype: type = np.int64) -> np.ndarray:
    size, width = int.from_bytes(packed[:8], "little"), np.dtype(dtype).itemsize
    if not size:
        return np.zeros(0, dtype)
    places = np.frombuffer(pa.Codec("zstd").decompress(packed[8:], size * width), np.uint8)
    return np.ascontiguousarray(places.reshape(width, size).T).view(dtype).reshape(size)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending unsigned numbers as differences."""
    return pack(np.diff(keys.astype(np.uint64), prepend=np.uint64(0)))


def unpack_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack(packed, np.uint64), dtype=np.uint64)


def hash_pairs(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """64 bits a pair of neighbours: the hash of the first word, then that of the second."""
    own = hashes[row]
    return (own[:-1] << _HIGH) | own[1:]


def cell_of(keys: np.ndarray, side: int) -> np.ndarray:
    """The cell of each pair: the class of the first word is its row, that of the second its column."""
    return ((keys >> _HIGH) % np.uint64(side) * np.uint64(side) + (keys & _LOW) % np.uint64(side)).astype(np.int64)


def dealt(parts: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order by part, stable, and (part, start, end) of each part that is there."""
    order = np.argsort(parts, kind="stable")
    there, starts = np.unique(parts[order], return_index=True)
    ends = [*starts[1:].tolist(), len(parts)]
    return order, list(zip(there.tolist(), starts.tolist(), ends))


class Block:
    """Different words and the texts of a block; word 0 is the edge of a text."""

    def __init__(self) -> None:
        # A new word gets the next number when it is looked up.
        self.index: defaultdict[bytes, int] = defaultdict(itertools.count(1).__next__, {b"": 0})
        self.texts: list[np.ndarray] = []
        self.size = 0

    def add(self, words: list[bytes]) -> int:
        """Take a text; its place among those with words, or -1."""
        self.size += len(words) + 1
        if not words:
            return -1
        self.texts.append(np.fromiter(map(self.index.__getitem__, words), np.uint32, len(words)))
        return len(self.texts) - 1

    def packed(self) -> tuple[bytes, bytes]:
        """The words, and the texts as their numbers with an edge before, between and after."""
        edge = np.zeros(1, np.uint32)
        row = np.concatenate([edge, *(x for t in self.texts for x in (t, edge))])
        names = sorted(self.index)
        own = np.fromiter(map(self.index.__getitem__, names), np.int64, len(names))
        # Small numbers for frequent words; words about as frequent stay in the order of the alphabet.
        often = np.frexp(np.bincount(row, minlength=len(names)).astype(np.float64))[1]
        often[0] = 64
        order = np.argsort(-often[own], kind="stable")
        number = np.empty(len(names), np.uint32)
        number[own[order]] = np.arange(len(names), dtype=np.uint32)
        joined = b"\n".join([names[k] for k in order])
        return pack(np.frombuffer(joined, np.uint8)), pack(number[row])


def words_of(packed: bytes) -> tuple[list[bytes], np.ndarray]:
    """The words of a block by number, and their hashes."""
    names = unpack(packed, np.uint8).tobytes().split(b"\n")
    return names, np.fromiter(map(zlib.crc32, names), np.uint64, len(names))


def encoded(docs: DataFrame, counts: tuple[str, ...], count: Callable) -> DataFrame:
    """Rows of the kinds BLOCK and DOCUMENT, from one pass over doc_id, lang and text.

    `count(text)` gives the figures named by `counts`, of which the first is the number of words,
    and whether the counting rules reject the text.
    """
    out = T.StructType(
        [
            T.StructField("kind", T.IntegerType()),
            T.StructField("block", T.LongType()),
            T.StructField("key", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("lang", T.StringType()),
            *[T.StructField(c, T.LongType()) for c in counts],
            T.StructField("base_failed", T.BooleanType()),
            T.StructField("words", T.BinaryType()),
            T.StructField("texts", T.BinaryType()),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 32, 0
        block, schema = Block(), None

        def rows_of(kind: int, size: int, **columns) -> pa.RecordBatch:
            columns |= {
                "kind": pa.array(np.full(size, kind, np.int32)),
                "block": pa.array(np.full(size, base + number, np.int64)),
            }
            return pa.RecordBatch.from_arrays(
                [columns[f.name] if f.name in columns else pa.nulls(size, f.type) for f in schema],
                schema=schema,
            )

        def ended() -> pa.RecordBatch:
            words, texts = block.packed()
            return rows_of(BLOCK, 1, words=pa.array([words]), texts=pa.array([texts]))

        for rows, texts in pieces(batches):
            if schema is None:
                ids = rows.schema.field("doc_id").type
                types = {"doc_id": ids, "kind": pa.int32(), "lang": pa.string()}
                types |= {"base_failed": pa.bool_(), "words": pa.binary(), "texts": pa.binary()}
                schema = pa.schema([(f.name, types.get(f.name, pa.int64())) for f in out])
            found = [count(t or b"") for t in texts]
            places, keys = [], []
            for text in texts:
                places.append(block.add((text or b"").lower().split()))
                digest = hashlib.blake2b(text or b"", digest_size=8).digest()
                keys.append(int.from_bytes(digest, "little", signed=True))
            figures = np.array([f for f, _ in found], np.int64).reshape(-1, len(counts))
            yield rows_of(
                DOCUMENT,
                len(texts),
                key=pa.array(keys, pa.int64()),
                n=pa.array(places, pa.int64()),
                doc_id=rows.column("doc_id"),
                lang=rows.column("lang").cast(pa.string()),
                base_failed=pa.array([f for _, f in found], pa.bool_()),
                **{c: pa.array(figures[:, k]) for k, c in enumerate(counts)},
            )
            if block.size >= BLOCK_WORDS or len(block.index) >= BLOCK_TYPES:
                yield ended()
                block, number = Block(), number + 1
        if schema is not None:
            yield ended()

    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang")
    return small_batches(docs.select("doc_id", lang, "text")).mapInArrow(encode, out)


@dataclass
class Corpus:
    """Figures of the whole corpus: what is taken off the counts, and the different pairs."""

    pair_off: np.ndarray
    word_off: np.ndarray
    pairs: int
    #: Weight of the spelling: what is taken off all words, over the pairs.
    spelled: float


def spelling_of(words: DataFrame) -> np.ndarray | None:
    """The spelling model of the different words (word): log probabilities of all grams."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 6 * SPELLING, np.int64)
        for batch in batches:
            found, _ = grams(batch.column("word").to_pylist(), SPELLING)
            total += np.bincount(found, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["gram", "n"])

    counted = words.select("word").mapInArrow(count, "gram bigint, n bigint")
    # At most 64**SPELLING rows.
    table = counted.groupBy("gram").agg(F.sum("n").alias("n")).orderBy("gram").toPandas()
    if table.empty:
        return None
    model = KneserNey(table["gram"].to_numpy(np.int64), table["n"].to_numpy(np.int64), SPELLING)
    return model.gram_scores()


def different_words(blocks: DataFrame) -> DataFrame:
    """(key, word) of the words of all blocks."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column("words"):
                names, hashes = words_of(packed.as_py())
                for at in range(0, len(names), 100_000):
                    words = [w.decode("utf-8", "replace") for w in names[at : at + 100_000]]
                    keys = pa.array(hashes[at : at + 100_000].astype(np.int64))
                    yield pa.RecordBatch.from_arrays([keys, pa.array(words, pa.string())], names=["key", "word"])

    named = blocks.select("words").mapInArrow(name, "key bigint, word string")
    return named.groupBy("key").agg(F.min("word").alias("word"))


def asked_pairs(blocks: DataFrame, side: int, part: int) -> DataFrame:
    """(cell, block, keys, times): the different pairs of each block in this part of the cells."""
    rounds = PAIR_ROUNDS

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words, texts in zip(*(batch.column(c) for c in ("block", "words", "texts"))):
                _, hashes = words_of(words.as_py())
                keys = hash_pairs(hashes, unpack(texts.as_py(), np.uint32))
                keys = keys[cell_of(keys, side) % rounds == part]
                keys, times = np.unique(keys, return_counts=True)
                order, cells = dealt(cell_of(keys, side))
                keys, times = keys[order], times[order]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([c for c, _, _ in cells], pa.int64()),
                        pa.array([block.as_py()] * len(cells), pa.int64()),
                        pa.array([pack_sorted(keys[s:e]) for _, s, e in cells], pa.binary()),
                        pa.array([pack(times[s:e]) for _, s, e in cells], pa.binary()),
                    ],
                    names=["cell", "block", "keys", "times"],
                )

    columns = "cell bigint, block bigint, keys binary, times binary"
    return blocks.select("block", "words", "texts").mapInArrow(ask, columns)


_COUNTED = pa.schema(
    [
        ("kind", pa.int32()),
        ("block", pa.int64()),
        ("at", pa.int64()),
        ("keys", pa.binary()),
        ("values", pa.binary()),
        *[(c, pa.int64()) for c in ("t1", "t2", "t3", "t4", "different")],
    ]
)
_COUNTED_DDL = (
    "kind int, block bigint, at bigint, keys binary, values binary, "
    "t1 bigint, t2 bigint, t3 bigint, t4 bigint, different bigint"
)


def _counted(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=_COUNTED)


def _totals(counts: np.ndarray) -> dict:
    """How many of the counts are 1 to 4, and how many there are."""
    found = {f"t{k}": int((counts == k).sum()) for k in (1, 2, 3, 4)}
    return {"kind": TOTALS, "different": len(counts)} | found


def counted_pairs(asked: DataFrame, side: int) -> DataFrame:
    """Of each cell what other blocks hold of a block's pairs (PAIRS, in the order asked), what it
    knows of first and second words, and how often its pairs are there."""

    def count(table: pa.Table) -> pa.Table:
        cell, blocks = table["cell"][0].as_py(), table["block"].to_pylist()
        keys = [unpack_sorted(k) for k in table["keys"].to_pylist()]
        times = np.concatenate([unpack(t) for t in table["times"].to_pylist()])
        ends = np.cumsum([len(k) for k in keys])
        pairs, where = np.unique(np.concatenate(keys), return_inverse=True)
        c = np.zeros(len(pairs), np.int64)
        np.add.at(c, where, times)
        others = c[where] - times
        rows = [
            {"kind": PAIRS, "block": b, "at": cell, "values": pack(others[e - len(k) : e])}
            for b, k, e in zip(blocks, keys, ends.tolist())
        ]
        first, starts = np.unique(pairs >> _HIGH, return_index=True)
        own = [np.add.reduceat(x.astype(np.int64), starts) for x in (c, c == 1, c == 2, c > 2)]
        second, after = np.unique(pairs & _LOW, return_counts=True)
        for kind, at, words, values in (
            (FIRST, cell // side, first, np.concatenate(own)),
            (SECOND, cell % side, second, after),
        ):
            rows.append({"kind": kind, "at": at, "keys": pack_sorted(words), "values": pack(values)})
        return _counted([*rows, _totals(c)])

    return asked.groupBy("cell").applyInArrow(count, _COUNTED_DDL)


def asked_words(blocks: DataFrame, side: int) -> DataFrame:
    """The words of each block by class, beside what the cells know of a class."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words in zip(batch.column("block"), batch.column("words")):
                keys = np.unique(words_of(words.as_py())[1])
                order, classes = dealt(keys % np.uint64(side))
                rows = [
                    {"kind": ASKED, "block": block.as_py(), "at": int(c), "keys": pack_sorted(keys[order][s:e])}
                    for c, s, e in classes
                ]
                yield from _counted(rows).to_batches()

    return blocks.select("block", "words").mapInArrow(ask, _COUNTED_DDL)


def counted_words(rows: DataFrame) -> DataFrame:
    """Of each class the figures of a block's words (WORDS, in the order asked), and how often words
    follow different ones."""

    def merged(table: pa.Table, kind: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        own = table.filter(pc.equal(table["kind"], kind))
        keys = [unpack_sorted(k) for k in own["keys"].to_pylist()]
        values = [unpack(v).reshape(width, -1) for v in own["values"].to_pylist()]
        words, where = np.unique(np.concatenate([np.zeros(0, np.uint64), *keys]), return_inverse=True)
        total = np.zeros((width, len(words)), np.int64)
        for k, row in enumerate(total):
            np.add.at(row, where, np.concatenate([np.zeros(0, np.int64), *(v[k] for v in values)]))
        return words, total

    def count(table: pa.Table) -> pa.Table:
        # Every word is the first of a pair, and the second of one.
        words, first = merged(table, FIRST, 4)
        _, second = merged(table, SECOND, 1)
        asked = table.filter(pc.equal(table["kind"], ASKED))
        figures = np.concatenate([first, second])
        rows = []
        for block, at, keys in zip(*(asked[c].to_pylist() for c in ("block", "at", "keys"))):
            # The edge of a text is no part of a corpus without words.
            own = np.searchsorted(words, unpack_sorted(keys)) if len(words) else np.zeros(0, np.int64)
            rows.append({"kind": WORDS, "block": block, "at": at, "values": pack(figures[:, own].ravel())})
        return _counted([*rows, _totals(second[0])])

    return rows.groupBy("at").applyInArrow(count, _COUNTED_DDL)


def _off(rows: DataFrame) -> tuple[np.ndarray, float, int]:
    """Discounts from the counts of counts, what they take off in all, and how many counts there are."""
    names = ("t1", "t2", "t3", "t4", "different")
    found = rows.filter(F.col("kind") == TOTALS).agg(*[F.sum(c).alias(c) for c in names]).first()
    t1, t2, t3, t4, different = (found[c] or 0 for c in names)
    off = discounts([t1, t2, t3, t4])
    return off, t1 * off[0] + t2 * off[1] + (different - t1 - t2) * off[2], different


def _left(counts: np.ndarray, off: np.ndarray) -> np.ndarray:
    """What is left of the counts after the discounts."""
    return np.where(counts > 0, counts - off[np.clip(counts, 1, 3) - 1], 0.0)


class Measure:
    """Perplexities of the texts of one block, given as they are stored."""

    def __init__(self, corpus: Corpus, hashes: np.ndarray, row: np.ndarray, side: int) -> None:
        self.corpus, self.hashes, self.row, self.side = corpus, hashes, row, side
        self.edges = np.flatnonzero(row == 0)
        self.keys, self.where, self.counts = np.unique(
            hash_pairs(hashes, row), return_inverse=True, return_counts=True
        )

    def pairs(self, others: dict[int, np.ndarray]) -> None:
        """Add what other blocks hold, by cell in the order of the keys."""
        order, cells = dealt(cell_of(self.keys, self.side))
        self.counts[order] += np.concatenate([others[c] for c, _, _ in cells])

    def words(self, figures: dict[int, np.ndarray], spelled: np.ndarray) -> None:
        """Take the figures of the words, by class in the order of their hashes."""
        keys = np.unique(self.hashes)
        order, classes = dealt(keys % np.uint64(self.side))
        found = np.empty((5, len(keys)), np.int64)
        found[:, order] = np.concatenate([figures[c].reshape(5, -1) for c, _, _ in classes], axis=1)
        total, once, twice, often, after = found[:, np.searchsorted(keys, self.hashes)]
        off = self.corpus.pair_off
        self.total, self.after, self.spelled = total, after, spelled
        self.back = (once * off[0] + twice * off[1] + often * off[2]) / total

    def of(self, copies: np.ndarray) -> np.ndarray:
        """Log perplexity of each text by pairs and by words alone, without what the text itself and
        its copies (as many as given, with it) add."""
        found = [np.zeros((0, 2))]
        start = 0
        while start < len(copies):
            end = int(np.searchsorted(self.edges, self.edges[start] + SCORED))
            end = min(max(end, start + 1), len(copies))
            found.append(self._some(start, end, copies[start:end]))
            start = end
        return np.concatenate(found)

    def _some(self, start: int, end: int, copies: np.ndarray) -> np.ndarray:
        """The same for the texts from start to end, in one go: by text and pair, by text and word."""
        low, high = self.edges[start], self.edges[end]
        events = np.diff(self.edges[start : end + 1])
        text = np.repeat(np.arange(end - start), events)
        asked, at, own = np.unique(
            text * len(self.keys) + self.where[low:high], return_index=True, return_counts=True
        )
        text, pair = text[at], asked % len(self.keys)
        first, second = self.row[low + at], self.row[low + at + 1]
        others = np.maximum(self.counts[pair] - own * copies[text], 0)
        ends, where = np.unique(text * len(self.hashes) + second, return_inverse=True)
        ends %= len(self.hashes)
        after = self.after[ends] - np.bincount(where, others == 0).astype(np.int64)
        lower = _left(after, self.corpus.word_off) / self.corpus.pairs
        lower = lower + self.corpus.spelled * self.spelled[ends] + 1e-300
        prob = _left(others, self.corpus.pair_off) / self.total[first]
        prob = prob + self.back[first] * lower[where]
        logs = [np.bincount(text, own * np.log(x), end - start) for x in (prob, lower[where])]
        return -np.stack(logs, axis=1) / events[:, None]


def _spelled(scores: np.ndarray, names: list[bytes]) -> np.ndarray:
    """Probability of the spelling of each word."""
    parts = []
    for at in range(0, len(names), SPELLED):
        words = [w.decode("utf-8", "replace") for w in names[at : at + SPELLED]]
        found, owner = grams(words, SPELLING)
        parts.append(np.bincount(owner, scores[found], len(words)))
    return np.exp(np.concatenate(parts))


def measured(docs: DataFrame, counts: tuple[str, ...], count: Callable) -> DataFrame:
    """doc_id, lang, the counts, base_failed, log_perplexity and log_word_perplexity."""
    with short_shuffles(docs.sparkSession):
        return _measured(docs, counts, count)


def _measured(docs: DataFrame, counts: tuple[str, ...], count: Callable) -> DataFrame:
    spark = docs.sparkSession
    rows = materialize(encoded(docs, counts, count), "encoded")
    texts = rows.filter(F.col("kind") == DOCUMENT)
    blocks = rows.filter(F.col("kind") == BLOCK)
    size = texts.agg(F.sum(counts[0])).first()[0] or 0
    side = max(1, math.ceil(math.sqrt(size / CELL_WORDS)))
    # At most 64**SPELLING numbers.
    spelling = spark.sparkContext.broadcast(spelling_of(different_words(blocks)))

    asked = [asked_pairs(blocks, side, k) for k in range(min(PAIR_ROUNDS, side * side))]
    pairs = reduce(DataFrame.unionByName, [materialize(counted_pairs(a, side), "pairs") for a in asked])
    pair_off, _, different = _off(pairs)
    about = pairs.filter(F.col("kind").isin(FIRST, SECOND)).unionByName(asked_words(blocks, side))
    words = materialize(counted_words(about), "words")
    word_off, taken_off, _ = _off(words)
    corpus = Corpus(pair_off, word_off, different, taken_off / max(different, 1))

    copied = texts.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    copied = texts.select("block", "key").distinct().join(copied, "key")

    def row(df: DataFrame, kind: int) -> DataFrame:
        known = [F.col(c) if c in df.columns else F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns[1:]]
        return df.select(F.lit(kind).alias("kind"), *known)

    def answers(df: DataFrame, kind: int) -> DataFrame:
        found = df.filter(F.col("kind") == kind)
        return row(found.select("block", F.col("at").alias("n"), F.col("values").alias("words")), kind)

    together = rows.unionByName(answers(pairs, PAIRS)).unionByName(answers(words, WORDS))
    together = together.unionByName(row(copied, COPIES))
    own = ["doc_id", "lang", *counts, "base_failed"]
    out = T.StructType(
        [
            *[rows.schema[c] for c in own],
            T.StructField("log_perplexity", T.DoubleType()),
            T.StructField("log_word_perplexity", T.DoubleType()),
        ]
    )

    def measure(table: pa.Table) -> pa.Table:
        def of(kind: int) -> pa.Table:
            return table.filter(pc.equal(table["kind"], kind))

        def by_part(kind: int) -> dict[int, np.ndarray]:
            found = of(kind)
            return {n: unpack(v) for n, v in zip(found["n"].to_pylist(), found["words"].to_pylist())}

        block, found, again = of(BLOCK), of(DOCUMENT), of(COPIES)
        names, hashes = words_of(block["words"][0].as_py())
        line = unpack(block["texts"][0].as_py(), np.uint32)
        copied = dict(zip(again["key"].to_pylist(), again["n"].to_pylist()))
        place = found["n"].to_numpy()
        logs = np.full((found.num_rows, 2), np.nan)
        if len(line) > 1:
            copies = np.ones(place.max() + 1, np.int64)
            copies[place[place >= 0]] = [
                copied.get(key, 1) for key, at in zip(found["key"].to_pylist(), place) if at >= 0
            ]
            held = Measure(corpus, hashes, line, side)
            held.pairs(by_part(PAIRS))
            held.words(by_part(WORDS), _spelled(spelling.value, names))
            logs[place >= 0] = held.of(copies)[place[place >= 0]]
        found = found.select(own)
        for k, name in enumerate(out.names[-2:]):
            found = found.append_column(name, pa.array(logs[:, k], mask=place < 0))
        return found

    parts = []
    for k in range(TEXT_ROUNDS):
        part = together.filter(F.pmod(F.xxhash64("block"), F.lit(TEXT_ROUNDS)) == k)
        parts.append(materialize(part.groupBy("block").applyInArrow(measure, out), "scored"))
    return reduce(DataFrame.unionByName, parts)
