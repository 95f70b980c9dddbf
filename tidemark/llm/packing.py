"""Packing documents into sequences by best fit and swap-based local search.

Documents are encoded and cut where they are longer than a sequence; full pieces are sequences of
their own. The others are written without their texts and dealt out at random in groups of a bounded
number of pieces. Each group is packed by itself: best fit in descending order first, then exchanges
that raise the sum of squared fills. A fuller sequence gives one piece for a larger one of another
sequence, or one for two, or takes a piece over; emptier sequences drain until they are gone. With
groups of thousands of pieces the partly filled last sequence of a group weighs next to nothing.

Defined results: a null text is empty, so its document is the end id alone; equal rows are packed
each for itself; an empty table gives no rows. Other columns are never read.
"""

from __future__ import annotations

import zlib
from bisect import insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import pieces, small_batches
from tidemark.llm.tokens import word_tokenizer
from tidemark.sources.scratch import materialize

#: Tokens of a sequence.
CAPACITY = 2048
#: Pieces that one task packs together, on average.
GROUP = 16_384
#: Rounds of the local search; it ends sooner when a round finds nothing.
ROUNDS = 12


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be short."""
    first = (length - 1) % capacity + 1
    return [(0, first)] + [(at, capacity) for at in range(first, length, capacity)]


def encoded_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and `deal`, a random number from the row's place."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokenizer(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        row = 0
        for rows, texts in pieces(batches):
            found: dict[str, list] = defaultdict(list)
            at: list[int] = []
            for i, ids in enumerate(words.ids(texts)):
                whole = ids + end
                for k, (start, length) in enumerate(cut(len(whole) // 4, capacity)):
                    crc = zlib.crc32(whole[4 * start : 4 * (start + length)])
                    at.append(i)
                    found["piece"].append(k)
                    found["start"].append(start)
                    found["length"].append(length)
                    found["ids_crc32"].append(crc)
                    found["deal"].append(zlib.crc32(f"{row}:{k}:{crc}".encode()))
                row += 1
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id").take(pa.array(at, pa.int64())),
                    pa.array(found["piece"], pa.int32()),
                    *[pa.array(found[c], pa.int64()) for c in _LONGS],
                ],
                names=["doc_id", "piece", *_LONGS],
            )

    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("piece", T.IntegerType()),
            *[T.StructField(c, T.LongType()) for c in _LONGS],
        ]
    )
    return small_batches(docs.select("doc_id", "text")).mapInArrow(encode, schema)


_LONGS = ("start", "length", "ids_crc32", "deal")


class Bins:
    """Underfull bins of one group, with an index of their items by size."""

    def __init__(self, sizes: list[int], capacity: int) -> None:
        self.sizes, self.capacity = sizes, capacity
        self.items: list[set[int]] = []
        self.fill: list[int] = []
        self.of: list[int] = [0] * len(sizes)
        self.by_size: dict[int, set[int]] = defaultdict(set)
        self._best_fit()
        for item, size in enumerate(sizes):
            self.by_size[size].add(item)

    def _best_fit(self) -> None:
        """Largest first, each into the fullest bin that takes it."""
        rooms: list[int] = []  # rooms that some bin has, ascending
        having: dict[int, list[int]] = defaultdict(list)
        for item in sorted(range(len(self.sizes)), key=self.sizes.__getitem__, reverse=True):
            size = self.sizes[item]
            at = _first_at_least(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                target = having[room].pop()
                if not having[room]:
                    del rooms[at]
            else:
                room, target = self.capacity, len(self.items)
                self.items.append(set())
                self.fill.append(0)
            self.items[target].add(item)
            self.fill[target] += size
            self.of[item] = target
            left = room - size
            if not having[left]:
                insort(rooms, left)
            having[left].append(target)

    def _move(self, item: int, target: int) -> None:
        source, size = self.of[item], self.sizes[item]
        self.items[source].discard(item)
        self.fill[source] -= size
        self.items[target].add(item)
        self.fill[target] += size
        self.of[item] = target

    def _donor(self, size: int, target: int, gain: int, taken: int = -1) -> int:
        """An item of this size in a bin that may lose `gain` to the target, or -1.

        Losing raises the sum of squares when the target ends up fuller than the other bin was.
        """
        top = self.fill[target] + gain
        for item in self.by_size.get(size, ()):
            other = self.of[item]
            if other != target and item != taken and self.fill[other] < top:
                return item
        return -1

    def _improve(self, target: int) -> bool:
        """The best move or exchange that fills this bin further."""
        room = self.capacity - self.fill[target]
        if not room or not self.items[target]:
            return False
        own = {self.sizes[i]: i for i in self.items[target]}
        for gain in range(room, 0, -1):
            if (item := self._donor(gain, target, gain)) >= 0:
                self._move(item, target)
                return True
            for size, mine in own.items():
                item = self._donor(size + gain, target, gain)
                if item >= 0:
                    source = self.of[item]
                    self._move(mine, source)
                    self._move(item, target)
                    return True
        for size, mine in own.items():
            if self._two_for_one(target, mine, size, room):
                return True
        return False

    def _two_for_one(self, target: int, mine: int, size: int, room: int) -> bool:
        """Give one item for two of another bin that fill this bin to the brim."""
        for first in range((size + room) // 2, 0, -1):
            second = size + room - first
            if not self.by_size.get(first) or not self.by_size.get(second):
                continue
            for item in self.by_size[first]:
                source = self.of[item]
                if source == target or self.fill[source] >= self.fill[target] + room:
                    continue
                for partner in self.items[source]:
                    if partner != item and self.sizes[partner] == second:
                        self._move(mine, source)
                        self._move(item, target)
                        self._move(partner, target)
                        return True
        return False

    def search(self, rounds: int) -> None:
        least = -(-sum(self.sizes) // self.capacity)
        for _ in range(rounds):
            used = [b for b in range(len(self.items)) if self.items[b]]
            if len(used) <= least:
                return
            changed = False
            for target in sorted(used, key=self.fill.__getitem__, reverse=True):
                while self._improve(target):
                    changed = True
            if not changed:
                return


def _first_at_least(values: list[int], least: int) -> int:
    low, high = 0, len(values)
    while low < high:
        mid = (low + high) // 2
        if values[mid] < least:
            low = mid + 1
        else:
            high = mid
    return low


def pack_sizes(sizes: list[int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[int]:
    """The bin of each item; bins are numbered without gaps."""
    bins = Bins(sizes, capacity)
    bins.search(rounds)
    names: dict[int, int] = {}
    return [names.setdefault(b, len(names)) for b in bins.of]


def packed(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 0,
    capacity: int = CAPACITY,
    group: int = GROUP,
    rounds: int = ROUNDS,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    cut_up = materialize(encoded_pieces(docs, tokenizer, end_id, capacity), "pieces")
    full = F.col("length") == capacity
    partly = cut_up.filter(~full)
    groups = max(1, round(partly.count() / group))
    out = ("doc_id", "piece", "start", "length", "ids_crc32")

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        bins = np.array(pack_sizes(rows["length"].tolist(), capacity, rounds), np.int64)
        placed = rows[[*out]].assign(sequence_id=key[0] * (1 << 32) + bins)
        placed["offset"] = placed.groupby("sequence_id")["length"].cumsum() - placed["length"]
        return placed

    schema = T.StructType(
        [
            *[cut_up.schema[c] for c in out],
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )
    dealt = partly.withColumn("group", F.pmod(F.xxhash64("deal", "ids_crc32"), F.lit(groups)))
    small = dealt.groupBy("group").applyInPandas(pack, schema)
    alone = cut_up.filter(full).select(
        *out,
        (-F.monotonically_increasing_id() - 1).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )
    return small.unionByName(alone)
