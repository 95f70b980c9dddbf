"""Token counts by byte-pair merging with a heap and a linked list, without emitting ids.

A part of a text starts as a linked list of its characters. All adjacent pairs that are a piece of
the vocabulary are on a heap by rank and position; the lowest is merged again and again, and each
merge puts the new neighbours on the heap. The count is the number of initial symbols minus the
merges, where a character outside the vocabulary stands for its UTF-8 bytes (byte fallback).

Pieces hold the word mark only at their front, so parts between marks are independent, and counts
of parts are kept in a cache of bounded size. Defined results: null and empty texts have 0 tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.batches import CACHED_LENGTH, pieces, small_batches

#: Documents with more tokens than this are over the limit.
LIMIT = 4096
#: Parts whose counts a Python worker keeps. A full cache stays as it is: frequent parts are met early.
PARTS = 500_000
_MARK = "▁"


class MergeCounter:
    """Counts the tokens that a byte-pair model in the sentencepiece format gives."""

    def __init__(self, path: str, cache: int = PARTS) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.vocab_size())
        plain = [
            i
            for i in ids
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        # The rank of a piece: the lower, the earlier it is merged.
        self.rank = {model.id_to_piece(i): -model.get_score(i) for i in plain}
        if model.normalize("A  b ") != f"{_MARK}A{_MARK}{_MARK}b{_MARK}":
            raise ValueError("only models without normalisation and with a mark in front")
        if any(_MARK in p.lstrip(_MARK) for p in self.rank):
            raise ValueError("the model has pieces that go on after a word mark")
        # A line break that no piece holds also ends a part.
        cut = "" if any("\n" in p for p in self.rank) else r"\n"
        self.parts = re.compile(rf" *[^ {cut}]+|\n| +")
        self.limit = cache
        self.cache: dict[str, int] = {}

    def _merged(self, text: str) -> tuple[int, int]:
        """Initial symbols and merges of one part."""
        symbols = list(text)
        n = len(symbols)
        rank = self.rank.get
        start = sum(1 if rank(c) is not None else len(c.encode()) for c in symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if (r := rank(pair)) is not None:
                heap.append((r, i, pair))
        heapify(heap)
        merges = 0
        while heap:
            _, i, pair = heappop(heap)
            j = after[i]
            if not symbols[i] or j >= n or symbols[i] + symbols[j] != pair:
                continue  # one of the two has been merged since
            symbols[i], symbols[j] = pair, ""
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank(pair + symbols[k])) is not None:
                    heappush(heap, (r, i, pair + symbols[k]))
            if (h := before[i]) >= 0 and (r := rank(symbols[h] + pair)) is not None:
                heappush(heap, (r, h, symbols[h] + pair))
        return start, merges

    def _part(self, part: str) -> int:
        start, merges = self._merged(part.replace(" ", _MARK))
        return start - merges

    def count(self, raw: bytes | None) -> int:
        text = (raw or b"").decode().replace(_MARK, " ")
        if not text:
            return 0
        parts, cache = self.parts.findall(" " + text), self.cache
        try:
            return sum(map(cache.__getitem__, parts))
        except KeyError:
            fresh = {p: self._part(p) for p in set(parts) if p not in cache}
        if len(cache) <= self.limit:
            cache.update((p, n) for p, n in fresh.items() if len(p) <= CACHED_LENGTH)
        return sum(fresh[p] if p in fresh else cache[p] for p in parts)


@lru_cache(maxsize=2)
def merge_counter(path: str) -> MergeCounter:
    """One per Python worker, so that its cache outlives a task."""
    return MergeCounter(path)


def token_counts(docs: DataFrame, model: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = merge_counter(model)
        for rows, texts in pieces(batches):
            n = [counter.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    pa.array([len(t or b"") for t in texts], pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array([x > limit for x in n], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )
    return small_batches(docs.select("doc_id", "text")).mapInArrow(count, schema)
