"""Language identification: multinomial naive Bayes over hashed character n-grams.

Features are the 1- to 3-grams of the letters of each word, lower-cased and with word ends, hashed
into a fixed number of buckets. Spark counts them per language over all labelled rows; the matrix of
log probabilities has (buckets x languages) entries and is broadcast for at most PART languages at a
time; with more of them the rows pass one part after the other and carry the best language so far,
which gives the same answers in bounded memory.
Texts are scored in batches: words of a batch are looked up or worked out once, and the sparse
document-by-word counts are multiplied by the word scores in numpy.

Defined results: a null text or one without a letter is `und` with score 0, and so is every text
when nothing could be learned. Rows with a null language teach nothing. Ties go to the first
language by name. Repeated rows get the same answer; other columns are never read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import CACHE, pieces, small_batches
from tidemark.sources.scratch import materialize

#: Buckets of hashed n-grams, and languages of a part of the model: 16 MB a broadcast, 4.2 million
#: counts a read.
BUCKETS = 1 << 16
PART = 64
#: Added to every count.
SMOOTHING = 0.5
#: Words counted before a task turns them into n-grams.
WORDS_HELD = 400_000
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: bytes | None) -> list[str]:
    """Runs of letters, lower-cased; none if the text has no letter."""
    found = _LETTERS.findall((text or b"").decode("utf-8", "replace").lower())
    return found if any(c.isalpha() for w in found for c in w) else []


def ngram_buckets(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the words, and the index of the word that each one is from."""
    codes = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le"), np.uint32)
    codes = codes.astype(np.uint64)
    space = codes == 32
    owner = np.cumsum(space) - 1
    found, owners = [], []
    for n in (1, 2, 3):
        last = len(codes) - n + 1
        valid = ~space[:last] if n == 1 else ~space[1 : last + 1]
        value = np.full(last, n, np.uint64)
        for k in range(n):
            value = (value ^ codes[k : last + k]) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(29)
        found.append((value[valid] % np.uint64(buckets)).astype(np.int64))
        owners.append(owner[:last][valid])
    return np.concatenate(found), np.concatenate(owners)


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray  # buckets x languages

    @property
    def buckets(self) -> int:
        return len(self.log_prob)


def ngram_counts(labelled: DataFrame, lang: str, buckets: int) -> DataFrame:
    """(lang, bucket, n) over all rows, and each language's documents under bucket -1."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        sums: dict[str, np.ndarray] = {}
        documents: Counter = Counter()

        def flush() -> None:
            for name, words in held.items():
                if words:
                    where, owner = ngram_buckets(list(words), buckets)
                    times = np.fromiter(words.values(), np.float64, len(words))
                    more = np.bincount(where, times[owner], buckets).astype(np.int64)
                    sums[name] = sums.get(name, 0) + more
                    words.clear()

        for rows, texts in pieces(batches):
            for name, text in zip(rows.column("lang").to_pylist(), texts, strict=True):
                documents[name] += 1
                held.setdefault(name, Counter()).update(words_of(text))
            if sum(map(len, held.values())) > WORDS_HELD:
                flush()
        flush()
        for name, total in documents.items():
            of = sums.get(name, np.zeros(0, np.int64))
            at = np.flatnonzero(of)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * (len(at) + 1), pa.string()),
                    pa.array(np.append(at, -1), pa.int64()),
                    pa.array(np.append(of[at], total), pa.int64()),
                ],
                names=["lang", "bucket", "n"],
            )

    rows = labelled.select(F.col(lang).cast("string").alias("lang"), "text")
    counted = small_batches(rows).mapInArrow(count, "lang string, bucket bigint, n bigint")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(
    labelled: DataFrame,
    lang: str = "lang",
    buckets: int = BUCKETS,
    smoothing: float = SMOOTHING,
    part: int = PART,
) -> Iterator[Model]:
    """Learn from `text` and the non-null `lang` of all rows given: parts in order of the names."""
    counts = ngram_counts(labelled.filter(F.col(lang).isNotNull()), lang, buckets)
    counts = materialize(counts, "ngrams")
    priors = counts.filter("bucket < 0").select("lang", F.col("n").alias("documents"))
    total = priors.agg(F.sum("documents")).first()[0] or 0
    last = None
    while True:
        rest = priors if last is None else priors.filter(F.col("lang") > F.lit(last))
        own = {r["lang"]: r["documents"] for r in rest.orderBy("lang").limit(part).collect()}
        if not own:
            return
        languages = sorted(own, key=lambda name: name.encode())
        last = languages[-1]
        # At most part x buckets rows: counts, never documents.
        here = counts.filter((F.col("bucket") >= 0) & (F.col("lang") <= F.lit(last)))
        here = here.filter(F.col("lang") >= F.lit(languages[0]))
        found = here.toPandas()
        place = {name: i for i, name in enumerate(languages)}
        table = np.zeros((buckets, len(languages)))
        table[found["bucket"], found["lang"].map(place).astype(int)] = found["n"]
        table += smoothing
        log_prob = np.log(table / table.sum(0)).astype(np.float32)
        prior = np.array([own[name] for name in languages], float)
        yield Model(languages, np.log(prior / total), log_prob)


class Scorer:
    """Log probabilities of documents under a model; keeps the scores of words it has seen."""

    def __init__(self, model: Model, cache: int = CACHE) -> None:
        self.model, self.cache = model, cache
        self.index: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.languages)))

    def _learn(self, words: set[str]) -> None:
        if len(self.index) + len(words) > self.cache:
            self.index, self.scores = {}, self.scores[:0]
        new = [w for w in words if w not in self.index]
        if new:
            where, owner = ngram_buckets(new, self.model.buckets)
            columns = [
                np.bincount(owner, self.model.log_prob[where, i], len(new))
                for i in range(len(self.model.languages))
            ]
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
            self.scores = np.concatenate([self.scores, np.stack(columns, 1)])

    def totals(self, texts: list[bytes | None]) -> tuple[list[int], np.ndarray]:
        """The texts that have letters, and their log probability with each language."""
        words = [words_of(t) for t in texts]
        filled = [i for i, found in enumerate(words) if found]
        if not filled or not self.model.languages:
            return [], np.zeros((0, len(self.model.languages)))
        fresh = {w for found in words for w in found if w not in self.index}
        if len(self.index) + len(fresh) > self.cache:
            fresh = {w for found in words for w in found}
        self._learn(fresh)
        sizes = np.array([len(words[i]) for i in filled])
        at = np.fromiter(
            (self.index[w] for i in filled for w in words[i]), np.int64, int(sizes.sum())
        )
        sums = np.add.reduceat(self.scores[at], np.cumsum(sizes) - sizes)
        return filled, sums + self.model.log_prior

    def better(self, texts: list[bytes | None], before: Best) -> Best:
        """The best language of each text among those of this part and of the parts before."""
        names, tops, sums = (list(x) for x in before)
        filled, total = self.totals(texts)
        if not filled:
            return names, tops, sums
        best, top = total.argmax(1), total.max(1)
        own = np.exp(total - top[:, None]).sum(1)
        for i, k, t, s in zip(filled, best.tolist(), top.tolist(), own.tolist(), strict=True):
            if names[i] == UNKNOWN and not sums[i]:
                names[i], tops[i], sums[i] = self.model.languages[k], t, s
            elif t > tops[i]:
                sums[i] = s + sums[i] * math.exp(tops[i] - t)
                names[i], tops[i] = self.model.languages[k], t
            else:
                sums[i] += s * math.exp(t - tops[i])
        return names, tops, sums

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], list[float]]:
        n = len(texts)
        names, _, sums = self.better(texts, ([UNKNOWN] * n, [0.0] * n, [0.0] * n))
        return names, [1 / s if s else 0.0 for s in sums]


#: Per text: language, its log probability, and the sum of all probabilities over it.
Best = tuple[list[str], list[float], list[float]]
_BEST = ("_tm_lang", "_tm_top", "_tm_sum")


def _with_part(docs: DataFrame, model: Model) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for rows, texts in pieces(batches, "text"):
            before = tuple(rows.column(c).to_pylist() for c in _BEST)
            names, tops, sums = scorer.better(texts, before)
            others = [c for c in rows.schema.names if c not in _BEST]
            yield pa.RecordBatch.from_arrays(
                [
                    *[rows.column(c) for c in others],
                    pa.array(names, pa.string()),
                    pa.array(tops, pa.float64()),
                    pa.array(sums, pa.float64()),
                ],
                names=[*others, *_BEST],
            )

    return small_batches(docs).mapInArrow(score, docs.schema)


def with_language(docs: DataFrame, parts: Iterable[Model]) -> DataFrame:
    """All columns of `docs` with _tm_lang and _tm_score. Other columns pass the Arrow batches."""
    start = (F.lit(UNKNOWN), F.lit(0.0), F.lit(0.0))
    found = docs.select(*docs.columns, *[v.alias(c) for v, c in zip(start, _BEST)])
    for k, model in enumerate(parts):
        if k:
            found = materialize(found, "languages")
        found = _with_part(found, model)
    score = F.when(F.col("_tm_sum") > 0, 1 / F.col("_tm_sum")).otherwise(0.0)
    return found.select(*docs.columns, "_tm_lang", score.alias("_tm_score"))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for the fold that teaches nothing; a null id counts as empty and is in it."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == 0


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score, learned from the labelled rows not held out."""
    apart = held_out(F.col("doc_id"))
    model = train(docs.filter(~apart).select("text", "lang"))
    found = with_language(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        apart.alias("held_out"),
        F.col("_tm_lang").alias("lang_pred"),
        F.col("_tm_score").alias("score"),
    )


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Documents whose language is known with a score of `least` or more; columns as they are."""
    model = train(docs.filter(~held_out(F.col("doc_id"))).select("text", "lang"))
    found = with_language(docs, model)
    known = (F.col("_tm_lang") != UNKNOWN) & (F.col("_tm_score") >= least)
    return found.filter(known).select(*docs.columns)
