"""Quality rules: counts per text and perplexity under a word model of the corpus.

The counting rules look at one text. What they leave is held against perplexity bands per language
(see `perplexity.py` for the model): how well the words themselves are foretold, and how much better
they are with the word before. Random letters and foreign symbols raise the first, words in no order
lose the second, and endless templates fall below the bands. Bands are the quartiles of all documents
that pass the counting rules, each moved outwards by multiples of its distance from the median.

Defined results: a null text has no words and fails the counting rules; a null language is a language
of its own, and there may be any number of them; documents without words have no perplexity; equal
texts of a language get equal results; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.perplexity import measured
from tidemark.sources.scratch import materialize

#: Counting rules: a text has at least so many words, and at most this share in repeated windows.
MIN_WORDS = 50
MAX_REPEATED = 50
#: How far the bands reach beyond the quartiles, below and above, in distances of that quartile from
#: the median: copies and foreign passages widen one side only.
WORD_REACH = (6.0, 2.0)
GAIN_REACH = (3.0, 12.0)

SYMBOLS = b"#*$%&|<>"


def _repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows that are found twice or more, the first included."""
    n = len(words) - 2
    if n < 2:
        return 0
    # Windows are compared by 64-bit hashes of their words.
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    windows = h[:-2] * np.uint64(0x9E3779B97F4A7C15)
    windows ^= windows >> np.uint64(31)
    windows = (windows + h[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F)
    windows ^= windows >> np.uint64(29)
    windows = (windows + h[2:]) * np.uint64(0x165667B19E3779F9)
    order = np.argsort(windows)
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n + 2, bool)
    for k in range(3):
        covered[k : n + k] |= twice
    return int(covered.sum())


def _repeated_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    again = 0
    for line in text.split(b"\n"):
        if line in seen:
            again += 1
        elif line.strip(b" \t\n\v\f\r"):
            seen.add(line)
    return again


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def text_counts(text: bytes | None) -> tuple[list[bytes], tuple[int, ...]]:
    """The words of a text and the figures that the counting rules take."""
    text = text or b""
    words = text.split()
    chars = len(text.decode("utf-8", "replace")) - sum(text.count(c) for c in b" \t\n\v\f\r")
    symbols = sum(text.count(c) for c in SYMBOLS)
    return words, (len(words), chars, symbols, _repeated_lines(text), _repeated_words(words))


def base_counts(text: bytes) -> tuple[tuple[int, ...], bool]:
    """The figures of a text and whether the counting rules reject it."""
    _, found = text_counts(text)
    return found, found[0] < MIN_WORDS or 100 * found[4] > MAX_REPEATED * found[0]


def _band(reach: tuple[float, float], name: str) -> list[Column]:
    low, middle, high = (F.col(f"q_{name}")[k] for k in range(3))
    return [
        (low - (middle - low) * reach[0]).alias(f"{name}_low"),
        (high + (high - middle) * reach[1]).alias(f"{name}_high"),
    ]


def judged(
    docs: DataFrame,
    word_reach: tuple[float, float] = WORD_REACH,
    gain_reach: tuple[float, float] = GAIN_REACH,
) -> DataFrame:
    """The measured documents (doc_id, lang, text) with the bands of their language and kept."""
    found = measured(docs, _COUNTS, base_counts)
    gain = F.col("log_word_perplexity") - F.col("log_perplexity")
    found = materialize(found.withColumn("gain", gain), "measured")

    def quartiles(figure: str) -> Column:
        return F.percentile_approx(figure, [0.25, 0.5, 0.75], 10_000)

    by_lang = found.filter(~F.col("base_failed")).groupBy("lang")
    by_lang = by_lang.agg(
        quartiles("log_word_perplexity").alias("q_word"), quartiles("gain").alias("q_gain")
    )
    gain_low, gain_high = _band(gain_reach, "gain")
    # Words in no order gain nothing from the word before, so the band ends at zero at the latest.
    gain_low = F.least(F.col("q_gain")[0], F.greatest(gain_low, F.lit(0.0))).alias("gain_low")
    bands = by_lang.select(
        F.col("lang").alias("_tm_lang"), *_band(word_reach, "word"), gain_low, gain_high
    )
    beside = found.join(bands, F.col("lang") == F.col("_tm_lang"), "left")
    inside = F.col("log_word_perplexity").between(F.col("word_low"), F.col("word_high"))
    inside &= F.col("gain").between(F.col("gain_low"), F.col("gain_high"))
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(False))
    return beside.drop("_tm_lang").withColumn("kept", kept)
