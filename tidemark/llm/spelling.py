"""Spelling of words: an interpolated modified Kneser-Ney model of their symbols.

A symbol is one of 64 classes, so there are at most 64**n different n-grams whatever the input. They
are stored as sorted arrays of packed grams with probabilities and back-off weights and looked up by
binary search.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ORDER = 4
#: Symbol classes; the last two are the start and the end of a word.
CLASSES = 64
_START, _END = 62, 63


def grams(words: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams that end in a symbol or the end of a word, and each one's word."""
    start = "\n" * (order - 1)
    text = start + f"\r{start}".join(words).lower() + "\r"
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letter = (codes >= 97) & (codes <= 122)
    digit = (codes >= 48) & (codes <= 57)
    kind = np.where(codes < 128, 28, 29 + codes % 33)
    kind[letter] = codes[letter] - 96
    kind[digit] = 27
    kind[codes == 10] = _START
    kind[codes == 13] = _END
    packed = kind[: len(kind) - order + 1]
    for k in range(1, order):
        packed = packed * CLASSES + kind[k : len(kind) - order + 1 + k]
    last = kind[order - 1 :]
    owner = np.cumsum(last == _END) - (last == _END)
    valid = last != _START
    return packed[valid], owner[valid]


@dataclass
class Level:
    """One order: sorted grams with probabilities, sorted contexts with back-off weights."""

    keys: np.ndarray
    prob: np.ndarray
    contexts: np.ndarray
    back: np.ndarray


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted keys in a sorted array, and whether they are there."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def discounts(t: list[int]) -> np.ndarray:
    """What is taken off counts of 1, 2 and 3 or more; t[k] is how many are k + 1, up to 4."""
    found = np.array([0.5, 1.0, 1.5])
    if t[0] and t[1]:
        y = t[0] / (t[0] + 2 * t[1])
        for k in (1, 2, 3):
            if t[k - 1]:
                found[k - 1] = min(max(k - (k + 1) * y * t[k] / t[k - 1], 0.05), k - 0.05)
    return found


class KneserNey:
    """Interpolated modified Kneser-Ney probabilities from the counts of the highest order."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int = ORDER) -> None:
        self.order = order
        by_order = {order: (keys, counts)}
        for n in range(order - 1, 0, -1):
            # Lower orders count in how many contexts a gram goes on.
            shorter = by_order[n + 1][0] & (CLASSES**n - 1)
            by_order[n] = np.unique(shorter, return_counts=True)
        self.levels: dict[int, Level] = {}
        for n in range(1, order + 1):
            grams_, times = by_order[n]
            off = discounts([int((times == k).sum()) for k in (1, 2, 3, 4)])
            contexts, where = np.unique(grams_ // CLASSES, return_inverse=True)
            total = np.bincount(where, times)
            taken = off[np.minimum(times, 3) - 1]
            back = np.bincount(where, taken) / total
            lower = self._prob(grams_ & (CLASSES ** (n - 1) - 1), n - 1)
            prob = (times - taken) / total[where] + back[where] * lower
            self.levels[n] = Level(
                grams_.astype(np.int32),
                prob.astype(np.float32),
                contexts.astype(np.int32),
                back.astype(np.float32),
            )

    def _prob(self, wanted: np.ndarray, n: int) -> np.ndarray:
        if n == 0:
            return np.full(len(wanted), 1 / (CLASSES - 1))
        level = self.levels[n]
        at, known = _find(level.keys, wanted)
        prob = level.prob[at].astype(np.float64)
        if not known.all():
            rest = wanted[~known]
            place, seen = _find(level.contexts, rest // CLASSES)
            weight = np.where(seen, level.back[place], 1.0)
            prob[~known] = weight * self._prob(rest & (CLASSES ** (n - 1) - 1), n - 1)
        return prob

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log probability of each word with its end."""
        found, owner = grams(words, self.order)
        return np.bincount(owner, np.log(self._prob(found, self.order)), len(words))

    def gram_scores(self) -> np.ndarray:
        """Log probability of every gram there can be, in the order of the packed grams."""
        return np.log(self._prob(np.arange(CLASSES**self.order), self.order))
