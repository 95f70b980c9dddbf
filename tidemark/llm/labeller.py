"""A recurrent labeller of sequences: a numpy LSTM in both directions over hashed features.

Each item has path features and word features; both are hashed into tables of vectors and averaged,
a few numbers are put beside them, and an LSTM reads the sequence forwards and backwards, so every
item is judged in the context of all others. Trained with Adam by back-propagation through time.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

from tidemark.llm.blocks import Block

PATHS, WORDS = 1 << 13, 1 << 12
PATH_WIDTH, WORD_WIDTH, HIDDEN, NUMBERS = 14, 6, 16, 5
EPOCHS, BATCH, RATE = 8, 32, 0.01
#: Chance that the words of a block are left out in a step of training, so paths can't be ignored.
WORDLESS = 0.6
#: Words of no meaning that are added to each text, so that one word alone says little.
DOUBT = 8

Model = dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Features:
    """Sequences in a row: flat hashed features with where each item's begin, and numbers."""

    paths: np.ndarray
    path_starts: np.ndarray
    words: np.ndarray
    word_starts: np.ndarray
    numbers: np.ndarray
    starts: np.ndarray  # first item of each sequence, and the end


class Hasher:
    """Turns blocks into features; remembers the slots of names and of a bounded number of words."""

    HELD = 200_000

    def __init__(self):
        self._paths: dict[tuple, list[int]] = {}
        self._words: dict[str, int] = {}

    def _path(self, path: tuple[tuple[str, ...], ...]) -> list[int]:
        slots = self._paths.get(path)
        if slots is None:
            if len(self._paths) > 10_000:
                self._paths.clear()
            names = [n for e in path for n in e]
            leaf = path[-1][0] if path else ""
            names += ["leaf " + leaf, "up " + ">".join(e[0] for e in path[-3:])]
            slots = [zlib.crc32(n.encode()) % PATHS for n in names]
            self._paths[path] = slots
        return slots

    def _word(self, word: str) -> int:
        if len(self._words) > self.HELD:
            self._words.clear()
        slot = self._words[word] = zlib.crc32(word.lower().encode()) % WORDS
        return slot

    def features(self, sequences: list[list[Block]]) -> Features:
        paths, path_starts, words, word_starts, numbers, starts = [], [], [], [], [], [0]
        known = self._words
        for blocks in sequences:
            for b in blocks:
                path_starts.append(len(paths))
                paths += self._path(b.path)
                word_starts.append(len(words))
                own = b.text.split()
                words += [known[w] if w in known else self._word(w) for w in own]
                size = len(b.text)
                numbers.append(
                    (
                        min(len(own), 400) ** 0.5 / 10,
                        size / (len(own) + 1) / 10,
                        b.linked,
                        b.text[-1] in ".!?",
                        len(b.path) / 10,
                    )
                )
            starts.append(len(path_starts))
        as_index = lambda x: np.array(x, np.int64)
        return Features(
            as_index(paths),
            as_index(path_starts),
            as_index(words),
            as_index(word_starts),
            np.array(numbers, np.float32).reshape(-1, NUMBERS),
            as_index(starts),
        )


def new_model(rng: np.random.Generator) -> Model:
    inputs = PATH_WIDTH + WORD_WIDTH + NUMBERS

    def drawn(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    model = {
        "paths": (rng.standard_normal((PATHS, PATH_WIDTH)) * 0.3).astype(np.float32),
        "words": (rng.standard_normal((WORDS, WORD_WIDTH)) * 0.05).astype(np.float32),
        "out": drawn(2 * HIDDEN + inputs),
        "bias": np.zeros(1, np.float32),
    }
    for way in ("f", "b"):
        model["in_" + way] = drawn(inputs, 4 * HIDDEN)
        model["loop_" + way] = drawn(HIDDEN, 4 * HIDDEN)
        model["gate_" + way] = np.repeat(np.float32([0, 1, 0, 0]), HIDDEN)
    return model


def _means(
    table: np.ndarray, slots: np.ndarray, starts: np.ndarray, more: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """Mean vector of each item's slots, as if there were `more` of zero, and their number."""
    counts = np.diff(np.append(starts, len(slots)))
    sums = np.zeros((len(starts), table.shape[1]), np.float32)
    some = counts > 0
    if some.any():
        sums[some] = np.add.reduceat(table[slots], starts[some], axis=0)
    counts = np.maximum(counts + more, 1)
    return sums / counts[:, None], counts


def _inputs(model: Model, f: Features, words: np.ndarray | None = None) -> tuple:
    path, n_path = _means(model["paths"], f.paths, f.path_starts)
    word, n_word = _means(model["words"], f.words, f.word_starts, DOUBT)
    if words is not None:
        word = word * words[:, None]
    return np.concatenate([path, word, f.numbers], 1), n_path, n_word


def _order(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """First and last items of the sequences, longest first, and how many have each step."""
    lengths = np.diff(starts)
    by = np.argsort(-lengths, kind="stable")
    lengths = lengths[by]
    steps = np.arange(lengths[0] if len(lengths) else 0)
    active = np.searchsorted(-lengths, -steps, "left").tolist()
    return starts[:-1][by], starts[1:][by] - 1, active


def _run(z: np.ndarray, loop: np.ndarray, first: np.ndarray, step: int, active: list[int], keep: bool):
    """States of all items; `first` is where each sequence begins and `step` the direction."""
    n, states = len(first), np.zeros((len(z), HIDDEN), np.float32)
    h = np.zeros((n, HIDDEN), np.float32)
    c = np.zeros((n, HIDDEN), np.float32)
    trace = []
    for t, k in enumerate(active):
        at = first[:k] + step * t
        gates = z[at] + h[:k] @ loop
        i, f, o = (_sigmoid(gates[:, a * HIDDEN : (a + 1) * HIDDEN]) for a in range(3))
        g = np.tanh(gates[:, 3 * HIDDEN :])
        before = c[:k]
        c = f * before + i * g
        squashed = np.tanh(c)
        if keep:
            trace.append((at, i, f, o, g, before, squashed, h[:k]))
        h = o * squashed
        states[at] = h
    return states, trace


def _back(trace: list, loop: np.ndarray, d_states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the gate inputs of all items and of the loop."""
    d_z = np.zeros((len(d_states), 4 * HIDDEN), np.float32)
    d_loop = np.zeros_like(loop)
    n = len(trace[0][0]) if trace else 0
    d_h, d_c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    for at, i, f, o, g, before, squashed, h in reversed(trace):
        k = len(at)
        dh = d_states[at] + d_h[:k]
        dc = d_c[:k] + dh * o * (1 - squashed**2)
        gates = np.concatenate(
            [dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)], 1
        )
        d_z[at] = gates
        d_loop += h.T @ gates
        d_h[:k] = gates @ loop.T
        d_c[:k] = dc * f
    return d_z, d_loop


def scores(model: Model, features: Features) -> np.ndarray:
    """Probability that each item is wanted."""
    x, _, _ = _inputs(model, features)
    first, last, active = _order(features.starts)
    forward, _ = _run(x @ model["in_f"] + model["gate_f"], model["loop_f"], first, 1, active, False)
    backward, _ = _run(x @ model["in_b"] + model["gate_b"], model["loop_b"], last, -1, active, False)
    return _sigmoid(np.concatenate([forward, backward, x], 1) @ model["out"] + model["bias"])


def _gradients(model: Model, f: Features, labels: np.ndarray, words: np.ndarray) -> Model:
    x, n_path, n_word = _inputs(model, f, words)
    first, last, active = _order(f.starts)
    forward, trace_f = _run(x @ model["in_f"] + model["gate_f"], model["loop_f"], first, 1, active, True)
    backward, trace_b = _run(x @ model["in_b"] + model["gate_b"], model["loop_b"], last, -1, active, True)
    joined = np.concatenate([forward, backward, x], 1)
    told = labels >= 0  # -1: not labelled
    off = np.where(told, _sigmoid(joined @ model["out"] + model["bias"]) - labels, 0).astype(np.float32)
    off /= max(1, told.sum())
    found = {"out": joined.T @ off, "bias": off.sum(keepdims=True)}
    d_joined = off[:, None] * model["out"][None, :]
    d_x = d_joined[:, 2 * HIDDEN :].copy()
    for way, trace, at in (("f", trace_f, 0), ("b", trace_b, HIDDEN)):
        d_z, found["loop_" + way] = _back(trace, model["loop_" + way], d_joined[:, at : at + HIDDEN])
        found["in_" + way] = x.T @ d_z
        found["gate_" + way] = d_z.sum(0)
        d_x += d_z @ model["in_" + way].T
    for name, slots, starts, n, d in (
        ("paths", f.paths, f.path_starts, n_path, d_x[:, :PATH_WIDTH]),
        ("words", f.words, f.word_starts, n_word, d_x[:, PATH_WIDTH : PATH_WIDTH + WORD_WIDTH] * words[:, None]),
    ):
        counts = np.diff(np.append(starts, len(slots)))
        owner = np.repeat(np.arange(len(d)), counts)
        shares = (d / n[:, None]).T
        sums = [np.bincount(slots, share[owner], len(model[name])) for share in shares]
        found[name] = np.array(sums, np.float32).T
    return found


def _some(f: Features, labels: np.ndarray, chosen: np.ndarray) -> tuple[Features, np.ndarray]:
    """The features and labels of some sequences."""
    path_ends = np.append(f.path_starts, len(f.paths))
    word_ends = np.append(f.word_starts, len(f.words))
    items = np.concatenate([np.arange(f.starts[s], f.starts[s + 1]) for s in chosen])

    def flat(values: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = [values[ends[i] : ends[i + 1]] for i in items]
        sizes = [len(p) for p in parts]
        return np.concatenate(parts), np.cumsum([0, *sizes])[:-1]

    paths, path_starts = flat(f.paths, path_ends)
    words, word_starts = flat(f.words, word_ends)
    lengths = f.starts[chosen + 1] - f.starts[chosen]
    starts = np.append(0, np.cumsum(lengths))
    return Features(paths, path_starts, words, word_starts, f.numbers[items], starts), labels[items]


def train(sequences: list[list[Block]], labels: list[list[int]], seed: int = 7) -> Model:
    """Learn from labelled sequences (1 wanted, 0 not, -1 unknown)."""
    rng = np.random.default_rng(seed)
    model = new_model(rng)
    features = Hasher().features(sequences)
    flat = np.concatenate([np.array(x, np.float32) for x in labels])
    first = {n: np.zeros_like(v) for n, v in model.items()}
    second = {n: np.zeros_like(v) for n, v in model.items()}
    steps = EPOCHS * -(-len(sequences) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        dealt = rng.permutation(len(sequences))
        for at in range(0, len(dealt), BATCH):
            some, wanted = _some(features, flat, dealt[at : at + BATCH])
            words = (rng.random(len(wanted)) >= WORDLESS).astype(np.float32)
            step += 1
            rate = RATE * (1 - (step - 1) / steps) + 1e-4
            for name, d in _gradients(model, some, wanted, words).items():
                d = np.clip(d, -1, 1)
                first[name] += 0.1 * (d - first[name])
                second[name] += 0.001 * (d * d - second[name])
                mean = first[name] / (1 - 0.9**step)
                spread = np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8
                model[name] -= (rate * mean / spread).astype(np.float32)
    return model
