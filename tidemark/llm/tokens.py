"""Token ids by a public tokenizer, piece by piece with caches of bounded size.

The pre-tokenizers of the supported kinds cut a text at white space before any merge, and between a
letter or digit and the punctuation behind it, so the ids of a text are those of its pieces in a row.
Pieces are encoded by the tokenizers library, many in one call with a special token between them. A
text that holds one of the special strings, or a sign that the cuts use, is encoded whole.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

from tidemark.llm.batches import CACHED_LENGTH

#: White space of Unicode, as the tokenizers' patterns understand it.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A word with the space before it; white space that no word takes.
_BYTE_PARTS = re.compile(rf" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: Line breaks next to white space, other ASCII white space, and wider white space by first byte.
_BESIDE = (b"\n\n", b"\n ", b" \n")
_OTHER = (b"\t", b"\x0b", b"\x0c", b"\r")
_WIDE = {
    b"\xc2": (b"\xc2\x85", b"\xc2\xa0"),
    b"\xe1": (b"\xe1\x9a\x80",),
    b"\xe2": (b"\xe2\x80", b"\xe2\x81\x9f"),
    b"\xe3": (b"\xe3\x80\x80",),
}
_ENDS = b".,;:!?"
_ALNUM = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
#: Pieces of one call to the library.
_CALL = 1000
#: Entries of the cache, about 200 bytes each.
WORDS = 480_000


def _plain_pieces(key: bytes) -> list[bytes]:
    """The word and the punctuation behind it, where a letter or digit is before that."""
    if key[-1] in _ENDS:
        word = key.rstrip(_ENDS)
        if word and word[-1] in _ALNUM:
            return [word, key[len(word) :]]
    return [key]


def _spaced_pieces(key: bytes) -> list[bytes]:
    """The same for keys that stand for a space and a word, or after \\0 or \\n for a word alone."""
    found = []
    if key[0] == 10:
        found, key = [b"\0\n"], b"\0" + key[1:]
    if key[-1] in _ENDS:
        word = key.rstrip(_ENDS)
        if word and word[-1] in _ALNUM:
            return [*found, word, b"\0" + key[len(word) :]]
    return [*found, key] if len(key) > 1 or key != b"\0" else found


def _is_even(raw: bytes) -> bool:
    """True when single spaces and single line breaks are all the white space of a text."""
    if any(c in raw for c in _OTHER) or (b"\n" in raw and any(p in raw for p in _BESIDE)):
        return False
    return raw.isascii() or not any(
        first in raw and any(w in raw for w in wide) for first, wide in _WIDE.items()
    )


def _cut_spaced(raw: bytes) -> list[bytes]:
    """Keys of the parts of a text whose tokenizer keeps white space."""
    if raw[0] != 32 and raw[-1] != 32 and raw[0] != 10 and b"  " not in raw and _is_even(raw):
        keys = raw.replace(b"\n", b" \n").split(b" ")
        keys[0] = b"\0" + keys[0]
        return keys
    return [b"\0" + p.encode() for p in _BYTE_PARTS.findall(raw.decode())]


def _spaced_text(key: bytes) -> bytes:
    return key[1:] if key[0] == 0 else b" " + key


def _lower_words(raw: bytes) -> list[bytes]:
    return raw.lower().split()


def _sliced(keys: list[bytes], flat: bytes, starts: list[int], ends: list[int]):
    spans = map(slice, starts, [*ends, len(flat)])
    return zip(keys, map(flat.__getitem__, spans), strict=True)


class WordTokenizer:
    """Ids of whole texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, cache: int = WORDS) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.limit = cache
        self.cache: dict[bytes, bytes] = {}
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        self.between = spec["added_tokens"][0]["content"].encode()
        self.between_id = spec["added_tokens"][0]["id"]
        kind = spec["pre_tokenizer"]["type"]
        if kind == "ByteLevel" and not spec["normalizer"]:
            self._cut, self._pieces, self._text = _cut_spaced, _spaced_pieces, _spaced_text
            edge = "\u0120"  # how the vocabulary writes a space; it opens a word
            self._joint, self._ends = b"", False
            marked = [i for t, i in spec["model"]["vocab"].items() if t.startswith(edge)]
        elif edge := spec["model"]["end_of_word_suffix"]:
            # Drops white space and lower-cases, so A-Z may be lower-cased ahead.
            self._cut, self._pieces, self._text = _lower_words, _plain_pieces, bytes
            self._joint, self._ends = b" ", True
            marked = [i for t, i in spec["model"]["vocab"].items() if t.endswith(edge)]
        else:
            raise ValueError(f"no rule to cut texts for a tokenizer of kind {kind}")
        self.edge = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.edge[marked] = True

    def _whole(self, text: bytes) -> np.ndarray:
        found = self.tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)
        return np.array(found[0].ids, "<u4")

    def _encode(self, keys: list[bytes]) -> dict[bytes, bytes]:
        """Ids of pieces without special strings, many in one call.

        Words of unaccented letters are one piece of the pre-tokenizer each, so a call of such words
        is cut where the vocabulary marks their ends; others are kept apart by a special token.
        """
        found: dict[bytes, bytes] = {}
        simple = [k for k in keys if k.isalpha()]
        others = [k for k in keys if not k.isalpha()]
        for at in range(0, len(simple), _CALL):
            call = simple[at : at + _CALL]
            ids = self._whole(self._joint.join(map(self._text, call)))
            edges = 4 * np.flatnonzero(self.edge[ids])
            inner = ((edges + 4)[:-1] if self._ends else edges[1:]).tolist()
            found.update(_sliced(call, ids.tobytes(), [0, *inner], inner))
        for at in range(0, len(others), _CALL):
            call = others[at : at + _CALL]
            ids = self._whole(self.between.join(map(self._text, call)))
            cuts = 4 * np.flatnonzero(ids == self.between_id)
            found.update(_sliced(call, ids.tobytes(), [0, *(cuts + 4).tolist()], cuts.tolist()))
        return found

    def ids(self, texts: list[bytes | None]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        unknown: list[tuple[int, list[bytes], list[bytes | None], list[int]]] = []
        get = self.cache.get
        seen = 0
        for i, raw in enumerate(texts):
            if not raw:
                continue
            if b"\0" in raw or any(s in raw for s in self.special):
                out[i] = self._whole(raw).tobytes()
                continue
            keys = self._cut(raw)
            found = list(map(get, keys))
            seen += len(keys)
            try:
                out[i] = b"".join(found)
            except TypeError:  # a key that is not in the cache
                unknown.append((i, keys, found, [j for j, v in enumerate(found) if v is None]))
        if unknown:
            self._learn(unknown, out, seen)
        return out

    def _learn(self, unknown: list, out: list[bytes], seen: int) -> None:
        """Encode what the cache lacks and fill the open texts."""
        cache = self.cache
        fresh = {keys[j] for _, keys, _, missing in unknown for j in missing}
        # Most keys are one piece: no punctuation at the end, no line break in front.
        plain = [k for k in fresh if k[-1] not in _ENDS and k[0] != 10]
        composed = {k: self._pieces(k) for k in fresh.difference(plain)}
        whole = [k for k, own in composed.items() if own == [k]]
        parts = {p for own in composed.values() for p in own}.difference(fresh)
        new = self._encode(plain + whole + [p for p in parts if p not in cache])
        for k in whole:
            del composed[k]
        values = {
            k: b"".join([new.get(p) or cache.get(p, b"") for p in own])
            for k, own in composed.items()
        }
        if len(cache) > self.limit and 2 * len(fresh) > seen > _CALL:
            self.cache = cache = {}  # full of words that are no longer met
        # A full cache stays as it is, as frequent words are met early; so is one with composed words.
        if len(cache) <= self.limit:
            cache.update(_short(new))
        if 2 * len(cache) <= self.limit:
            cache.update(_short(values))
        new.update(values)
        for i, keys, found, missing in unknown:
            for j in missing:
                found[j] = new[keys[j]]
            out[i] = b"".join(found)


def _short(found: dict[bytes, bytes]) -> dict[bytes, bytes]:
    """Without the words that are worked out each time."""
    if max(map(len, found), default=0) <= CACHED_LENGTH:
        return found
    return {k: v for k, v in found.items() if len(k) <= CACHED_LENGTH}


@lru_cache(maxsize=2)
def word_tokenizer(path: str, cache: int = WORDS) -> WordTokenizer:
    """One per Python worker, so that its caches outlive a task."""
    return WordTokenizer(path, cache)
