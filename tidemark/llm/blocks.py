"""The leaf sequences of a web page: runs of text between block-level tags, with their tag paths.

One regular expression finds tags, comments and raw elements; a stack of open elements, with the
closings that HTML implies, gives the path. Scripts, styles, titles and the like never give text.
Character references are decoded piece by piece, white space inside a block becomes one space.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

# Elements of HTML whose content is no text of the page, that break a line, that have
# no end tag, and which open elements end when another begins.
RAW = "script style noscript template textarea title iframe noframes noembed xmp svg math object".split()
BLOCK = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "legend li main menu nav ol optgroup option p pre search section select summary table tbody td "
    "tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}

#: Innermost open elements that a path names.
DEPTH = 24

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({'|'.join(RAW)})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[a-z]+")


@dataclass(frozen=True, slots=True)
class Block:
    """A text, the names on its path from the outside in, and how much of it is inside links."""

    path: tuple[tuple[str, ...], ...]
    text: str
    linked: float


def element(tag: str, names: str = "") -> tuple[str, ...]:
    """The tag and the words of its class, id and role."""
    return (tag, *("." + w for w in _WORDS.findall(names.lower())))


def blocks(html: str) -> list[Block]:
    """All leaf sequences with text, in page order."""
    found: list[Block] = []
    tags: list[str] = []
    path: list[tuple[str, ...]] = []
    texts: list[str] = []
    linked, links, at = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if texts:
            text = " ".join("".join(texts).split())
            texts.clear()
            if text:
                found.append(Block(tuple(path[-DEPTH:]), text, min(1.0, linked / len(text))))
        linked = 0

    def close(position: int) -> None:
        nonlocal links
        links -= tags[position:].count("a")
        del tags[position:], path[position:]

    for token in _TOKEN.finditer(html):
        if token.start() > at:
            text = unescape(html[at : token.start()])
            texts.append(text)
            linked += len(text) if links else 0
        at = token.end()
        tag = token[3]
        if tag is None:
            continue
        tag = tag.lower()
        breaks = tag in BLOCK
        if token[2]:
            for position in range(len(tags) - 1, -1, -1):
                if tags[position] == tag:
                    if breaks:  # an end without a beginning breaks nothing
                        flush()
                    close(position)
                    break
                if not breaks and tags[position] in BLOCK:
                    break
            continue
        if breaks:
            flush()
        if tag == "br":
            texts.append(" ")
        if tag in VOID:
            continue
        if breaks:
            own, outer = ENDS.get(tag, ({"p"}, {"table", "button"}))
            for position in range(len(tags) - 1, -1, -1):
                if tags[position] in own or tags[position] == "p":
                    close(position)
                    if tag not in ENDS:
                        break
                elif tags[position] in outer or tag not in ENDS and tags[position] in BLOCK:
                    break
        names = " ".join(a or b or c for a, b, c in _NAMES.findall(token[4])) if token[4] else ""
        tags.append(tag)
        path.append(element(tag, names))
        links += tag == "a"
    if at < len(html):
        text = unescape(html[at:])
        texts.append(text)
        linked += len(text) if links else 0
    flush()
    return found
