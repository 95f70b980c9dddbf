"""Main text of web pages: a recurrent labeller judges every leaf sequence in its whole page.

The labeller (`labeller.py`) reads tag paths and hashed words of all blocks of a page forwards and
backwards. It is trained here, on a bounded sample: SAMPLE pages in the order of a hash, at most
READ characters of each. A block of these is labelled by the innermost element around it that says
what it is (`article`, `nav`, a class such as `sidebar`). As tables may hold one layout only, the
same texts are also laid out anew in LAID layouts for each page: with other containers, names
dropped or made up, menus, notices, adverts, forms, sidebars and comments around and inside the
article, labelled by how they were made. Prediction reads neither url nor id.

Every page is read whole and every block classified; blocks above one half are joined in page order.

Defined results: a null or empty page, and one without a text, gives an empty text. Repeated rows
get the same answer. Where no page has a text nothing is learned and nothing extracted. Other
columns are never read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import pieces, small_batches
from tidemark.llm.blocks import Block, blocks, element
from tidemark.llm.labeller import Hasher, Model, scores, train

#: Pages that training reads, characters of each, blocks of each, and new layouts for each.
SAMPLE = 240
READ = 60_000
LEARNED = 120
LAID = 3
#: Chance that the names of an element are dropped or made up in a new layout.
NAMELESS = 0.2

# What elements and names say about the text in them.
MAIN_TAGS = {"article", "main"}
MAIN_NAMES = {".article", ".content", ".entry", ".post", ".story", ".main"}
OTHER_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "search"}
OTHER_NAMES = {
    "." + n
    for n in (
        "ad ads advert advertisement sponsored promo banner cookie notice consent alert popup modal "
        "menu nav navbar navigation breadcrumb breadcrumbs toolbar header masthead topbar footer "
        "copyright sidebar widget related recommended share social newsletter subscribe login "
        "search comment comments commentlist disqus reply replies pagination pager tags"
    ).split()
}

# Containers of new layouts, as tag and names.
CONTENT = "article|main|div content|div article-body|div entry-content|div post|section story|div main|div text|td"
MENUS = "nav|div menu|ul nav|div navbar|div breadcrumbs|nav navigation|div pagination|div tags"
HEADERS = "header|div header|div masthead|div topbar|div site-header"
NOTICES = "div cookie-notice|div notice|div alert|div banner|div consent|dialog|div popup|div newsletter"
ADVERTS = "div ad|div ads|div advert|aside promo|div sponsored|div advertisement|section ad"
SIDEBARS = "aside|div sidebar|aside sidebar|div widget|div related|section related|div recommended"
FORMS = "form|form search|form login|div subscribe|form newsletter|div search"
COMMENTS = "section comments|div comments|ol commentlist|div comment|ul replies|div disqus|section comment"
FOOTERS = "footer|div footer|div copyright|footer footer|div site-footer|section footer"

Path = tuple[tuple[str, ...], ...]


def told(path: Path) -> int:
    """What the innermost telling element says: 1 main text, 0 other, -1 nothing."""
    for tag, *names in reversed(path):
        if tag in OTHER_TAGS or OTHER_NAMES.intersection(names):
            return 0
        if tag in MAIN_TAGS or MAIN_NAMES.intersection(names):
            return 1
    return -1


class _Layouts:
    """Pages laid out anew from the texts of the sample."""

    def __init__(self, main: list[list[str]], other: list[str], rng: np.random.Generator):
        self.main, self.rng = main, rng
        words = [w for texts in main[:50] for t in texts for w in t.split()[:200]] or ["text"]
        self.words, self.other = words[:20_000], other or words[:500]

    def _one(self, values):
        return values[int(self.rng.integers(len(values)))]

    def _chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def _element(self, kinds: str) -> tuple[str, ...]:
        tag, _, names = self._one(kinds.split("|")).partition(" ")
        if names and self._chance(NAMELESS):
            names = "" if self._chance(0.5) else self._made_up()
        elif not names and self._chance(0.15):
            names = self._made_up()
        return element(tag, names)

    def _made_up(self) -> str:
        return "".join(chr(97 + int(c)) for c in self.rng.integers(0, 26, 5))

    def _short(self) -> str:
        return self._one(self.words)[:40]

    def _text(self) -> str:
        """A text as others have it: a foreign paragraph, a line of another part, a few words."""
        k = self.rng.random()
        if k < 0.4:
            return self._one(self._one(self.main) or ["text"])
        if k < 0.7:
            return self._one(self.other)
        return " ".join(self._short() for _ in range(int(self.rng.integers(1, 25))))

    def _links(self, outer: Path, kinds: str) -> list[Block]:
        own = (*outer, self._element(kinds))
        item = self._one([(("ul",), ("li",), ("a",)), (("a",),), (("li",), ("a",)), (("ul",), ("li",))])
        linked = 1.0 if item[-1] == ("a",) else 0.0
        item = item[:-1] if linked and len(item) > 1 else item
        return [Block((*own, *item), self._short(), linked) for _ in range(int(self.rng.integers(2, 9)))]

    def _part(self, outer: Path, kinds: str, most: int = 3) -> list[Block]:
        own = (*outer, self._element(kinds))
        inner = self._one([(), (("p",),), (("p",),), (("div",),), (("ul",), ("li",)), (("h3",),), (("h2",),), (("h1",),),
                           (("span",),), (("li",), ("p",))])
        return [
            Block((*own, *inner), self._text(), float(self._chance(0.15)))
            for _ in range(int(self.rng.integers(1, most + 1)))
        ]

    def _article(self, outer: Path, texts: list[str]) -> tuple[list[Block], list[int]]:
        if self._chance(0.9):
            outer = (*outer, self._element(CONTENT))
        if self._chance(0.15):
            outer = (*outer, element("div", self._made_up()))
        found, labels = [], []
        for i, text in enumerate(texts):
            if i and self._chance(0.08):
                kinds = self._one([ADVERTS, SIDEBARS, NOTICES, FORMS])
                extra = self._part(outer, kinds, 2)
                found += extra
                labels += [0] * len(extra)
            if i == 0 and self._chance(0.9):
                inner = self._one([(("h1",),), (("h1",),), (("h2",),), (("header",), ("h1",))])
            elif self._chance(0.85):
                inner = (("p",),) if self._chance(0.9) else (("p",), ("b",))
            else:
                inner = self._one([(("ul",), ("li",)), (("blockquote",),), (("blockquote",), ("p",)), (("h2",),),
                                   (("h3",),), (("pre",),), (("div",),), (("ol",), ("li",)), (("table",), ("tr",), ("td",)), ()])
            found.append(Block((*outer, *inner), text, 0.0 if self._chance(0.9) else 0.3))
            labels.append(1)
        return found, labels

    def page(self, texts: list[str]) -> tuple[list[Block], list[int]]:
        outer: Path = (("html",), ("body",))
        for _ in range(int(self.rng.integers(0, 3))):
            outer = (*outer, self._element("div wrapper|div page|div container|div|section|div row|div site"))
        before: list[list[Block]] = []
        for chance, make in (
            (0.5, lambda: self._part(outer, HEADERS)),
            (0.7, lambda: self._links(outer, MENUS)),
            (0.3, lambda: self._links((*outer, self._element(HEADERS)), MENUS)),
            (0.35, lambda: self._part(outer, NOTICES, 2)),
            (0.4, lambda: self._part(outer, ADVERTS, 2)),
            (0.2, lambda: self._part(outer, FORMS)),
            (0.2, lambda: self._part(outer, SIDEBARS)),
        ):
            if self._chance(chance):
                before.append(make())
        found = [b for k in self.rng.permutation(len(before)) for b in before[k]]
        article, labels = self._article(outer, texts)
        inside = article[-1].path[: len(outer) + 1] if self._chance(0.3) else outer
        after: list[list[Block]] = []
        for chance, make in (
            (0.5, lambda: self._part(inside, COMMENTS, 5)),
            (0.35, lambda: self._part(outer, SIDEBARS, 4)),
            (0.2, lambda: self._links(outer, SIDEBARS)),
            (0.3, lambda: self._part(outer, FORMS)),
            (0.25, lambda: self._part(outer, ADVERTS, 2)),
            (0.15, lambda: self._part(outer, NOTICES, 2)),
        ):
            if self._chance(chance):
                after.append(make())
        rest = [b for part in after for b in part]
        if self._chance(0.8):
            rest += self._part(outer, FOOTERS)
        return found + article + rest, [0] * len(found) + labels + [0] * len(rest)


def training_pages(htmls: list[str], seed: int = 11) -> tuple[list[list[Block]], list[list[int]]]:
    """The pages of a sample and new layouts of their texts, with labels."""
    rng = np.random.default_rng(seed)
    pages = [p for p in (blocks(h)[:LEARNED] for h in htmls) if p]
    labels = [[told(b.path) for b in p] for p in pages]
    main = [
        [b.text for b, y in zip(p, ys, strict=True) if y == 1] or [b.text for b, y in zip(p, ys, strict=True) if y]
        for p, ys in zip(pages, labels, strict=True)
    ]
    other = [b.text for p, ys in zip(pages, labels, strict=True) for b, y in zip(p, ys, strict=True) if y == 0]
    main = [texts for texts in main if texts]
    if not main:
        main = [[b.text for b in p] for p in pages]
    layouts = _Layouts(main, other, rng)
    sequences, wanted = [], []
    for page, ys in zip(pages, labels, strict=True):
        if 1 in ys:
            sequences.append(page)
            wanted.append(ys)
    for texts in main:
        for _ in range(LAID):
            page, ys = layouts.page(texts)
            sequences.append(page)
            wanted.append(ys)
    return sequences, wanted


def learn(pages: DataFrame) -> Model | None:
    """The labeller from a bounded sample of the pages; None where there is no text at all."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    texts = pages.select(html.alias("html"), F.xxhash64(html).alias("order")).filter("html <> ''")
    # Hashes first, so that no more than SAMPLE texts ever leave their tasks; copies count once.
    hashes = texts.select("order").distinct().orderBy("order").limit(SAMPLE).collect()
    chosen = texts.filter(F.col("order").isin([r.order for r in hashes]))
    cut = chosen.groupBy("order").agg(F.min(F.substring("html", 1, READ)).alias("html"))
    sequences, wanted = training_pages([r.html for r in cut.orderBy("order").collect()])
    return train(sequences, wanted) if sequences else None


def main_texts(model: Model, hasher: Hasher, htmls: list[str]) -> list[str]:
    """The main text of each page."""
    pages = [blocks(h) for h in htmls]
    if not any(pages):
        return [""] * len(pages)
    features = hasher.features(pages)
    keep = scores(model, features) > 0.5
    found = []
    for page, start in zip(pages, features.starts.tolist()):
        found.append("\n".join(b.text for k, b in enumerate(page, start) if keep[k]))
    return found


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    spark = pages.sparkSession
    model = spark.sparkContext.broadcast(learn(pages))
    schema = T.StructType(
        [
            pages.schema["page_id"],
            pages.schema["url"],
            T.StructField("text", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for rows, htmls in pieces(batches, "html"):
            as_text = [(h or b"").decode("utf-8", "replace") for h in htmls]
            texts = main_texts(model.value, hasher, as_text) if model.value else [""] * len(htmls)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("page_id"),
                    rows.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return small_batches(pages.select("page_id", "url", "html")).mapInArrow(extract, schema)
