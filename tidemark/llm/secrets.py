"""Secret scan: fixed patterns, and Markov models of random strings against ordinary identifiers.

The patterns find assignments, access keys and hexadecimal runs. The method looks at other long
tokens: two first-order character models, one of random strings and one of ordinary identifiers,
give a log-likelihood ratio per transition, and tokens whose mean ratio is above a threshold are
added. The models are counted from labelled samples. Random strings are drawn once from the alphabets
below, in equal parts, whatever the table holds; the different values that a fixed pattern found are
one part more per kind, which never weighs more than a drawn one. Identifiers are the words without
digits of a bounded sample of documents, or the names of Python where a sample has no words.

Everything is a DataFrame expression: matches by `regexp_extract_all`, their places from the lengths
of what `split` leaves between them, ratios from a table of 68 x 68 numbers in the plan.

Defined results: a null text is empty and has no spans; null and repeated ids are ids like others, and
equal rows are scanned each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

import builtins
import keyword
import math
import random
import string
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.scratch import materialize

#: Fixed patterns by kind, in the order of the report, with the least length that counts.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
PATTERNS = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]{16,}"}
LEAST = {"assign": 12, "access": 18, "hex": 16}
#: Tokens that the models judge.
MARKOV = "markov"
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = [*PATTERNS, MARKOV]
#: Symbols of the models; all others share the last place.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_SIZE = len(ALPHABET) + 1
#: Alphabets of the random strings that are drawn, and how many strings of DRAWN_LENGTH for each.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": string.ascii_uppercase + "234567",
    "base64": string.ascii_letters + string.digits + "+/",
    "alphanumeric": string.ascii_letters + string.digits,
    "lower and digits": string.ascii_lowercase + string.digits,
    "upper and digits": string.ascii_uppercase + string.digits,
    "letters": string.ascii_letters,
    "lower": string.ascii_lowercase,
    "upper": string.ascii_uppercase,
}
DRAWN, DRAWN_LENGTH = 1000, 41
#: Documents that the identifiers are learned from, about; the bound of the sample.
SAMPLE = 4000
#: Weight of a character's own frequency in the transitions to it.
PRIOR = 10.0
#: Mean log-likelihood ratio per transition that makes a token a secret.
THRESHOLD = 0.4


def scanned(docs: DataFrame) -> DataFrame:
    """A written row per document: row, doc_id, and per kind its matches and the gaps before them."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text.alias("text"))
    patterns = PATTERNS | {MARKOV: TOKEN}
    for kind, pattern in patterns.items():
        rows = rows.withColumn(kind, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    for kind, pattern in patterns.items():
        gaps = F.transform(F.split("text", pattern, -1), F.length)
        rows = rows.withColumn(f"{kind}_gaps", F.when(F.size(kind) > 0, gaps))
    return materialize(rows.drop("text"), "scanned")


def placed(found: DataFrame) -> DataFrame:
    """(row, kind, start, end, value): the matches that are long enough, with their places."""
    spans = None
    for number, kind in enumerate(KINDS):
        zipped = F.arrays_zip(F.col(kind).alias("hit"), F.col(f"{kind}_gaps").alias("gap"))
        own = found.filter(F.size(kind) > 0).select("row", F.posexplode(zipped).alias("at", "m"))
        own = own.filter(F.col("m.hit").isNotNull()).select(
            "row", F.lit(number).alias("kind"), "at", F.col("m.hit").alias("hit"), "m.gap"
        )
        spans = own if spans is None else spans.unionByName(own)
    ahead = Window.partitionBy("row", "kind").orderBy("at")
    so_far = ahead.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.length("hit")).over(so_far)
    spans = spans.withColumn("end", end).withColumn("start", F.col("end") - F.length("hit"))
    value = F.when(F.col("kind") == 0, F.regexp_extract("hit", ASSIGN, 2)).otherwise(F.col("hit"))
    least = F.element_at(F.array(*[F.lit(LEAST.get(k, 1)) for k in KINDS]), F.col("kind") + 1)
    spans = spans.withColumn("value", value).filter(F.length("value") >= least)
    return materialize(spans.select("row", "kind", "start", "end", "value"), "spans")


def _places(token: Column) -> Column:
    """Numbers of the characters in the alphabet."""
    codes = [ALPHABET.find(chr(c)) if chr(c) in ALPHABET else _SIZE - 1 for c in range(128)]
    table = F.array(*[F.lit(c) for c in codes])
    return F.transform(
        F.split(token, ""), lambda c: F.coalesce(F.get(table, F.ascii(c)), F.lit(_SIZE - 1))
    )


def _pairs(token: Column) -> Column:
    """Numbers of the transitions of a token of two characters or more."""
    places, n = _places(token), F.length(token) - 1
    return F.zip_with(F.slice(places, 1, n), F.slice(places, 2, n), lambda a, b: a * _SIZE + b)


def _transitions(tokens: DataFrame) -> dict[int, int]:
    """How often each transition occurs: at most 68 x 68 numbers."""
    long = tokens.filter(F.length("token") > 1)
    counted = long.select(F.explode(_pairs(F.col("token"))).alias("pair")).groupBy("pair").count()
    return {pair: n for pair, n in counted.collect()}


def drawn(seed: int = 1) -> dict[int, float]:
    """Transitions of the drawn strings of all alphabets."""
    rng, found = random.Random(seed), Counter()
    for alphabet in ALPHABETS.values():
        for _ in range(DRAWN):
            places = [ALPHABET.index(c) for c in rng.choices(alphabet, k=DRAWN_LENGTH)]
            found.update(a * _SIZE + b for a, b in zip(places, places[1:]))
    return found


def random_strings(fixed: DataFrame) -> dict[int, float]:
    """Transitions of the drawn strings and of the different values of each fixed kind."""
    found, part = Counter(drawn()), DRAWN * (DRAWN_LENGTH - 1)
    for number in range(len(PATTERNS)):
        own = fixed.filter(F.col("kind") == number).select(F.col("value").alias("token"))
        counts = _transitions(own.distinct())
        weight = min(1.0, part / max(sum(counts.values()), 1))
        for pair, n in counts.items():
            found[pair] += n * weight
    return found


def identifiers(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Different words without digits of about `sample` documents, picked by a hash of id and text."""
    every = max(1, round(docs.count() / sample))
    some = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(every)) == 0)
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[A-Za-z_+/=-]{4,}"), F.lit(0))
    return some.select(F.explode(words).alias("token")).distinct()


def known_identifiers() -> dict[int, int]:
    """Transitions of the names that Python itself has: identifiers for a sample without words."""
    found: Counter = Counter()
    for name in {*keyword.kwlist, *dir(builtins)}:
        places = [ALPHABET.find(c) % _SIZE for c in name]
        found.update(a * _SIZE + b for a, b in zip(places, places[1:]))
    return found


def ratios(labelled: dict[int, float], ordinary: dict[int, int]) -> list[float] | None:
    """Log-likelihood ratio of every transition, or None without samples of both kinds."""
    if not labelled or not ordinary:
        return None
    tables = []
    for counts in (labelled, ordinary):
        single = [0.5] * _SIZE
        for pair, n in counts.items():
            single[pair % _SIZE] += n
        whole = sum(single)
        starts = [sum(counts.get(a * _SIZE + b, 0) for b in range(_SIZE)) for a in range(_SIZE)]
        # Transitions lean on the frequency of the character where a start was seldom met.
        tables.append(
            [
                math.log(
                    (counts.get(a * _SIZE + b, 0) + PRIOR * single[b] / whole) / (starts[a] + PRIOR)
                )
                for a in range(_SIZE)
                for b in range(_SIZE)
            ]
        )
    return [a - b for a, b in zip(*tables, strict=True)]


def mean_ratio(token: Column, table: list[float]) -> Column:
    values = F.array(*[F.lit(round(v, 6)) for v in table])
    total = F.aggregate(
        _pairs(token), F.lit(0.0), lambda acc, pair: acc + F.get(values, pair)
    )
    return total / (F.length(token) - 1)


def spans(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(found, spans): written rows of all documents, and (row, kind, start, end) of all secrets.

    A token that overlaps a fixed span is left to it.
    """
    found = scanned(docs)
    places = placed(found)
    fixed = places.filter(F.col("kind") < len(PATTERNS))
    table = ratios(random_strings(fixed), _transitions(identifiers(docs)) or known_identifiers())
    by_start = Window.partitionBy("row").orderBy("start", "kind")
    is_fixed = F.col("kind") < len(PATTERNS)
    before = F.max(F.when(is_fixed, F.col("end"))).over(
        by_start.rowsBetween(Window.unboundedPreceding, -1)
    )
    after = F.min(F.when(is_fixed, F.col("start"))).over(
        by_start.rowsBetween(1, Window.unboundedFollowing)
    )
    apart = (F.coalesce(before, F.lit(0)) <= F.col("start")) & (
        after.isNull() | (after >= F.col("end"))
    )
    judged = places.withColumn("apart", apart).filter(is_fixed | F.col("apart"))
    secret = F.when(is_fixed, True).otherwise(mean_ratio(F.col("value"), table) > threshold)
    return found, judged.filter(secret).select("row", "kind", "start", "end")


def report(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, counts of the fixed kinds, a digest of their spans, and all spans."""
    found, hits = spans(docs, threshold)
    name = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    label = F.concat_ws(":", name, F.col("start"), F.col("end"))
    listed = hits.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", label.alias("label")))).alias("all"),
        *[F.count_if(F.col("kind") == i).alias(f"n_{k}") for i, k in enumerate(PATTERNS)],
    )
    joined = found.select("row", "doc_id").join(listed, "row", "left")
    everything = F.coalesce("all", F.array().cast("array<struct<start:bigint,kind:int,label:string>>"))
    fixed = F.filter(everything, lambda s: s["kind"] < len(PATTERNS))

    def written(array: Column) -> Column:
        return F.array_join(F.transform(array, lambda s: s["label"]), ",")

    return joined.select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in PATTERNS],
        F.sha2(written(fixed), 256).alias("base_sha256"),
        written(everything).alias("spans"),
    )
