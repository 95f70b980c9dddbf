"""URL filters: fixed rules first, association rules mined from labelled pages for the rest.

A page is labelled through `labels` by the document that its url names, the last number of the path
(page ids are counted by themselves): toxic or of low quality means block, else allow. The tokens of a url (parts of its host, words of its path, names of its parameters; numbers share one
token) and the label are a transaction. Spark's FP-growth finds the frequent combinations; rules
from tokens to a label stay when support, confidence and lift are high enough and no shorter rule is
at least as sure. They are matched through an inverted index: a token lists the rules that hold it,
a rule fires when all its tokens have been met, and the surest one decides. No rule: allow.

The number of mined rules is bounded by the support, not by the input. Defined results: a null url,
or one without `://`, has an empty host and path and no tokens, so it is allowed; without labelled
pages no rules are mined; a page without a number in its path has no label; ties between rules go to the higher support, then to the first by name.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import pandas as pd
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed rules: (verdict, host and path).
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
MIN_SUPPORT = 0.004
#: Labelled pages that a rule rests on at least, where the support would ask for fewer.
MIN_PAGES = 25
MIN_CONFIDENCE = 0.6
MIN_LIFT = 1.02
#: Tokens of a rule at most.
LONGEST = 4
_LABEL = "label:"


def host_of(url: Column) -> Column:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, upper, lower)


def path_of(url: Column) -> Column:
    pattern = r"(?s)^.*?://[^/?#]*([^?#]*)"
    return F.regexp_extract(F.coalesce(url, F.lit("")), pattern, 1)


def document_of(path: Column) -> Column:
    """Number of the document that a path names: its last run of digits, as text without zeros ahead."""
    last = F.regexp_extract(path, r"(?s)([0-9]+)[^0-9]*$", 1)
    return F.regexp_replace(F.when(last != "", last), "^0+(?=.)", "")


def fixed_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fixed rule that fits, else nulls."""
    rule = verdict = None
    for kind, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        site, _, start = text.partition("/")
        fits = ((host == site) | host.endswith("." + site)) & path.startswith("/" + start)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return rule, verdict


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Different tokens of a url, with the part they are from in front."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\?([^#]*)", 1)

    def named(part: Column, pattern: str, prefix: str) -> Column:
        words = F.filter(F.split(F.lower(part), pattern), lambda w: w != "")
        return F.transform(
            words,
            lambda w: F.concat(F.lit(prefix), F.when(w.rlike("^[0-9]+$"), "0").otherwise(w)),
        )

    names = F.regexp_replace(query, "=[^&]*", "")
    found = F.concat(
        named(host, r"[.:@-]", "h:"), named(path, r"[^\p{L}0-9]+", "p:"), named(names, "&", "q:")
    )
    return F.array_distinct(found)


def mine(
    labelled: DataFrame,
    support: float = MIN_SUPPORT,
    confidence: float = MIN_CONFIDENCE,
    lift: float = MIN_LIFT,
    min_pages: int = MIN_PAGES,
) -> pd.DataFrame:
    """Rules (tokens, label, confidence, support) from rows of `tokens` and `label`."""
    items = F.array_append("tokens", F.concat(F.lit(_LABEL), F.col("label")))
    rows = labelled.select(items.alias("items"))
    columns = ["tokens", "label", "confidence", "support"]
    n_rows = rows.count()
    if n_rows < min_pages:
        return pd.DataFrame(columns=columns)
    support = max(support, min_pages / n_rows)
    mined = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(rows)
    rules = mined.associationRules.filter(
        F.col("consequent")[0].startswith(_LABEL)
        & (F.size("antecedent") <= LONGEST)
        & (F.col("lift") >= lift)
    )
    found = rules.select(
        F.sort_array("antecedent").alias("tokens"),
        F.substring(F.col("consequent")[0], len(_LABEL) + 1, 10).alias("label"),
        "confidence",
        "support",
    )
    return pruned(found.toPandas())


def pruned(rules: pd.DataFrame) -> pd.DataFrame:
    """Without the rules that a rule of fewer tokens makes needless."""
    kept: dict[tuple, float] = {}
    rows = sorted(rules.itertuples(index=False), key=lambda r: (len(r.tokens), list(r.tokens)))
    stay = []
    for r in rows:
        own = frozenset(r.tokens)
        if not any(
            label == r.label and less < own and sure >= r.confidence
            for (less, label), sure in kept.items()
        ):
            kept[own, r.label] = r.confidence
            stay.append(r)
    return pd.DataFrame(stay, columns=["tokens", "label", "confidence", "support"])


class RuleIndex:
    """Inverted index from tokens to the mined rules that hold them."""

    def __init__(self, rules: pd.DataFrame, default: str = "allow") -> None:
        order = sorted(
            rules.itertuples(index=False), key=lambda r: (-r.confidence, -r.support, list(r.tokens))
        )
        self.labels = [r.label for r in order]
        self.sizes = [len(r.tokens) for r in order]
        self.default = default
        self.lists: dict[str, list[int]] = defaultdict(list)
        for i, r in enumerate(order):
            for token in r.tokens:
                self.lists[token].append(i)

    def verdict(self, tokens) -> str:
        met = Counter(i for t in set(tokens) for i in self.lists.get(t, ()))
        fired = [i for i, n in met.items() if n == self.sizes[i]]
        return self.labels[min(fired)] if fired else self.default


def judged(pages: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of every page."""
    url = F.col("url")
    host, path = host_of(url), path_of(url)
    parts = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    parts = parts.select(
        "page_id",
        "host",
        "path",
        tokens_of(url, host, path).alias("tokens"),
        document_of(F.col("path")).alias("document"),
    )
    bad = F.bool_or((F.col("toxic") == 1) | (F.col("quality") == 0))
    known = labels.groupBy(F.col("doc_id").cast("string").alias("document")).agg(bad.alias("bad"))
    known = known.filter(F.col("bad").isNotNull() & F.col("document").isNotNull())
    label = F.when(F.col("bad"), "block").otherwise("allow").alias("label")
    index = RuleIndex(mine(parts.join(known, "document").select("tokens", label)))

    @F.pandas_udf("string")
    def by_rules(tokens: pd.Series) -> pd.Series:
        return tokens.map(index.verdict)

    rule, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    return parts.select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, by_rules("tokens")).alias("verdict"),
    )
