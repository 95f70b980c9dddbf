"""Data-quality checks. Every check is an aggregate that yields one result row.

A rule set is checked in one scan for all row-wise rules plus one scan and one shuffle of digests for
all uniqueness rules.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import digest, unpivoted
from tidemark.functions.measures import ratio

CRITICAL = "critical"
WARNING = "warning"
# Keys of a rule file. Those of the details of a result row, below, are fixed as well
# (columns, column, pattern, min_expected, max_expected, actual_min, actual_max, fill_rate,
# worst_columns, null_rate): existing logs have them.
RULE_KEYS = ("not_null", "unique", "ranges", "patterns", "min_fill_rate")
RESULT_COLUMNS = (
    "check_name",
    "passed",
    "severity",
    "failed_rows",
    "total_rows",
    "failure_rate",
    "message",
    "details",
)


class DataQualityError(RuntimeError):
    """A critical check failed."""


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def load_rules(text: str) -> dict:
    """Rule set from JSON; the rules may stand at the top or under `checks`."""
    rules = json.loads(text)
    rules = rules.get("checks", rules)
    return {k: rules[k] for k in RULE_KEYS if k in rules}


# --- what makes a row fail ------------------------------------------------------------------


def fails_not_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (_q(c).isNull() for c in columns))


def fails_range(column: str, low: float | None, high: float | None) -> Column:
    """Outside the closed range; NULL fails as soon as one bound is set."""
    inside = F.lit(True)
    if low is not None:
        inside = inside & (_q(column) >= F.lit(low))
    if high is not None:
        inside = inside & (_q(column) <= F.lit(high))
    return ~F.coalesce(inside, F.lit(False))


def fails_pattern(column: str, pattern: str) -> Column:
    """Text that does not match from its start; NULL is tested as the text `None`."""
    text = F.coalesce(_q(column).cast("string"), F.lit("None"))
    return ~text.rlike(f"^(?:{pattern})")


# --- result rows ----------------------------------------------------------------------------


def _result(
    name: str, severity: str, failed: Column, total: Column, details: Column, passed: Column | None = None
) -> Column:
    """One result row as a struct of `RESULT_COLUMNS`."""
    ok = failed == 0 if passed is None else passed
    message = F.when(ok, F.lit("ok")).otherwise(
        F.concat(failed.cast("string"), F.lit(" of "), total.cast("string"), F.lit(" rows failed"))
        if passed is None
        else F.lit("fill rate below minimum")
    )
    values = (F.lit(name), ok, F.lit(severity), failed, total, ratio(failed, total), message, details)
    return F.struct(*(v.alias(c) for v, c in zip(values, RESULT_COLUMNS)))


def _rows(aggregated: DataFrame, results: Sequence[Column]) -> DataFrame:
    return aggregated.select(F.explode(F.array(*results)).alias("r")).select("r.*")


class _Fused:
    """Collects the aggregates of several rules so that one scan serves them all."""

    def __init__(self, df: DataFrame):
        self.df = df
        self.aggregates: dict[str, Column] = {"n": F.count(F.lit(1))}
        self.results: list[Column] = []

    def _agg(self, expr: Column) -> Column:
        name = f"a{len(self.aggregates)}"
        self.aggregates[name] = expr
        return F.col(name)

    def not_null(self, columns: Sequence[str], severity: str, name: str) -> None:
        failed = self._agg(F.count_if(fails_not_null(columns)))
        details = F.to_json(F.struct(F.array(*map(F.lit, columns)).alias("columns")))
        self.results.append(_result(name, severity, failed, F.col("n"), details))

    def value_range(self, column, low, high, severity: str, name: str) -> None:
        failed = self._agg(F.count_if(fails_range(column, low, high)))
        least, most = self._agg(F.min(_q(column))), self._agg(F.max(_q(column)))
        details = F.to_json(
            F.struct(
                F.lit(column).alias("column"),
                F.lit(low).cast("double").alias("min_expected"),
                F.lit(high).cast("double").alias("max_expected"),
                least.alias("actual_min"),
                most.alias("actual_max"),
            ),
            {"ignoreNullFields": "false"},
        )
        self.results.append(_result(name, severity, failed, F.col("n"), details))

    def pattern(self, column: str, pattern: str, severity: str, name: str) -> None:
        failed = self._agg(F.count_if(fails_pattern(column, pattern)))
        details = F.to_json(
            F.struct(F.lit(column).alias("column"), F.lit(pattern).alias("pattern"))
        )
        self.results.append(_result(name, severity, failed, F.col("n"), details))

    def completeness(self, min_fill_rate: float, severity: str, name: str) -> None:
        columns = self.df.columns
        nulls = [(c, self._agg(F.count_if(_q(c).isNull()))) for c in columns]
        cells = F.col("n") * F.lit(len(columns))
        null_cells = reduce(lambda a, b: a + b, (k for _, k in nulls))
        fill_rate = F.lit(1.0) - ratio(null_cells, cells)
        worst = F.slice(
            F.array_sort(
                F.array(
                    *(
                        F.struct((-ratio(k, F.col("n"))).alias("r"), F.lit(c).alias("c"))
                        for c, k in nulls
                    )
                )
            ),
            1,
            5,
        )
        details = F.to_json(
            F.struct(
                fill_rate.alias("fill_rate"),
                F.lit(float(min_fill_rate)).alias("min_expected"),
                F.transform(
                    worst, lambda x: F.struct(x["c"].alias("column"), F.abs(x["r"]).alias("null_rate"))
                ).alias("worst_columns"),
            )
        )
        passed = fill_rate >= F.lit(float(min_fill_rate))
        # The check judges cells, not rows, so it reports no failed rows.
        self.results.append(
            _result(name, severity, F.lit(0).cast("bigint"), F.col("n"), details, passed)
        )

    def rows(self) -> DataFrame:
        aggregated = self.df.agg(*(e.alias(n) for n, e in self.aggregates.items()))
        return _rows(aggregated, self.results)


# --- single checks --------------------------------------------------------------------------


def check_not_null(df: DataFrame, columns: Sequence[str], severity=CRITICAL, name="not_null") -> DataFrame:
    """Rows with a NULL in any of the columns."""
    fused = _Fused(df)
    fused.not_null(columns, severity, name)
    return fused.rows()


def check_value_range(
    df: DataFrame, column: str, low=None, high=None, severity=WARNING, name="value_range"
) -> DataFrame:
    """Rows outside the closed range, with the actual limits."""
    fused = _Fused(df)
    fused.value_range(column, low, high, severity, name)
    return fused.rows()


def check_pattern(df: DataFrame, column: str, pattern: str, severity=WARNING, name="pattern") -> DataFrame:
    """Rows whose text does not start with a match of the pattern."""
    fused = _Fused(df)
    fused.pattern(column, pattern, severity, name)
    return fused.rows()


def check_completeness(
    df: DataFrame, min_fill_rate: float = 0.95, severity=WARNING, name="completeness"
) -> DataFrame:
    """Share of filled cells against a minimum; an empty table counts as filled."""
    fused = _Fused(df)
    fused.completeness(min_fill_rate, severity, name)
    return fused.rows()


def check_uniqueness(df: DataFrame, columns: Sequence[str], severity=CRITICAL, name="uniqueness") -> DataFrame:
    """All rows of keys that occur more than once; NULLs count as equal."""
    return check_unique_sets(df, {name: columns}, severity)


def check_unique_sets(df: DataFrame, keys: Mapping[str, Sequence[str]], severity=CRITICAL) -> DataFrame:
    """A result row per named set of columns, from one scan and one shuffle for all of them.

    Rows are unpivoted to (rule, digest of the key): fixed width whatever the values, counted per
    task before the shuffle, so a key that fills the table is one row per task.
    """
    names = list(keys)
    cells = [digest(df, keys[name]) for name in names]
    counts = (
        unpivoted(cells, df, ["d1", "d2"])
        .withColumnRenamed("id", "rule")
        .groupBy("rule", "d1", "d2")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    figures = counts.groupBy("rule").agg(
        F.sum(F.when(F.col("cnt") > 1, F.col("cnt")).otherwise(0)).alias("failed"),
        F.sum("cnt").alias("n"),
    )
    # One row, so that an empty table has its result rows too.
    by_rule = figures.agg(
        F.map_from_entries(F.collect_list(F.struct("rule", F.struct("failed", "n")))).alias("by_rule")
    )
    results = []
    for place, name in enumerate(names):
        found = F.col("by_rule")[place]
        failed, total = (F.coalesce(found[c], F.lit(0)).cast("bigint") for c in ("failed", "n"))
        details = F.to_json(F.struct(F.array(*map(F.lit, keys[name])).alias("columns")))
        results.append(_result(name, severity, failed, total, details))
    return _rows(by_rule, results)


def worst_columns(df: DataFrame, n: int = 5) -> DataFrame:
    """The `n` columns with the highest share of NULLs, in one scan."""
    rates = df.agg(
        *(ratio(F.count_if(_q(c).isNull()), F.count(F.lit(1))).alias(c) for c in df.columns)
    )
    listed = rates.unpivot([], [f"`{c}`" for c in df.columns], "column_name", "null_rate")
    return listed.orderBy(F.desc("null_rate"), "column_name").limit(n)


# --- samples, asked for only when a check has failed ---------------------------------------


def sample_duplicates(df: DataFrame, columns: Sequence[str], n: int = 10) -> DataFrame:
    """Lowest `n` keys that occur more than once."""
    keys = [_q(c) for c in columns]
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1")
        .orderBy(*keys).limit(n)
    )


def sample_mismatches(df: DataFrame, column: str, pattern: str, n: int = 5) -> DataFrame:
    """Lowest `n` distinct values that do not match."""
    return (
        df.filter(fails_pattern(column, pattern)).select(_q(column)).distinct()
        .orderBy(_q(column)).limit(n)
    )


def failure_samples(df: DataFrame, rules: Mapping, failed: Iterable[str]) -> DataFrame | None:
    """Samples of the failed uniqueness and pattern rules, as `check_name` and a JSON text.

    At most ten rows a rule, all rules in one job; None when no such rule failed.
    """
    wanted, parts = set(failed), []
    for keys in rules.get("unique", ()):
        parts.append(("unique_" + "_".join(keys), sample_duplicates(df, keys).drop("cnt")))
    for column, pattern in rules.get("patterns", {}).items():
        parts.append((f"pattern_{column}", sample_mismatches(df, column, pattern)))
    samples = [
        part.select(
            F.lit(name).alias("check_name"),
            F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("sample"),
        )
        for name, part in parts
        if name in wanted
    ]
    return reduce(DataFrame.unionByName, samples) if samples else None


def run_with_samples(df: DataFrame, rules: Mapping) -> DataFrame:
    """`run_all_checks`, with samples in the details of what failed.

    The second pass over the data is made only when a rule has failed. The result rows (one per
    rule) are held by the driver.
    """
    results = run_all_checks(df, rules)
    rows = [r.asDict() for r in results.collect()]
    samples = failure_samples(df, rules, [r["check_name"] for r in rows if not r["passed"]])
    found: dict[str, list] = {}
    for sample in samples.collect() if samples is not None else ():
        found.setdefault(sample["check_name"], []).append(json.loads(sample["sample"]))
    for row in rows:
        if row["check_name"] in found:
            details = json.loads(row["details"]) | {"samples": found[row["check_name"]]}
            row["details"] = json.dumps(details, ensure_ascii=False)
    return df.sparkSession.createDataFrame(rows, results.schema)


# --- rule sets ------------------------------------------------------------------------------


def run_all_checks(df: DataFrame, rules: Mapping) -> DataFrame:
    """Result rows of a whole rule set."""
    fused = _Fused(df)
    for column in rules.get("not_null", ()):
        fused.not_null([column], CRITICAL, f"not_null_{column}")
    for column, bounds in rules.get("ranges", {}).items():
        fused.value_range(column, bounds.get("min"), bounds.get("max"), WARNING, f"range_{column}")
    for column, pattern in rules.get("patterns", {}).items():
        fused.pattern(column, pattern, WARNING, f"pattern_{column}")
    if "min_fill_rate" in rules:
        fused.completeness(rules["min_fill_rate"], WARNING, "completeness")
    parts = [fused.rows()] if fused.results else []
    if rules.get("unique"):
        parts.append(check_unique_sets(df, {"unique_" + "_".join(keys): keys for keys in rules["unique"]}))
    if not parts:
        raise ValueError("the rule set holds no rule")
    return reduce(DataFrame.unionByName, parts)


def summarize(results: DataFrame, table: str) -> DataFrame:
    """Totals over result rows, one row."""
    total = F.count(F.lit(1))
    passed = F.count_if(F.col("passed"))
    critical = F.count_if(~F.col("passed") & (F.col("severity") == CRITICAL))
    return results.agg(
        total.alias("total_checks"),
        passed.alias("passed"),
        (total - passed).alias("failed"),
        ratio(passed, total).alias("success_rate"),
        critical.alias("critical_failures"),
        (critical > 0).alias("has_critical_failure"),
    ).select(F.lit(table).alias("table_name"), "*")


def failed_critical(results: Iterable) -> list[str]:
    """Names of the critical checks that failed."""
    return [r["check_name"] for r in results if not r["passed"] and r["severity"] == CRITICAL]


def gate(results: DataFrame) -> list:
    """Result rows (one per rule), or `DataQualityError` when a critical check failed."""
    rows = results.collect()
    failures = failed_critical(rows)
    if failures:
        raise DataQualityError(f"critical checks failed: {', '.join(sorted(failures))}")
    return rows


def timestamp_inconsistencies(df: DataFrame) -> DataFrame:
    """Number of rows loaded before their own source timestamp, one row."""
    wrong = F.col("ts_source").isNotNull() & (F.col("load_ts") < F.col("ts_source"))
    return df.agg(F.count_if(wrong).alias("invalid_rows"), F.count(F.lit(1)).alias("total_rows"))


def audit_target(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Checks every loaded table has to pass: keys unique and present, hash present."""
    rules = {"not_null": [*keys, "hashdiff"], "unique": [list(keys)]}
    return run_all_checks(df, rules)
