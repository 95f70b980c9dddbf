"""Data-quality checks and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.inputs import AS_OF, CUSTOMER_GAPS_SQL, SPARSE_SQL, customer_gaps, sparse_lineitem
from suite.registry import query, table
from tidemark.operators import profiling as prof
from tidemark.operators import quality as dq

_SHOWN = ["check_name", "passed", "severity", "failed_rows", "total_rows", "failure_rate"]


def _shown(results, *more):
    rate = F.round("failure_rate", 6).alias("failure_rate")
    return results.select(*(rate if c == "failure_rate" else c for c in _SHOWN), *more)


def _row(name, severity, failed, source, total="count(*)"):
    """SQL of one result row; `failed` is an aggregate over `source`."""
    return f"""SELECT '{name}' AS check_name, f = 0 AS passed, '{severity}' AS severity,
       f AS failed_rows, n AS total_rows,
       round(CASE WHEN n > 0 THEN f / n ELSE 0 END, 6) AS failure_rate
       FROM (SELECT CAST({failed} AS BIGINT) AS f, CAST({total} AS BIGINT) AS n FROM {source}) a"""


_GAPS = f"({CUSTOMER_GAPS_SQL}) c"
_QUANTITY = "(SELECT *, CASE WHEN l_returnflag <> 'N' THEN l_quantity END AS q FROM lineitem) l"
_DUPLICATES = """(SELECT count(*) AS cnt FROM lineitem GROUP BY l_orderkey, l_linenumber) k"""


@query("dq_not_null", _row("not_null", "critical", "count(*) FILTER (c_name IS NULL OR c_mktsegment IS NULL)", _GAPS))
def dq_not_null(spark, sf):
    return _shown(dq.check_not_null(customer_gaps(spark, sf), ["c_name", "c_mktsegment"]))


@query(
    "dq_uniqueness",
    _row("uniqueness", "critical", "coalesce(sum(cnt) FILTER (cnt > 1), 0)", _DUPLICATES, "sum(cnt)"),
)
def dq_uniqueness(spark, sf):
    return _shown(dq.check_uniqueness(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]))


@query(
    "dq_uniqueness_text",
    _row(
        "uniqueness",
        "critical",
        "coalesce(sum(cnt) FILTER (cnt > 1), 0)",
        "(SELECT count(*) AS cnt FROM documents GROUP BY text) k",
        "sum(cnt)",
    ),
)
def dq_uniqueness_text(spark, sf):
    return _shown(dq.check_uniqueness(table(spark, sf, "documents"), ["text"]))


@query(
    "dq_duplicate_sample",
    """SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
       ORDER BY l_orderkey, l_linenumber LIMIT 10""",
)
def dq_duplicate_sample(spark, sf):
    return dq.sample_duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dq_range",
    f"""SELECT r.*, low AS actual_min, high AS actual_max FROM ({_row(
        "value_range", "warning", "count(*) FILTER (NOT coalesce(q BETWEEN 5 AND 45, false))", _QUANTITY
    )}) r, (SELECT min(q) AS low, max(q) AS high FROM {_QUANTITY}) m""",
)
def dq_range(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn(
        "q", F.when(F.col("l_returnflag") != "N", F.col("l_quantity"))
    )
    return _shown(
        dq.check_value_range(rows, "q", 5, 45),
        F.get_json_object("details", "$.actual_min").cast("double").alias("actual_min"),
        F.get_json_object("details", "$.actual_max").cast("double").alias("actual_max"),
    )


_HTTPS = r"https://[\w.-]+/"


@query(
    "dq_pattern",
    _row("pattern", "warning", f"count(*) FILTER (NOT regexp_matches(url, '^(?:{_HTTPS})'))", "pages"),
)
def dq_pattern(spark, sf):
    return _shown(dq.check_pattern(table(spark, sf, "pages"), "url", _HTTPS))


@query(
    "dq_pattern_with_null",
    _row(
        "pattern",
        "warning",
        "count(*) FILTER (NOT regexp_matches(coalesce(c_mktsegment, 'None'), '^(?:[A-Z]+$)'))",
        _GAPS,
    ),
)
def dq_pattern_with_null(spark, sf):
    return _shown(dq.check_pattern(customer_gaps(spark, sf), "c_mktsegment", "[A-Z]+$"))


@query(
    "dq_pattern_sample",
    rf"""SELECT DISTINCT url FROM pages WHERE NOT regexp_matches(url, '^(?:{_HTTPS})')
         ORDER BY url LIMIT 5""",
)
def dq_pattern_sample(spark, sf):
    return dq.sample_mismatches(table(spark, sf, "pages"), "url", _HTTPS)


_GAP_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
_FILL = (
    "1 - ("
    + " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in _GAP_COLUMNS)
    + f") / ({len(_GAP_COLUMNS)} * count(*))"
)


@query(
    "dq_completeness",
    f"""SELECT 'completeness' AS check_name, fill >= 0.95 AS passed, 'warning' AS severity,
               CAST(0 AS BIGINT) AS failed_rows, n AS total_rows, 0.0::DOUBLE AS failure_rate,
               round(fill, 6) AS fill_rate
        FROM (SELECT {_FILL} AS fill, count(*) AS n FROM {_GAPS}) a""",
)
def dq_completeness(spark, sf):
    fill = F.get_json_object("details", "$.fill_rate").cast("double")
    return _shown(dq.check_completeness(customer_gaps(spark, sf)), F.round(fill, 6).alias("fill_rate"))


@query(
    "dq_worst_columns",
    "SELECT column_name, round(r, 6) AS null_rate FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) / count(*) AS r FROM {_GAPS}"
        for c in _GAP_COLUMNS
    )
    + ") w ORDER BY r DESC, column_name LIMIT 3",
)
def dq_worst_columns(spark, sf):
    worst = dq.worst_columns(customer_gaps(spark, sf), 3)
    return worst.select("column_name", F.round("null_rate", 6).alias("null_rate"))


RULES = {
    "not_null": ["c_custkey", "c_name"],
    "unique": [["c_custkey"], ["c_nationkey", "c_mktsegment"]],
    "ranges": {"c_acctbal": {"min": 0, "max": 9000}, "c_nationkey": {"min": 1}},
    "patterns": {"c_name": r"Customer#\d{9}$"},
    "min_fill_rate": 0.9,
}


def _groups(columns):
    return f"(SELECT count(*) AS cnt FROM {_GAPS} GROUP BY {columns}) k"


_REPEATED = "coalesce(sum(cnt) FILTER (cnt > 1), 0)"
_RUN_ALL_SQL = " UNION ALL ".join(
    [
        _row("not_null_c_custkey", "critical", "count(*) FILTER (c_custkey IS NULL)", _GAPS),
        _row("not_null_c_name", "critical", "count(*) FILTER (c_name IS NULL)", _GAPS),
        _row("unique_c_custkey", "critical", _REPEATED, _groups("c_custkey"), "sum(cnt)"),
        _row(
            "unique_c_nationkey_c_mktsegment",
            "critical",
            _REPEATED,
            _groups("c_nationkey, c_mktsegment"),
            "sum(cnt)",
        ),
        _row(
            "range_c_acctbal",
            "warning",
            "count(*) FILTER (NOT coalesce(c_acctbal BETWEEN 0 AND 9000, false))",
            _GAPS,
        ),
        _row("range_c_nationkey", "warning", "count(*) FILTER (NOT coalesce(c_nationkey >= 1, false))", _GAPS),
        _row(
            "pattern_c_name",
            "warning",
            r"count(*) FILTER (NOT regexp_matches(coalesce(c_name, 'None'), '^(?:Customer#\d{9}$)'))",
            _GAPS,
        ),
        f"""SELECT 'completeness', {_FILL} >= 0.9, 'warning', CAST(0 AS BIGINT), count(*), 0.0
            FROM {_GAPS}""",
    ]
)


@query("dq_run_all", _RUN_ALL_SQL)
def dq_run_all(spark, sf):
    return _shown(dq.run_all_checks(customer_gaps(spark, sf), RULES))


# Three uniqueness rules, one of them over long texts, in one scan and one shuffle.
_UNIQUE_SETS = {"unique_doc_id": ["doc_id"], "unique_text": ["text"], "unique_source_n_chars": ["source", "n_chars"]}


@query(
    "dq_unique_sets",
    " UNION ALL ".join(
        _row(
            name,
            "critical",
            _REPEATED,
            f"(SELECT count(*) AS cnt FROM documents GROUP BY {', '.join(columns)}) k",
            "sum(cnt)",
        )
        for name, columns in _UNIQUE_SETS.items()
    ),
)
def dq_unique_sets(spark, sf):
    return _shown(dq.check_unique_sets(table(spark, sf, "documents"), _UNIQUE_SETS))


@query(
    "dq_summary",
    f"""SELECT 'customer' AS table_name, count(*) AS total_checks, count(*) FILTER (passed) AS passed,
               count(*) FILTER (NOT passed) AS failed,
               round(count(*) FILTER (passed) / count(*), 6) AS success_rate,
               count(*) FILTER (NOT passed AND severity = 'critical') AS critical_failures,
               count(*) FILTER (NOT passed AND severity = 'critical') > 0 AS has_critical_failure
        FROM ({_RUN_ALL_SQL}) r""",
)
def dq_summary(spark, sf):
    summary = dq.summarize(dq.run_all_checks(customer_gaps(spark, sf), RULES), "customer")
    return summary.withColumn("success_rate", F.round("success_rate", 6))


# --- profiles -------------------------------------------------------------------------------

_SPARSE_TYPES = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
    "l_currency": "string",
    "l_note": "string",
    "l_memo": "string",
    "l_obsolete": "bigint",
}


def _profile_sql(types, source):
    parts = []
    for place, (name, kind) in enumerate(types.items(), 1):
        blank = f"count(*) FILTER (trim({name}) = '')" if kind == "string" else "0"
        parts.append(
            f"""SELECT '{name}' AS column_name, {place} AS ordinal, '{kind}' AS data_type,
                 count(*) AS total_rows, count(*) FILTER ({name} IS NULL) AS null_count,
                 {blank} AS empty_count, count(DISTINCT {name}) AS distinct_count FROM {source}"""
        )
    return f"""SELECT *, null_count + empty_count AS empty_total,
                 round((null_count + empty_count) / total_rows * 100, 2) AS empty_pct,
                 round(distinct_count / total_rows, 4) AS distinct_ratio
               FROM ({" UNION ALL ".join(parts)}) p"""


_PROFILE_SQL = _profile_sql(_SPARSE_TYPES, f"({SPARSE_SQL}) s")
_SHARE = "empty_total / total_rows * 100"
_ADVICE_SQL = f"""SELECT *,
    distinct_count <= 1 OR {_SHARE} >= 99.9 OR ({_SHARE} >= 90 AND distinct_count <= 2)
      AS recommend_exclude,
    CASE WHEN distinct_count <= 1 THEN 'static'
         WHEN {_SHARE} >= 99.9 THEN 'all_empty'
         WHEN {_SHARE} >= 90 AND distinct_count <= 2 THEN 'mostly_empty' END AS rule
    FROM ({_PROFILE_SQL}) q"""


@query("column_profile", _PROFILE_SQL)
def column_profile(spark, sf):
    return prof.column_profile(sparse_lineitem(spark, sf))


@query(
    "column_profile_documents",
    _profile_sql(
        {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"},
        "documents",
    ),
)
def column_profile_documents(spark, sf):
    return prof.column_profile(table(spark, sf, "documents"))


# The sketches of two batches are merged; the estimate lies within its bound of the exact figure.
@query(
    "profile_merged_sketches",
    f"""SELECT column_name, ordinal, data_type, total_rows, null_count, empty_count, empty_pct,
               true AS distinct_within_bound FROM ({_PROFILE_SQL}) p""",
)
def profile_merged_sketches(spark, sf):
    rows = sparse_lineitem(spark, sf)
    early = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    batches = [prof.sketch_columns(rows.filter(early)), prof.sketch_columns(rows.filter(~early))]
    merged = prof.profile_of_sketches(batches[0].unionByName(batches[1]))
    exact = prof.column_profile(rows).select("column_name", F.col("distinct_count").alias("exact"))
    off = F.abs(F.col("distinct_count") - F.col("exact"))
    within = off <= F.ceil(4 * prof.SKETCH_ERROR * F.col("exact"))
    return merged.join(exact, "column_name").select(
        "column_name",
        "ordinal",
        "data_type",
        "total_rows",
        "null_count",
        "empty_count",
        "empty_pct",
        within.alias("distinct_within_bound"),
    )


@query("profile_exclusions", _ADVICE_SQL)
def profile_exclusions(spark, sf):
    return prof.with_advice(prof.column_profile(sparse_lineitem(spark, sf)))


@query(
    "profile_summary",
    f"""SELECT count(*) AS total_columns, count(*) FILTER (NOT recommend_exclude) AS active_columns,
               count(*) FILTER (recommend_exclude) AS excluded_columns,
               round(count(*) FILTER (recommend_exclude) / count(*) * 100, 6) AS excluded_pct
        FROM ({_ADVICE_SQL}) a""",
)
def profile_summary(spark, sf):
    summary = prof.profile_summary(prof.with_advice(prof.column_profile(sparse_lineitem(spark, sf))))
    return summary.withColumn("excluded_pct", F.round("excluded_pct", 6))


@query("profile_apply", f"SELECT * EXCLUDE (l_currency, l_note, l_obsolete) FROM ({SPARSE_SQL}) s")
def profile_apply(spark, sf):
    rows = sparse_lineitem(spark, sf)
    return prof.apply_exclusions(rows, prof.with_advice(prof.column_profile(rows)), ["l_orderkey"])


# Purchases stand for profiles; a user without one was never profiled.
_PROFILE_LOG = """SELECT 'table_' || CAST(user_id AS VARCHAR) AS table_name,
       CASE WHEN event_type = 'purchase' THEN ts END AS profiled_ts FROM events"""
_AGE_SQL = f"""SELECT *, CASE WHEN last_profiling_ts IS NULL THEN 'never'
                              WHEN days_since_profiling >= 2 THEN 'obsolete'
                              ELSE 'recent' END AS profile_status
  FROM (SELECT table_name, max(profiled_ts) AS last_profiling_ts,
               coalesce(date_diff('day', max(profiled_ts), TIMESTAMP '2024-01-31'), 999)
                 AS days_since_profiling
        FROM ({_PROFILE_LOG}) l GROUP BY table_name) a"""


def _profile_log(spark, sf):
    return table(spark, sf, "events").select(
        F.concat(F.lit("table_"), F.col("user_id").cast("string")).alias("table_name"),
        F.when(F.col("event_type") == "purchase", F.col("ts")).alias("profiled_ts"),
    )


@query("profiling_age", _AGE_SQL)
def profiling_age(spark, sf):
    return prof.profiling_age(_profile_log(spark, sf), AS_OF, threshold_days=2)


@query("profiling_due", f"SELECT * FROM ({_AGE_SQL}) d WHERE profile_status <> 'recent'")
def profiling_due(spark, sf):
    return prof.profiling_due(_profile_log(spark, sf), AS_OF, threshold_days=2)


@query(
    "profiling_due_first",
    f"""SELECT * FROM ({_AGE_SQL}) d WHERE profile_status <> 'recent'
        ORDER BY days_since_profiling DESC, table_name LIMIT 5""",
)
def profiling_due_first(spark, sf):
    return prof.profiling_due(_profile_log(spark, sf), AS_OF, threshold_days=2, max_tables=5)
