"""Extraction and incremental reads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from suite.inputs import ORDER_COLUMNS, ORDERS, REGISTRY_SQL, registry
from suite.registry import query, table
from tidemark.operators.clean import safe_names
from tidemark.operators.runlog import select_tables, with_priority
from tidemark.sources.extract import RANGE_ERROR, even_bounds, extract, filtered, range_predicates
from tidemark.spec import ColumnSpec, TableSpec

CUSTOMERS = TableSpec("customer", ("c_custkey",), has_timestamps=False)
CUSTOMER_COLUMNS = [
    ColumnSpec("c-custkey", "bigint", source_expr="c_custkey"),
    ColumnSpec("c-name", "varchar", 25, source_expr="upper(c_name)"),
    ColumnSpec("c-acctbal", "numeric", 15, 2, source_expr="round(c_acctbal * 2, 2)"),
    ColumnSpec("c-mktsegment", "varchar", 10, excluded=True),
]


@query(
    "extract_project",
    """SELECT round(c_acctbal * 2, 2) AS c_acctbal, c_custkey, upper(c_name) AS c_name
       FROM customer""",
)
def extract_project(spark, sf):
    return extract(table(spark, sf, "customer"), CUSTOMERS, CUSTOMER_COLUMNS)


@query(
    "safe_names",
    """SELECT p_partkey AS part_key, p_name AS part_name, p_brand AS brand FROM part""",
)
def safe_name_columns(spark, sf):
    source = table(spark, sf, "part").selectExpr(
        "p_partkey AS `part-key`", "p_name AS `part-name`", "p_brand AS brand"
    )
    return safe_names(source)


@query("business_filter", "SELECT * FROM orders WHERE o_orderpriority <> '5-LOW'")
def business_filter(spark, sf):
    return filtered(table(spark, sf, "orders"), ORDERS)


EVENTS = TableSpec(
    "events",
    ("event_id",),
    modified_col="ts",
    last_success=datetime(2024, 1, 20, 15, 30, 45, 500_000),
)


def _events(spec):
    def run(spark, sf):
        return filtered(table(spark, sf, "events"), spec)

    return run


query("incremental_extract", "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-20 15:30:45'")(
    _events(EVENTS)
)
query(
    "incremental_lookback_days",
    """SELECT * FROM orders
       WHERE o_orderpriority <> '5-LOW' AND o_orderdate >= TIMESTAMP '2000-12-30 12:00:00'""",
)(
    lambda spark, sf: extract(
        table(spark, sf, "orders"),
        TableSpec(
            "orders",
            ("o_orderkey",),
            modified_col="o_orderdate",
            filter_clause="o_orderpriority <> '5-LOW'",
            last_success=datetime(2001, 1, 1, 12),
            lookback="2d",
        ),
        ORDER_COLUMNS,
    )
)


def _with(**changes):
    from dataclasses import replace

    return replace(EVENTS, **changes)


query(
    "incremental_lookback_hours",
    "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-20 03:30:45'",
)(_events(_with(lookback="12h")))
query(
    "incremental_lookback_minutes",
    "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-20 15:00:45'",
)(_events(_with(lookback="30m")))
query(
    "incremental_date_precision",
    "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-19 00:00:00'",
)(_events(_with(lookback="1d", precision="date")))
query("incremental_first_run", "SELECT * FROM events")(_events(_with(last_success=None)))
query("extract_full_forced", "SELECT * FROM events")(_events(_with(has_timestamps=False)))


@query(
    "keyword_subset",
    f"""SELECT * FROM ({REGISTRY_SQL}) r
        WHERE notes LIKE '%priority%' OR notes LIKE '%critique%'""",
)
def keyword_subset(spark, sf):
    return select_tables(registry(spark, sf), "priority")


@query("dimension_subset", f"SELECT * FROM ({REGISTRY_SQL}) r WHERE is_dimension = 1")
def dimension_subset(spark, sf):
    return select_tables(registry(spark, sf), "dimensions")


@query("fact_subset", f"SELECT * FROM ({REGISTRY_SQL}) r WHERE is_fact = 1")
def fact_subset(spark, sf):
    return select_tables(registry(spark, sf), "facts")


@query(
    "priority_class",
    f"""SELECT *, CASE WHEN notes LIKE '%critical%' OR notes LIKE '%critique%' THEN 'critical'
                       WHEN is_dimension = 1 OR is_fact = 1 THEN 'high'
                       ELSE 'normal' END AS priority
        FROM ({REGISTRY_SQL}) r""",
)
def priority_class(spark, sf):
    return with_priority(registry(spark, sf))


# Prices are skewed on purpose; every row falls in one of eight ranges of about equal size.
@query(
    "extract_even_ranges",
    """SELECT 8 AS n_ranges, count(*) AS n_rows, true AS even
       FROM lineitem""",
)
def extract_even_ranges(spark, sf):
    skewed = F.pow(F.col("l_extendedprice") / 100, F.lit(4)).cast("bigint")
    lines = table(spark, sf, "lineitem").select(skewed.alias("price"))
    bounds = even_bounds(lines, "price", 8)
    conditions = range_predicates("price", bounds)
    place = F.array(*(F.coalesce(F.expr(c), F.lit(False)).cast("int") for c in conditions))
    ranges = lines.select(F.posexplode(place).alias("range", "n")).groupBy("range").agg(F.sum("n").alias("n"))
    total = F.sum("n")
    slack = total * (1 / 8 + 2 * RANGE_ERROR) + 1
    return ranges.agg(
        F.count("*").cast("int").alias("n_ranges"), total.alias("n_rows"), (F.max("n") <= slack).alias("even")
    )
