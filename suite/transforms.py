"""Cleaning, typing, hashing."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.inputs import (
    CUSTOMER_GAPS_SQL,
    EVENT_TEXT_COLUMNS,
    EVENT_TEXT_SQL,
    SECOND_LOAD,
    customer_gaps,
    event_text,
)
from suite.registry import query, table
from tidemark.functions.hashing import row_hash
from tidemark.functions.typing import coerce
from tidemark.operators.clean import (
    add_technical_columns,
    bad_values,
    in_target_order,
    normalize,
    optimize_dtypes,
    scrub_nan,
    typed_select,
)
from tidemark.spec import ColumnSpec, TableSpec

# Padding of every kind around the part names: blanks, tabs, line ends, a no-break space, an
# ideographic space. Inner white space must stay.
_PADDED_SQL = """
SELECT p_partkey,
       CASE p_type WHEN 'ECONOMY' THEN '  ' || p_name || ' '
            WHEN 'LARGE' THEN chr(9) || p_name || chr(13) || chr(10)
            WHEN 'MEDIUM' THEN chr(160) || p_name || chr(12288)
            WHEN 'PROMO' THEN chr(11) || chr(133) || p_name || chr(28)
            WHEN 'SMALL' THEN '   ' ELSE p_name END AS p_name,
       p_size
FROM part"""

# The white-space characters, in code order.
_WS = (
    "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)"
    "||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)"
    "||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)"
    "||chr(8239)||chr(8287)||chr(12288)"
)


@query("normalize_trim", f"SELECT p_partkey, trim(p_name, {_WS}) AS p_name, p_size FROM ({_PADDED_SQL}) p")
def normalize_trim(spark, sf):
    name, kind = F.col("p_name"), F.col("p_type")
    padded = table(spark, sf, "part").select(
        "p_partkey",
        F.when(kind == "ECONOMY", F.concat(F.lit("  "), name, F.lit(" ")))
        .when(kind == "LARGE", F.concat(F.lit("\t"), name, F.lit("\r\n")))
        .when(kind == "MEDIUM", F.concat(F.lit("\xa0"), name, F.lit("　")))
        .when(kind == "PROMO", F.concat(F.lit("\x0b\x85"), name, F.lit("\x1c")))
        .when(kind == "SMALL", F.lit("   "))
        .otherwise(name)
        .alias("p_name"),
        "p_size",
    )
    return normalize(padded)


@query("normalize_documents", f"SELECT doc_id, trim(text, {_WS}) AS text, lang FROM documents")
def normalize_documents(spark, sf):
    return normalize(table(spark, sf, "documents").select("doc_id", "text", "lang"))


_CUSTOMER_HASH = """sha1(concat_ws('|', CAST(c_custkey AS VARCHAR), coalesce(c_name, 'None'),
    coalesce(CAST(c_nationkey AS VARCHAR), 'None'), coalesce(CAST(c_acctbal AS VARCHAR), 'None'),
    coalesce(c_mktsegment, 'None')))"""


@query("hashdiff", f"SELECT c_custkey, {_CUSTOMER_HASH} AS hashdiff FROM ({CUSTOMER_GAPS_SQL}) c")
def hashdiff(spark, sf):
    rows = customer_gaps(spark, sf)
    return rows.select("c_custkey", row_hash(rows).alias("hashdiff"))


@query(
    "hashdiff_lineitem",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
              sha1(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR),
                CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                CAST(l_quantity AS VARCHAR), CAST(l_extendedprice AS VARCHAR),
                CAST(l_discount AS VARCHAR), CAST(l_tax AS VARCHAR), l_returnflag, l_linestatus,
                strftime(l_shipdate, '%Y-%m-%d %H:%M:%S'))) AS hashdiff
       FROM lineitem""",
)
def hashdiff_lineitem(spark, sf):
    rows = table(spark, sf, "lineitem")
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return rows.select(*keys, row_hash(rows).alias("hashdiff"))


@query(
    "hashdiff_strict",
    r"""SELECT page_id, sha1(concat_ws('|', CAST(page_id AS VARCHAR),
              replace(replace(url, '\', '\\'), '|', '\|'),
              replace(replace(html, '\', '\\'), '|', '\|'))) AS hashdiff
        FROM pages""",
)
def hashdiff_strict(spark, sf):
    rows = table(spark, sf, "pages").select("page_id", "url", "html")
    return rows.select("page_id", row_hash(rows, strict=True).alias("hashdiff"))


_EVENTS = TableSpec("events", ("event_id",), modified_col="date_text")


@query(
    "technical_columns",
    f"""SELECT *, TRY_CAST(date_text AS TIMESTAMP) AS ts_source,
               TIMESTAMP '2002-01-01 06:00:00' AS load_ts,
               sha1(concat_ws('|', CAST(event_id AS VARCHAR), date_text, note_text)) AS hashdiff
        FROM (SELECT event_id, date_text, note_text FROM ({EVENT_TEXT_SQL}) t) e""",
)
def technical_columns(spark, sf):
    rows = event_text(spark, sf).select("event_id", "date_text", "note_text")
    return add_technical_columns(rows, _EVENTS, SECOND_LOAD)


@query(
    "optimize_dtypes",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
              CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE) AS l_extendedprice,
              CAST(CAST(l_tax AS FLOAT) AS DOUBLE) AS l_tax
       FROM lineitem""",
)
def optimized(spark, sf):
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_tax"]
    narrow = optimize_dtypes(table(spark, sf, "lineitem").select(*columns))
    # Widened again so that the rows compare as they were.
    wide = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint"}
    wide |= {"l_extendedprice": "double", "l_tax": "double"}
    return narrow.select(*(F.col(c).cast(wide.get(c, "int")).alias(c) for c in columns))


def _coerced(column, spec, **options):
    def run(spark, sf):
        rows = event_text(spark, sf)
        value = coerce(F.col(column), rows.schema[column].dataType, spec, **options)
        return rows.select("event_id", value.alias("value"))

    return run


query(
    "coerce_bit",
    f"""SELECT event_id, CASE WHEN flag_text IN ('True', 'true', '1') THEN true
                              WHEN flag_text IN ('False', 'false', '0') THEN false END AS value
        FROM ({EVENT_TEXT_SQL}) e""",
)(_coerced("flag_text", ColumnSpec("flag_text", "bit")))
query(
    "coerce_int",
    rf"""SELECT event_id, CASE WHEN regexp_full_match(number_text, '[+-]?\d+')
                              THEN CAST(number_text AS BIGINT) END AS value
        FROM ({EVENT_TEXT_SQL}) e""",
)(_coerced("number_text", ColumnSpec("number_text", "bigint")))
query(
    "coerce_datetime",
    f"SELECT event_id, TRY_CAST(date_text AS TIMESTAMP) AS value FROM ({EVENT_TEXT_SQL}) e",
)(_coerced("date_text", ColumnSpec("date_text", "datetime")))
query(
    "coerce_date",
    f"SELECT event_id, TRY_CAST(date_text AS DATE) AS value FROM ({EVENT_TEXT_SQL}) e",
)(_coerced("date_text", ColumnSpec("date_text", "date")))
query(
    "coerce_decimal",
    f"""SELECT event_id, CASE WHEN NOT isnan(amount) THEN CAST(amount AS DECIMAL(12,2)) END AS value
        FROM ({EVENT_TEXT_SQL}) e""",
)(_coerced("amount", ColumnSpec("amount", "numeric", 12, 2)))


@query(
    "varchar_truncate",
    """SELECT doc_id, substr(text, 1, 1200) AS text FROM documents""",
)
def varchar_truncate(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "text")
    columns = [ColumnSpec("doc_id", "bigint"), ColumnSpec("text", "varchar", 1200)]
    return typed_select(rows, columns)


# Without a declared width (or with a type of its own) no text is cut, however long.
@query("text_whole", "SELECT doc_id, text, text AS raw_text FROM documents")
def text_whole(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "text", F.col("text").alias("raw_text"))
    columns = [
        ColumnSpec("doc_id", "bigint"),
        ColumnSpec("text", "varchar"),
        ColumnSpec("raw_text", "raw"),
    ]
    return typed_select(rows, columns)


@query(
    "typed_load",
    rf"""SELECT event_id,
               CASE WHEN flag_text IN ('True', 'true', '1') THEN true
                    WHEN flag_text IN ('False', 'false', '0') THEN false END AS flag_text,
               CASE WHEN regexp_full_match(number_text, '[+-]?\d+')
                    THEN CAST(number_text AS BIGINT) END AS number_text,
               TRY_CAST(date_text AS TIMESTAMP) AS date_text,
               CASE WHEN note_text NOT IN ('nan', 'None', '<NA>') THEN substr(note_text, 1, 6) END
                 AS note_text,
               CASE WHEN NOT isnan(amount) THEN CAST(amount AS DECIMAL(12,2)) END AS amount
        FROM ({EVENT_TEXT_SQL}) e""",
)
def typed_load(spark, sf):
    rows = typed_select(event_text(spark, sf), EVENT_TEXT_COLUMNS)
    return in_target_order(rows, [c.sql_name for c in EVENT_TEXT_COLUMNS])


@query(
    "bad_value_counts",
    rf"""SELECT 'event_id' AS column_name, 0 AS bad_rows
        UNION ALL
        SELECT 'flag_text', count(*) FILTER (flag_text = 'maybe') FROM ({EVENT_TEXT_SQL}) e
        UNION ALL
        SELECT 'number_text', count(*) FILTER (number_text NOT IN ('nan', '')
                 AND NOT regexp_full_match(number_text, '[+-]?\d+')) FROM ({EVENT_TEXT_SQL}) e
        UNION ALL
        SELECT 'date_text', count(*) FILTER (TRY_CAST(date_text AS TIMESTAMP) IS NULL)
        FROM ({EVENT_TEXT_SQL}) e
        UNION ALL SELECT 'note_text', 0
        UNION ALL SELECT 'amount', 0""",
)
def bad_value_counts(spark, sf):
    return bad_values(event_text(spark, sf), EVENT_TEXT_COLUMNS)


@query(
    "scrub_nan",
    f"SELECT event_id, CASE WHEN NOT isnan(amount) THEN amount END AS amount FROM ({EVENT_TEXT_SQL}) e",
)
def scrubbed(spark, sf):
    return scrub_nan(event_text(spark, sf).select("event_id", "amount"))
