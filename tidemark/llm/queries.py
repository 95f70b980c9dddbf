"""The registered queries of the corpus operators and the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.collocations import collocations
from tidemark.llm.conversations import repaired
from tidemark.llm.exact_dedup import exact_groups, full_hash
from tidemark.llm.language import identify
from tidemark.llm.main_text import extracted
from tidemark.llm.mixing import mixed
from tidemark.llm.packing import packed
from tidemark.llm.quality import judged as quality_judged
from tidemark.llm.secrets import report as secret_report
from tidemark.llm.simhash import near_groups
from tidemark.llm.token_counts import token_counts
from tidemark.llm.token_files import read_tokens, token_index, write_tokens
from tidemark.llm.url_rules import judged as urls_judged
from tidemark.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


OP1_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)"""


@query("op1_exact_dedup", OP1_SQL)
def op1_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_groups(
        table(spark, sf, "documents"), carry={"text_sha256": full_hash(F.col("text"))}
    )


@query("op2_simhash")
def op2_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return near_groups(table(spark, sf, "documents")).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"),
    )


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return identify(table(spark, sf, "documents"))


@query("op4_url_filters")
def op4_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    return urls_judged(table(spark, sf, "pages"), table(spark, sf, "labels"))


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS key,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents),
s AS (
  SELECT source, sum(size) AS source_size, count(*) AS n,
         [3, 1, 2][CAST((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS INT) + 1]
           AS weight
  FROM d GROUP BY source),
filled AS (
  SELECT *, 2 * source_size AS cap, 1.5 * sum(source_size) OVER () AS total,
         coalesce(sum(2 * source_size) OVER before, 0) AS caps_before,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weight_left
  FROM s WINDOW before AS (ORDER BY 2 * source_size / CAST(weight AS DOUBLE), source
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (
  SELECT *, CAST(total - caps_before AS DOUBLE) * weight / weight_left > cap AS capped FROM filled),
t AS (
  SELECT source, source_size, n,
         CASE WHEN capped THEN CAST(cap AS DOUBLE)
              ELSE CAST(total - (SELECT coalesce(sum(cap), 0) FROM marked WHERE capped) AS DOUBLE) * weight
                   / CAST((SELECT sum(weight) FROM marked WHERE NOT capped) AS DOUBLE) END AS target
  FROM marked),
e AS (
  SELECT d.doc_id, d.source, d.key, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0
              THEN least(t.target * 1.0 / CAST(t.source_size AS DOUBLE), 2.0) ELSE 0.0 END AS expected,
         (CAST('0x' || substr(d.key, 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
r AS (
  SELECT *, floor(expected) AS certain, expected - floor(expected) AS p,
         CASE WHEN expected - floor(expected) > 0
              THEN (u / (1 - u)) / ((expected - floor(expected)) / (1 - (expected - floor(expected))))
              END AS rank
  FROM e),
rests AS (
  SELECT source, any_value(target) - sum(certain * size) AS rest FROM r GROUP BY source),
runs AS (
  SELECT r.source, rank, key, rest,
         abs(rest - sum(size) OVER (PARTITION BY r.source ORDER BY rank, key)) AS off
  FROM r JOIN rests ON r.source IS NOT DISTINCT FROM rests.source WHERE p > 0),
ends AS (
  SELECT source, arg_min(rank, (off, rank, key)) AS stop_rank, arg_min(key, (off, rank, key)) AS stop_key
  FROM runs GROUP BY source HAVING min(off) < abs(any_value(rest)))
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * (certain + CASE WHEN p > 0 AND (rank, key) <= (stop_rank, stop_key)
                                   THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r LEFT JOIN ends ON r.source IS NOT DISTINCT FROM ends.source"""


@query("op5_mix_sources", OP5_SQL)
def op5_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    return mixed(table(spark, sf, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


@query("op6_quality")
def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality_judged(table(spark, sf, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "log_perplexity",
        "log_word_perplexity",
    )


@query("op7_token_files")
def op7_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    write_tokens(table(spark, sf, "documents"), path, tokenizer, end_id=2)
    return token_index(read_tokens(spark, path))


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts(table(spark, sf, "documents"), model)


@query("op9_secrets")
def op9_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secret_report(table(spark, sf, "documents"))


@query("op10_packing")
def op10_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packed(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def _crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text, byte by byte, for a database without it."""
    codes = f"list_transform(string_split({text}, ''), lambda ch: ord(ch)::BIGINT)"
    byte = """list_reduce(list_concat([xor(c, b)], range(8)),
                          lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"""
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda c, b: {byte}), 4294967295)"


def _edit(state: str, cost: str, letter: str, line: str | None) -> str:
    """A state's cost, letters and lines after one more edit."""
    lines = f"{state}.t" if line is None else f"list_append({state}.t, {line})"
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {lines}}}"


def _inserts(source: str) -> str:
    """The states after at most one insert."""
    to_user = ", ".join(_edit(s, "5", "I", "'user:'") for s in ("s0", "s1", "s3"))
    to_assistant = _edit("s2", "5", "I", "'assistant:'")
    return (
        f"SELECT * REPLACE (least(s2, {to_user}) AS s2, least(s3, {to_assistant}) AS s3) FROM ({source})"
    )


_NONE = "{'c': 1000000000, 'a': '', 't': []::VARCHAR[]}"
_INTO = {1: ("s", "s0"), 2: ("u", "s0 s1 s3"), 3: ("a", "s2")}
_ROLE = {2: "user", 3: "assistant"}


def _after_row(state: int) -> str:
    """The best way to a state with the next row."""
    ways = [_edit(f"s{state}", "2", "D", None)]
    initial, sources = _INTO.get(state, ("", ""))
    for before in sources.split():
        kept = _edit(before, "extra", "K", "role || ':' || text")
        ways.append(f"CASE WHEN NOT must_go AND initial = '{initial}' THEN {kept} ELSE {_NONE} END")
        if state in _ROLE:
            other = _edit(before, "1 + extra", "R", f"'{_ROLE[state]}:' || text")
            ways.append(f"CASE WHEN NOT must_go THEN {other} ELSE {_NONE} END")
    return f"least({', '.join(ways)}, {_NONE}) AS s{state}"


_FATE = _crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")
_NEXT_ROW = _inserts(
    _inserts(
        """SELECT o.g, o.i, s0, s1, s2, s3, role, text, initial, must_go, extra
           FROM walk w JOIN ordered o ON o.g = w.g AND o.i = w.i + 1"""
    )
)
OP13_SQL = rf"""
WITH RECURSIVE dealt AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_FATE} % 20 AS fate
  FROM conversations),
ids AS (
  SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS g FROM (SELECT DISTINCT conv_id FROM dealt)),
damaged AS (
  SELECT g, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE fate WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM dealt JOIN ids ON dealt.conv_id IS NOT DISTINCT FROM ids.conv_id),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role,
                               md5(length(role) || ':' || role || text), copy) AS i,
         left(role, 1) AS initial, regexp_matches(text, '[^\x20\x09-\x0D]') AS solid
  FROM damaged),
faults AS (
  SELECT *, lag(initial) OVER (PARTITION BY g ORDER BY i) || initial AS pair,
         solid AND row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 AS again
  FROM placed),
ordered AS (
  SELECT *, NOT solid OR again AS must_go,
         solid AND NOT again AND NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
         CASE WHEN cut THEN 5 ELSE 0 END AS extra
  FROM faults),
walk AS (
  SELECT g, 0::BIGINT AS i, {{'c': 0, 'a': '', 't': []::VARCHAR[]}} AS s0, {_NONE} AS s1, {_NONE} AS s2,
         {_NONE} AS s3
  FROM ids
  UNION ALL
  SELECT g, i, {", ".join(map(_after_row, range(4)))} FROM ({_NEXT_ROW})),
figures AS (
  SELECT g, count(*) AS n, count(*) FILTER (NOT solid) AS blank, count(*) FILTER (again) AS duplicate,
         count(*) FILTER (cut) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
         max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps
  FROM ordered GROUP BY g),
ends AS (SELECT g, i, least(s0, s3) AS best FROM ({_inserts(_inserts("SELECT * FROM walk"))}))
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(best.c AS BIGINT) AS cost,
       best.a AS audit, sha256(array_to_string(best.t, chr(10))) AS repaired_sha256
FROM ids LEFT JOIN figures USING (g) JOIN ends ON ends.g = ids.g AND ends.i = coalesce(n, 0)"""


@query("op13_conversations", OP13_SQL)
def op13_conversations(spark: SparkSession, sf: str) -> DataFrame:
    return repaired(table(spark, sf, "conversations"))


@query("op11_main_text")
def op11_main_text(spark: SparkSession, sf: str) -> DataFrame:
    return extracted(table(spark, sf, "pages"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2),
                                        lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase
  FROM split, range(1, 5) t(k) WHERE len(w) >= k),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w
               FROM counts WHERE k > 1 AND f >= 30),
cuts AS (
  SELECT lang, phrase, k, a, unnest(range(1, k)) AS cut, w FROM candidates),
scored AS (
  SELECT c.lang, c.phrase, c.k, a, cut, l.f AS l, r.f AS r, (2000000 * a::HUGEINT) // (l.f + r.f) AS score
  FROM cuts c
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(w[1 : cut], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(w[cut + 1 : c.k], ' ')),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, a, unnest(list_transform(range(1, k - j + 2),
                                        lambda i: array_to_string(w[i : i + j - 1], ' '))) AS phrase
  FROM candidates, range(2, 4) t(j) WHERE j < k),
shadows AS (SELECT lang, phrase, max(a) AS most FROM inside GROUP BY ALL),
alive AS (
  SELECT lowest.* FROM lowest LEFT JOIN shadows USING (lang, phrase)
  WHERE most IS NULL OR 100 * most < 80 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
       phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM alive JOIN totals USING (lang) QUALIFY rank <= 2000"""


@query("op12_collocations", OP12_SQL)
def op12_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations(table(spark, sf, "documents"))
