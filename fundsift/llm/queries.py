"""One registered query per operator, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundsift.llm import (
    byte_bpe,
    conversation_repair,
    decontaminate,
    exact_dedup,
    html_extract,
    language,
    maxent,
    minhash,
    prefix_trie,
    sharding,
    simhash,
    substrings,
    token_counts,
)
from fundsift.llm.common import remainder, table, whole

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


@query
def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = docs.select("doc_id", byte_bpe.round_trip(F.col("text")).alias("found")).select("doc_id", "found.*")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


SHARDS = 8


@query
def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = whole(F.col("text"))
    docs = table(spark, folder, "documents").select(
        "doc_id",
        "source",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = sharding.interleave(docs.withColumn("tie", F.col("text_crc32")), SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


_UNIT = "CAST(('0x' || substr(md5({}), 1, 8)) AS BIGINT) / 4294967296.0"

SQL["op3_sharding"] = f"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t
), bytes AS (
  SELECT doc_id, coalesce(source, '') AS name, source, strlen(coalesce(text, '')) + 1 AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT))),
      lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1])), 4294967295::BIGINT) AS text_crc32
  FROM documents, crc_table
), shuffled AS (
  SELECT *, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || text_crc32) AS digest FROM bytes
), ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY source ORDER BY digest, doc_id)
      - (1.0::DOUBLE - {_UNIT.format("'mix:' || name")})) / count(*) OVER (PARTITION BY source) AS fraction
  FROM shuffled
), placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, source NULLS FIRST, digest, doc_id) - 1 AS pos,
    count(*) OVER () AS total
  FROM ranked
)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(pos * {SHARDS} // total AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY pos * {SHARDS} // total ORDER BY pos) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM placed"""


@query
def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.groups(table(spark, folder, "documents"))


SQL["op5_exact_dedup"] = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), grouped AS (
  SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM texts
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256 FROM grouped"""


@query
def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = remainder(F.col("doc_id"), 5) == 0
    model = language.train(docs.filter(~held_out))
    predicted = language.predict(spark, F.col("text"), model)
    return docs.select("doc_id", held_out.alias("held_out"), predicted.alias("found")).select(
        "doc_id", "held_out", "found.lang_pred", "found.score"
    )


@query
def op4_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


@query
def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", token_counts.token_counts(F.col("text")).alias("found"))
    return docs.select("doc_id", "found.n_words", "found.n_tokens")


@query
def op7_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    text = html_extract.extract(spark, F.col("html"), html_extract.train(pages))
    found = pages.select("page_id", "url", text.alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query
def op9_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.without_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_maxent(spark: SparkSession, folder: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 5) == 1
    scored = maxent.score(table(spark, folder, "documents"), ~held_out)
    return scored.withColumn("held_out", held_out).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query
def op11_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def _crc32(column: str) -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary"))


@query
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"), _crc32("conv_id") % 9)


_CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t
)"""


def _sql_crc32(text: str) -> str:
    """CRC-32 of a text, beside ``crc_table``."""
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT))),
      lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1])), 4294967295::BIGINT)"""


SQL["op12_prefix_trie"] = f"""
WITH {_CRC_TABLE}, turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, {_sql_crc32("CAST(conv_id AS VARCHAR)")} % 9 AS head
  FROM (SELECT DISTINCT conv_id FROM turns), crc_table
), rebuilt AS (
  SELECT i.conv_id, pos, role, text FROM ids i JOIN turns t ON t.conv_id = i.base AND pos <= head
  UNION ALL
  SELECT i.conv_id, pos, role, text FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND pos > head
), paths AS (
  SELECT i.conv_id, count(pos) AS n,
    coalesce(list(md5(role || ':' || md5(text)) ORDER BY pos) FILTER (pos IS NOT NULL), []) AS path,
    list(strlen(text) ORDER BY pos) AS sizes
  FROM ids i LEFT JOIN rebuilt r ON r.conv_id = i.conv_id GROUP BY i.conv_id
), prefixes AS (
  SELECT conv_id, d AS depth, array_to_string(path[1:d], '') AS prefix, CASE WHEN d = 0 THEN 0 ELSE sizes[d] END AS last_bytes,
    d = n AS ending
  FROM (SELECT *, unnest(range(n + 1)) AS d FROM paths)
), nodes AS (
  SELECT depth, prefix, left(prefix, 32 * (depth - 1)) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(last_bytes) AS last_bytes,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ending), '')) AS ends_sha256
  FROM prefixes GROUP BY depth, prefix
), children AS (
  SELECT above AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY above
), counted AS (
  SELECT nodes.*, coalesce(c.n, 0) AS n_children FROM nodes LEFT JOIN children c ON c.prefix = nodes.prefix
), sums AS (
  SELECT left(prefix, 32 * d) AS prefix, CAST(count_if(n_children = 0) AS BIGINT) AS n_leaves, CAST(sum((n_convs - 1) * last_bytes) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM counted) GROUP BY 1
)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, s.n_leaves, s.saved_tokens, c.ends_sha256
FROM counted c JOIN sums s ON s.prefix = c.prefix LEFT JOIN nodes p ON c.depth > 0 AND p.prefix = c.above"""


@query
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    conv_id, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    name = F.concat(conv_id, F.lit(":"), turn)
    return conversation_repair.repair_conversations(table(spark, folder, "conversations"), F.crc32(name.cast("binary")) % 20)


def _sql_step(state: str, cost: str, letter: str, line: str | None = None) -> str:
    """A state of the repair in SQL (k: padded cost and audit, t: repaired lines) after one edit."""
    added = f"{state}.t || chr(10) || {line}" if line else f"{state}.t"
    return f"{{k: lpad(CAST(CAST(left({state}.k, 8) AS BIGINT) + {cost} AS VARCHAR), 8, '0') || substr({state}.k, 9) || '{letter}', t: {added}}}"


def _sql_least(*states: str) -> str:
    return f"list_min(list_filter([{', '.join(states)}], lambda x: x.k IS NOT NULL))"


def _sql_row(to: str, role: str | None) -> str:
    """The state ``to`` after row r: it was deleted, kept, or its role was changed."""
    sound, more = "r.fault IN ('k', 't')", "CASE r.fault WHEN 't' THEN 5 ELSE 0 END"
    before = {"s": ["e"], "u": ["e", "s", "a"], "a": ["u"]}.get(to, [])
    ways = [_sql_step(f"d.{to}", "2", "D")]
    for b in before:
        ways.append(f"CASE WHEN {sound} AND r.initial = '{to}' THEN {_sql_step(f'd.{b}', more, 'K', 'r.line')} END")
        if role:
            changed = f"'{role}:' || r.text"
            ways.append(f"CASE WHEN {sound} THEN {_sql_step(f'd.{b}', f'1 + {more}', 'R', changed)} END")
    return _sql_least(*ways)


_INSERT_USER = _sql_least("u", *[_sql_step(b, "5", "I", "'user:'") for b in ("e", "s", "a")])
_INSERT_ASSISTANT = _sql_least("a", _sql_step("u", "5", "I", "'assistant:'"))
_NONE = "{k: CAST(NULL AS VARCHAR), t: CAST(NULL AS VARCHAR)}"

SQL["op13_conversation_repair"] = rf"""
WITH RECURSIVE {_CRC_TABLE}, filled AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations
), coded AS (
  SELECT *, {_sql_crc32("name")} % 20 AS f FROM filled, crc_table
), damaged AS (
  SELECT conv_id, turn, role AS first_role, sha256(text) AS first_text, CASE f WHEN 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE f WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM coded WHERE f <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, first_role, first_text, copy) AS pos FROM damaged
), seen AS (
  SELECT *, left(role, 1) AS initial, role || ':' || text AS line,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again
  FROM placed
), judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN again THEN 'd'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE 'k' END AS fault
  FROM seen
), counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
), ids AS (
  SELECT i.conv_id, row_number() OVER () AS nr, c.* EXCLUDE (conv_id)
  FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM i.conv_id
), steps AS (
  SELECT ids.nr, j.pos, j.initial, j.text, j.line, j.fault FROM judged j JOIN ids ON ids.conv_id IS NOT DISTINCT FROM j.conv_id
), states(nr, pos, e, s, u, a) AS (
  SELECT nr, 0::BIGINT, {{k: '00000000', t: ''}}, {_NONE}, {_NONE}, {_NONE} FROM ids
  UNION ALL
  SELECT r.nr, r.pos, {_sql_row("e", None)}, {_sql_row("s", None)}, {_sql_row("u", "user")}, {_sql_row("a", "assistant")}
  FROM (SELECT nr, pos, e, s, {_INSERT_USER} AS u, {_INSERT_ASSISTANT} AS a FROM states) d
  JOIN steps r ON r.nr = d.nr AND r.pos = d.pos + 1
), ends AS (
  SELECT nr, {_sql_least("e", "inserted")} AS x, pos FROM (SELECT nr, pos, e, {_INSERT_ASSISTANT} AS inserted FROM states)
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(left(x.k, 8) AS BIGINT) AS cost, substr(x.k, 9) AS audit,
  sha256(substr(x.t, 2)) AS repaired_sha256
FROM ids JOIN ends ON ends.nr = ids.nr AND ends.pos = coalesce(n, 0)"""
