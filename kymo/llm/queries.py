"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kymo.llm import chat, decontam, langid, linededup, mixing, neardup, pii, quality, secret_scan, tokens
from kymo.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted and read back from the formatted text."""
    own = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", own), (-7, 1, "assistant", own)], "conv_id long, turn long, role string, text string")
    source = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    done = chat.format_chats(source).withColumn("turns", chat.read_back(F.col("formatted")))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat.loss_text(F.col("turns"))
    return done.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(flat.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        F.coalesce("first_bad_turn", F.lit(-1)).alias("first_bad_turn"),
    )


OP1_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), m AS (
  SELECT *, replace(text, chr(92), chr(92) || chr(92)) AS doubled,
    regexp_replace(replace(text, chr(92), chr(92) || chr(92)),
      '(<)(<SYS>>|</SYS>>|s>|/s>)|(\[)(INST\]|/INST\]|ASST\]|ROLE:|/ROLE\])', '\1\3' || chr(92) || chr(92) || ';\2\4', 'g') AS body
  FROM c
), f AS (
  SELECT *, length(body) + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 12 WHEN 'system' THEN 18
    ELSE 16 + length(role) END AS n,
    row_number() OVER o - 1 AS place, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) = 1 AS is_last,
    coalesce(lag(role) OVER o, 'start') || '>' || role IN ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user') AS in_order
  FROM m WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(n))::BIGINT AS formatted_chars,
  bool_and(in_order) AND bool_or(is_last AND role = 'assistant') AS valid,
  coalesce(min(place) FILTER (WHERE NOT in_order), -1)::BIGINT AS first_bad_turn
FROM f GROUP BY conv_id
"""


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose four-word shingle sets are alike to 0.8 or more."""
    return neardup.link(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=4, similarity=0.8)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts, base verdict and host verdict of every document."""
    return quality.judge(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from four fifths of the labelled ones."""
    documents = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))
    dictionaries = langid.fit(documents, ~held_out)
    return langid.classify(documents, dictionaries).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secret_scan.digest(table(spark, sf_dir, "documents"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))[1]


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that ten or more documents share."""
    return linededup.digest(linededup.drop_lines(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op8_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms in every document."""
    return pii.digest(pii.sanitise(table(spark, sf_dir, "documents").select("doc_id", "text")))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the byte-level BPE vocabulary."""
    return tokens.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.digest(decontam.scan(documents, table(spark, sf_dir, "benchmark")))


#: Words of the documents with their positions, from one.
_WORDS = r"""d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
 l AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d)"""

OP3_SQL = rf"""
WITH {_WORDS}, w AS (SELECT rid, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM l),
 g AS (SELECT rid, p, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o AS g FROM w WINDOW o AS (PARTITION BY rid ORDER BY p)),
 r AS (SELECT rid, p, count(*) OVER (PARTITION BY rid, g) AS n FROM g WHERE g IS NOT NULL),
 h AS (SELECT rid, count(DISTINCT p + k) AS n_repeat_words FROM r, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY 1),
 y AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM l),
 z AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines FROM y WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1),
 q AS (SELECT l.rid, doc_id, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars, (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words FROM l LEFT JOIN h USING (rid) LEFT JOIN z USING (rid)),
 b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM q),
 s AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE base_failed) AS f FROM b GROUP BY 1),
 p AS (SELECT sum(f) / sum(n) AS m, var_pop(f / n) AS spread, avg(1.0::DOUBLE / n) AS noise FROM s),
 o AS (SELECT m, CASE WHEN m > 0 AND m < 1 AND spread / (m * (1 - m)) - noise > 1e-9 THEN least(greatest((1 - noise) / (spread / (m * (1 - m)) - noise) - 1, 1e-3), 1e6) ELSE 2.0 END AS k FROM p),
 v AS (SELECT source, (f + m * k) / (n + k) AS rate, least(greatest(m + 3 * sqrt(m * (1 - m) / (k + 1)), {quality.LEAST_RATE}), {quality.MOST_RATE}) AS most FROM s, o)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rate > most AS kept, rate > most AS host_failed, round(rate, 9) AS shrunk_rate
FROM b JOIN v ON b.source IS NOT DISTINCT FROM v.source
"""

_KIND = "SELECT rid, {rank} AS rank, '{kind}' AS kind, {least} AS least, regexp_extract_all(t, '{pattern}') AS ms, regexp_split_to_array(t, '{pattern}') AS ps, regexp_extract_all(t, '{pattern}', {group}) AS gs FROM d"


def _op5_sql() -> str:
    """Positions from the lengths of the pieces between the matches of each expression."""

    def plain(rule: secret_scan.Rule) -> str:
        pattern = rule.pattern.replace("(?<![0-9a-f])", "").replace("'", "''")
        return re.sub(r"\(\?i:(.*?)\)(?=\[\")", lambda m: re.sub("[a-z]", lambda c: f"[{c[0]}{c[0].upper()}]", m[1]), pattern)

    kinds = " UNION ALL ".join(_KIND.format(rank=k, kind=r.kind, least=r.least, pattern=plain(r), group=r.group) for k, r in enumerate(secret_scan.RULES))
    base = ", ".join(f"'{r.kind}'" for r in secret_scan.RULES if r.base)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents), k AS ({kinds}),
 u AS (SELECT rid, rank, kind, least, unnest(ms) AS m, unnest(gs) AS g, unnest(ps[1:len(ms)]) AS p, unnest(range(1, len(ms) + 1)) AS i FROM k),
 c AS (SELECT *, sum(length(p)) OVER w + sum(length(m)) OVER w AS stop FROM u WINDOW w AS (PARTITION BY rid, rank ORDER BY i)),
 s AS (SELECT rid, rank, kind, (stop - length(m))::BIGINT AS a, stop::BIGINT AS b FROM c WHERE length(g) >= least),
 x AS (SELECT rid, kind IN ({base}) AS base, kind, kind || ':' || a || ':' || b AS span, a, rank FROM s)
SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
 sha256(coalesce(string_agg(span, ',' ORDER BY a, rank) FILTER (WHERE base), '')) AS base_sha256, coalesce(string_agg(span, ',' ORDER BY a, rank), '') AS spans
FROM d LEFT JOIN x USING (rid) GROUP BY rid, doc_id
"""


OP7_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
 l AS (SELECT rid, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM d),
 k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
 r AS (SELECT key FROM (SELECT DISTINCT rid, key FROM k WHERE key <> '') GROUP BY key HAVING count(*) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE r.key IS NOT NULL) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE r.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN r ON k.key = r.key GROUP BY rid, doc_id
"""

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP10_SQL = rf"""
WITH b AS (SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
 s AS (SELECT item, ws, least(len(ws), 10) AS n, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS p FROM b WHERE len(ws) > 0),
 win AS (SELECT DISTINCT item, n, array_to_string(ws[p:p + n - 1], ' ') AS g FROM s),
 d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
 x AS (SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS p FROM d),
 y AS (SELECT rid, p, n, array_to_string(ws[p:p + n - 1], ' ') AS g FROM x, (SELECT DISTINCT n FROM win) WHERE p + n - 1 <= len(ws)),
 h AS (SELECT rid, p, y.n, item FROM y JOIN win ON win.n = y.n AND win.g = y.g),
 w AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM h) GROUP BY 1),
 i AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM h) GROUP BY 1)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN w USING (rid) LEFT JOIN i USING (rid)
"""

QUERIES: dict[str, Query] = {
    "op1_chat_format": op1_chat_format,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_quality_rules": op3_quality_rules,
    "op4_language_id": op4_language_id,
    "op5_secret_scan": op5_secret_scan,
    "op6_source_mix": op6_source_mix,
    "op7_line_dedup": op7_line_dedup,
    "op8_private_data": op8_private_data,
    "op9_token_counts": op9_token_counts,
    "op10_decontaminate": op10_decontaminate,
}

ORACLE_SQL: dict[str, str] = {
    "op1_chat_format": OP1_SQL,
    "op3_quality_rules": OP3_SQL,
    "op5_secret_scan": _op5_sql(),
    "op7_line_dedup": OP7_SQL,
    "op10_decontaminate": OP10_SQL,
}
