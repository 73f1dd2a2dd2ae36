"""Registered queries of these operators, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, fingerprints, langid, lexical, maxent, mixing, neardup, pii, repair, token_counts, toxicity, trie_bpe
from ._text import table

#: Vocabulary files of public tokenizers; a parameter, never part of the repository.
TOKENIZER_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
WORD_VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"


def held_out(n: int, remainder: int) -> Column:
    """crc32 of doc_id as text modulo n; a null doc_id counts as empty text."""
    return langid.fold_of("doc_id", n) == remainder


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.train(docs))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: int) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{pii.KINDS[kind]}")

    return found.select("doc_id", *map(count, range(len(pii.KINDS))), F.sha2(pii.joined(base), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


#: A conversation whose texts hold control strings.
PLANTED = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame(PLANTED, "conv_id long, turn long, role string, text string")
    return chat.format_digests(turns.unionByName(more)).drop("rewrites")


def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.document_counts(table(spark, sf_dir, "documents"), TOKENIZER_RANKS)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    apart = held_out(5, 0)
    found = langid.identify(docs, langid.train(docs.filter(~apart)))
    return found.select("doc_id", apart.alias("held_out"), "lang_pred", "score", "margin")


def op7_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.scores(table(spark, sf_dir, "documents"), held_out(7, 2))


def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    apart = held_out(5, 0)
    model = toxicity.train(docs.filter(~apart), table(spark, sf_dir, "labels"))
    found = toxicity.score(docs, model)
    spans = F.array_join(F.transform("toxic_spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["stop"].cast("string"))), ",")
    return found.select("doc_id", apart.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), spans.alias("toxic_spans"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_bpe.digests(table(spark, sf_dir, "documents"), trie_bpe.load_vocabulary(WORD_VOCABULARY))


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repairs(repair.damage(table(spark, sf_dir, "conversations")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pii, op2_fingerprints, op3_chat, op4_tokens, op5_decontaminate, op6_langid, op7_maxent, op8_neardup, op9_toxicity, op10_mixing, op11_bpe, op12_lexical, op13_repair, pipeline)
}

_MARKS = r"\\|<\||<s>|</s>|<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]"

ORACLES = {
    "op3_chat": rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(3 + sum(24 + length(role) + length(text) + len(regexp_extract_all(role, '{_MARKS}')) + len(regexp_extract_all(text, '{_MARKS}'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id""",
    "op8_neardup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
r(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
m AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d JOIN m ON m.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""",
    "op12_lexical": r"""
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM n),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, total GROUP BY term),
s AS (
  SELECT q.item_id, tf.doc_id, CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * (50 + (50 * n.n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN n ON n.doc_id = tf.doc_id, total GROUP BY q.item_id, tf.doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 50""",
    "op13_repair": r"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY n) AS tab FROM (
    SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v FROM range(256) r(n))),
src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
kinds AS (
  SELECT src.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: xor(c // 256, tab[(xor(c, b) % 256) + 1])), 4294967295) % 20 AS kind FROM src, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM kinds, (SELECT unnest([1, 2]) AS c) WHERE kind <> 0 AND (c = 1 OR kind = 3)),
ordered AS (
  SELECT *, row_number() OVER w AS i, lag(left(role, 1)) OVER w AS before,
    regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
faults AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM ordered),
sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM faults GROUP BY conv_id),
go(f, x, g) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
name(x, role) AS (VALUES ('u', 'user'), ('a', 'assistant')),
ins AS (
  SELECT DISTINCT f, f AS g, '' AS ks, [] :: VARCHAR[] AS rows FROM go
  UNION ALL SELECT 3, 3, '', []
  UNION ALL SELECT f, g, 'I', [role || ':'] FROM go JOIN name USING (x)
  UNION ALL SELECT a.f, b.g, 'II', [n.role || ':', m.role || ':'] FROM go a JOIN go b ON b.f = a.g JOIN name n ON n.x = a.x JOIN name m ON m.x = b.x),
pre AS (SELECT DISTINCT * FROM ins),
moves AS (
  SELECT f, g, ks || 'D' AS ks, rows, 5 * len(ks) + 2 AS cost, '' AS x, '' AS role FROM pre
  UNION ALL SELECT p.f, go.g, ks || 'K', rows, 5 * len(ks), go.x, '' FROM pre p JOIN go ON go.f = p.g
  UNION ALL SELECT p.f, go.g, ks || 'R', rows, 5 * len(ks) + 1, go.x, name.role FROM pre p JOIN go ON go.f = p.g JOIN name ON name.x = go.x),
talks AS (SELECT DISTINCT conv_id FROM conversations),
dp AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS st, CAST(0 AS BIGINT) AS cost, '' AS audit, [] :: VARCHAR[] AS rows FROM talks
  UNION ALL
  SELECT d.conv_id, f.i, m.g, d.cost + m.cost + CASE WHEN f.fault = 'truncated' AND right(m.ks, 1) <> 'D' THEN 5 ELSE 0 END, d.audit || m.ks,
    list_concat(d.rows, list_concat(m.rows, CASE WHEN right(m.ks, 1) = 'D' THEN [] :: VARCHAR[] WHEN right(m.ks, 1) = 'K' THEN [f.role || ':' || f.text] ELSE [m.role || ':' || f.text] END))
  FROM dp d JOIN faults f ON f.conv_id IS NOT DISTINCT FROM d.conv_id AND f.i = d.i + 1 JOIN moves m ON m.f = d.st
  WHERE CASE right(m.ks, 1) WHEN 'D' THEN true WHEN 'K' THEN left(f.role, 1) = m.x AND f.fault NOT IN ('blank', 'duplicate') ELSE f.fault NOT IN ('blank', 'duplicate') END
  QUALIFY row_number() OVER (PARTITION BY d.conv_id, m.g ORDER BY d.cost + m.cost + CASE WHEN f.fault = 'truncated' AND right(m.ks, 1) <> 'D' THEN 5 ELSE 0 END, d.audit || m.ks) = 1),
ends AS (
  SELECT d.conv_id, d.cost + 5 * len(p.ks) AS cost, d.audit || p.ks AS audit, list_concat(d.rows, p.rows) AS rows
  FROM dp d JOIN pre p ON p.f = d.st LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM d.conv_id
  WHERE d.i = coalesce(s.n, 0) AND p.g IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY d.conv_id ORDER BY d.cost + 5 * len(p.ks), d.audit || p.ks) = 1)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, e.cost, e.audit, sha256(array_to_string(e.rows, chr(10))) AS repaired_sha256
FROM ends e LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM e.conv_id""",
}
