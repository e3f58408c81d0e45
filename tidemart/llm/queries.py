"""One query for each operator over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bpe, chat, collocations, exact_dedup, html_extract, line_dedup, minhash, packing, pii, quality, sharding, spelling, token_counts
from .common import table


def op1_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    q = quality.quality(docs, table(spark, sf_dir, "labels"), carry=["doc_id"])
    return q.select("doc_id", *[f"_quality.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")], F.round("_quality.probability", 6).alias("probability"))


def op2_pii(spark, sf_dir):
    return pii.report(table(spark, sf_dir, "documents"))


def op3_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), keep_ids=False).drop("ids")


def op4_sharding(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).drop("th")


def op6_token_counts(spark, sf_dir):
    return token_counts.count_tokens(token_counts.revision(table(spark, sf_dir, "documents")))


def op7_minhash_dedup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=2, threshold=80).drop("th")


def op8_chat_format(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat.digests(chat.format_conversations(rows.unionByName(probe)))


def op9_byte_bpe(spark, sf_dir):
    return bpe.encode_decode(table(spark, sf_dir, "documents"), keep_ids=False).drop("ids")


def op10_html_extract(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op11_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_line_dedup(spark, sf_dir):
    out = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_pii, op3_packing, op4_sharding, op5_exact_dedup, op6_token_counts, op7_minhash_dedup, op8_chat_format, op9_byte_bpe, op10_html_extract,
    op11_spelling_variants, op12_line_dedup, op13_collocations)}

ORACLE = {
    "op4_sharding": sharding.ORACLE,
    "op5_exact_dedup": r"""
WITH n AS (SELECT doc_id, coalesce(length(text), 0) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id)
""",
    "op7_minhash_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]] ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM w),
c AS (SELECT list_sort(s) AS s, min(doc_id) AS node, len(any_value(s)) AS n FROM s WHERE len(s) > 0 GROUP BY 1),
t AS (SELECT node, n, unnest(s) AS x FROM c),
f AS (SELECT node, n, x, row_number() OVER (PARTITION BY node ORDER BY k, x) AS r FROM (SELECT *, count(*) OVER (PARTITION BY x) AS k FROM t)),
q AS (SELECT * FROM f WHERE r <= n - (80 * n + 99) // 100 + 1),
p AS (SELECT DISTINCT a.node AS a, b.node AS b FROM q a JOIN q b ON a.x = b.x AND a.node < b.node AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n),
l AS (SELECT p.a, p.b FROM p JOIN c a ON a.node = p.a JOIN c b ON b.node = p.b
  WHERE 100 * len(list_intersect(a.s, b.s)) >= 80 * (a.n + b.n - len(list_intersect(a.s, b.s)))),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach AS (SELECT node, node AS hop FROM c UNION SELECT r.node, e.b FROM reach r JOIN e ON e.a = r.hop),
m AS (SELECT node, min(hop) AS comp FROM reach GROUP BY node)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(m.comp, s.doc_id) AS component_id, coalesce(m.comp, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN c ON list_sort(s.s) = c.s LEFT JOIN m ON m.node = c.node
""",
    "op8_chat_format": chat.ORACLE,
    "op11_spelling_variants": spelling.ORACLE,
    "op12_line_dedup": line_dedup.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
