"""The queries of this subpackage: op1_ to op13_ over whole tables of sf_dir, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann_search, chat_format, decontaminate, fill_in_middle, language_id, line_dedup, minhash_dedup, packing, quality, secrets, suffix_dedup, token_alignment, topk_search


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), keep="none")
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    spans = lambda x: F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["s"].cast("string"), s["e"].cast("string"))), ",")
    out = chat_format.preferences(turns, chat_format.neighbours(turns))
    return out.withColumns({"chosen_spans": spans("chosen_spans"), "rejected_spans": spans("rejected_spans")})


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", F.size("lines_removed").alias("n_removed"), "lines_removed", F.sha2("text", 256).alias("kept_sha256"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs)
    out = language_id.identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return topk_search.top_k(e, e.filter(F.col("vec_id") % 50 == 0))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    digests = {"output_sha256": F.sha2("output", 256), "restored_sha256": F.sha2(fill_in_middle.restore(F.col("output"), F.col("form")), 256)}
    return out.withColumns(digests).drop("output")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"))


def op13_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return ann_search.nearest(e, e.filter(F.col("vec_id") % 20 == 0))


OP10_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""

def _rendered(side: str) -> str:
    """SQL: a side's turns after the common prefix, rendered, and the spans learnt from."""
    return f"""(SELECT p.chosen_id, coalesce(string_agg('<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10), '' ORDER BY t.i), '') AS {side}
  FROM p LEFT JOIN t ON t.conv_id = p.{side}_id AND t.i > p.n GROUP BY 1)"""


def _spans(side: str) -> str:
    return f"""(SELECT chosen_id, coalesce(string_agg(CASE WHEN role = 'assistant' THEN (e - length(text) - 8) || ':' || e END, ',' ORDER BY i), '') AS {side}_spans FROM (
    SELECT p.chosen_id, t.role, t.text, t.i, sum(length(t.role) + length(t.text) + 13) OVER (PARTITION BY p.chosen_id ORDER BY t.i) AS e
    FROM p LEFT JOIN t ON t.conv_id = p.{side}_id AND t.i > p.n) GROUP BY 1)"""


OP4_SQL = f"""
WITH t AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i
  FROM (SELECT DISTINCT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL)
), h AS (
  SELECT min(conv_id) AS chosen_id, max(conv_id) AS rejected_id FROM (SELECT DISTINCT conv_id FROM t) GROUP BY conv_id // 2 HAVING count(*) = 2
), m AS (
  SELECT h.chosen_id, h.rejected_id, c.i, coalesce(c.role = r.role AND c.text = r.text, false) AS same
  FROM h JOIN t c ON c.conv_id = h.chosen_id LEFT JOIN t r ON r.conv_id = h.rejected_id AND r.i = c.i
), p AS (
  SELECT chosen_id, rejected_id, coalesce(min(CASE WHEN NOT same THEN i END) - 1, max(i)) AS n FROM m GROUP BY 1, 2
)
SELECT p.chosen_id, p.rejected_id, CAST(p.n AS INTEGER) AS n_prompt_turns,
  coalesce((SELECT string_agg('<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10), '' ORDER BY t.i) FROM t WHERE t.conv_id = p.chosen_id AND t.i <= p.n), '') AS prompt,
  c.chosen, cs.chosen_spans, r.rejected, rs.rejected_spans
FROM p JOIN {_rendered("chosen")} c USING (chosen_id) JOIN {_rendered("rejected")} r USING (chosen_id) JOIN {_spans("chosen")} cs USING (chosen_id) JOIN {_spans("rejected")} rs USING (chosen_id)
"""

OP11_SQL = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || doc_id) AS h FROM documents
), d AS (
  SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3,
    CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM t
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d
), p AS (
  SELECT *, array_to_string(u[1:lo], '') AS a, array_to_string(u[lo + 1:hi], '') AS m, array_to_string(u[hi + 1:], '') AS s FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(a) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || a || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || a || '<M>' || m ELSE text END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""

QUERIES = {f.__name__: f for f in (op1_minhash_dedup, op2_secrets, op3_suffix_dedup, op4_chat_format, op5_quality, op6_line_dedup, op7_decontaminate, op8_language_id, op9_packing, op10_topk_search, op11_fill_in_middle, op12_token_alignment, op13_ann_search)}
ORACLE = {"op4_chat_format": OP4_SQL, "op10_topk_search": OP10_SQL, "op11_fill_in_middle": OP11_SQL}
