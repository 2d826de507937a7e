"""Queries over the text tables and, where SQL can say them, the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavetide.llm import encode, leaks, spans
from wavetide.sources.tables import table


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.encode(table(spark, sf_dir, "documents"))


def p8_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.decode(p8_ids(spark, sf_dir))


def p8_token_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.encode_with_spans(table(spark, sf_dir, "documents")).select(
        "doc_id", F.size("ids").alias("n_ids"), F.coalesce(F.array_max("ends"), F.lit(0)).alias("n_chars"), F.size(F.filter("split", lambda x: x)).alias("n_split")
    )


def p8_covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters that the tokens' spans reach, and whether each span begins where the one before ends, or within its last character."""
    told = encode.encode_with_spans(table(spark, sf_dir, "documents"))
    joined = F.forall(F.arrays_zip(F.array_prepend(F.slice("ends", 1, F.greatest(F.size("ends") - 1, F.lit(0))), F.lit(0)).alias("b"), F.col("starts").alias("a"), F.col("split").alias("s")), lambda x: F.when(x["s"], x["a"] == x["b"] - 1).otherwise(x["a"] == x["b"]))
    return told.select("doc_id", F.coalesce(F.array_max("ends"), F.lit(0)).alias("n_chars"), ((F.size("ids") == 0) | joined).alias("joined"))


def p9_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_leaks(spark, sf_dir).select("doc_id", "item_id")


def p9_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return leaks.without_leaks(docs, p9_leaks(spark, sf_dir))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.shared_spans(table(spark, sf_dir, "documents"))


def p10_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.shared_share(table(spark, sf_dir, "documents").select("doc_id", "text"), p10_found(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p8_ids, p8_decoded, p8_token_spans, p8_covered, p9_found, p9_leaks, p9_clean, p10_found, p10_share)
}

_WORDS = """list_filter(regexp_split_to_array(lower({}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"""
_LEAKS = f"""dw AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents), iw AS (SELECT item_id, {_WORDS.format("text")} AS w FROM eval_items),
dg AS (SELECT doc_id, array_to_string(list_slice(w, k, k + 14), ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 14)) AS k FROM dw)),
ig AS (SELECT DISTINCT item_id, array_to_string(list_slice(w, k, k + 14), ' ') AS g FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - 14)) AS k FROM iw)),
leaked AS (SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g))"""
_PASSAGES = f"""dw AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents), iw AS (SELECT DISTINCT item_id, text, {_WORDS.format("text")} AS w FROM eval_items),
dg AS (SELECT doc_id, k, array_to_string(list_slice(w, k, k + 14), ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 14)) AS k FROM dw)),
ig AS (SELECT item_id, k, array_to_string(list_slice(w, k, k + 14), ' ') AS g FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - 14)) AS k FROM iw)),
met AS (SELECT doc_id, item_id, dg.k AS dk, ig.k AS ik FROM dg JOIN ig USING (g)),
run AS (SELECT *, dk - row_number() OVER (PARTITION BY doc_id, item_id, dk - ik ORDER BY dk) AS run FROM met),
passages AS (SELECT doc_id, item_id, count(*) + 14 AS n_words, min(ik) - 1 AS item_from, min(dk) - 1 AS doc_from FROM run GROUP BY doc_id, item_id, dk - ik, run)"""
_SPANS = """starts AS (SELECT doc_id, s, md5_number(substr(text, CAST(s + 1 AS BIGINT), 256)) AS h FROM (SELECT doc_id, text, unnest(generate_series(0, length(text) - 256)) AS s FROM documents)),
twice AS (SELECT h FROM starts GROUP BY h HAVING min(doc_id) <> max(doc_id)),
hits AS (SELECT doc_id, s FROM starts WHERE h IN (SELECT h FROM twice)),
marked AS (SELECT *, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 256 THEN 0 ELSE 1 END AS new FROM hits),
runs AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM marked),
spans AS (SELECT doc_id, CAST(min(s) AS INTEGER) AS span_start, CAST(max(s) + 256 AS INTEGER) AS span_end FROM runs GROUP BY doc_id, run)"""

SQL: dict[str, str] = {
    "p8_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    "p8_covered": "SELECT doc_id, CAST(coalesce(length(text), 0) AS INTEGER) AS n_chars, true AS joined FROM documents",
    "p9_leaks": f"""WITH {_PASSAGES} SELECT doc_id, item_id, unnest(best) FROM (SELECT doc_id, item_id, first(struct_pack(n_words := n_words, item_from := item_from, doc_from := doc_from)
  ORDER BY n_words DESC, item_from, doc_from) AS best FROM passages GROUP BY ALL)""",
    "p9_found": f"WITH {_LEAKS} SELECT * FROM leaked",
    "p9_clean": f"WITH {_LEAKS} SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM leaked)",
    "p10_found": f"WITH {_SPANS} SELECT doc_id, span_start, span_end FROM spans",
    "p10_share": f"""WITH {_SPANS} SELECT doc_id, CAST(coalesce(length(text), 0) AS INTEGER) AS n_chars,
  CAST(coalesce((SELECT sum(span_end - span_start) FROM spans s WHERE s.doc_id = d.doc_id), 0) AS BIGINT) AS n_shared FROM documents d""",
}
