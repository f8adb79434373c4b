"""Registered queries and, beside each, the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn
    return add


# The tables of kbvec.plans.fixtures, in SQL: ``kb_vectors`` holds every embedding, ``kb_source`` every document and
# embedding.
KB = """kb AS (
  SELECT s.*,
    CASE WHEN source_url = '' THEN 'kb_' || kb_id
         WHEN is_chunked THEN md5(source_url) || '_chunk_' || chunk_index
         ELSE md5(source_url) END AS vector_id
  FROM (
    SELECT e.vec_id AS kb_id, e.label AS label, e.embedding::DOUBLE[] AS embedding,
      CASE e.label % 3 WHEN 0 THEN 'default' WHEN 1 THEN 'support_en' ELSE 'support_fr' END AS bot_id,
      CASE (e.vec_id // 5) % 3 WHEN 0 THEN '' WHEN 1 THEN 'https://kb.example/d/' || (e.vec_id // 5)
           ELSE 'https://kb.example/p/' || e.vec_id END AS source_url,
      (e.vec_id // 5) % 3 = 1 AS is_chunked,
      CASE WHEN (e.vec_id // 5) % 3 = 1 THEN (e.vec_id % 5)::INTEGER END AS chunk_index,
      CASE WHEN (e.vec_id // 5) % 3 = 1 THEN 5 END AS total_chunks,
      coalesce(e.text, '') AS content,
      CASE WHEN e.vec_id % 4 = 0 THEN 'subscriber' ELSE 'public' END AS role_restriction,
      CASE e.vec_id % 3 WHEN 0 THEN 'post' WHEN 1 THEN 'page' ELSE 'product' END AS content_type,
      TIMESTAMP '2024-01-01' + to_minutes(e.vec_id::INTEGER) AS updated_at
    FROM (SELECT coalesce(v.vec_id, d.doc_id) AS vec_id, coalesce(v.label, (d.doc_id % 10)::INTEGER) AS label,
      v.embedding, d.text FROM embeddings v LEFT JOIN documents d ON d.doc_id = v.vec_id) e) s)"""
SOURCE = KB.replace("LEFT JOIN", "FULL JOIN")
# Source rows that hold a usable vector.
HAS_VECTOR = "(embedding IS NOT NULL AND (label <> 8 OR content_type <> 'product'))"
ASKED = "asked AS (SELECT embedding AS qe FROM kb WHERE kb_id = 0)"
WORDS = r"list_filter(regexp_split_to_array(lower({0}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"


def words_sql(expr: str) -> str:
    return WORDS.format(expr)


def kb_sql(body: str, *ctes: str, source: bool = False) -> str:
    """A statement over ``kb`` (and further CTEs), the source table with ``source``; ``body`` is the final SELECT."""
    return "WITH " + ",\n".join([SOURCE if source else KB, *ctes]) + "\n" + body


def vector_sql(vector: str = "embedding") -> str:
    """Digest of all components: their sum, and their sum weighted by place."""
    return (f"round(list_sum({vector}), 4) AS vector_sum, "
            f"round(list_sum(list_transform({vector}, lambda x, i: x * i)), 3) AS vector_weighted")
