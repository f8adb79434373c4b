"""Hybrid search: min-max normalised vector and BM25 legs, blended per query."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kbvec.operators.batch import best_per_query, search_batch
from kbvec.operators.bm25 import bm25_batch, bm25_scores, leg_size, query_terms
from kbvec.operators.filters import tenant_rows
from kbvec.operators.search import Rerank, dedup_sources, overfetch, scored, search, take_top
from kbvec.operators.textindex import index_top
from kbvec.schema import DEFAULT_TENANT
from kbvec.session import broadcast_if_small, materialize

# Fixed value: weight of the vector leg.
DEFAULT_ALPHA = 0.7
#: By how much the legs grow when dedup leaves too few sources.
GROWTH = 4


def normalize(scores: DataFrame, by: str = "query_id") -> DataFrame:
    """``score`` rescaled to [0, 1] within each query; equal scores all become 1.

    The window holds one query's leg, whose size the search fixes beforehand.
    """
    w = Window.partitionBy(by)
    low, high = F.min("score").over(w), F.max("score").over(w)
    return (scores.withColumn("_low", low).withColumn("_span", high - low)
            .withColumn("score", F.when(F.col("_span") > 0, (F.col("score") - F.col("_low")) / F.col("_span"))
                        .otherwise(F.lit(1.0)))
            .drop("_low", "_span"))


def blend(vector_leg: DataFrame, text_leg: DataFrame, alpha: float, by: str = "query_id") -> DataFrame:
    """``alpha * vector + (1 - alpha) * text``; a missing text score is 0.

    Rows found by text only carry no metadata and are not part of the result.
    """
    text = normalize(text_leg, by).select(by, "vector_id", F.col("score").alias("_text"))
    return (normalize(vector_leg, by).join(text, [by, "vector_id"], "left")
            .withColumn("score", F.lit(alpha) * F.col("score")
                        + F.lit(1.0 - alpha) * F.coalesce("_text", F.lit(0.0)))
            .drop("_text"))


def hybrid_search(vectors: DataFrame, query: Sequence[float], text: str, k: int = 50,
                  tenant: str = DEFAULT_TENANT, spec: Mapping[str, Any] | None = None,
                  alpha: float = DEFAULT_ALPHA, metric: str = "cosine", dim: int | None = None,
                  dedup: bool = False, text_available: bool = True, text_index: str | None = None,
                  rerank: Rerank | None = None, version: int | None = None) -> DataFrame:
    """Vector search refined by BM25; plain vector search where there is no text to match.

    The text leg scores live text, or reads the index at ``text_index``, which must be of the table's ``version`` and
    only touches the postings of the query's words. With ``text_available=False`` (no text leg can be computed) raw
    vector scores come back, deduped as a list when asked for. Where one source fills the legs so that fewer than ``k``
    sources are left, both legs are taken ``GROWTH`` times as long (and normalised anew) until there are enough.
    """
    if not text:
        return search(vectors, query, k, tenant, spec, metric, dim, dedup, rerank)
    own = tenant_rows(vectors, tenant, spec)
    terms = query_terms(vectors.sparkSession, text) if text_available and not text_index else []

    def blended(rows: int) -> DataFrame:
        leg = take_top(scored(own, query, metric, dim), rows)
        if not text_available:
            return leg
        if text_index:
            words_leg = index_top(vectors.sparkSession, text_index, text, rows, tenant, spec, version)
        else:
            words_leg = take_top(bm25_scores(vectors, terms, own), rows)
        one = F.lit(0).alias("query_id")
        return blend(leg.select(one, "*"), words_leg.select(one, "vector_id", "score"), alpha).drop("query_id")

    if not dedup:
        found = take_top(blended(leg_size(k)), k)
    else:
        rows = leg_size(overfetch(k))
        while True:
            leg = materialize(blended(rows), "blended")
            found = dedup_sources(leg, k)
            if found.count() >= k or leg.count() < rows:
                break
            rows *= GROWTH
    return rerank(found) if rerank else found


def hybrid_batch(vectors: DataFrame, queries: DataFrame, k: int = 50, alpha: float = DEFAULT_ALPHA,
                 metric: str = "cosine", spec: Mapping[str, Any] | None = None, dedup: bool = False) -> DataFrame:
    """``query_id, vector_id, score, rank`` for ``queries(query_id, bot_id, embedding, query_text)``.

    Both legs are computed for all queries at once; each query is blended and deduped like a single one. Queries
    without a text are plain vector searches.
    """
    blank = F.coalesce("query_text", F.lit("")) == ""
    columns = ["query_id", "vector_id", "score", "rank"]
    plain = search_batch(vectors, queries.filter(blank), k, metric, spec, dedup).select(*columns)
    asked, rows = queries.filter(~blank), leg_size(overfetch(k) if dedup else k)
    if not dedup:
        return best_per_query(_blended_batch(vectors, asked, rows, alpha, metric, spec), k).select(*columns).unionByName(plain)
    done = plain
    while True:
        # Legs hold a fixed number of rows for each query.
        leg = materialize(_blended_batch(vectors, asked, rows, alpha, metric, spec), "blended")
        urls = vectors.select("vector_id", "source_url").join(broadcast_if_small(leg), "vector_id")
        found = materialize(best_per_query(dedup_sources(urls, k, by=["query_id"]).drop("source_url"), k).select(*columns), "found")
        full = leg.groupBy("query_id").agg(F.count("*").alias("n")).filter(F.col("n") >= rows)
        short = full.join(found.groupBy("query_id").agg(F.count("*").alias("n")).filter(F.col("n") >= k), "query_id", "left_anti")
        short = materialize(short.select("query_id"), "short")
        done = done.unionByName(found.join(broadcast_if_small(short), "query_id", "left_anti"))
        if short.isEmpty():
            return done
        again = short.withColumnRenamed("query_id", "_id")
        asked = asked.join(broadcast_if_small(again), F.col("query_id").cast("string") == F.col("_id"), "left_semi")
        rows *= GROWTH


def _blended_batch(vectors: DataFrame, queries: DataFrame, rows: int, alpha: float, metric: str,
                   spec: Mapping[str, Any] | None) -> DataFrame:
    leg = search_batch(vectors, queries, rows, metric, spec).drop("rank")
    text = bm25_batch(vectors, queries, rows, spec=spec).drop("rank")
    return blend(materialize(leg, "vector-leg"), materialize(text, "text-leg"), alpha)
