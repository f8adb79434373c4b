"""Single-query search: exact top-K, per-source dedup, rerank hook, match rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kbvec.functions.vectors import readable, score
from kbvec.operators.filters import tenant_rows
from kbvec.schema import DEFAULT_ROLE, DEFAULT_TENANT, DEFAULT_TYPE

Rerank = Callable[[DataFrame], DataFrame]

MATCH_COLUMNS = ("content", "source_url", "role_restriction", "content_type",
                 "chunk_index", "total_chunks", "is_chunked")


def overfetch(k: int) -> int:
    """Rows of a hybrid search kept ahead of dedup, so that collapsing sources as a rule leaves ``k``."""
    return max(k * 3, k + 10)


def best_first(score_col: str = "score") -> list[Column]:
    """Highest score first; the id decides ties, so results do not depend on the plan."""
    return [F.col(score_col).desc_nulls_last(), F.col("vector_id").asc()]


def scored(rows: DataFrame, query: Sequence[float], metric: str = "cosine",
           dim: int | None = None) -> DataFrame:
    """Rows with a ``score`` in place of the embedding; a zero vector has no cosine, its score is null."""
    if dim is not None and len(query) != dim:
        raise ValueError(f"embedding dimension mismatch: expected {dim}, got {len(query)}")
    kept = [c for c in rows.columns if c != "embedding"]
    return readable(rows, metric).select(*kept, score(F.col("embedding"), query, metric).alias("score"))


def take_top(rows: DataFrame, k: int) -> DataFrame:
    """Best ``k`` scored rows. Nulls sort last and go after the limit: a test before it would be
    pushed below the projection and compute every score twice."""
    return rows.orderBy(*best_first()).limit(k).filter(F.col("score").isNotNull())


def dedup_sources(matches: DataFrame, k: int, by: Sequence[str] = ()) -> DataFrame:
    """Best row per source URL, rows without a URL all kept, best ``k`` of the rest (per ``by``).

    A row without a URL is a group of its own, so one ``rank = 1`` test covers both kinds and Spark
    can drop losers before the shuffle.
    """
    url = F.coalesce(F.col("source_url"), F.lit(""))
    alone = F.when(url == "", F.col("vector_id"))
    per_source = Window.partitionBy(*by, url, alone).orderBy(*best_first())
    kept = matches.withColumn("_n", F.row_number().over(per_source)).filter(F.col("_n") == 1).drop("_n")
    if not by:
        return take_top(kept, k)
    ranked = Window.partitionBy(*by).orderBy(*best_first())
    return kept.withColumn("_n", F.row_number().over(ranked)).filter(F.col("_n") <= k).drop("_n")


def search(vectors: DataFrame, query: Sequence[float], k: int = 50, tenant: str = DEFAULT_TENANT,
           spec: Mapping[str, Any] | None = None, metric: str = "cosine", dim: int | None = None,
           dedup: bool = False, rerank: Rerank | None = None, fetch: int | None = None) -> DataFrame:
    """Top ``k`` rows of one tenant by similarity to ``query``, exact over the whole tenant.

    ``dedup`` keeps the best row of every source URL: of the whole tenant, or of its ``fetch`` best rows.
    """
    candidates = scored(tenant_rows(vectors, tenant, spec), query, metric, dim)
    if dedup:
        found = dedup_sources(candidates if fetch is None else take_top(candidates, fetch), k)
    else:
        found = take_top(candidates, k)
    return rerank(found) if rerank else found


def to_matches(rows: DataFrame) -> DataFrame:
    """Result rows ``id, score, metadata`` with nulls replaced by the documented defaults."""
    metadata = F.struct(
        F.coalesce("content", F.lit("")).alias("text"),
        F.coalesce("source_url", F.lit("")).alias("source_url"),
        F.coalesce("role_restriction", F.lit(DEFAULT_ROLE)).alias("role_restriction"),
        F.coalesce("content_type", F.lit(DEFAULT_TYPE)).alias("type"),
        F.col("chunk_index").cast("int").alias("chunk_index"),
        F.col("total_chunks").cast("int").alias("total_chunks"),
        F.coalesce("is_chunked", F.lit(False)).alias("is_chunked"),
    )
    lead = [F.col(c) for c in ("query_id",) if c in rows.columns]
    lead.append(F.coalesce("vector_id", F.lit("")).alias("id"))
    if "score" in rows.columns:
        lead.append(F.coalesce("score", F.lit(0.0)).alias("score"))
    return rows.select(*lead, metadata.alias("metadata"))


def boost(column: Column) -> Rerank:
    """A rerank function that replaces the score and sorts anew."""
    def apply(matches: DataFrame) -> DataFrame:
        return matches.withColumn("score", column).orderBy(*best_first())
    return apply


def rerank_groups(matches: DataFrame, fn, schema) -> DataFrame:
    """Run a pandas rerank function once per query; a group holds one query's top rows only."""
    return matches.groupBy("query_id").applyInPandas(fn, schema)
