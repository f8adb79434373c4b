"""Upsert, deletes and orphan compaction as DataFrame to DataFrame operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kbvec.functions.ids import vector_id, without_chunk_suffix
from kbvec.operators.ingest import missing_parts
from kbvec.schema import DEFAULT_TENANT, conform
from kbvec.session import broadcast_if_small, materialize

# Entry source that this table mirrors, minimum load age of a compaction.
ENTRY_SOURCE = "pinecone"
MIN_LOAD_AGE_SECONDS = 3600


def last_per_id(rows: DataFrame, seq: str | None = None) -> DataFrame:
    """One row per id, the last by ``seq``.

    Without ``seq`` the newest ``updated_at`` wins where there is one, and among the rest the row whose values come
    last in order, so the same input always leaves the same row. The rank test prunes inside each task, so an id
    with very many versions ships few rows.
    """
    if seq is None:
        stamp = [F.col("updated_at").desc_nulls_last()] if "updated_at" in rows.columns else []
        ordered = [f.name for f in rows.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
        order = [*stamp, *[F.col(c).desc_nulls_last() for c in ordered]]
    else:
        order = [F.col(seq).desc()]
    w = Window.partitionBy("vector_id").orderBy(*order)
    last = rows.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") == 1).drop("_n")
    return last if seq is None else last.drop(seq)


def upsert(target: DataFrame, rows: DataFrame, seq: str | None = None, storage: str = "float32",
           now=None) -> DataFrame:
    """``target`` with ``rows`` replaced or inserted by id; input without id or embedding is skipped."""
    fresh = conform(last_per_id(rows.filter(~missing_parts()), seq), storage, now)
    ids = broadcast_if_small(fresh.select("vector_id"))
    return target.join(ids, "vector_id", "left_anti").select(*fresh.columns).unionByName(fresh)


def delete_by_ids(target: DataFrame, ids: DataFrame, tenant: str = DEFAULT_TENANT) -> DataFrame:
    """``target`` without the listed ids of one tenant; other tenants' rows never match."""
    gone = broadcast_if_small(ids.select("vector_id").distinct()
                              .withColumn("bot_id", F.lit(tenant)))
    return target.join(gone, ["vector_id", "bot_id"], "left_anti").select(*target.columns)


def delete_by_url(target: DataFrame, url: str, tenant: str = DEFAULT_TENANT) -> DataFrame:
    """``target`` without the base row and every chunk of one URL in one tenant."""
    hit = (F.col("bot_id") == F.lit(tenant)) & (F.col("source_url") == F.lit(url))
    return target.filter(~F.coalesce(hit, F.lit(False)))


def split_entries(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct ids and distinct URLs named by ``entries(id, source, sourceUrl, isGroup)``."""
    own = entries.filter(F.coalesce("source", F.lit("")) == ENTRY_SOURCE)
    url, entry_id = F.coalesce("sourceUrl", F.lit("")), F.coalesce("id", F.lit(""))
    by_url = F.coalesce(F.col("isGroup").cast("string") == "true", F.lit(False)) & (url != "")
    urls = own.filter(by_url).select(url.alias("source_url")).distinct()
    ids = own.filter(~by_url & (entry_id != "")).select(entry_id.alias("vector_id")).distinct()
    return ids, urls


def bulk_delete(target: DataFrame, entries: DataFrame, tenant: str = DEFAULT_TENANT) -> DataFrame:
    ids, urls = split_entries(entries)
    gone = broadcast_if_small(urls.withColumn("bot_id", F.lit(tenant)))
    kept = delete_by_ids(target, ids, tenant)
    return kept.join(gone, ["source_url", "bot_id"], "left_anti").select(*target.columns)


def orphans(target: DataFrame, alive: DataFrame, strict_ids: bool = False, prefix: str = "kb_") -> DataFrame:
    """Rows of ``target`` with no living source row ``alive(id, source_url)``.

    Chunk rows belong to their URL's source row. ``strict_ids=True`` compares whole ids instead, under
    which a chunk row is always an orphan.
    """
    living = alive.select(vector_id(F.col("id"), F.col("source_url"), prefix=prefix).alias("_base")).distinct()
    base = F.col("vector_id") if strict_ids else without_chunk_suffix(F.col("vector_id"))
    return target.withColumn("_base", base).join(living, "_base", "left_anti").drop("_base")


def compaction_list(target: DataFrame, alive: DataFrame, max_deletes: int | None = None, **options) -> DataFrame:
    """Ids one compaction run removes: all orphans, or the smallest ``max_deletes`` ids of them."""
    found = orphans(target.select("vector_id"), alive, **options)
    return found if max_deletes is None else found.orderBy("vector_id").limit(max_deletes)


def may_compact(last_load: dt.datetime | None, now: dt.datetime) -> bool:
    """A run is skipped while the last load is too recent to trust the source's contents."""
    return last_load is None or (now - last_load).total_seconds() >= MIN_LOAD_AGE_SECONDS


def compact(target: DataFrame, alive: DataFrame, max_deletes: int | None = None, **options) -> DataFrame:
    gone = broadcast_if_small(materialize(compaction_list(target, alive, max_deletes, **options), "orphans"))
    return target.join(gone, "vector_id", "left_anti")
