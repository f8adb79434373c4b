"""Stable vector ids: the same source row always gets the same id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kbvec.functions.text import CHUNK_ID_INFIX


def vector_id(row_id: Column, source_url: Column, is_chunked: Column | None = None,
              chunk_index: Column | None = None, prefix: str = "kb_") -> Column:
    """``md5(url)`` plus the chunk suffix where chunked; ``prefix || row id`` where there is no URL."""
    url = F.coalesce(source_url, F.lit(""))
    base = F.md5(url)
    if is_chunked is not None:
        position = F.coalesce(chunk_index, F.lit(0)).cast("string")
        base = F.when(is_chunked, F.concat(base, F.lit(CHUNK_ID_INFIX), position)).otherwise(base)
    return F.when(url != "", base).otherwise(
        F.concat(F.lit(prefix), F.coalesce(row_id, F.lit(0)).cast("string")))


def without_chunk_suffix(vector_id_col: Column) -> Column:
    return F.regexp_replace(vector_id_col, CHUNK_ID_INFIX + r"\d+$", "")
