"""Search for many queries at once.

A query frame holds ``query_id, bot_id, embedding``. Up to ``BLOCK`` queries travel to every task and
the table is scanned once; the task multiplies blocks and keeps only ``k`` rows per query, so no
(query, row) pair is ever shuffled that cannot be part of the answer. Larger query sets go through
``knn_join``, which compares chunks of both sides and is exact too.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kbvec.functions.topk import (ROWS_PER_BLOCK, TIE_DIGITS, RunningTop, as_bytes, as_matrix, block_scores,
                                  rows_matrix, strings, unit_rows)
from kbvec.functions.vectors import readable
from kbvec.operators.filters import compile_filter
from kbvec.operators.search import MATCH_COLUMNS
from kbvec.schema import DEFAULT_TENANT
from kbvec.session import broadcast_if_small, materialize

BLOCK = 2048
RESULT = "query_id string, vector_id string, score double, source string"
FOUND = ["query_id", "vector_id", "score", "source"]


def best_per_query(partial: DataFrame, k: int) -> DataFrame:
    """Merge local winners: best ``k`` per query, with their rank; ties as in the tasks."""
    w = Window.partitionBy("query_id").orderBy(F.round("score", TIE_DIGITS).desc_nulls_last(), "vector_id")
    ranked = partial.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return ranked.filter(F.col("score").isNotNull())


def _prepared(matrix: np.ndarray, metric: str) -> np.ndarray:
    return unit_rows(matrix) if metric == "cosine" else matrix


def pack(vectors: DataFrame) -> DataFrame:
    """``vectors`` with float embeddings as packed bytes, for a scan table of wide vectors.

    Batch searches take either form. Bytes reach the tasks as one copy instead of number by number,
    which is most of the cost of a scan. Rows without an embedding are left out.
    """
    rows = vectors.filter(F.col("embedding").isNotNull())
    schema = T.StructType([T.StructField(f.name, T.BinaryType() if f.name == "embedding" else f.dataType)
                           for f in rows.schema.fields])

    def convert(batches):
        for batch in (b for b in batches if b.num_rows):
            yield pa.RecordBatch.from_arrays(
                [as_bytes(batch.column(c)) if c == "embedding" else batch.column(c) for c in batch.schema.names],
                names=batch.schema.names)

    return readable(rows, "ip").mapInArrow(convert, schema)


def source_key():
    """Of a URL only the best row counts; a row without one stands for itself."""
    return F.when(F.coalesce("source_url", F.lit("")) != "", F.concat(F.lit("url "), F.col("source_url"))).otherwise(
        F.concat(F.lit("id "), F.col("vector_id")))


def _candidates(vectors: DataFrame, metric: str, spec: Mapping[str, Any] | None, dedup: bool) -> DataFrame:
    """vector_id, bot_id, embedding and source of the rows that pass the filter."""
    predicate, _ = compile_filter(spec)
    rows = vectors if predicate is None else vectors.filter(predicate)
    source = source_key() if dedup else F.lit(None).cast("string")
    return readable(rows.filter(F.col("embedding").isNotNull() & F.col("bot_id").isNotNull()), metric).select(
        "vector_id", "bot_id", "embedding", source.alias("source"))


def _found(top: RunningTop, ids: list[str]) -> list[pa.Array]:
    t = top.table
    return [pa.array([ids[i] for i in t["q"].to_pylist()], pa.string()), *[t[c].combine_chunks() for c in "vsu"]]


def _scan_block(rows: DataFrame, queries: list, k: int, metric: str, dedup: bool) -> DataFrame:
    ids = [str(r["query_id"]) for r in queries]
    tenants = np.array([r["bot_id"] for r in queries], dtype=object)
    matrix = _prepared(rows_matrix(r["embedding"] for r in queries), metric)
    groups = {t: np.flatnonzero(tenants == t) for t in set(tenants)}

    def local_top(batches):
        top = RunningTop(len(ids), k)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_PER_BLOCK):
                part = batch.slice(start, ROWS_PER_BLOCK)
                owner = strings(part.column("bot_id")).dictionary_encode()
                code = np.asarray(owner.indices)
                data = _prepared(as_matrix(part.column("embedding")), metric)
                names, sources = strings(part.column("vector_id")), strings(part.column("source"))
                for i, tenant in enumerate(owner.dictionary.to_pylist()):
                    if tenant in groups:
                        at, cols = np.flatnonzero(code == i), groups[tenant]
                        top.add(block_scores(data[at], matrix[cols], metric), names.take(pa.array(at)), cols,
                                sources.take(pa.array(at)) if dedup else None)
        yield pa.RecordBatch.from_arrays(_found(top, ids), names=FOUND)

    return rows.filter(F.col("bot_id").isin(*groups)).mapInArrow(local_top, RESULT)


def _asked(queries: DataFrame) -> DataFrame:
    return queries.filter(F.col("embedding").isNotNull()).select(
        F.col("query_id").cast("string").alias("query_id"),
        F.coalesce("bot_id", F.lit(DEFAULT_TENANT)).alias("bot_id"), "embedding")


def search_batch(vectors: DataFrame, queries: DataFrame, k: int, metric: str = "cosine",
                 spec: Mapping[str, Any] | None = None, dedup: bool = False, block: int = BLOCK) -> DataFrame:
    """``query_id, vector_id, score, rank``: top ``k`` of the query's own tenant, exact.

    ``spec`` is a filter document for all queries, ``dedup`` keeps the best row of every source URL. Up to ``block``
    queries travel to every task; larger sets go through ``knn_join``.
    """
    queries = _asked(queries)
    head = queries.limit(block + 1).collect()
    if not head:
        return vectors.sparkSession.createDataFrame([], RESULT + ", rank int").drop("source")
    if len(head) <= block:
        rows = _candidates(vectors, metric, spec, dedup)
        return _merged(_scan_block(rows, head, k, metric, dedup), k, dedup)
    return knn_join(vectors, queries, k, metric, spec, dedup)


def _merged(partial: DataFrame, k: int, dedup: bool) -> DataFrame:
    if dedup:
        w = Window.partitionBy("query_id", "source").orderBy(F.round("score", TIE_DIGITS).desc_nulls_last(), "vector_id")
        partial = partial.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") == 1).drop("_n")
    return best_per_query(partial.drop("source"), k)


def with_matches(found: DataFrame, vectors: DataFrame) -> DataFrame:
    """Search results with the columns of the rows found, ready for ``to_matches``."""
    carried = [c for c in MATCH_COLUMNS if c in vectors.columns]
    return vectors.select("vector_id", *carried).join(broadcast_if_small(materialize(found, "found")), "vector_id")


# --- exact join for query sets of any size -----------------------------------------------------

#: Bytes of vectors of one side that a task holds, on average at most; queries it compares at a time.
CHUNK_BYTES = 64 * 1024 * 1024
QUERIES_AT_ONCE = 512
#: Chunks of a tenant's rows and of its queries, at most, while they stay within ``CHUNK_BYTES``. Each is copied once for
#: each chunk of the other side, and a query has ``k`` results for each chunk of rows.
MOST_ROW_CHUNKS, MOST_QUERY_CHUNKS = 16, 16


def _compact(df: DataFrame) -> DataFrame:
    """``df`` with float embeddings packed; doubles stay as they are."""
    kind = df.schema["embedding"].dataType
    return pack(df) if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else df


def chunk_count(total: Column, chunk_bytes: int, most: int | None = None, bound: int = CHUNK_BYTES) -> Column:
    """Chunks of about ``chunk_bytes``; larger ones, up to ``bound``, where there would be more than ``most``."""
    n = F.ceil(total / chunk_bytes)
    return (n if most is None else F.least(n, F.greatest(F.lit(most), F.ceil(total / bound)))).cast("int")


def _chunks(df: DataFrame, chunk_bytes: int, name: str, most: int | None = None) -> DataFrame:
    """Per tenant, into how many chunks its vectors go."""
    packed = isinstance(df.schema["embedding"].dataType, T.BinaryType)
    width = F.octet_length("embedding") if packed else F.size("embedding") * 8
    return df.groupBy("bot_id").agg(chunk_count(F.sum(width.cast("long")), chunk_bytes, most).alias(name))


def knn_join(vectors: DataFrame, queries: DataFrame, k: int, metric: str = "cosine",
             spec: Mapping[str, Any] | None = None, dedup: bool = False, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Exact top ``k`` for query sets that do not fit a broadcast, by blocks.

    The rows and the queries of a tenant are each cut into chunks of bounded bytes by id hash, packed and written
    once; a task compares one chunk with one other and ships ``k`` rows per query. A hot tenant or a pile of equal
    vectors is thus many tasks of bounded size, whatever the table's, and a side is shuffled once for each chunk of
    the other. Chunks of ``chunk_bytes`` grow up to ``CHUNK_BYTES`` before there are more than ``MOST_ROW_CHUNKS`` or
    ``MOST_QUERY_CHUNKS`` of them, so what is shuffled for a row does not grow with the table until a tenant's
    vectors fill these chunks.
    """
    rows = materialize(_compact(_candidates(vectors, metric, spec, dedup)), "knn-rows")
    asked = materialize(_compact(_asked(queries)), "knn-queries")
    plan = broadcast_if_small(materialize(
        _chunks(rows, chunk_bytes, "v_chunks", MOST_ROW_CHUNKS).join(
            _chunks(asked, chunk_bytes, "q_chunks", MOST_QUERY_CHUNKS), "bot_id"), "knn-chunks"))

    def keyed(df, id_col, own, other):
        """Own chunk by id hash, one copy per chunk of the other side."""
        return (df.join(plan, "bot_id")
                .withColumn(own[0], F.pmod(F.xxhash64(id_col), F.col(own)).cast("int"))
                .withColumn(other[0], F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
                .drop("v_chunks", "q_chunks"))

    def local_top(_, v: pa.Table, q: pa.Table) -> pa.Table:
        names, parts = q["query_id"].to_pylist(), []
        if len(names) and v.num_rows:
            data, ids = _prepared(as_matrix(v["embedding"]), metric), strings(v["vector_id"])
            sources = strings(v["source"])
            matrix = _prepared(as_matrix(q["embedding"]), metric)
            for at in range(0, len(names), QUERIES_AT_ONCE):
                top = RunningTop(len(names[at:at + QUERIES_AT_ONCE]), k)
                for start in range(0, len(data), ROWS_PER_BLOCK):
                    stop = start + ROWS_PER_BLOCK
                    top.add(block_scores(data[start:stop], matrix[at:at + QUERIES_AT_ONCE], metric), ids[start:stop],
                            None, sources[start:stop] if dedup else None)
                parts.append(pa.table(_found(top, names[at:at + QUERIES_AT_ONCE]), names=FOUND))
        empty = pa.table({c: pa.array([], pa.float64() if c == "score" else pa.string()) for c in FOUND})
        return pa.concat_tables([empty, *parts])

    keys = ["bot_id", "v", "q"]
    left = keyed(rows, "vector_id", "v_chunks", "q_chunks").groupBy(*keys)
    right = keyed(asked, "query_id", "q_chunks", "v_chunks").groupBy(*keys)
    return _merged(left.cogroup(right).applyInArrow(local_top, RESULT), k, dedup)


# --- equal queries -----------------------------------------------------------------------------

def query_key(k: int, spec_json: str = "{}", generation: int = 0):
    """A 128-bit key per distinct (vector, k, tenant, filter, table generation)."""
    parts = [F.col("embedding").cast("array<float>"), F.lit(k), F.col("bot_id"), F.lit(spec_json),
             F.lit(generation)]
    return F.concat(F.hex(F.xxhash64(*parts)), F.lit("-"), F.hex(F.xxhash64(F.lit(1), *parts)))


def search_collapsed(vectors: DataFrame, queries: DataFrame, k: int, metric: str = "cosine",
                     spec: Mapping[str, Any] | None = None, dedup: bool = False, generation: int = 0) -> DataFrame:
    """Search each distinct query once and hand the answer to every request that asked it."""
    filter_text = json.dumps([spec or {}, dedup, metric], sort_keys=True, default=str)
    keyed = queries.withColumn("key", query_key(k, filter_text, generation))
    distinct = materialize(keyed.groupBy("key").agg(
        F.any_value("bot_id").alias("bot_id"), F.any_value("embedding").alias("embedding")), "queries")
    found = search_batch(vectors, distinct.withColumnRenamed("key", "query_id"), k, metric, spec, dedup)
    answers = broadcast_if_small(materialize(found.withColumnRenamed("query_id", "key"), "answers"))
    return keyed.select("query_id", "key").join(answers, "key")
