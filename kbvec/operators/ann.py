"""Approximate top-K by random-hyperplane hashing (Charikar 2002).

The index holds each vector once, and per table the ids of every bucket; a query reads only the
buckets its vector falls into, whose number grows with the table. Exact search remains the contract;
this trades recall for bytes read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kbvec.functions.topk import as_matrix
from kbvec.functions.vectors import cosine
from kbvec.operators.batch import best_per_query
from kbvec.session import broadcast_if_small, materialize

#: Folders of postings per table, and rows that a bucket holds on average.
FOLDERS, BUCKET_ROWS = 64, 256


class HyperplaneHash:
    """``tables`` independent hashes of ``bits`` sign bits each, reproducible from ``seed``."""

    def __init__(self, dim: int, tables: int = 8, bits: int = 6, seed: int = 17):
        self.dim, self.tables, self.bits = dim, tables, bits
        self.planes = np.random.RandomState(seed).standard_normal((tables * bits, dim))

    @classmethod
    def for_rows(cls, dim: int, rows: int, tables: int = 8, seed: int = 17) -> HyperplaneHash:
        """As many bits as leave about ``BUCKET_ROWS`` rows in a bucket, so that a query's share falls with the table."""
        return cls(dim, tables, max(1, min(30, round(np.log2(max(rows, 1) / BUCKET_ROWS)))), seed)

    def buckets(self, matrix: np.ndarray) -> np.ndarray:
        """One bucket number per row and table."""
        signs = (matrix @ self.planes.T >= 0).reshape(len(matrix), self.tables, self.bits)
        return (signs * (1 << np.arange(self.bits))).sum(axis=2).astype(np.int32)

    def column(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``df`` with an array column ``buckets``, computed per Arrow batch."""
        def attach(batches):
            for batch in (b for b in batches if b.num_rows):
                found = self.buckets(as_matrix(batch.column("embedding")))
                offsets = np.arange(len(found) + 1, dtype=np.int32) * np.int32(self.tables)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in keep], lists], names=[*keep, "buckets"])

        schema = df.select(*keep).schema.add("buckets", T.ArrayType(T.IntegerType()))
        read = list(dict.fromkeys([*keep, "embedding"]))
        return df.filter(F.col("embedding").isNotNull()).select(*read).mapInArrow(attach, schema)


def build_index(vectors: DataFrame, hashing: HyperplaneHash, path: str) -> None:
    """Write each vector once, and per table the bucket and id of every row.

    Postings lie in a bounded number of folders per table, sorted by bucket, so a reader skips by folder and by the
    files' statistics, however many buckets there are.
    """
    rows = hashing.column(vectors, ["vector_id", "bot_id"])
    (rows.select("*", F.posexplode("buckets").alias("tbl", "bucket"))
     .withColumn("folder", F.col("bucket") % FOLDERS)
     .hint("rebalance", "tbl", "folder").sortWithinPartitions("tbl", "folder", "bucket")
     .write.option("compression", "zstd").partitionBy("tbl", "folder").parquet(f"{path}/postings"))
    (vectors.filter(F.col("embedding").isNotNull()).select("vector_id", "embedding")
     .write.option("compression", "zstd").parquet(f"{path}/vectors"))


def ann_search(path: str, queries: DataFrame, hashing: HyperplaneHash, k: int) -> DataFrame:
    """``query_id, vector_id, score, rank`` among rows sharing a bucket with the query in any table.

    A row met in several tables counts in the first of them only, so no distinct step is needed. Queries are a
    bounded batch; the vectors of the candidates are fetched by id and scored exactly.
    """
    spark = queries.sparkSession
    hashed = hashing.column(queries, ["query_id", "bot_id", "embedding"]).select(
        F.col("query_id").cast("string").alias("query_id"), "bot_id", F.col("embedding").alias("_q"),
        F.col("buckets").alias("_b"))
    asked = hashed.select("query_id", "bot_id", "_b", F.posexplode("_b").alias("tbl", "bucket")).withColumn(
        "folder", F.col("bucket") % FOLDERS)
    pairs = spark.read.parquet(f"{path}/postings").join(
        broadcast_if_small(asked), ["tbl", "folder", "bucket", "bot_id"])
    earlier = F.exists(F.zip_with(F.slice("buckets", 1, F.col("tbl")), F.slice("_b", 1, F.col("tbl")),
                                  lambda x, y: x == y), lambda same: same)
    candidates = materialize(pairs.filter(~earlier).select("query_id", "vector_id"), "candidates")
    scored = (spark.read.parquet(f"{path}/vectors").join(broadcast_if_small(candidates), "vector_id")
              .join(broadcast_if_small(hashed.select("query_id", "_q")), "query_id")
              .select("query_id", "vector_id", cosine(F.col("embedding"), F.col("_q")).alias("score")))
    return best_per_query(scored, k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact result that the approximate search returned, per query."""
    hits = found.select("query_id", "vector_id", F.lit(1).alias("_hit"))
    return (exact.join(hits, ["query_id", "vector_id"], "left")
            .groupBy("query_id").agg((F.count("_hit") / F.count("*")).alias("recall")))
