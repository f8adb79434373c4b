"""Stored word counts, so that a text query reads the postings of its own words and nothing else.

``postings`` holds one row per (word, row) with the columns filters may address, partitioned by word
hash and sorted by word; ``words`` holds the number of rows per word; ``totals`` the table's row count
and mean length, and the version of the table it was built from. A reader that names another version is
refused, so a stale index is never served unnoticed.

A task counts ``WORDS_AT_ONCE`` words at a time and sorts the postings of about ``PART_BYTES`` of text, whatever the table's
size: a bucket is cut into as many parts, by row id, as its share of the texts asks for.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kbvec.functions.text import words
from kbvec.operators.bm25 import K1, B, query_terms
from kbvec.operators.filters import tenant_rows
from kbvec.operators.search import take_top
from kbvec.schema import DEFAULT_TENANT
from kbvec.session import materialize

CARRIED = ("vector_id", "bot_id", "content_type", "role_restriction", "source_url", "chunk_index")
BUCKETS = 64
#: Text whose postings one task sorts (some 30 bytes for each byte of prose); words that are counted at a time.
PART_BYTES, WORDS_AT_ONCE = 8 * 1024 * 1024, 1 << 18


def _bucket(word, buckets: int):
    return F.pmod(F.xxhash64(word), F.lit(buckets)).cast("int")


def count_words(vectors: DataFrame) -> DataFrame:
    """One row per (row, distinct word) with its count and the row's length; counted where the text is."""
    source = vectors.select(*CARRIED, words(F.col("content")).alias("w"))

    def pieces(batches):
        """Rows of ``WORDS_AT_ONCE`` words together, or a single one."""
        for batch in batches:
            ends = np.cumsum(np.asarray(pc.list_value_length(batch.column("w")), dtype=np.int64))
            at = 0
            while at < len(ends):
                before = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, before + WORDS_AT_ONCE, "right")))
                yield batch.slice(at, to - at)
                at = to

    def count(batches):
        for batch in pieces(batches):
            w = batch.column("w")
            lengths = np.asarray(pc.list_value_length(w), dtype=np.int64)
            coded = w.flatten().cast(pa.string()).dictionary_encode()
            size = max(1, len(coded.dictionary))
            cell, tf = np.unique(np.repeat(np.arange(len(w)), lengths) * size + np.asarray(coded.indices),
                                 return_counts=True)
            doc = cell // size
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(pa.array(doc)) for c in CARRIED],
                 coded.dictionary.take(pa.array(cell % size)), pa.array(tf.astype(np.int32)),
                 pa.array(lengths[doc].astype(np.int32))], names=[*CARRIED, "word", "tf", "dl"])

    return source.mapInArrow(count, source.drop("w").schema.add("word", "string").add("tf", "integer").add("dl", "integer"))


def build_index(vectors: DataFrame, path: str, buckets: int = BUCKETS, version: int | None = None) -> None:
    """Write the index of a table (of its ``version``); a frequent word's postings are spread over several files."""
    spark = vectors.sparkSession
    vectors = materialize(vectors.select(*CARRIED, "content"), "index-texts")
    size = vectors.agg(F.coalesce(F.sum(F.octet_length("content").cast("long")), F.lit(0))).first()[0]
    parts = max(1, -(-size // (PART_BYTES * buckets)))
    part = F.col("bucket") * parts + F.pmod(F.xxhash64("vector_id"), F.lit(parts)).cast("int")
    (count_words(vectors).withColumn("bucket", _bucket("word", buckets))
     .repartitionById(buckets * parts, part).sortWithinPartitions("bucket", "word")
     .write.option("compression", "zstd").partitionBy("bucket").parquet(f"{path}/postings"))
    postings = spark.read.parquet(f"{path}/postings")
    (postings.groupBy("bucket", "word").agg(F.count("*").alias("df"))
     .hint("rebalance", "bucket").sortWithinPartitions("bucket", "word")
     .write.partitionBy("bucket").parquet(f"{path}/words"))
    # Every word of every text is in exactly one posting's count.
    length = postings.agg(F.coalesce(F.sum("tf"), F.lit(0))).scalar()
    (vectors.agg(F.count("*").alias("n"))
     .select("n", F.try_divide(length.cast("double"), F.col("n")).alias("avgdl"), F.lit(buckets).alias("buckets"),
             F.lit(version).cast("long").alias("version"))
     .write.parquet(f"{path}/totals"))


def index_scores(spark: SparkSession, path: str, terms: list[str], tenant: str = DEFAULT_TENANT,
                 spec: Mapping[str, Any] | None = None, version: int | None = None) -> DataFrame:
    """``vector_id, score`` of one tenant's rows that hold a term; statistics are the whole table's."""
    totals = spark.read.parquet(f"{path}/totals").first()
    if totals["version"] != version:
        raise ValueError(f"the text index is of table version {totals['version']}, not {version}")
    terms = sorted(set(terms))
    if not terms or not totals["n"]:
        return spark.createDataFrame([], "vector_id string, score double")
    where = spark.range(1).select(F.array(*[_bucket(F.lit(t), totals["buckets"]) for t in terms])).first()[0]
    wanted = F.col("bucket").isin(*set(where)) & F.col("word").isin(*terms)
    # At most one row per word of the query.
    df = {r["word"]: r["df"] for r in spark.read.parquet(f"{path}/words").filter(wanted).collect()}
    if not df:
        return spark.createDataFrame([], "vector_id string, score double")
    n, avgdl = totals["n"], totals["avgdl"]
    idf = F.create_map(*[x for t, d in df.items() for x in (F.lit(t), F.lit(float(np.log(1 + (n - d + 0.5) / (d + 0.5)))))])
    hits = tenant_rows(spark.read.parquet(f"{path}/postings").filter(wanted), tenant, spec)
    weight = (F.element_at(idf, F.col("word")) * F.col("tf") * F.lit(K1 + 1)
              / (F.col("tf") + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * F.col("dl") / F.lit(avgdl))))
    return hits.groupBy("vector_id").agg(F.sum(weight).alias("score"))


def index_top(spark: SparkSession, path: str, text: str, n: int, tenant: str = DEFAULT_TENANT,
              spec: Mapping[str, Any] | None = None, version: int | None = None) -> DataFrame:
    """Best ``n`` rows for a text; equal to scoring the live text of the version asked for."""
    found = index_scores(spark, path, query_terms(spark, text), tenant, spec, version)
    return take_top(found.withColumn("score", F.round("score", 9)), n)
