"""BM25 over live text: one query as Column expressions, many queries over counts written once.

Term weight ``idf * tf (k1+1) / (tf + k1 (1 - b + b dl/avgdl))`` (Robertson and Zaragoza 2009) with
``idf = ln(1 + (N - df + 0.5) / (df + 0.5))``. Statistics are taken over the whole table, as one text
index does, whatever filter the search applies. Texts are tokenised whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kbvec.functions.text import words
from kbvec.functions.topk import RunningTop, strings
from kbvec.operators.batch import best_per_query
from kbvec.operators.filters import compile_filter
from kbvec.operators.search import take_top
from kbvec.session import broadcast_if_small, materialize, scratch_path

# BM25 parameters.
K1, B = 1.2, 0.75
#: Queries that one scan answers; documents that a task scores at a time.
BLOCK, DOCS_PER_BLOCK = 1024, 512
SCORED = "query_id string, vector_id string, score double"


def leg_size(k: int) -> int:
    """Rows each leg of a hybrid search contributes."""
    return max(k * 4, 50)


def _frequency(tokens: str, term: str):
    return F.size(tokens) - F.size(F.array_remove(tokens, term))


def bm25_scores(corpus: DataFrame, terms: Sequence[str], rows: DataFrame | None = None) -> DataFrame:
    """``rows`` (default: all of ``corpus``) with their score, null where no term occurs.

    Both passes tokenise in place: no token is shuffled, and the statistics are one row read back
    through a scalar subquery. Rows without a hit are not filtered here, as a filter would be pushed
    below the projections and tokenise every text again.
    """
    terms = sorted(set(terms))
    rows = corpus if rows is None else rows
    if not terms:
        return rows.limit(0).withColumn("score", F.lit(0.0))
    tokens = corpus.select(words(F.col("content")).alias("w"))
    stats = tokens.agg(F.struct(
        F.count("*").alias("n"), F.avg(F.size("w")).alias("avgdl"),
        *[F.coalesce(F.sum(F.array_contains("w", t).cast("long")), F.lit(0)).alias(f"df{i}")
          for i, t in enumerate(terms)]).alias("s")).scalar()

    counted = rows.withColumn("_w", words(F.col("content"))).select(
        *rows.columns, F.size("_w").alias("_dl"),
        *[_frequency("_w", t).alias(f"_tf{i}") for i, t in enumerate(terms)])
    scored = counted.withColumn("_s", stats)
    length = F.lit(1 - B) + F.lit(B) * F.col("_dl") / F.col("_s.avgdl")
    hit, parts = [], []
    for i in range(len(terms)):
        df, tf = F.col(f"_s.df{i}"), F.col(f"_tf{i}")
        idf = F.log(F.lit(1.0) + (F.col("_s.n") - df + F.lit(0.5)) / (df + F.lit(0.5)))
        parts.append(idf * tf * F.lit(K1 + 1) / (tf + F.lit(K1) * length))
        hit.append(tf)
    score = F.when(reduce(add, hit) > 0, reduce(add, parts))
    return scored.select(*rows.columns, score.alias("score"))


def query_terms(spark, text: str) -> list[str]:
    """Distinct words of a query, cut by the same expression as the documents."""
    row = spark.range(1).select(F.array_distinct(words(F.lit(text))).alias("w")).first()
    return list(row["w"])


def bm25_top(corpus: DataFrame, text: str, n: int, rows: DataFrame | None = None) -> DataFrame:
    return take_top(bm25_scores(corpus, query_terms(corpus.sparkSession, text), rows), n)


# --- many queries ------------------------------------------------------------------------------

STAGED = "vector_id string, bot_id string, asked boolean, dl int, terms array<long>, tfs array<int>"


def _stage(corpus: DataFrame, spec: Mapping[str, Any] | None) -> DataFrame:
    """Length and counts of all words (64-bit hashes, in order) per document; whether it passes the filter."""
    predicate, _ = compile_filter(spec)

    def count(batches):
        for batch in batches:
            w = batch.column("w")
            lengths = np.asarray(pc.list_value_length(w), dtype=np.int64)
            doc, word = np.repeat(np.arange(len(w)), lengths), np.asarray(w.flatten(), dtype=np.int64)
            order = np.lexsort((word, doc))
            doc, word = doc[order], word[order]
            first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (word[1:] != word[:-1])]) if len(doc) else doc
            tf = np.diff(np.r_[first, len(doc)])
            offsets = np.searchsorted(doc[first], np.arange(len(w) + 1)).astype(np.int32)

            def lists(values, kind):
                return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("vector_id", "bot_id", "asked")], pa.array(lengths.astype(np.int32)),
                 lists(word[first], pa.int64()), lists(tf, pa.int32())],
                names=["vector_id", "bot_id", "asked", "dl", "terms", "tfs"])

    tenant = F.col("bot_id") if "bot_id" in corpus.columns else F.lit(None)
    return corpus.select(
        F.col("vector_id").cast("string").alias("vector_id"), tenant.cast("string").alias("bot_id"),
        F.coalesce(F.lit(True) if predicate is None else predicate, F.lit(False)).alias("asked"),
        F.transform(words(F.col("content")), lambda w: F.xxhash64(w)).alias("w")).mapInArrow(count, STAGED)


def _document_counts(staged: DataFrame) -> DataFrame:
    """In how many documents each word occurs; counted inside the tasks first."""
    def count(batches):
        for batch in batches:
            term, n = np.unique(np.asarray(batch.column(0).flatten(), dtype=np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(n)], names=["term", "df"])

    return staged.select("terms").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def _score_block(staged: DataFrame, queries: list, n: int, avgdl: float, n_top: int) -> DataFrame:
    """Best documents for a block of queries; weights are held per (word, query), not for all pairs of them."""
    ids = [str(r["query_id"]) for r in queries]
    owner = np.array([r["bot_id"] for r in queries], dtype=object)
    pairs = np.array([(t["term"], t["df"], j) for j, r in enumerate(queries) for t in r["terms"]], dtype=np.int64)
    pairs = pairs[np.lexsort((pairs[:, 2], pairs[:, 0]))]
    terms, first, holders = np.unique(pairs[:, 0], return_index=True, return_counts=True)
    df, query = pairs[first, 1], pairs[:, 2]
    idf = np.log(1.0 + (n - df + 0.5) / (df + 0.5))

    def local_top(batches):
        top = RunningTop(len(ids), n_top)
        for batch in batches:
            for start in range(0, batch.num_rows, DOCS_PER_BLOCK):
                part = batch.slice(start, DOCS_PER_BLOCK)
                listed = part.column("terms")
                doc = np.repeat(np.arange(len(part)), np.asarray(pc.list_value_length(listed)))
                word = np.asarray(listed.flatten(), dtype=np.int64)
                at = np.minimum(np.searchsorted(terms, word), len(terms) - 1)
                known = np.flatnonzero(terms[at] == word)
                doc, at = doc[known], at[known]
                tf = np.asarray(part.column("tfs").flatten(), dtype=np.float64)[known]
                norm = K1 * (1 - B + B * np.asarray(part.column("dl")) / avgdl)
                weight = idf[at] * tf * (K1 + 1) / (tf + norm[doc])
                times = holders[at]
                asker = query[np.repeat(first[at] - np.cumsum(times) + times, times) + np.arange(times.sum())]
                scores = np.bincount(np.repeat(doc, times) * len(ids) + asker, weights=np.repeat(weight, times),
                                     minlength=len(part) * len(ids)).reshape(len(part), len(ids))
                fits = np.asarray(part.column("asked"))[:, None] & (scores > 0)
                tenant = np.array(part.column("bot_id").to_pylist(), dtype=object)
                fits &= (owner == None)[None, :] | (tenant[:, None] == owner[None, :])  # noqa: E711
                top.add(np.where(fits, scores, np.nan), strings(part.column("vector_id")))
        t = top.table
        yield pa.RecordBatch.from_arrays(
            [pa.array([ids[i] for i in t["q"].to_pylist()], pa.string()), t["v"].combine_chunks(), t["s"].combine_chunks()],
            names=["query_id", "vector_id", "score"])

    return best_per_query(staged.mapInArrow(local_top, SCORED), n_top)


def bm25_batch(corpus: DataFrame, queries: DataFrame, n_top: int, block: int = BLOCK,
               spec: Mapping[str, Any] | None = None) -> DataFrame:
    """``query_id, vector_id, score, rank`` for ``queries(query_id, query_text)``.

    Texts are tokenised and counted once, whole, for all queries; statistics are those of the whole corpus. Queries
    with a ``bot_id`` are answered from that tenant's rows, all from rows that pass ``spec``. The counts are scanned
    once for each block of queries, and each task keeps ``n_top`` rows per query.
    """
    spark = corpus.sparkSession
    tenant = F.col("bot_id") if "bot_id" in queries.columns else F.lit(None)
    each = queries.select(F.col("query_id").cast("string").alias("query_id"), tenant.cast("string").alias("bot_id"),
                          F.explode(F.array_distinct(words(F.col("query_text")))).alias("word"))
    each = materialize(each.select("query_id", "bot_id", F.xxhash64("word").alias("term")), "bm25-queries")
    staged = materialize(_stage(corpus, spec), "bm25-counts")
    total = staged.agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl")).first()
    known = _document_counts(staged).join(broadcast_if_small(each.select("term").distinct()), "term")
    asked = materialize(each.join(known, "term").groupBy("query_id", "bot_id").agg(
        F.collect_list(F.struct("term", "df")).alias("terms")), "bm25-asked")
    n_blocks = -(-asked.count() // block)
    path = scratch_path(spark, "bm25")
    for b in range(n_blocks):
        # A block of queries is bounded; the hash may put a few more than ``block`` into one.
        part = asked.filter(F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)) == b).collect()
        if part:
            found = _score_block(staged, part, total["n"], total["avgdl"] or 1.0, n_top)
            if n_blocks == 1:
                return found
            found.write.mode("append").parquet(path)
    if not n_blocks:
        return spark.createDataFrame([], SCORED + ", rank int")
    return spark.read.schema(SCORED + ", rank int").parquet(path)
