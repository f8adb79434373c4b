"""Approximate nearest neighbours by adaptive dimension scans over probed lists.

Vectors are normalised and rotated by a fixed random rotation, so that every block of columns carries about its share
of a vector's length. Each goes to the list of its nearest centre; the centres are fitted on a bounded sample, all rows
are indexed. A query probes the lists of its nearest centres. Within a list the distances to all candidates grow by
blocks of columns; after each block a hypothesis test compares the partial distance, scaled up to all columns, with
the query's k-th best so far, and candidates that cannot be among the best (at the test's confidence) are left. The
survivors are scored on the original vectors in double precision.

Spark deals out the work: lists are cut into chunks of bounded size by a hash of the id, the queries of a list in
blocks of bounded size, and a task scans one chunk for one block at a time, so neither a heavily used list nor a
pile of equal vectors becomes one group. Equal vectors are indexed once, with their ids beside them: of any
number of equal candidates the k smallest ids (and the query's own) suffice for an exact answer.

Defined cases: vectors that are null, zero, of another dimension than most, or hold null or non-finite components take
no part; a repeated id counts once (the smallest vector in sort order); fewer candidates than k are all returned; ties
go to the smaller id; an empty table or no query gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kbvec.session import materialize

#: Rows of which centres are fitted; rows of a chunk and queries of a block, on average at most.
SAMPLE_ROWS, CHUNK_ROWS, QUERY_ROWS = 20_000, 16_384, 8_192
#: Queries that a task compares with its chunk at a time.
QUERIES_AT_ONCE = 64
#: Columns of a block, and standard errors that a partial distance must exceed the bound by to be abandoned.
COLUMNS, ERRORS = 8, 3.0
#: The share of all lists that a query probes.
PROBED = 0.85
OUT = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that take part; one row for each id."""
    rows = vectors.filter("vec_id is not null and embedding is not null").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    return rows.filter(F.size("embedding") > 0).filter(fine).filter(some).groupBy("vec_id").agg(
        F.min("embedding").alias("embedding"))


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def unit(x: np.ndarray) -> np.ndarray:
    # Scaled first: squares of very large or small components stay within range.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_centres(sample: np.ndarray, lists: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Spherical k-means of unit vectors."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), min(lists, len(sample)), replace=False)].copy()
    for _ in range(rounds):
        own = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        norm = np.sqrt((sums * sums).sum(axis=1))
        centres[norm > 1e-9] = sums[norm > 1e-9] / norm[norm > 1e-9, None]
    return centres


def matrix(column, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def scan(query: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) of unit rotated vectors that may be among a query's k nearest, by partial distances.

    The bound of a query is the k-th smallest distance to a first part of the rows. Under the hypothesis that a
    candidate lies within it, the partial distance scaled up to all columns exceeds it by an error that falls with
    the square root of the columns seen; candidates beyond ``ERRORS`` of those are abandoned.
    """
    n, dim = rows.shape
    first = min(n, max(16 * k, 256))
    near = 2.0 - 2.0 * query @ rows[:first].T
    limit = np.partition(near, k - 1, axis=1)[:, k - 1] if first >= k else np.full(len(query), np.inf)
    limit = np.maximum(limit, 0.0) + 1e-9
    at = min(2 * COLUMNS, dim)
    a, b = query[:, :at], rows[:, :at]
    partial = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * a @ b.T

    def bound(columns):
        return limit * (columns / dim * (1 + ERRORS / np.sqrt(columns)) if columns < dim else 1.0)

    of, to = np.nonzero(partial <= bound(at)[:, None])
    partial = partial[of, to]
    while at < dim:
        end = min(at + COLUMNS, dim)
        gap = np.ascontiguousarray(rows[:, at:end])[to] - query[of, at:end]
        partial += np.einsum("ij,ij->i", gap, gap)
        at = end
        keep = partial <= bound(at)[of]
        of, to, partial = of[keep], to[keep], partial[keep]
    order = np.lexsort((partial, of))
    of, to, partial = of[order], to[order], partial[order]
    count = np.bincount(of, minlength=len(query))
    start = np.cumsum(count) - count
    last = partial[np.minimum(start + k, start + count) - 1] if len(of) else np.zeros(len(query))
    keep = partial <= last[of] + 1e-9
    return of[keep], to[keep]


def _assign(centres, dim: int, probes: int):
    """List numbers of every row: the nearest, or the ``probes`` nearest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            near = unit(matrix(batch.column(batch.schema.get_field_index("embedding")), dim)) @ centres.value.T
            if probes < near.shape[1]:
                lists = np.argpartition(-near, probes - 1, axis=1)[:, :probes] if probes > 1 else near.argmax(axis=1)[:, None]
            else:
                lists = np.tile(np.arange(near.shape[1]), (len(near), 1))
            at = np.repeat(np.arange(len(near)), lists.shape[1])
            yield pa.RecordBatch.from_arrays(
                [*[c.take(pa.array(at)) for c in batch.columns], pa.array(lists.ravel().astype(np.int32))],
                names=[*batch.schema.names, "list"])
    return run


def _exact_scores(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosines in double precision of paired rows; each is summed alike wherever it stands."""
    q, x = (m / np.abs(m).max(axis=1, keepdims=True) for m in (query, rows))
    return (x * q).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((q * q).sum(axis=1)))


def _search_chunk(turn, dim: int, k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """left: queries (query_id, embedding); right: vectors (embedding, ids)."""
        out: list[list[np.ndarray]] = [[], [], []]
        if len(left) and len(right):
            raw, asked = matrix(right["embedding"], dim), matrix(left["embedding"], dim)
            lists = right["ids"].combine_chunks()
            first = np.asarray(lists.offsets, np.int64)
            ids = lists.values.to_numpy(zero_copy_only=False)
            query_ids = left["query_id"].to_numpy()
            rows = unit(raw) @ turn.value
            for at in range(0, len(asked), QUERIES_AT_ONCE):
                part = asked[at:at + QUERIES_AT_ONCE]
                # One more than k: the query itself may be among the best.
                of, to = scan(unit(part) @ turn.value, rows, k + 1)
                score = _exact_scores(part[of], raw[to])
                copies = first[to + 1] - first[to]
                which = np.repeat(np.arange(len(to)), copies)
                vec = ids[np.repeat(first[to] - np.cumsum(copies) + copies, copies) + np.arange(len(which))]
                of, score = query_ids[at + of[which]], score[which]
                other = vec != of
                of, vec, score = of[other], vec[other], score[other]
                order = np.lexsort((vec, -score, of))
                of, vec, score = of[order], vec[order], score[order]
                new = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.zeros(0, np.int64)
                place = np.arange(len(of)) - np.repeat(new, np.diff(np.r_[new, len(of)]))
                for have, add in zip(out, (of, vec, score)):
                    have.append(add[place < k])
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(np.concatenate(x) if x else [], t) for x, t in zip(out, kinds)],
                        names=["query_id", "vec_id", "score"])
    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, probed: float = PROBED) -> DataFrame:
    """query_id, rank, vec_id and score (cosine) of the k nearest found for every row of ``queries`` (vec_id,
    embedding), the query's own id left out."""
    spark: SparkSession = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = usable(vectors)
    sizes = rows.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("rows")).orderBy(
        F.desc("rows"), "dim").limit(1).collect()
    if not sizes:
        return empty
    dim, total = sizes[0]
    rows = materialize(rows.filter(F.size("embedding") == dim), "vectors")
    asked = usable(queries).filter(F.size("embedding") == dim).select(F.col("vec_id").alias("query_id"), "embedding")
    # Of equal vectors a query needs the k smallest ids besides its own: k + 1 of them are kept.
    rank = F.row_number().over(Window.partitionBy("embedding", "salt").orderBy("vec_id"))
    few = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(64))).withColumn("r", rank).filter(F.col("r") <= k + 1)
    distinct = few.groupBy("embedding").agg(F.slice(F.array_sort(F.collect_list("vec_id")), 1, k + 1).alias("ids"))

    share = min(1.0, SAMPLE_ROWS / total)
    sample = rows.filter(F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1_000_000)) < F.lit(int(share * 1_000_000) + 1))
    fitted = unit(np.array([r[0] for r in sample.select("embedding").limit(2 * SAMPLE_ROWS).collect()]
                           or [r[0] for r in rows.select("embedding").limit(100).collect()]))
    lists = max(1, min(1024, int(round(np.sqrt(total) / 4))))
    centres = fit_centres(fitted, lists)
    probes = max(1, int(np.ceil(probed * len(centres))))
    centres_all = spark.sparkContext.broadcast(centres)
    turn = spark.sparkContext.broadcast(rotation(dim))

    stored = "embedding array<double>, ids array<bigint>, list int"
    indexed = materialize(distinct.mapInArrow(_assign(centres_all, dim, 1), stored), "index")
    counts = indexed.groupBy("list").agg(F.ceil(F.count("*") / CHUNK_ROWS).cast("int").alias("chunks"))
    chunked = indexed.join(F.broadcast(counts), "list").withColumn(
        "chunk", F.pmod(F.xxhash64("ids"), F.col("chunks")).cast("int")).select("list", "chunk", "embedding", "ids")
    blocks = max(1, -(-asked.count() // QUERY_ROWS))
    chunked = chunked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    probing = asked.mapInArrow(_assign(centres_all, dim, probes), "query_id long, embedding array<double>, list int")
    routed = probing.join(F.broadcast(counts), "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
        F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block"), "query_id", "embedding")
    keys = ["list", "chunk", "block"]
    found = routed.groupBy(*keys).cogroup(chunked.groupBy(*keys)).applyInArrow(_search_chunk(turn, dim, k), OUT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int"), "vec_id", "score")
