"""Approximate top-K by product quantisation over coarse lists (Jegou, Douze, Schmid 2011).

A vector of length one belongs to the list of its nearest coarse centre. What is left of it is cut into parts, and each
part is stored as the number of its nearest entry in a codebook: a byte for a few components, so 64 floats take 16
bytes. A query reads the codes of the lists it probes; a row's approximate cosine is its list's share plus one table
lookup for each byte. The best ``keep`` rows of a query are fetched by id and scored exactly.

Centres and codebooks are fitted on a bounded sample (``FIT_ROWS``); every row is indexed. Exact search remains the
contract; this trades recall for bytes read, and ``report`` measures both.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kbvec.functions.topk import ROWS_PER_BLOCK, RunningTop, as_matrix, rows_matrix, strings, unit_rows
from kbvec.functions.vectors import cosine
from kbvec.operators.batch import BLOCK, best_per_query
from kbvec.session import broadcast_if_small, materialize

#: Rows that centres and codebooks are fitted on, at most about.
FIT_ROWS = 20_000
#: Entries of a codebook; components of a part; rows that a list holds on average, and lists at most.
ENTRIES, PART, LIST_ROWS, MOST_LISTS = 256, 4, 2_000, 4_096
#: Folders of the codes, in which lists are sorted.
FOLDERS = 64


def _means(rows: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Centres of k-means; an empty one takes the row that is worst served."""
    rng = np.random.default_rng(seed)
    centres = rows[rng.permutation(len(rows))[:k]].copy()
    for _ in range(rounds):
        near, off = _nearest(rows, centres)
        count = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        full = count > 0
        centres[full] = sums[full] / count[full, None]
        worst = np.argsort(-off)
        centres[~full] = rows[worst[:(~full).sum()]]
    return centres


def _nearest(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row, and how far off it is (squared, up to rounding)."""
    near, off = np.zeros(len(rows), np.int64), np.zeros(len(rows))
    size = np.einsum("ij,ij->i", centres, centres)
    for at in range(0, len(rows), ROWS_PER_BLOCK):
        part = rows[at:at + ROWS_PER_BLOCK]
        gap = size[None, :] - 2.0 * (part @ centres.T)
        near[at:at + len(part)] = gap.argmin(axis=1)
        off[at:at + len(part)] = gap.min(axis=1) + np.einsum("ij,ij->i", part, part)
    return near, off


@dataclass
class Quantiser:
    """Coarse centres (lists x dim) and, for each part of the components, a codebook (entries x its components)."""

    centres: np.ndarray
    books: list[np.ndarray]

    @property
    def cuts(self) -> list[slice]:
        ends = np.cumsum([b.shape[1] for b in self.books])
        return [slice(e - b.shape[1], e) for e, b in zip(ends, self.books)]

    @classmethod
    def fit(cls, sample: np.ndarray, rows: int, list_rows: int = LIST_ROWS, seed: int = 29) -> Quantiser:
        """From a sample of vectors, for a table of ``rows`` in lists of about ``list_rows``."""
        sample = unit_rows(sample)
        sample = sample[np.isfinite(sample).all(axis=1)]
        lists = int(max(1, min(MOST_LISTS, rows / list_rows, len(sample) / 32)))
        centres = _means(sample, lists, seed) if len(sample) else np.zeros((1, sample.shape[1]))
        rest = sample - centres[_nearest(sample, centres)[0]]
        dim = sample.shape[1]
        cuts = [slice(a, min(a + PART, dim)) for a in range(0, dim, PART)]
        return cls(centres, [_means(np.ascontiguousarray(rest[:, c]), min(ENTRIES, len(rest)), seed + 1 + i)
                             if len(rest) else np.zeros((1, c.stop - c.start)) for i, c in enumerate(cuts)])

    def encode(self, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """List and codes (one byte a part) of unit rows."""
        near, _ = _nearest(matrix, self.centres)
        rest = matrix - self.centres[near]
        return near, np.stack([_nearest(np.ascontiguousarray(rest[:, c]), b)[0] for c, b in zip(self.cuts, self.books)], 1).astype(np.uint8)

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """For each query and part, the share of each entry of the part's codebook (padded to ``ENTRIES``)."""
        out = np.zeros((len(queries), len(self.books), ENTRIES))
        for i, (c, book) in enumerate(zip(self.cuts, self.books)):
            out[:, i, :len(book)] = queries[:, c] @ book.T
        return out


def fit_sample(vectors: DataFrame, rows: int, most: int = FIT_ROWS) -> np.ndarray:
    """About ``most`` of ``rows`` vectors, by a hash of the id."""
    part = min(1.0, most / max(rows, 1))
    chosen = vectors.filter(F.pmod(F.xxhash64("vector_id", F.lit(13)), F.lit(1 << 20)) < F.lit(int(part * (1 << 20)) + 1))
    return rows_matrix(r[0] for r in chosen.select("embedding").orderBy("vector_id").toLocalIterator())


def build_index(vectors: DataFrame, path: str, most: int = FIT_ROWS, list_rows: int = LIST_ROWS) -> Quantiser:
    """Write codes by list, and each vector once, for the rows that have a direction; returns what queries need."""
    usable = vectors.filter(F.col("embedding").isNotNull() & F.exists("embedding", lambda x: x != 0)).select(
        "vector_id", "bot_id", "embedding")
    rows = usable.count()
    quantiser = Quantiser.fit(fit_sample(usable, rows, most), rows, list_rows) if rows else Quantiser(np.zeros((1, PART)), [np.zeros((1, PART))])
    sent = vectors.sparkSession.sparkContext.broadcast(quantiser)

    def encode(batches):
        for batch in (b for b in batches if b.num_rows):
            near, codes = sent.value.encode(unit_rows(as_matrix(batch.column("embedding"))))
            ends = np.arange(len(codes) + 1, dtype=np.int32) * np.int32(codes.shape[1])
            packed = pa.Array.from_buffers(pa.binary(), len(codes), [None, pa.py_buffer(ends), pa.py_buffer(codes.tobytes())])
            yield pa.RecordBatch.from_arrays([strings(batch.column("vector_id")), strings(batch.column("bot_id")),
                                              pa.array(near.astype(np.int32)), packed], names=["vector_id", "bot_id", "list", "codes"])

    (usable.mapInArrow(encode, "vector_id string, bot_id string, list int, codes binary")
     .withColumn("folder", F.col("list") % FOLDERS).hint("rebalance", "folder").sortWithinPartitions("folder", "list")
     .write.option("compression", "zstd").partitionBy("folder").parquet(f"{path}/codes"))
    usable.select("vector_id", "embedding").write.option("compression", "zstd").parquet(f"{path}/vectors")
    return quantiser


def search(path: str, queries: DataFrame, quantiser: Quantiser, k: int, probe: float = 0.5, keep: int = 20) -> DataFrame:
    """``query_id, vector_id, score, rank``: the best ``k`` by exact cosine of the ``keep * k`` best by codes.

    ``probe`` is the share of lists that a query reads. Queries (query_id, bot_id, embedding) are a bounded batch, at
    most ``BLOCK``; a query without a direction finds nothing.
    """
    spark = queries.sparkSession
    asked = queries.filter(F.col("embedding").isNotNull()).select(
        F.col("query_id").cast("string").alias("query_id"), "bot_id", "embedding").limit(BLOCK + 1).collect()
    if len(asked) > BLOCK:
        raise ValueError(f"at most {BLOCK} queries at a time")
    empty = spark.createDataFrame([], "query_id string, vector_id string, score double, rank int")
    if not asked:
        return empty
    matrix = unit_rows(rows_matrix(r["embedding"] for r in asked))
    some = np.flatnonzero(np.isfinite(matrix).all(axis=1))
    if not len(some):
        return empty
    asked, matrix = [asked[i] for i in some], matrix[some]
    of_list = matrix @ quantiser.centres.T
    probed = min(len(quantiser.centres), max(1, int(np.ceil(probe * len(quantiser.centres)))))
    reads = np.zeros(of_list.shape, bool)
    np.put_along_axis(reads, np.argsort(-of_list, axis=1, kind="stable")[:, :probed], True, axis=1)
    ids, tenants = [r["query_id"] for r in asked], np.array([r["bot_id"] for r in asked], dtype=object)
    sent = spark.sparkContext.broadcast((quantiser.tables(matrix), of_list, reads, ids, tenants))

    def scan(batches):
        tables, shares, reads, ids, tenants = sent.value
        top = RunningTop(len(ids), keep * k)
        part = np.arange(tables.shape[1])[None, :]
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_PER_BLOCK):
                rows = batch.slice(start, ROWS_PER_BLOCK)
                lists, owner = np.asarray(rows.column("list")), np.array(rows.column("bot_id").to_pylist(), dtype=object)
                codes = np.frombuffer(b"".join(rows.column("codes").to_pylist()), np.uint8).reshape(rows.num_rows, -1)
                names = strings(rows.column("vector_id"))
                for number in np.unique(lists):
                    for tenant in set(owner[lists == number]):
                        at = np.flatnonzero((lists == number) & (owner == tenant))
                        cols = np.flatnonzero(reads[:, number] & (tenants == tenant))
                        if len(cols):
                            found = np.stack([shares[q, number] + tables[q][part, codes[at]].sum(axis=1) for q in cols], 1)
                            top.add(found, names.take(pa.array(at)), cols)
        t = top.table
        yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in t["q"].to_pylist()], pa.string()),
                                          t["v"].combine_chunks(), t["s"].combine_chunks()], names=["query_id", "vector_id", "score"])

    wanted = np.flatnonzero(reads.any(axis=0))
    codes = spark.read.schema("vector_id string, bot_id string, list int, codes binary, folder int").parquet(f"{path}/codes").filter(
        F.col("folder").isin(sorted({int(i) % FOLDERS for i in wanted})) & F.col("list").isin([int(i) for i in wanted])
        & F.col("bot_id").isin([t for t in set(tenants) if t is not None]))
    first = codes.select("vector_id", "bot_id", "list", "codes").mapInArrow(scan, "query_id string, vector_id string, score double")
    candidates = materialize(best_per_query(first, keep * k).select("query_id", "vector_id"), "candidates")
    vectors = spark.read.parquet(f"{path}/vectors").join(broadcast_if_small(candidates), "vector_id")
    whole = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in zip(ids, matrix)], "query_id string, _q array<double>")
    scored = vectors.join(broadcast_if_small(whole), "query_id").select(
        "query_id", "vector_id", cosine(F.col("embedding"), F.col("_q")).alias("score"))
    return best_per_query(scored, k)


def read_bytes(quantiser: Quantiser, rows: int, k: int, probe: float = 0.5, keep: int = 20) -> dict[str, int]:
    """Bytes of vectors that a query reads of a table of ``rows``: codes of the lists probed and vectors scored again,
    beside those that an exact scan reads."""
    lists, dim = quantiser.centres.shape
    share = max(1, int(np.ceil(probe * lists))) / lists
    return {"codes": int(rows * share) * len(quantiser.books), "vectors": min(rows, keep * k) * dim * 4, "exact": rows * dim * 4}


def report(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: number of queries, mean and least recall of ``found`` against ``exact``."""
    hits = found.select("query_id", "vector_id", F.lit(1).alias("_hit"))
    each = exact.join(hits, ["query_id", "vector_id"], "left").groupBy("query_id").agg((F.count("_hit") / F.count("*")).alias("recall"))
    return each.agg(F.count("*").alias("queries"), F.avg("recall").alias("mean_recall"), F.min("recall").alias("least_recall"))
