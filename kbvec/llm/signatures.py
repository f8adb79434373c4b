r"""Ranked lexical search over bit-sliced Bloom signatures.

Documents of about one size form a block. A block has rows of bits, one bit for each document; a term of a document
sets that document's bit in eight rows picked by hashing. The bits of a term in all documents of a block are the *and*
of its rows: never too few, sometimes too many. A term that occurs tf times is entered once for every level of
``LEVELS`` up to tf, so the same rows bound how often it occurs.

1. One scan of the texts writes the blocks with the length of each document, and counts the documents of each query
   term (N, L and df).
2. Over the blocks, each query sums weight times the largest possible share of each term: an upper bound of every
   document's score. The documents with the highest bounds are scored exactly; their last exact score is a floor.
3. Over the blocks again, every document that is not provably behind that floor is found (its bound is above it, or
   equal with a smaller id), scored exactly from its text, and ranked.

Exact scores come from counts of the texts themselves; the signatures only exclude. Queries are taken in parts of a
bounded number, each with passes of its own.

Defined cases: null texts, and texts or items without a term, take no part; an item id with several rows asks for the
terms of all of them, once each; repeated rows and rows that share an id are documents each; a null doc_id ranks last
among equal scores; a null item_id is an item; empty tables give an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kbvec.llm.tables import text_batches
from kbvec.llm.textarrays import codes, mix, running, spans, stretch, text_pieces
from kbvec.session import broadcast_if_small, materialize

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SCALE, ONE, PER_LENGTH, BASE_LENGTH, LENGTH_PART = 1_000_000_000, 1_000, 20, 50, 50
#: Counts from which a term is entered once more.
LEVELS = np.array([1, 2, 3, 4, 5, 6, 8, 10, 13, 17, 24, 36, 60, 120, 300, 1000])
ROWS_PER_ENTRY, HASHES = 24, 8
#: Entries and documents of a block, at most (one document may have more entries).
BLOCK_ENTRIES, BLOCK_DOCS = 100_000, 1_024
#: Queries of one pass.
PART_ITEMS = 10_000

_CODES = codes(71)
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_STEP = 0x9E3779B97F4A7C15
_NULL = -(1 << 63)


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """row, hash and count of the distinct terms of a piece of texts, by row and hash."""
    starts, ends, rows = spans(_INSIDE[data], offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = stretch(running(_CODES[data]), starts, ends)
    order = np.lexsort((word, rows))
    rows, word = rows[order], word[order]
    first = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]) | (word[1:] != word[:-1])])
    return rows[first], word[first], np.diff(np.r_[first, len(rows)])


def _places(word: np.ndarray, level: int, rows: int) -> np.ndarray:
    """The rows of bits of a term's entry at a level."""
    keys = [np.uint64(((level + 1) * _STEP + k * 0xD1B54A32D192ED03) % (1 << 64)) for k in range(HASHES)]
    return np.stack([mix(word + key) % np.uint64(rows) for key in keys], 1).astype(np.int64)


def block(docs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[int, bytes]:
    """Number of rows of bits, and the rows, of the documents given as (hashes, counts)."""
    word = np.concatenate([d[0] for d in docs])
    count = np.concatenate([d[1] for d in docs])
    doc = np.repeat(np.arange(len(docs)), [len(d[0]) for d in docs])
    entries = np.bincount(doc, weights=np.searchsorted(LEVELS, count, "right"))
    rows = int(ROWS_PER_ENTRY * max(entries.max(), 1))
    bits = np.zeros((rows, len(docs)), bool)
    for level, least in enumerate(LEVELS):
        use = count >= least
        if not use.any():
            break
        places = _places(word[use], level, rows)
        bits[places, doc[use][:, None]] = True
    return rows, np.packbits(bits, axis=1, bitorder="little").tobytes()


_INDEX = "ids array<long>, lengths array<long>, rows int, bits binary, asked array<long>, dfs array<long>"


def _indexed(asked):
    """Blocks of a task's documents, and at its end how many of them hold each of the terms ``asked``."""
    def row(ids, lengths, rows, bits, terms_, dfs):
        return pa.RecordBatch.from_arrays(
            [pa.array([ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())), pa.array([rows], pa.int32()),
             pa.array([bits], pa.binary()), pa.array([terms_], pa.list_(pa.int64())), pa.array([dfs], pa.list_(pa.int64()))],
            names=["ids", "lengths", "rows", "bits", "asked", "dfs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = asked.value
        held = np.zeros(len(known), np.int64)
        open_blocks: dict[int, list] = {}

        def flush(kind):
            members = open_blocks.pop(kind)
            rows, bits = block([m[2] for m in members])
            return row([m[0] for m in members], [m[1] for m in members], rows, bits, [], [])

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at, data, offsets in text_pieces(batch):
                rows, word, count = terms(data, offsets)
                if len(known) and len(word):
                    place = np.minimum(np.searchsorted(known, word), len(known) - 1)
                    held += np.bincount(place[known[place] == word], minlength=len(known))
                bounds = np.searchsorted(rows, np.arange(len(offsets)))
                for r in np.flatnonzero(np.diff(bounds)):
                    a, b = bounds[r], bounds[r + 1]
                    # Members of a block differ in size by a quarter at most, so its rows fit all of them.
                    kind = int(math.log(b - a + 8) * 4)
                    members = open_blocks.setdefault(kind, [])
                    members.append((ids[at + r], int(count[a:b].sum()), (word[a:b].copy(), count[a:b].copy())))
                    if len(members) >= BLOCK_DOCS or len(members) * (b - a) >= BLOCK_ENTRIES:
                        yield flush(kind)
        for kind in list(open_blocks):
            yield flush(kind)
        some = np.flatnonzero(held)
        if len(some):
            yield row([], [], 0, b"", known[some].view(np.int64), held[some])
    return run


@dataclass
class Queries:
    """Items of one pass: their terms as places in ``known`` (sorted hashes), weights of these, N and L."""

    known: np.ndarray
    weight: np.ndarray
    items: list[np.ndarray]
    documents: int
    length: int
    #: Floor of each item, and the id up to which a document of that very score still counts.
    floor: np.ndarray | None = None
    last: np.ndarray | None = None

    def share(self, count: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """What a unit of weight scores in a document; exact in 64-bit integers."""
        m = 100 - BASE_LENGTH + (LENGTH_PART * lengths * self.documents) // self.length
        return (SCALE * count) // (ONE * count + PER_LENGTH * m)


def bounds(queries: Queries, lengths: np.ndarray, rows: int, bits: bytes) -> Iterator[np.ndarray]:
    """For each item, upper bounds of the scores of a block's documents."""
    n = len(lengths)
    slices = np.frombuffer(bits, np.uint8).reshape(rows, -1)
    # Scores stay below 2**53, so doubles add them without loss.
    shares = np.zeros((len(queries.known), n))
    alive, held = np.arange(len(queries.known)), None
    for level, least in enumerate(LEVELS):
        if least > lengths.max() or not len(alive):
            break
        entry = np.bitwise_and.reduce(slices[_places(queries.known[alive], level, rows)], axis=1)
        entry = entry if held is None else entry & held
        some = entry.any(axis=1)
        alive, held = alive[some], entry[some]
        most = np.minimum(lengths, LEVELS[level + 1] - 1) if level + 1 < len(LEVELS) else lengths
        flags = np.unpackbits(held, axis=1, count=n, bitorder="little").astype(bool)
        shares[alive] = np.where(flags, queries.share(most, lengths).astype(float)[None, :], shares[alive])
    for places in queries.items:
        yield queries.weight[places] @ shares[places]


def _order(ids: np.ndarray) -> np.ndarray:
    """Ids with null (the least number) behind all others."""
    return np.where(ids == _NULL, np.iinfo(np.int64).max, ids)


def _found(sent, k: int, first: bool):
    """Candidates of a task's blocks: the ``k`` highest bounds of each item (``first``), or all above the floors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = sent.value
        best = [(np.zeros(0, np.int64), np.zeros(0))] * len(queries.items)
        schema = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("bound", pa.float64())])

        def out(item, ids, bound):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), item, np.int32)), pa.array(ids, mask=ids == _NULL), pa.array(bound)], schema=schema)

        for batch in batches:
            for ids, lengths, rows, bits in zip(*(batch.column(i) for i in range(4))):
                if not len(ids):
                    continue
                ids = np.array([_NULL if i is None else i for i in ids.as_py()], np.int64)
                lengths = np.array(lengths.as_py(), np.int64)
                for item, bound in enumerate(bounds(queries, lengths, rows.as_py(), bits.as_py())):
                    if not first:
                        use = bound > queries.floor[item]
                        if queries.floor[item] > 0:
                            use |= (bound == queries.floor[item]) & (_order(ids) <= queries.last[item])
                        if use.any():
                            yield out(item, ids[use], bound[use])
                        continue
                    had_ids, had = best[item]
                    use = bound >= had.min() if len(had) == k else bound > 0
                    if use.any():
                        all_ids, all_bounds = np.r_[had_ids, ids[use]], np.r_[had, bound[use]]
                        top = np.lexsort((_order(all_ids), -all_bounds))[:k]
                        best[item] = all_ids[top], all_bounds[top]
        for item, (ids, bound) in enumerate(best):
            if len(ids):
                yield out(item, ids, bound)
    return run


def _scored(sent):
    """item, doc_id and exact score of each text for each of its ``items``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = sent.value
        for batch in batches:
            ids, wanted = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            items, docs, scores = [], [], []
            for at, data, offsets in text_pieces(batch):
                rows, word, count = terms(data, offsets)
                ends = np.searchsorted(rows, np.arange(len(offsets)))
                for r in np.flatnonzero(np.diff(ends)):
                    own, times = word[ends[r]:ends[r + 1]], count[ends[r]:ends[r + 1]]
                    share = queries.share(times, np.int64(times.sum()))
                    for item in wanted[at + r]:
                        places = queries.items[item]
                        to = np.minimum(np.searchsorted(own, queries.known[places]), len(own) - 1)
                        hit = own[to] == queries.known[places]
                        items.append(item)
                        docs.append(ids[at + r])
                        scores.append(int((queries.weight[places][hit].astype(np.int64) * share[to[hit]]).sum()))
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int32()), pa.array(docs, pa.int64()), pa.array(scores, pa.int64())],
                                             names=["item", "doc_id", "score"])
    return run


def _exact(texts: DataFrame, candidates: DataFrame, sent) -> DataFrame:
    """Exact scores above 0 of the candidates; every row of a candidate's id is scored."""
    wanted = candidates.select("item", F.col("doc_id").alias("id")).distinct().groupBy("id").agg(
        F.collect_list("item").alias("items"))
    wanted = broadcast_if_small(materialize(wanted, "candidates"), 500_000)
    joined = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["id"])).select("doc_id", "text", "items")
    return joined.mapInArrow(_scored(sent), "item int, doc_id long, score long").filter("score > 0")


def _ranked(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _hashes(values: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Item and hash of the terms of each item, through the same code as those of the texts."""
    batch = pa.RecordBatch.from_arrays([pa.array([" ".join(v) for v in values], pa.string())], names=["text"])
    found = [(at + rows, word) for at, data, offsets in text_pieces(batch) for rows, word, _ in [terms(data, offsets)]]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def search(docs: DataFrame, items: DataFrame, k: int = 50, part_items: int = PART_ITEMS) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents of every item."""
    spark = docs.sparkSession
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    asked = items.select("item_id", F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("term")).distinct().groupBy(
        "item_id").agg(F.sort_array(F.collect_list("term")).alias("terms"))
    asked = materialize(asked.withColumn("part", F.xxhash64("item_id")), "items")
    parts = max(1, math.ceil(asked.count() / part_items))
    results = None
    for part in range(parts):
        of_part = asked.filter(F.pmod("part", F.lit(parts)) == part).select("item_id", "terms")
        found = _search_part(docs, of_part, k)
        results = found if results is None else results.unionByName(found)
    return results if results is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


def _search_part(docs: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    spark = docs.sparkSession
    text_batches(spark)
    texts = docs.select("doc_id", "text")
    rows = asked.orderBy("item_id").collect()
    item, word = _hashes([r["terms"] for r in rows])
    known = np.unique(word)
    index = materialize(texts.mapInArrow(_indexed(spark.sparkContext.broadcast(known)), _INDEX), "index")
    blocks = index.select("ids", "lengths", "rows", "bits").filter("rows > 0")
    total = blocks.agg(F.sum(F.size("ids")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b))).first()
    df = index.select(F.explode(F.arrays_zip("asked", "dfs")).alias("z")).groupBy("z.asked").agg(F.sum("z.dfs").alias("df")).toArrow()
    held = np.zeros(len(known), np.int64)
    if df.num_rows:
        held[np.searchsorted(known, df["asked"].to_numpy().view(np.uint64))] = df["df"].to_numpy()
    # Terms that no document holds score nothing.
    n = total[0] or 0
    use = held > 0
    place = np.cumsum(use) - 1
    at = np.searchsorted(known, word)
    pairs = use[at]
    item, at = item[pairs], place[at[pairs]]
    of_item = [at[a:b] for a, b in zip(*(np.searchsorted(item, np.arange(len(rows)), s) for s in ("left", "right")))]
    weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in held[use]], float)
    queries = Queries(known[use], weight, of_item, n, total[1] or 1)
    sent = spark.sparkContext.broadcast(queries)
    schema = "item int, doc_id long, bound double"
    top = Window.partitionBy("item").orderBy(F.desc("bound"), F.col("doc_id").asc_nulls_last())
    first = blocks.mapInArrow(_found(sent, k, True), schema).withColumn("r", F.row_number().over(top)).filter(F.col("r") <= k)
    scored = materialize(_ranked(_exact(texts, first, sent), k), "first")
    queries.floor, queries.last = np.zeros(len(rows)), np.full(len(rows), np.iinfo(np.int64).max)
    # One row for each item of this pass.
    for r in scored.filter(F.col("rank") == k).collect():
        queries.floor[r["item"]] = r["score"]
        queries.last[r["item"]] = np.iinfo(np.int64).max if r["doc_id"] is None else r["doc_id"]
    sent = spark.sparkContext.broadcast(queries)
    last = blocks.mapInArrow(_found(sent, k, False), schema)
    best = _ranked(_exact(texts, last, sent), k)
    numbered = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], "item int, item_id long")
    return best.join(F.broadcast(numbered), "item").select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
