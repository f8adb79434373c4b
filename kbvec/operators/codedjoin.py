"""Exact top-K joins that ship int8 codes and fetch the floats of the pairs that remain.

A vector is stored as bytes with a scale of its own, and with the length of what the rounding took away. By the
inequality of Cauchy and Schwarz that length bounds the score of a pair from both sides. Tasks compare chunks of codes
and keep, for a query, the pairs whose upper bound reaches its k-th largest lower bound; only those meet their floats.
Codes are a quarter of packed floats, so a chunk of the same bytes holds four times the rows and each side is copied to a
quarter of the chunks. A self join visits each unordered pair of chunks once. Chunks grow up to ``CODE_BYTES`` before a
tenant has more than ``MOST_CHUNKS``, so codes and open pairs shuffled for a row do not grow with the table until its codes
fill these. Classes go by short numbers and bounds in single precision, rounded outwards.

Equal vectors of a tenant are one class: the join runs over classes, and a class stands for its k smallest ids. A query
whose bounds leave more than ``crowded`` pairs within one pair of chunks (vectors closer together than their rounding) is
answered by ``knn_join``, so no task emits more than a bounded number of rows for a query.

Rows without an id, embedding or (as a row) tenant, with a component that is null or not finite and, for cosine, of length
zero take no part; repeated rows count as often as they stand there; an empty side gives no rows; further columns of
any name are left aside. All vectors of a join have one dimension.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kbvec.functions.topk import as_matrix, strings
from kbvec.operators.batch import (CHUNK_BYTES, _asked, _candidates, _compact, _prepared, best_per_query, chunk_count,
                                   knn_join)
from kbvec.session import broadcast_if_small, materialize

#: Vectors of either side that are multiplied at a time.
BLOCK_ROWS = 1024
#: Chunks of a tenant's codes, at most, while they stay within so many bytes: a code is copied, and a query has pairs, once
#: for each chunk of the other side.
MOST_CHUNKS, CODE_BYTES = 4, 8 * 1024 * 1024
#: Pairs of one query that a task may keep, for each row asked for; beyond it the query goes through ``knn_join``.
CROWDED = 32
#: Added to every bound: scores that differ by less count as ties, and products are rounded.
MARGIN = 2e-9

CODED = "bot_id string, class string, code binary, scale double, size double, lost double"
BOUNDED = "bot_id string, q string, v string, low float, high float"


def _finite(df: DataFrame) -> DataFrame:
    kind = df.schema["embedding"].dataType
    if not isinstance(kind, T.ArrayType):
        return df
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return df.filter(~odd & (F.size("embedding") > 0))


def _members(df: DataFrame, name: str) -> DataFrame:
    """id, tenant, embedding and class; vectors that are equal bit by bit are one class of their tenant."""
    key = F.concat(F.hex(F.xxhash64("embedding")), F.lit("-"), F.hex(F.xxhash64(F.lit(1), F.col("embedding"))))
    rows = _compact(_finite(df)).filter(F.col("id").isNotNull())
    return materialize(rows.select("id", "bot_id", "embedding", key.alias("class")), name)


def _classes(members: DataFrame, name: str) -> DataFrame:
    return materialize(members.groupBy("bot_id", "class").agg(F.any_value("embedding").alias("embedding")), name)


def _numbered(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Members and classes, with short numbers for the classes: pairs of them are most of what is shuffled."""
    members = _members(df, name)
    classes = materialize(_classes(members, f"{name}-classes").withColumn(
        "number", F.monotonically_increasing_id().cast("string")), f"{name}-numbered")
    known = broadcast_if_small(classes.select("bot_id", "class", "number"))
    return (materialize(members.join(known, ["bot_id", "class"]).drop("class").withColumnRenamed("number", "class"), name),
            classes.drop("class").withColumnRenamed("number", "class"))


def _encode(classes: DataFrame, metric: str) -> DataFrame:
    """Codes, their scale, the length of the coded vector and of what it lost."""
    def code(batches):
        for batch in (b for b in batches if b.num_rows):
            with np.errstate(invalid="ignore", over="ignore"):
                rows = _prepared(as_matrix(batch.column("embedding")), metric)
                usable = np.isfinite(rows).all(axis=1) & np.isfinite(np.einsum("ij,ij->i", rows, rows))
            rows = rows[usable]
            scale = np.abs(rows).max(axis=1, initial=0.0) / 127.0
            scale[scale == 0.0] = 1.0
            codes = np.rint(rows / scale[:, None]).astype(np.int8)
            back = codes * scale[:, None]
            keep = batch.filter(pa.array(usable))
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.shape[1])
            packed = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(codes.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [strings(keep.column("bot_id")), strings(keep.column("class")), packed, pa.array(scale),
                 pa.array(np.linalg.norm(back, axis=1)), pa.array(np.linalg.norm(rows - back, axis=1))],
                names=["bot_id", "class", "code", "scale", "size", "lost"])

    return classes.mapInArrow(code, CODED)


class _Codes:
    """One side of a task."""

    def __init__(self, table: pa.Table):
        self.names = strings(table["class"])
        codes = b"".join(table["code"].to_pylist())
        self.codes = np.frombuffer(codes, dtype=np.int8).reshape(table.num_rows, -1) if table.num_rows else np.zeros((0, 1), np.int8)
        self.scale, self.size, self.lost = (table[c].to_numpy() for c in ("scale", "size", "lost"))

    def blocks(self) -> list[slice]:
        return [slice(at, at + BLOCK_ROWS) for at in range(0, len(self.names), BLOCK_ROWS)]


def _bounds(a: _Codes, i: slice, b: _Codes, j: slice, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of every pair of two blocks."""
    # Sums of up to 1,040 products of bytes are exact in single precision.
    kind = np.float32 if a.codes.shape[1] * 127 * 127 < 2 ** 24 else np.float64
    product = (a.codes[i].astype(kind) @ b.codes[j].astype(kind).T).astype(np.float64)
    product *= a.scale[i][:, None] * b.scale[j][None, :]
    sizes = np.outer(a.size[i], b.size[j])
    if metric == "l2sq":
        squares = (a.size[i] ** 2)[:, None] + (b.size[j] ** 2)[None, :]
        # The expanded square is exact up to rounding, which its root magnifies close to zero.
        slip = squares * 1e-13
        gap = squares - 2.0 * product
        far, near = np.sqrt(np.maximum(gap + slip, 0.0)), np.sqrt(np.maximum(gap - slip, 0.0))
        lost = a.lost[i][:, None] + b.lost[j][None, :] + MARGIN + np.sqrt(squares) * 1e-12
        return -far - lost, -near + lost
    lost = (np.outer(a.size[i], b.lost[j]) + np.outer(a.lost[i], b.size[j]) + np.outer(a.lost[i], b.lost[j])
            + MARGIN + sizes * 1e-12)
    return product - lost, product + lost


def _single(x: np.ndarray, to: float) -> np.ndarray:
    """Single precision, rounded towards ``to``."""
    with np.errstate(over="ignore"):
        y = x.astype(np.float32)
        return np.where((y < x) if to > 0 else (y > x), np.nextafter(y, np.float32(to)), y)


class _Survivors:
    """Pairs of a block of queries that the bounds leave open, over a sequence of blocks of rows."""

    def __init__(self, n: int, k: int, most: int):
        self.k, self.most = k, most
        self.floor, self.crowded = np.full(n, -np.inf), np.zeros(n, bool)
        self.q, self.v = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.low, self.high = np.zeros(0), np.zeros(0)

    def add(self, low: np.ndarray, high: np.ndarray, start: int) -> None:
        n = low.shape[1]
        if n >= self.k:
            self.floor = np.maximum(self.floor, np.partition(low, n - self.k, axis=1)[:, n - self.k])
        q, v = np.nonzero((high >= self.floor[:, None]) & ~self.crowded[:, None])
        self.q, self.v = np.r_[self.q, q], np.r_[self.v, v + start]
        self.low, self.high = np.r_[self.low, low[q, v]], np.r_[self.high, high[q, v]]
        order = np.lexsort((-self.low, self.q))
        own = self.q[order]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else own
        full = first[np.diff(np.r_[first, len(own)]) >= self.k]
        self.floor[own[full]] = np.maximum(self.floor[own[full]], self.low[order][full + self.k - 1])
        self._keep(self.high >= self.floor[self.q])
        self.crowded |= np.bincount(self.q, minlength=len(self.floor)) > self.most
        self._keep(~self.crowded[self.q])

    def _keep(self, mask: np.ndarray) -> None:
        self.q, self.v, self.low, self.high = self.q[mask], self.v[mask], self.low[mask], self.high[mask]

    def table(self, tenant: str, queries: pa.Array, rows: pa.Array) -> pa.Table:
        """The pairs left; a crowded query is one row without a partner."""
        lost = np.flatnonzero(self.crowded)
        q = queries.take(pa.array(np.r_[self.q, lost]))
        v = pa.concat_arrays([rows.take(pa.array(self.v)), pa.nulls(len(lost), pa.string())])
        none = np.zeros(len(lost), np.float32)
        return pa.table([pa.array([tenant] * len(q), pa.string()), q, v, pa.array(np.r_[_single(self.low, -np.inf), none]),
                         pa.array(np.r_[_single(self.high, np.inf), none])], names=["bot_id", "q", "v", "low", "high"])


def _none() -> pa.Table:
    return pa.table({c: pa.array([], pa.float32() if c in ("low", "high") else pa.string())
                     for c in ("bot_id", "q", "v", "low", "high")})


def _one_width(*sides: _Codes) -> None:
    if len({s.codes.shape[1] for s in sides if len(s.names)}) > 1:
        raise ValueError("embeddings of different dimensions in one join")


def _parts(coded: DataFrame, chunk_bytes: int, name: str) -> DataFrame:
    """Per tenant, into how many chunks its codes go."""
    size = F.sum(F.octet_length("code").cast("long"))
    return coded.groupBy("bot_id").agg(chunk_count(size, chunk_bytes, MOST_CHUNKS, CODE_BYTES).alias(name))


def _chunk(of: str):
    return F.pmod(F.xxhash64("class"), F.col(of)).cast("int")


def _two_sided(rows: DataFrame, asked: DataFrame, k: int, metric: str, chunk_bytes: int, most: int) -> DataFrame:
    plan = broadcast_if_small(materialize(
        _parts(rows, chunk_bytes, "v_parts").join(_parts(asked, chunk_bytes, "q_parts"), "bot_id"), "coded-plan"))

    def keyed(df, own, other):
        return (df.join(plan, "bot_id").withColumn(own[0], _chunk(own))
                .withColumn(other[0], F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("v_parts", "q_parts"))

    def compare(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        q, v, parts = _Codes(left), _Codes(right), [_none()]
        _one_width(q, v)
        for i in q.blocks():
            open_pairs = _Survivors(len(q.names[i]), k, most)
            for j in v.blocks():
                open_pairs.add(*_bounds(q, i, v, j, metric), j.start)
            parts.append(open_pairs.table(key[0].as_py(), q.names[i], v.names))
        return pa.concat_tables(parts)

    keys = ["bot_id", "q", "v"]
    left, right = keyed(asked, "q_parts", "v_parts"), keyed(rows, "v_parts", "q_parts")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, BOUNDED)


def _one_sided(rows: DataFrame, k: int, metric: str, chunk_bytes: int, most: int) -> DataFrame:
    """Each unordered pair of chunks once: the chunks of a pair answer each other."""
    plan = broadcast_if_small(materialize(_parts(rows, chunk_bytes, "parts"), "coded-plan"))
    keyed = (rows.join(plan, "bot_id").withColumn("own", _chunk("parts"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .withColumn("a", F.least("own", "other")).withColumn("b", F.greatest("own", "other"))
             .drop("parts", "other"))

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        tenant, first, second = (x.as_py() for x in key)
        own = table["own"].to_numpy()
        a = _Codes(table.filter(pa.array(own == first)))
        b = a if first == second else _Codes(table.filter(pa.array(own == second)))
        _one_width(a, b)
        parts, waiting = [_none()], [_Survivors(len(b.names[j]), k, most) for j in b.blocks()]
        for i in a.blocks():
            left = _Survivors(len(a.names[i]), k, most)
            for j, right in zip(b.blocks(), waiting):
                low, high = _bounds(a, i, b, j, metric)
                left.add(low, high, j.start)
                if b is not a:
                    right.add(low.T, high.T, i.start)
            parts.append(left.table(tenant, a.names[i], b.names))
        if b is not a:
            parts += [s.table(tenant, b.names[j], a.names) for j, s in zip(b.blocks(), waiting)]
        return pa.concat_tables(parts)

    return keyed.groupBy("bot_id", "a", "b").applyInArrow(compare, BOUNDED)


def _still_open(bounded: DataFrame, k: int) -> DataFrame:
    """The pairs that can be among the best ``k`` of their query over all chunks."""
    w = Window.partitionBy("bot_id", "q").orderBy(F.col("low").desc()).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    # Null where a query has fewer pairs.
    pairs = bounded.filter(F.col("v").isNotNull()).withColumn("floor", F.nth_value("low", k).over(w))
    return pairs.filter(F.col("floor").isNull() | (F.col("high") >= F.col("floor"))).select("bot_id", "q", "v")


def _exact(pairs: DataFrame, rows: DataFrame, asked: DataFrame, metric: str) -> DataFrame:
    """Pairs with the score of their floats."""
    def score(batches):
        for batch in (b for b in batches if b.num_rows):
            v, q = (_prepared(as_matrix(batch.column(c)), metric) for c in ("v_vector", "q_vector"))
            s = 0.0 - np.linalg.norm(v - q, axis=1) if metric == "l2sq" else np.einsum("ij,ij->i", v, q)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("bot_id", "q", "v")], pa.array(s)],
                                             names=["bot_id", "q", "v", "score"])

    def side(df, name):
        return df.select("bot_id", F.col("class").alias(name), F.col("embedding").alias(f"{name}_vector"))
    met = pairs.join(side(rows, "v"), ["bot_id", "v"]).join(side(asked, "q"), ["bot_id", "q"])
    return met.select("bot_id", "q", "v", "v_vector", "q_vector").mapInArrow(
        score, "bot_id string, q string, v string, score double")


def _answers(scores: DataFrame, row_ids: DataFrame, query_ids: DataFrame, k: int) -> DataFrame:
    """From classes to rows: the smallest ids of a class stand for it, and equal queries share an answer."""
    w = Window.partitionBy("bot_id", "class").orderBy("id")
    few = row_ids.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= k).select(
        "bot_id", F.col("class").alias("v"), F.col("id").alias("vector_id"))
    one = F.struct("bot_id", "q").alias("query_id")
    best = best_per_query(scores.join(few, ["bot_id", "v"]).select(one, "vector_id", "score"), k)
    best = best.select("query_id.bot_id", F.col("query_id.q").alias("class"), "vector_id", "score", "rank")
    return query_ids.select("bot_id", "class", F.col("id").alias("query_id")).join(best, ["bot_id", "class"]).select(
        "query_id", "vector_id", "score", "rank")


def _joined(bounded: DataFrame, codes: DataFrame, rows: DataFrame, asked: DataFrame, row_ids: DataFrame,
            query_ids: DataFrame, k: int, metric: str) -> DataFrame:
    bounded = materialize(bounded, "coded-pairs")
    crowd = materialize(bounded.filter(F.col("v").isNull()).select("bot_id", F.col("q").alias("class")).distinct(), "coded-crowd")
    if crowd.isEmpty():
        return _answers(_exact(_still_open(bounded, k), rows, asked, metric), row_ids, query_ids, k)
    crowd = broadcast_if_small(crowd)
    open_pairs = _still_open(bounded, k).join(crowd.withColumnRenamed("class", "q"), ["bot_id", "q"], "left_anti")
    answers = _answers(_exact(open_pairs, rows, asked, metric), row_ids, query_ids, k)
    # Equal queries are asked once here too.
    again = asked.join(crowd, ["bot_id", "class"], "left_semi").select(
        F.concat_ws(" ", "class", "bot_id").alias("query_id"), "bot_id", "embedding")
    usable = row_ids.withColumnRenamed("id", "vector_id").join(codes.select("bot_id", "class"), ["bot_id", "class"], "left_semi")
    found = knn_join(usable, again, k, metric).withColumnRenamed("query_id", "of")
    owners = query_ids.select(F.col("id").alias("query_id"), F.concat_ws(" ", "class", "bot_id").alias("of"))
    return answers.unionByName(owners.join(found, "of").select("query_id", "vector_id", "score", "rank"))


def coded_join(vectors: DataFrame, queries: DataFrame, k: int, metric: str = "cosine",
               spec: Mapping[str, Any] | None = None, chunk_bytes: int = CHUNK_BYTES, crowded: int = CROWDED) -> DataFrame:
    """``query_id, vector_id, score, rank``: exact top ``k`` of each query's tenant, as ``knn_join`` gives them."""
    row_ids, rows = _numbered(_candidates(vectors, metric, spec, False).withColumnRenamed("vector_id", "id"), "coded-rows")
    query_ids, asked = _numbered(_asked(queries).withColumnRenamed("query_id", "id"), "coded-queries")
    codes = [materialize(_encode(df, metric), "codes") for df in (rows, asked)]
    return _joined(_two_sided(*codes, k, metric, chunk_bytes, crowded * k), codes[0], rows, asked, row_ids, query_ids, k,
                   metric)


def coded_self_join(vectors: DataFrame, k: int, metric: str = "cosine", chunk_bytes: int = CHUNK_BYTES,
                    crowded: int = CROWDED) -> DataFrame:
    """``query_id, vector_id, score, rank``: every row against its tenant, itself included."""
    ids, rows = _numbered(_candidates(vectors, metric, None, False).withColumnRenamed("vector_id", "id"), "coded-rows")
    codes = materialize(_encode(rows, metric), "codes")
    return _joined(_one_sided(codes, k, metric, chunk_bytes, crowded * k), codes, rows, rows, ids, ids, k, metric)
