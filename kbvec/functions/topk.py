"""Numpy/Arrow helpers used inside tasks: block scores and a running top-k per query."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Scores equal to this many digits count as ties, so that copies of a row tie whatever lane of the
# matrix product computed them. The scores themselves are kept as they are.
TIE_DIGITS = 9
ROWS_PER_BLOCK = 2048


def as_matrix(column) -> np.ndarray:
    """An Arrow column of equally long lists, or of packed float32 bytes, as a float64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        width = np.int32 if pa.types.is_binary(column.type) else np.int64
        _, offsets, data = column.buffers()
        ends = np.frombuffer(offsets, dtype=width)[column.offset:column.offset + len(column) + 1]
        _one_width(np.diff(ends) // 4)
        flat = np.frombuffer(data, dtype="<f4", offset=int(ends[0]), count=int(ends[-1] - ends[0]) // 4)
        return flat.astype(np.float64).reshape(len(column), -1)
    if column.null_count:
        raise ValueError("embeddings must not be null here")
    _one_width(np.asarray(pc.list_value_length(column)))
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1)


def _one_width(widths: np.ndarray) -> None:
    if (widths != widths[0]).any():
        raise ValueError(f"embeddings of {widths.min()} to {widths.max()} components in one table")


def rows_matrix(values) -> np.ndarray:
    """Collected embeddings, as lists or as packed bytes, as a float64 matrix."""
    return np.array([np.frombuffer(bytes(v), dtype="<f4") if isinstance(v, (bytes, bytearray)) else v
                     for v in values], dtype=np.float64)


def as_bytes(column) -> pa.Array:
    """The packed form of an Arrow list column."""
    rows = as_matrix(column).astype("<f4")
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.shape[1] * 4)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())])


def as_lists(matrix: np.ndarray) -> pa.ListArray:
    """The inverse of ``as_matrix``."""
    n, width = matrix.shape
    offsets = np.arange(n + 1, dtype=np.int32) * np.int32(width)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows become NaN, which no comparison selects."""
    norms = np.sqrt(np.einsum("ij,ij->i", m, m))
    with np.errstate(invalid="ignore", divide="ignore"):
        return m / norms[:, None]


def block_scores(rows: np.ndarray, queries: np.ndarray, metric: str) -> np.ndarray:
    """Scores, one line per row and one column per query; cosine expects unit rows on both sides."""
    if metric != "l2sq":
        return rows @ queries.T
    sq = np.einsum("ij,ij->i", rows, rows)[:, None] + np.einsum("ij,ij->i", queries, queries)[None, :]
    near = np.sqrt(np.maximum(sq - 2.0 * (rows @ queries.T), 0.0))
    # The expanded form loses digits close to zero, where the plain difference is exact.
    r, c = np.nonzero(near < 1e-3)
    near[r, c] = np.sqrt(((rows[r] - queries[c]) ** 2).sum(1))
    return 0.0 - near


class RunningTop:
    """Best ``k`` ids per query over a sequence of blocks; ties go to the smaller id.

    With ``sources`` in every block, the best ``k`` of different sources: of a source only its best row stays.
    """

    def __init__(self, n_queries: int, k: int):
        self.k = k
        self.floor = np.full(n_queries, -np.inf)
        self.table = pa.table({"q": pa.array([], pa.int32()), "t": pa.array([], pa.float64()),
                               "v": pa.array([], pa.string()), "s": pa.array([], pa.float64()),
                               "u": pa.array([], pa.string())})

    def add(self, scores: np.ndarray, ids: pa.Array, queries: np.ndarray | None = None,
            sources: pa.Array | None = None) -> None:
        """Offer a block; ``queries`` maps its columns to query numbers (default: all, in order)."""
        n = scores.shape[0]
        if n == 0 or scores.shape[1] == 0:
            return
        cols = np.arange(scores.shape[1]) if queries is None else queries
        s = np.where(np.isnan(scores), -np.inf, scores).T
        if sources is not None:
            code = np.asarray(sources.dictionary_encode().indices)
            order = np.argsort(code, kind="stable")
            first = np.flatnonzero(np.r_[True, np.diff(code[order]) != 0])
            best = np.round(np.maximum.reduceat(s[:, order], first, axis=1), TIE_DIGITS)
            s = np.where(np.round(s, TIE_DIGITS) >= best[:, code], s, -np.inf)
        least = self.floor[cols]
        mask = s >= (least - 10.0 ** -TIE_DIGITS)[:, None]
        # Later blocks offer few rows above the floor; only where many pass is the block itself ranked.
        crowded = np.flatnonzero(mask.sum(axis=1) > 4 * self.k)
        if n > self.k and len(crowded):
            own = np.round(s[crowded], TIE_DIGITS)
            mask[crowded] &= own >= np.partition(own, n - self.k, axis=1)[:, n - self.k, None]
        qi, ri = np.nonzero(mask)
        tie = np.round(s[qi, ri], TIE_DIGITS)
        ok = (tie >= least[qi]) & (tie > -np.inf)
        qi, ri, tie = qi[ok], ri[ok], tie[ok]
        if not len(qi):
            return
        names = ids.take(pa.array(ri))
        fresh = pa.table({"q": pa.array(cols[qi].astype(np.int32)), "t": pa.array(tie), "v": names,
                          "s": pa.array(s[qi, ri]), "u": names if sources is None else sources.take(pa.array(ri))})
        both = pa.concat_tables([self.table, fresh])
        both = both.take(pc.sort_indices(
            both, sort_keys=[("q", "ascending"), ("t", "descending"), ("v", "ascending")]))
        if sources is not None:
            seen = both.select(["q", "u"]).to_pandas().duplicated().to_numpy()
            both = both.filter(pa.array(~seen))
        q = both["q"].to_numpy()
        starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        sizes = np.diff(np.r_[starts, len(q)])
        rank = np.arange(len(q)) - np.repeat(starts, sizes)
        self.table = both.filter(pa.array(rank < self.k))
        full = sizes >= self.k
        last = both["t"].to_numpy()[starts[full] + self.k - 1]
        self.floor[q[starts[full]]] = last


def strings(column) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.string())
