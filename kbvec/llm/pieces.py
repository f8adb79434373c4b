"""SentencePiece encoding by forward filtering and backward sampling over the piece lattice, and lossless decoding.

A text is a chain of units (a run of spaces and what follows up to the next space or line end); no piece of the
model crosses a unit's bounds, so the lattice of a text is the chain of its units' lattices and each is filtered once
for all its occurrences in a worker. Forward: the log-weight of all segmentations up to each character. Backward: from
the end of every unit, one piece at a time, drawn in proportion to the weight of all segmentations that end with it.
All units of a piece of texts are drawn together, step by step, as numpy arrays.

Draws come from a hash of the row key, the unit's place and the character's place, so a row's segmentation is
the same in every run, whatever the partitioning. ``sharpness`` 0 draws all segmentations alike; large values approach
the best one. A unigram model's scores are log-weights; a BPE model's are merge ranks, of which weights follow as
1 / (rank + 2).

Characters without a piece become the pieces of their UTF-8 bytes. The model's space mark as a character of the text
goes by bytes too, so decoding gives back every text exactly.

Texts stay where they are: there is no shuffle. The model, whose size is fixed, is sent to the workers once.

Defined cases: a null text gives null pieces and counts as decoded exactly; an empty text has no pieces; rows with
equal key and text get equal pieces; a null key counts as 0; an empty table gives an empty result; further columns
are kept by ``encode`` unless they carry the name of a result column, which replaces them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kbvec.llm.tables import text_batches
from kbvec.llm.textarrays import mix, text_pieces

MARK = 0x2581
#: Code that the mark has as a character of a text, outside Unicode.
LITERAL_MARK = 0x110000 + MARK
NEWLINE, SPACE = 10, 32
#: Edges of lattices that a worker keeps, and lattice positions that are filtered at a time.
KEPT_EDGES, FILTERED = 2_000_000, 10_000
#: Leading bits of a hash by which stretches that are no piece are told before the search among the pieces.
SIFT_BITS = 18
#: Bytes of text that are drawn together.
TEXT_BYTES = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@dataclass
class Model:
    """pieces as bytes (a byte piece is its byte), log-weights, and the id of every byte."""

    surface: list[bytes]
    weight: np.ndarray
    normal: np.ndarray
    byte_ids: np.ndarray
    dummy_prefix: bool


def load_model(path: str, sharpness: float = 1.0) -> Model:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    names = [sp.id_to_piece(i) for i in range(n)]
    special = np.array([sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)])
    byte_ids = np.full(256, -1, np.int32)
    for i in range(n):
        if sp.is_byte(i):
            byte_ids[int(names[i][3:5], 16)] = i
    if (byte_ids < 0).any():
        raise ValueError("the model has no byte pieces, so not every text could be decoded again")
    mark = chr(MARK)
    if any(mark in s.lstrip(mark) for s in names):
        raise ValueError("a piece goes beyond a space")
    scores = np.array([sp.get_score(i) for i in range(n)])
    ranks = bool((scores[~special] == np.round(scores[~special])).all())
    weight = -np.log(2.0 - scores) if ranks else scores
    surface = [bytes([int(s[3:5], 16)]) if sp.is_byte(i) else s.replace(mark, " ").encode() for i, s in enumerate(names)]
    return Model(surface, sharpness * weight, ~special, byte_ids, [sp.id_to_piece(i) for i in sp.encode("a")][0][:1] == mark)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(n, b, np.uint64))])
                 for b in (_BASE, _INVERSE))


def _char_codes(chars: np.ndarray) -> np.ndarray:
    return mix(chars.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03) + np.uint64(17))


def _sift(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SIFT_BITS)).astype(np.intp)


class Lattices:
    """Filtered lattices of units, for one model; flat arrays over nodes (a unit's characters) and edges."""

    def __init__(self, model: Model):
        self.model = model
        self.up, self.down = _powers(1 << 12)
        by_length: dict[int, list[tuple[int, int]]] = {}
        for i in np.flatnonzero(model.normal):
            text = model.surface[i].decode()
            chars = np.array([MARK if c == " " else ord(c) for c in text], np.int64)
            value = (_char_codes(chars) * self.up[:len(chars)]).sum(dtype=np.uint64)
            by_length.setdefault(len(chars), []).append((int(value), int(i)))
        self.tables = {}
        for n, found in by_length.items():
            found.sort()
            values, ids = np.array([v for v, _ in found], np.uint64), np.array([i for _, i in found], np.int32)
            seen = np.zeros(1 << SIFT_BITS, bool)
            seen[_sift(values)] = True
            self.tables[n] = (values, ids, seen)
        self.longest = max(self.tables)
        self.fallback = float(model.weight[model.normal].min()) - 10.0
        lengths = np.array([len(s) for s in model.surface])
        self.surface_length = lengths
        self.surface_start = np.r_[0, np.cumsum(lengths)]
        self.surface_bytes = np.frombuffer(b"".join(model.surface), np.uint8)
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.slot = np.zeros(0, np.int64)
        self.node0 = np.zeros(0, np.int64)
        self.nodes = self.units = 0
        self.edge0 = np.zeros(0, np.int64)
        self.edge_share = np.zeros(0, np.float32)
        self.edge_len = np.zeros(0, np.uint8)
        self.edge_piece = np.zeros(0, np.int32)

    def _filtered(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Nodes and edges of units of one length: a row of ``chars`` each."""
        m, n = chars.shape
        width = min(self.longest, n)
        if n >= len(self.up):
            self.up, self.down = _powers(1 << n.bit_length())
        sums = np.zeros((m, n + 1), np.uint64)
        np.cumsum(_char_codes(chars) * self.up[:n], axis=1, out=sums[:, 1:])
        piece = np.full((m, n, width), -1, np.int32)
        weight = np.full((m, n, width), -np.inf)
        found = 1
        for size in range(1, width + 1):
            if size not in self.tables:
                continue
            values, ids, seen = self.tables[size]
            part = (sums[:, size:] - sums[:, :-size]) * self.down[:n - size + 1]
            row, start = np.nonzero(seen[_sift(part)])
            part = part[row, start]
            at = np.minimum(np.searchsorted(values, part), len(values) - 1)
            hit = np.flatnonzero(values[at] == part)
            if len(hit):
                row, end, own, found = row[hit], start[hit] + size - 1, ids[at[hit]], size
                piece[row, end, size - 1] = own
                weight[row, end, size - 1] = self.model.weight[own]
        # Longer stretches are pieces in none of the units.
        width, piece, weight = found, piece[:, :, :found], weight[:, :, :found]
        bare = piece[:, :, 0] < 0
        piece[:, :, 0][bare] = len(self.model.surface) + chars[bare].astype(np.int32)
        weight[:, :, 0][bare] = self.fallback
        total = np.full((m, n + 1), -np.inf)
        total[:, 0] = 0.0
        for end in range(1, n + 1):
            k = min(width, end)
            # Column j of a node is a piece of j + 1 characters.
            reach = weight[:, end - 1, :k] + total[:, end - k:end][:, ::-1]
            top = reach.max(axis=1)
            total[:, end] = top + np.log(np.exp(reach - top[:, None]).sum(axis=1))
            weight[:, end - 1, :k] = reach - total[:, end][:, None]
        # Edges of a node from the longest piece down; the last share is above every draw.
        there = piece[:, :, ::-1] >= 0
        shares = np.zeros(there.shape)
        shares[there] = np.exp(weight[:, :, ::-1][there])
        np.cumsum(shares, axis=2, out=shares)
        count = there.sum(axis=2).ravel()
        share = shares[there].astype(np.float32)
        share[np.cumsum(count) - 1] = 2.0
        size = np.broadcast_to(np.arange(width, 0, -1, dtype=np.uint8), there.shape)[there]
        return count, share, size, piece[:, :, ::-1][there]

    def add(self, keys: np.ndarray, chars: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        """Filter new units, given by their hashes and places in ``chars``."""
        edges, slots, firsts = [], [], []
        for n in np.unique(lengths):
            own = np.flatnonzero(lengths == n)
            step = max(1, FILTERED // int(n))
            for group in (own[i:i + step] for i in range(0, len(own), step)):
                edges.append(self._filtered(chars[starts[group][:, None] + np.arange(n)]))
                slots.append(group)
                firsts.append(self.nodes + np.arange(len(group)) * n)
                self.nodes += len(group) * int(n)
        order = np.concatenate(slots)
        self.node0 = np.concatenate([self.node0, *firsts])
        new_slot = np.empty(len(keys), np.int64)
        new_slot[order] = self.units + np.arange(len(order))
        self.units += len(order)
        all_keys, all_slots = np.concatenate([self.keys, keys]), np.concatenate([self.slot, new_slot])
        rank = np.argsort(all_keys, kind="stable")
        self.keys, self.slot = all_keys[rank], all_slots[rank]
        counts = np.concatenate([e[0] for e in edges])
        self.edge0 = np.concatenate([self.edge0, len(self.edge_share) + np.cumsum(counts) - counts])
        self.edge_share = np.concatenate([self.edge_share, *[e[1] for e in edges]])
        self.edge_len = np.concatenate([self.edge_len, *[e[2] for e in edges]])
        self.edge_piece = np.concatenate([self.edge_piece, *[e[3] for e in edges]])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of every hash, -1 where it is not known."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.slot[at], -1)

    def encode(self, data: np.ndarray, offsets: np.ndarray, row_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts, and where each text's ids begin (with the end as last)."""
        chars, bounds = self._chars(data, offsets)
        n = len(chars)
        if not n:
            return np.zeros(0, np.int32), np.zeros(len(bounds), np.int64)
        space, line = chars == MARK, chars == NEWLINE
        begins = np.zeros(n, bool)
        begins[bounds[:-1][np.diff(bounds) > 0]] = True
        begins[1:] |= (space[1:] & ~space[:-1]) | line[1:] | line[:-1]
        starts = np.flatnonzero(begins)
        ends = np.r_[starts[1:], n]
        lengths = ends - starts
        up, down = _powers(n)
        sums = np.r_[np.zeros(1, np.uint64), np.cumsum(_char_codes(chars) * up[:n], dtype=np.uint64)]
        keys = mix((sums[ends] - sums[starts]) * down[starts] + lengths.astype(np.uint64))
        distinct, sample, which = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.edge_share) > KEPT_EDGES:
            self.clear()
        new = self.find(distinct) < 0
        if new.any():
            self.add(distinct[new], chars, starts[sample[new]], lengths[sample[new]])
        node0 = self.node0[self.find(distinct)[which]]

        row = np.searchsorted(bounds, starts, "right") - 1
        seed = mix(row_keys[row].astype(np.uint64) ^ mix((starts - bounds[row]).astype(np.uint64)))
        chosen = np.full(n, -1, np.int32)
        active, left = np.arange(len(starts)), lengths.copy()
        while len(active):
            draw = (mix(seed[active] + left[active].astype(np.uint64)) >> np.uint64(11)) * 2.0 ** -53
            node = node0[active] + left[active] - 1
            edge = self.edge0[node]
            passed = np.flatnonzero(draw >= self.edge_share[edge])
            while len(passed):
                edge[passed] += 1
                passed = passed[draw[passed] >= self.edge_share[edge[passed]]]
            chosen[starts[active] + left[active] - 1] = self.edge_piece[edge]
            left[active] -= self.edge_len[edge]
            active = active[left[active] > 0]
        at = np.flatnonzero(chosen >= 0)
        return self._with_bytes(chosen[at], np.searchsorted(at, bounds))

    def _chars(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters of all texts, spaces as marks, each text behind a mark if the model wants one."""
        first = (data & 0xC0) != 0x80
        chars = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.int64)
        bounds = np.r_[0, np.cumsum(first)][offsets]
        chars[chars == MARK] = LITERAL_MARK
        chars[chars == SPACE] = MARK
        if self.model.dummy_prefix:
            there = np.diff(bounds) > 0
            chars = np.insert(chars, bounds[:-1][there], MARK)
            bounds = bounds + np.r_[0, np.cumsum(there)]
        return chars, bounds

    def _with_bytes(self, piece: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replace characters without a piece by the pieces of their bytes."""
        size = len(self.model.surface)
        char = piece.astype(np.int64) - size
        char = np.where(char >= 0x110000, char - 0x110000, char)
        count = np.where(char < 0, 1, 1 + (char >= 0x80) + (char >= 0x800) + (char >= 0x10000))
        to = np.r_[0, np.cumsum(count)]
        out = np.empty(to[-1], np.int32)
        out[to[:-1][char < 0]] = piece[char < 0]
        for n, lead in ((1, 0), (2, 0xC0), (3, 0xE0), (4, 0xF0)):
            own = np.flatnonzero((char >= 0) & (count == n))
            for k in range(n):
                bits = char[own] >> (6 * (n - 1 - k))
                out[to[own] + k] = self.model.byte_ids[bits | lead if k == 0 else (bits & 0x3F) | 0x80]
        return out, to[bounds]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts, and where each begins."""
        size = self.surface_length[ids]
        ends = np.r_[0, np.cumsum(size)]
        data = self.surface_bytes[np.arange(ends[-1]) + np.repeat(self.surface_start[ids] - ends[:-1], size)]
        at = ends[bounds]
        if self.model.dummy_prefix:
            there = np.diff(at) > 0
            data = np.delete(data, at[:-1][there])
            at = at - np.r_[0, np.cumsum(there)]
        return data, at


#: The lattices of this worker, by model.
_LATTICES: dict[tuple, Lattices] = {}


def _lattices(model, name: tuple) -> Lattices:
    if name not in _LATTICES:
        _LATTICES.clear()
        _LATTICES[name] = Lattices(model.value)
    return _LATTICES[name]


def _encode(model, name: tuple, key: str, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _lattices(model, name)
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(key)).cast(pa.int64()).fill_null(0).to_numpy().view(np.uint64)
            there = batch.column(batch.schema.get_field_index(text)).is_valid().to_numpy(zero_copy_only=False)
            for at, data, offsets in text_pieces(batch, text, TEXT_BYTES):
                rows = len(offsets) - 1
                ids, bounds = own.encode(data, offsets, keys[at:at + rows])
                back, back_at = own.decode(ids, bounds)
                same = np.diff(back_at) == np.diff(offsets)
                if same.all():
                    bad = np.r_[0, np.cumsum(back != data)]
                    same &= bad[offsets[1:]] == bad[offsets[:-1]]
                else:
                    same &= np.array([back[back_at[i]:back_at[i + 1]].tobytes() == data[offsets[i]:offsets[i + 1]].tobytes()
                                      for i in range(rows)])
                own_there = there[at:at + rows]
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids),
                                                 mask=pa.array(~own_there))
                counts = pa.array(np.diff(bounds), pa.int64(), mask=~own_there)
                part = batch.slice(at, rows)
                yield pa.RecordBatch.from_arrays([*part.columns, lists, counts, pa.array(same)],
                                                 names=[*part.schema.names, "pieces", "n_pieces", "exact"])
    return run


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", sharpness: float = 1.0) -> DataFrame:
    """``docs`` with pieces (ids), n_pieces, and whether decoding them has given back the text."""
    text_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(load_model(path, sharpness))
    rows = docs.drop("pieces", "n_pieces", "exact")
    schema = T.StructType([*rows.schema.fields, T.StructField("pieces", T.ArrayType(T.IntegerType())),
                           T.StructField("n_pieces", T.LongType()), T.StructField("exact", T.BooleanType())])
    return rows.mapInArrow(_encode(model, (path, sharpness), key, text), schema)


def _decode(model, name: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _lattices(model, name)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("pieces"))
            empty = lists.fill_null(pa.scalar([], lists.type)) if lists.null_count else lists
            bounds = np.asarray(empty.offsets, np.int64)
            data, at = own.decode(np.asarray(empty.flatten()), bounds - bounds[0])
            raw = data.tobytes()
            texts = [raw[a:b].decode("utf-8") if ok else None
                     for a, b, ok in zip(at[:-1], at[1:], lists.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*batch.schema.names, "decoded"])
    return run


def decode(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` with decoded, the text of their ``pieces``."""
    model = rows.sparkSession.sparkContext.broadcast(load_model(path))
    kept = rows.drop("decoded")
    return kept.mapInArrow(_decode(model, (path, 1.0)), T.StructType(
        [*kept.schema.fields, T.StructField("decoded", T.StringType())]))


def digest(docs: DataFrame, path: str, sharpness: float = 1.0) -> DataFrame:
    """doc_id, n_pieces, a checksum of the ids, and whether decoding was exact, for every row."""
    coded = encode(docs.select("doc_id", "text"), path, sharpness=sharpness)
    return coded.select("doc_id", "n_pieces", F.md5(F.array_join("pieces", ",")).alias("pieces_md5"), "exact")
