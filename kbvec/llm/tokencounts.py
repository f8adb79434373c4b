"""Token counts by byte-pair merging over a heap and a linked list; no identifiers are made.

A text is cut at the vocabulary's special strings (one token each) and into pieces by the vocabulary's pattern. The
symbols of a piece form a linked list; a heap holds its adjacent pairs by merge rank, and the lowest is merged until
none is left. A piece has as many tokens as it had bytes, less the merges. Counts of short pieces are kept in each
worker, within a bound; that changes no result.

Texts stay where they are: there is no shuffle. The vocabulary, whose size is fixed, is sent to the workers once.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); a piece of any length is merged whole; repeated rows
and null ids give a row each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from kbvec.llm.tables import text_batches

#: Pieces whose counts a worker keeps, and the longest such piece.
KEPT_PIECES, KEPT_CHARS = 1_000_000, 48
#: Characters above which the pieces of a text are not held together.
LONG_TEXT = 1 << 20
# Fixed value: the piece pattern of the vocabulary's library.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> list[str]:
    """The printable character that stands for every byte in a byte-level vocabulary."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


def load_vocabulary(path: str) -> tuple[dict[tuple[str, str], int], list[str]]:
    """Merge ranks by pair, and special strings, of a byte-level BPE file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
    return {pair: rank for rank, pair in enumerate(merges)}, [t["content"] for t in spec["added_tokens"]]


class MergeCounter(dict):
    """Tokens of a piece; looks up what it has counted before."""

    def __init__(self, ranks: dict[tuple[str, str], int], specials: list[str]):
        super().__init__()
        self.ranks, self.symbols = ranks, byte_symbols()
        self.pattern = regex.compile(PATTERN)
        self.specials = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None

    def __missing__(self, piece: str) -> int:
        count = self.merged([self.symbols[b] for b in piece.encode("utf-8")])
        if len(piece) <= KEPT_CHARS and len(self) < KEPT_PIECES:
            self[piece] = count
        return count

    def merged(self, symbols: list[str]) -> int:
        """Symbols that are left when no adjacent pair can be merged."""
        n, ranks = len(symbols), self.ranks
        if n < 2:
            return n
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank, i, symbols[i], symbols[i + 1]) for i in range(n - 1)
                if (rank := ranks.get((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)
        left = n
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            # An entry is old when either of its symbols has been merged since.
            if j >= n or symbols[i] != a or symbols[j] != b:
                continue
            symbols[i], symbols[j] = a + b, ""
            left -= 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (rank := ranks.get((symbols[i], symbols[k]))) is not None:
                    heapq.heappush(heap, (rank, i, symbols[i], symbols[k]))
            h = before[i]
            if h >= 0 and (rank := ranks.get((symbols[h], symbols[i]))) is not None:
                heapq.heappush(heap, (rank, h, symbols[h], symbols[i]))
        return left

    def count(self, text: str) -> int:
        if self.specials and self.specials.search(text):
            parts = self.specials.split(text)
            return len(parts) - 1 + sum(self._plain(p) for p in parts)
        return self._plain(text)

    def _plain(self, text: str) -> int:
        if len(text) > LONG_TEXT:
            return sum(self[m.group()] for m in self.pattern.finditer(text))
        total = sum(map(self.__getitem__, self.pattern.findall(text)))
        if len(self) >= KEPT_PIECES:
            self.clear()
        return total


#: The counter of this worker, by vocabulary.
_COUNTERS: dict[str, MergeCounter] = {}


def _counts(vocabulary, name: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _COUNTERS:
            _COUNTERS[name] = MergeCounter(*vocabulary.value)
        counter = _COUNTERS[name]
        for batch in batches:
            sizes, tokens = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                sizes.append(len(text.encode("utf-8")))
                tokens.append(counter.count(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([t > limit for t in tokens], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return run


def count_tokens(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether the text is over ``limit`` tokens, for every row."""
    text_batches(docs.sparkSession)
    vocabulary = docs.sparkSession.sparkContext.broadcast(load_vocabulary(path))
    return docs.select("doc_id", "text").mapInArrow(
        _counts(vocabulary, path, limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
