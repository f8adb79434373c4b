r"""Spelling variants of frequent words by a bit-sliced position index.

A word is *near* another when one inserted, deleted or replaced code point makes them equal. The vocabulary is held in
bitsets, one for each (position, letter): the bit of a word is set where it has that letter at that position. A word is
looked up by a recurrence over its letters that keeps three sets of vocabulary words at once: those that agree so far
(zero errors), those with one letter replaced, and those with one letter more, which are read one position further on.
Each step is a few word-parallel operations; all words of a cell are looked up together.

Cells keep that linear in the vocabulary. Of two near words, the shorter of L letters, the first L div 2 letters agree,
or else the last L - L div 2 do. A word therefore joins classes L and L - 1 by both ends; ends are hashed into cells of
some thousand words. The set of words that agree on the first half also tells which end found a pair, so each pair
counts once, though a cell mixes several ends. Cells that one end overfills are split into blocks, and every block of
words is looked up in every block: whole, and in bounded tasks.

Words are counted in tasks (numpy and Arrow), batch by batch, before rows are shuffled.

Defined cases: a null text has no words; a null id is written as the empty string before the colon; repeated rows count
again; an empty table, or no word that is frequent enough, gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kbvec.llm.tables import text_batches
from kbvec.llm.textarrays import spans, text_pieces
from kbvec.session import broadcast_if_small, materialize

LEAST_CHARS, LEAST_COUNT, FORM_TIMES = 6, 5, 5
#: One run in so many loses a letter.
NOISE = 199
#: Words of a cell, and letters of a cell where words are long.
CELL_WORDS, CELL_LETTERS = 2_048, 1 << 22

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = (_CRC >> np.uint32(1)) ^ np.where(_CRC & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
#: Longer runs take their checksum from zlib one by one.
_LONG = 64


def _checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of every stretch, continued from the checksum ``before`` it."""
    state = before ^ np.uint32(0xFFFFFFFF)
    size = ends - starts
    at = np.flatnonzero(size <= _LONG)
    for j in range(_LONG):
        at = at[size[at] > j]
        if not len(at):
            break
        now = state[at]
        state[at] = _CRC[(now ^ data[starts[at] + j]) & np.uint32(255)] ^ (now >> np.uint32(8))
    out = state ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > _LONG):
        out[i] = zlib.crc32(data[starts[i]:ends[i]].tobytes(), int(before[i]))
    return out


def runs(data: np.ndarray, offsets: np.ndarray, ids: list) -> pa.Array:
    """The words of a piece of texts that are long enough, each as often as it stands there."""
    c3 = data == 0xC3
    after = np.r_[False, c3[:-1]]
    inside = _LETTER[data] | c3 | after
    starts, ends, rows = spans(inside, offsets)
    wide = np.r_[0, np.cumsum(c3)]
    chars = ends - starts - (wide[ends] - wide[starts])
    use = chars >= LEAST_CHARS
    starts, ends, rows, chars = starts[use], ends[use], rows[use], chars[use]
    if not len(starts):
        return pa.array([], pa.string())
    data = np.where(after, data, _LOWER[data])
    heads = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    check = _checksums(data, starts, ends, heads[rows])
    hit = check % np.uint32(NOISE) == 0
    changed = []
    for i in np.flatnonzero(hit):
        word = data[starts[i]:ends[i]].tobytes().decode("utf-8")
        gone = int(check[i]) % len(word)
        changed.append(word[:gone] + word[gone + 1:])
    starts, ends = starts[~hit], ends[~hit]
    mark = np.zeros(len(data) + 1, np.int8)
    mark[starts] = 1
    mark[ends] -= 1
    kept = data[np.cumsum(mark[:-1]).astype(bool)]
    places = np.r_[0, np.cumsum(ends - starts)].astype(np.int64)
    whole = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(kept.tobytes()))
    rest = pa.array([w for w in changed if len(w) >= LEAST_CHARS], pa.large_string())
    return pa.concat_arrays([whole, rest])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_pylist()
        found = [runs(data, offsets, ids[at:at + len(offsets) - 1]) for at, data, offsets in text_pieces(batch)]
        counts = pa.chunked_array([f.cast(pa.large_string()) for f in found], pa.large_string()).value_counts()
        for part in [counts] if isinstance(counts, pa.StructArray) else counts.chunks:
            yield pa.RecordBatch.from_arrays([part.field(0).cast(pa.string()), part.field(1)], names=["word", "n"])


def frequent_words(docs: DataFrame) -> DataFrame:
    """word and n of the words that occur often enough."""
    text_batches(docs.sparkSession)
    counts = docs.select("doc_id", "text").mapInArrow(_counted, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _bits(flags: np.ndarray) -> np.ndarray:
    """Rows of flags as rows of 64-bit words."""
    packed = np.packbits(flags, axis=1, bitorder="little")
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)


def near_pairs(queries: np.ndarray, words: np.ndarray, longer: np.ndarray, half: int,
               same_half: bool) -> tuple[np.ndarray, np.ndarray]:
    """query and word of every pair one edit apart, of which the first halves agree, or do not.

    ``queries`` (L columns) and ``words`` (L + 1 columns) hold code points; ``longer`` marks words of L + 1 letters,
    the others end in a zero.
    """
    size = queries.shape[1]
    ends = _bits(longer[None, :])[0]
    every = _bits(np.ones((1, len(words)), bool))[0]
    zero = np.broadcast_to(every, (len(queries), len(every))).copy()
    replaced, added = np.zeros_like(zero), np.zeros_like(zero)
    agree = zero

    def slices(place: int) -> tuple[np.ndarray, np.ndarray]:
        letters = np.unique(words[:, place])
        return letters, np.vstack([_bits(words[:, place][None, :] == letters[:, None]), np.zeros((1, len(every)), np.uint64)])

    def pick(letters: np.ndarray, sets: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(letters, wanted), len(letters) - 1)
        return sets[np.where(letters[at] == wanted, at, len(letters))]

    here = slices(0)
    for i in range(size):
        further = slices(i + 1)
        letter = queries[:, i]
        match = pick(*here, letter)
        added = (added | zero) & pick(*further, letter)
        replaced = (replaced & match) | (zero & ~match)
        zero = zero & match
        if i + 1 == half:
            agree = zero
        here = further
    found = (replaced & ~ends) | ((added | zero) & ends)
    found &= agree if same_half else ~agree
    row, cell = np.nonzero(found)
    bits = np.unpackbits(found[row, cell].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    pair, bit = np.nonzero(bits)
    return row[pair], cell[pair] * 64 + bit


def _looked_up(table: pa.Table) -> pa.Table:
    """word, number of near words and the most frequent of them, for the words of one cell that have any there."""
    size, end = table["size"][0].as_py(), table["end"][0].as_py()
    i, j = table["i"][0].as_py(), table["j"][0].as_py()
    words, n = table["word"].to_pylist(), table["n"].to_numpy()
    block = table["block"].to_numpy()
    code = np.array(words, dtype=f"<U{size + 1}").view(np.uint32).reshape(len(words), size + 1)
    longer = code[:, size] != 0
    known, asked = np.flatnonzero(block == i), np.flatnonzero((block == j) & ~longer)
    order = np.array(sorted(range(len(words)), key=lambda k: (-n[k], words[k])), np.int64)
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    count, best = np.zeros(len(words), np.int64), np.full(len(words), len(words), np.int64)
    for at in range(0, len(asked) if len(known) else 0, CELL_WORDS):
        part = asked[at:at + CELL_WORDS]
        q, w = near_pairs(code[part, :size], code[known], longer[known], size // 2, end == 0)
        q, w = part[q], known[w]
        one = longer[w]
        # Words of equal length look each other up; of a longer one this is the only look.
        for a, b in ((q, w), (w[one], q[one])):
            count += np.bincount(a, minlength=len(words))
            np.minimum.at(best, a, rank[b])
    has = np.flatnonzero(count)
    form = order[best[has]]
    return pa.table([pa.array([words[k] for k in has], pa.string()), pa.array(count[has]), pa.array(-n[form]),
                     pa.array([words[k] for k in form], pa.string())], names=["word", "n_near", "less", "form"])


def near_words(words: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """word, n_near, and of its near words the most frequent one (form) and its count (form_n), where there is one."""
    sized = words.withColumn("length", F.char_length("word"))
    # Words of a class are spread over so many cells.
    spread = sized.groupBy("length").agg(F.count("*").alias("c"))
    both = spread.select(F.col("length").alias("size"), "c").union(spread.select(F.col("length") - 1, "c"))
    room = F.least(F.lit(cell_words), F.greatest(F.lit(1), F.floor(F.lit(CELL_LETTERS) / F.col("size"))))
    classes = both.filter(F.col("size") >= LEAST_CHARS).groupBy("size").agg(F.sum("c").alias("c")).withColumn(
        "cells", F.ceil(F.col("c") / room)).withColumn("room", room).drop("c")
    joined = sized.select("word", "n", F.explode(F.array(F.col("length"), F.col("length") - 1)).alias("size")).join(
        broadcast_if_small(classes), "size")
    key = F.when(F.col("end") == 0, F.expr("left(word, size div 2)")).otherwise(F.expr("right(word, size - size div 2)"))
    keyed = joined.withColumn("end", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
        "cell", F.pmod(F.xxhash64(key), "cells")).drop("cells")
    keyed = materialize(keyed, "ends")
    full = keyed.groupBy("size", "end", "cell").agg(F.count("*").alias("c"), F.first("room").alias("most")).filter(
        F.col("c") > 4 * F.col("most")).select("size", "end", "cell", F.ceil(F.col("c") / F.col("most")).cast("int").alias("blocks"))
    placed = keyed.join(broadcast_if_small(full), ["size", "end", "cell"], "left").withColumn(
        "blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("word", F.lit(3)), "blocks").cast("int"))
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    known = F.transform(others, lambda j: F.struct(F.col("block").alias("i"), j.alias("j")))
    asked = F.transform(others, lambda i: F.struct(i.alias("i"), F.col("block").alias("j")))
    cells = placed.withColumn("at", F.explode(F.array_union(known, asked))).select(
        "size", "end", "cell", "block", "at.i", "at.j", "word", "n")
    found = cells.groupBy("size", "end", "cell", "i", "j").applyInArrow(
        _looked_up, "word string, n_near long, less long, form string")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("less", "form")).alias("best")).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """word and the last of its forms, of words that have a form; every round doubles the steps taken.

    A form is at least FORM_TIMES as frequent as its word, so chains are short and have no rings.
    """
    at = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        if not moved.filter("next is not null").limit(1).count():
            return moved.select("word", "root")
        at = moved.select("word", "root")


def variants(docs: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """word, n, n_near, form, form_n and root of every frequent word."""
    words = materialize(frequent_words(docs), "words")
    near = near_words(words, cell_words)
    is_form = F.col("form_n") >= FORM_TIMES * F.col("n")
    joined = materialize(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("form")).alias("form"),
        F.when(is_form, F.col("form_n")).alias("form_n")), "near")
    return joined.join(_roots(joined.filter("form is not null")), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
