"""Benchmark decontamination by templates.

Texts become templates: every number, name and unit of measure is a typed placeholder, everything else its word in
lower case without punctuation. Windows of eight template tokens of the benchmark are joined with those of the
documents by hash, so a question with other numbers or names in it still matches. Matches of a document and an item
on one diagonal (equal distance between their places) are one occurrence; it counts when its slots are consistent,
that is when equal values in the item stand for equal values in the document. A document is contaminated by an item
when the occurrences cover at least three windows of it (all, if it has fewer).

A number is a word that begins with a digit; a unit is a word of ``UNITS`` behind a number; a name is a word with a
capital that is not all capitals. Whether a capital marks a name or only a sentence or a title cannot be known, so such a
word is read both as a name and as itself: by itself in an item, and in a document together with the other capitals of
its window that begin sentences, or with those that do not. The first word of an item's sentence is read as a name
without a capital too, but then the document's word must be the same. A window needs words of its own: at least half of
its tokens are literal, or it matches only windows of just the same words.

The documents' windows are sifted by a bitmap of fixed size (``CELLS`` bits) before they leave a task, and joined
with the benchmark's windows by hash; that side is sent to all tasks only when it was measured to be small.

Defined cases: null and blank texts have no windows; an item shorter than a window is one window of all its tokens;
an item of mere placeholders is matched by copies only; rows without an id are not reported; rows with one id are one
document; equal items are each reported; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kbvec.llm.tables import text_batches
from kbvec.llm.textarrays import ASCII_SPACE, codes, mix, running, spans, stretch, text_pieces
from kbvec.session import is_small, materialize

WINDOW, COVERED = 8, 3
CELLS = 1 << 22
# Words that are units of measure behind a number.
UNITS = ("kg g mg lb lbs oz km m cm mm mi ft inch inches mile miles meter meters metre metres litre litres liter liters "
         "l ml second seconds minute minutes hour hours day days week weeks month months year years dollar dollars euro "
         "euros cent cents percent degree degrees gram grams kilogram kilograms kilometer kilometers kilometre "
         "kilometres mph kmh watt watts volt volts").split()
_NUMBER, _NAME, _UNIT = (np.uint64(x) for x in (0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93))
_CODES = codes(31)
_KEPT = np.zeros(256, bool)
_KEPT[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:;\n\""]] = True
_FACTORS = [np.uint64(pow(0xC2B2AE3D27D4EB4F, k, 1 << 64)) for k in range(WINDOW)]


def _hash_words(words: list[str]) -> np.ndarray:
    data = "".join(words).encode()
    ends = np.cumsum([len(w.encode()) for w in words])
    return stretch(running(_CODES[np.frombuffer(data, np.uint8)]), np.r_[0, ends[:-1]], ends)


_UNIT_HASHES = np.sort(_hash_words(UNITS))


LITERAL, SLOT, NAME, START, LOWER_START = range(5)


def templates(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """row, template token, word hash and kind for all words of a piece of texts.

    Tokens are placeholders for numbers and units only; the kinds tell which words can be read as names as well: those
    with a capital inside a sentence (``NAME``) or at its start (``START``). ``LOWER_START`` begins one without it.
    """
    starts, ends, rows = spans(~ASCII_SPACE[data], offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int8)
    n = len(data)
    # General punctuation (quotes, dashes, dots of three bytes) goes like that of one byte.
    kept = _KEPT[data].copy()
    lead = np.flatnonzero((data[:-2] == 0xE2) & ((data[1:-1] == 0x80) | (data[1:-1] == 0x81))) if n > 2 else np.zeros(0, np.int64)
    for k in range(3):
        kept[lead + k] = False
    after_c3 = np.r_[False, data[:-1] == 0xC3] & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    total = np.r_[0, np.cumsum(kept)]
    plain = data[kept].copy()
    plain[after_c3[kept]] += 0x20
    has = total[ends] > total[starts]
    starts, ends, rows = starts[has], ends[has], rows[has]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int8)
    word = stretch(running(_CODES[plain]), total[starts], total[ends])
    place = np.flatnonzero(kept)
    first = place[total[starts]]
    upper = ((data >= 65) & (data <= 90)) | after_c3
    follows_c3 = np.r_[after_c3[1:], False]
    capital = upper[first] | follows_c3[first]
    lowers = np.r_[0, np.cumsum(((data >= 97) & (data <= 122)) | (np.r_[False, data[:-1] == 0xC3] & (data >= 0x9F)))]
    capitals = np.r_[0, np.cumsum(upper)]
    shout = (lowers[ends] == lowers[starts]) & (capitals[ends] - capitals[starts] > 1)
    # A sentence begins with a text, and where a stop or a line end stands since the last word's letters.
    stops = np.r_[0, np.cumsum(_STOP[data])]
    last = place[total[ends] - 1] + 1
    begins = np.ones(len(starts), bool)
    begins[1:] = (rows[1:] != rows[:-1]) | (stops[first[1:]] > stops[last[:-1]])
    number = _DIGIT[data[first]]
    before = np.r_[False, number[:-1] & (rows[1:] == rows[:-1])]
    at = np.minimum(np.searchsorted(_UNIT_HASHES, word), len(_UNIT_HASHES) - 1)
    unit = before & (_UNIT_HASHES[at] == word) & ~number
    token = np.where(number, _NUMBER, np.where(unit, _UNIT, word))
    kind = np.where(begins, np.where(capital & ~shout, START, LOWER_START), np.where(capital & ~shout, NAME, LITERAL))
    return rows, token, word, np.where(number | unit, SLOT, kind).astype(np.int8)


def _places(rows, size: int, whole: bool) -> np.ndarray:
    """First words of the windows of ``size`` words; with ``whole``, only of texts of just that size."""
    n = len(rows) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    fine = rows[:n] == rows[size - 1:]
    if whole:
        fine &= np.bincount(rows)[rows[:n]] == size
    return np.flatnonzero(fine)


def _holds(mark, size: int, at) -> np.ndarray:
    """How many words with a mark the windows at ``at`` have."""
    total = np.r_[0, np.cumsum(mark)]
    return total[at + size] - total[at]


def _readings(rows, token, kind, size: int):
    """first words, names among the words (for all windows one row) and whether it is the usual one, for every reading of
    the documents' windows: the capitals inside sentences and those at starts are all names or all words."""
    at = _places(rows, size, False)
    inner, start = _holds(kind == NAME, size, at), _holds(kind == START, size, at)
    slots = _holds(kind == SLOT, size, at)
    for names, has in (((NAME,), True), ((NAME, START), start > 0), ((), inner > 0), ((START,), (inner > 0) & (start > 0))):
        held = slots + inner * (NAME in names) + start * (START in names)
        use = at[has & (2 * held <= size)]
        yield use, np.isin(kind, names)[use[:, None] + np.arange(size)], np.full(len(use), names == (NAME,))


def _all_readings(rows, token, kind, size: int):
    """The same for an item's windows, where every word that can be a name is read both ways by itself."""
    at = _places(rows, size, size < WINDOW)
    grid = at[:, None] + np.arange(size)
    bit = 1 << np.arange(size)
    open_, usual = ((kind[grid] >= NAME) * bit).sum(axis=1), ((kind[grid] == NAME) * bit).sum(axis=1)
    slots = (kind[grid] == SLOT).sum(axis=1)
    for names in range(1 << size):
        use = (open_ & names == names) & (2 * (slots + names.bit_count()) <= size)
        if use.any():
            yield at[use], np.broadcast_to((names & bit) > 0, (int(use.sum()), size)), usual[use] == names


def _heavy(rows, kind, size: int, whole: bool) -> np.ndarray:
    """First words of the windows that more than half slots can make unusable as templates."""
    at = _places(rows, size, whole)
    return at[2 * _holds((kind == SLOT) | (kind == NAME) | (kind == START), size, at) > size]


def _hashes(tokens: np.ndarray, copies: bool = False) -> np.ndarray:
    value = np.full(len(tokens), tokens.shape[1] + 2 * WINDOW * copies, np.uint64)
    for k in range(tokens.shape[1]):
        value += tokens[:, k] * _FACTORS[k]
    return mix(value)


def _lists(values: np.ndarray, counts: np.ndarray, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(values, kind))


SCHEMA = "id long, hash long, pos int, words int, vals array<long>, fixed array<boolean>, usual boolean, light boolean"


def _window_rows(sizes, items: bool, cells):
    """Windows as rows; of the benchmark all (``items``), of documents those in the bitmap ``cells``.

    ``vals`` are the words in slots; those ``fixed`` must be equal in a document. ``usual`` is the reading by which only
    capitals inside sentences are names, ``light`` tells that a window is usable by it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None if cells is None else np.unpackbits(cells.value.view(np.uint8), bitorder="little").view(bool)
        for batch in batches:
            ids = batch.column(0)
            for at, data, offsets in text_pieces(batch):
                rows, token, word, kind = templates(data, offsets)
                if not len(rows):
                    continue
                first = np.searchsorted(rows, np.arange(len(offsets)))

                def out(start, value, size, is_slot, usual):
                    if wanted is not None:
                        hit = wanted[value & np.uint64(CELLS - 1)]
                        start, value, is_slot, usual = start[hit], value[hit], is_slot[hit], usual[hit]
                    if not len(value):
                        return
                    grid = start[:, None] + np.arange(size)
                    counts = is_slot.sum(axis=1)
                    light = 2 * ((kind[grid] == SLOT) | (kind[grid] == NAME)).sum(axis=1) <= size
                    row = rows[start]
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(at + row)), pa.array(value.view(np.int64)),
                         pa.array((start - first[row]).astype(np.int32)), pa.array(np.full(len(start), size, np.int32)),
                         _lists(word[grid][is_slot].view(np.int64), counts, pa.int64()),
                         _lists((kind[grid] == LOWER_START)[is_slot], counts, pa.bool_()),
                         pa.array(usual), pa.array(light)],
                        names=["id", "hash", "pos", "words", "vals", "fixed", "usual", "light"])

                for size in sizes:
                    for start, names, usual in (_all_readings if items else _readings)(rows, token, kind, size):
                        grid = start[:, None] + np.arange(size)
                        yield from out(start, _hashes(np.where(names, _NAME, token[grid])), size,
                                       names | (kind[grid] == SLOT), usual)
                    # Copies only: all words are in the hash, and all of them are slots that hold the item's own values.
                    start = _heavy(rows, kind, size, items and size < WINDOW)
                    every = np.ones((len(start), size), bool)
                    yield from out(start, _hashes(word[start[:, None] + np.arange(size)], True), size, every, every[:, 0] & False)
    return run


def _bitmap(windows: DataFrame) -> np.ndarray:
    """Which cells the windows' hashes fall into; at most ``CELLS`` / 64 numbers reach the driver."""
    cell = F.col("hash").bitwiseAND(F.lit(CELLS - 1))
    found = windows.select((cell / 64).cast("int").alias("w"), (cell % 64).cast("int").alias("b")).groupBy("w").agg(
        F.bit_or(F.expr("shiftleft(1L, b)")).alias("bits")).toPandas()
    out = np.zeros(CELLS // 64, np.uint64)
    out[found["w"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, windows of the item that are covered and that it has, and whether all slots hold the item's
    own values, for every contaminated document and item."""
    spark = docs.sparkSession
    text_batches(spark)
    items = materialize(benchmark.filter("item_id is not null").select("item_id", "text").distinct().mapInArrow(
        _window_rows(range(1, WINDOW + 1), True, None), SCHEMA).distinct(), "items")
    sizes = sorted(r[0] for r in items.select("words").distinct().collect())
    cells = spark.sparkContext.broadcast(_bitmap(items))
    found = docs.filter("doc_id is not null").select("doc_id", "text").mapInArrow(
        _window_rows(sizes, False, cells), SCHEMA)
    theirs = items.select(F.col("id").alias("item_id"), "hash", F.col("pos").alias("item_pos"), "light", "fixed",
                          F.col("usual").alias("item_usual"), F.col("vals").alias("item_vals"))
    theirs = F.broadcast(theirs) if is_small(theirs) else theirs
    found = found.select("id", "hash", "pos", "vals", "usual")
    slots = F.zip_with("item_vals", "vals", lambda a, b: F.struct(a.alias("item"), b.alias("doc")))
    equal = F.forall(F.arrays_zip("item_vals", "vals", "fixed"), lambda s: ~s["fixed"] | (s["item_vals"] == s["vals"]))
    met = found.join(theirs, "hash").filter(equal).select(
        F.col("id").alias("doc_id"), "item_id", (F.col("pos") - F.col("item_pos")).alias("shift"),
        F.struct("item_pos", "light").alias("at"), (F.col("usual") & F.col("item_usual")).alias("usual"), slots.alias("slots"))

    def gathered(when):
        return F.struct(F.collect_set(F.when(when, F.col("at"))).alias("at"),
                        F.array_distinct(F.flatten(F.collect_list(F.when(when, F.col("slots"))))).alias("slots"))

    def consistent(of):
        return F.size(F.array_distinct(F.transform(of["slots"], lambda s: s["item"]))) == F.size(of["slots"])

    # Words that need not be names can make slots inconsistent; then the usual readings stand by themselves.
    occurrence = met.groupBy("doc_id", "item_id", "shift").agg(
        gathered(F.lit(True)).alias("any"), gathered(F.col("usual")).alias("usual"))
    occurrence = occurrence.withColumn("of", F.when(consistent(F.col("any")), F.col("any")).when(
        consistent(F.col("usual")), F.col("usual"))).filter(F.size("of.at") > 0).withColumn(
        "same", F.forall("of.slots", lambda s: s["item"] == s["doc"]))
    covered = occurrence.groupBy("doc_id", "item_id").agg(
        F.array_distinct(F.flatten(F.collect_list("of.at"))).alias("at"), F.bool_and("same").alias("exact")).select(
        "doc_id", "item_id", F.size("at").alias("windows"), F.size(F.filter("at", lambda x: x["light"])).alias("light"), "exact")
    have = items.groupBy(F.col("id").alias("item_id")).agg(
        F.countDistinct("pos").alias("item_windows"), F.countDistinct(F.when(F.col("light"), F.col("pos"))).alias("item_light"))
    have = F.broadcast(have) if is_small(have) else have
    enough = (F.col("windows") >= F.least(F.lit(COVERED), F.col("item_windows"))) | (
        (F.col("light") > 0) & (F.col("light") >= F.least(F.lit(COVERED), F.col("item_light"))))
    return covered.join(have, "item_id").filter(enough).select(
        "doc_id", "item_id", F.col("windows").cast("long"), F.col("item_windows").cast("long"), "exact")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated ones."""
    bad = contaminated(docs, benchmark).select("doc_id").distinct()
    bad = materialize(bad, "contaminated")
    return docs.join(F.broadcast(bad) if is_small(bad, 1_000_000) else bad, "doc_id", "left_anti").select(*docs.columns)
