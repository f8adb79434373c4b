r"""Line dedup by a deletion-neighbourhood join.

A line is compared as its words. A line that is not blank repeats an earlier one (by document id, then place) when the
words are equal or, from five words on, differ by one edit: a word replaced, added or missing. A line goes when there is
any earlier line that it repeats.

1. Equal lines meet by a 128-bit hash; each distinct line is known by its earliest place.
2. Distinct lines are sifted without loss: one edit leaves the first or the last half of the words as it was, so only
   lines that share such a half with another line go on.
3. Those emit the hashes of all variants with one word deleted, beside their own. Lines with the same variant and the
   same deleted place differ by that word; a line whose own hash is a variant of another lacks a word of it. The
   earliest line of a variant is all that its other lines need, so no pairs within a group are made.
4. The words of both lines of a match are compared.

Rows of lines are narrow (hashes and places). Texts are read again for the lines that are compared, and joined with
their documents' removals when these are applied. Counts and minima of keys are aggregated inside the tasks first and
joined back, so a key of very many lines is split like any other skewed join.

A document is a row's id and text (``version``, a hash of the text, tells texts of one id apart); its place is after
that of smaller ids, and, without an id, after all others.

Defined cases: null and blank texts have no lines; rows that repeat an id with its text are one document; an empty table
gives an empty result; ``apply`` keeps all columns of its input, whatever their names, leaves one row of every document,
and drops a document of which lines went when every line that is left is blank.
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

#: Words from which a line has deletion variants: with fewer, one word is too large a part of it.
NEAR_WORDS = 5
_CODES = codes(53, lower=False)
_BASE = 0xC2B2AE3D27D4EB4F
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(n, b, np.uint64))])
                 for b in (_BASE, _INVERSE))


def _lines(data: np.ndarray, offsets: np.ndarray):
    """For the lines of a piece that are not blank: row, place, first word and end word; and the hashes of all words."""
    ends_line = data == 10
    starts, ends, rows = spans(~ASCII_SPACE[data], offsets)
    none = np.zeros(0, np.int64)
    if not len(starts):
        return none, none, none, none, np.zeros(0, np.uint64)
    word = stretch(running(_CODES[data]), starts, ends)
    breaks = np.r_[0, np.cumsum(ends_line)]
    place = breaks[starts] - breaks[offsets[rows]]
    first = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]) | (place[1:] != place[:-1])])
    end = np.r_[first[1:], len(rows)]
    return rows[first], place[first], first, end, word


class _Sums:
    """Hashes of runs of words, from running sums."""

    def __init__(self, word: np.ndarray):
        self.up, self.down = _powers(len(word) + 2)
        self.total = np.r_[np.zeros(1, np.uint64), np.cumsum(word * self.up[:len(word)], dtype=np.uint64)]

    def run(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.total[b] - self.total[a]) * self.down[a]

    def without(self, a: np.ndarray, b: np.ndarray, skip: np.ndarray) -> np.ndarray:
        """The run from a to b without the word ``skip``."""
        return self.run(a, skip) + self.run(skip + 1, b) * self.up[skip - a]


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, data, offsets in text_pieces(batch):
            row, place, a, b, word = _lines(data, offsets)
            take = pa.array(at + row)
            sums = _Sums(word)
            n = b - a
            own = sums.run(a, b)
            second = _Sums(mix(word ^ np.uint64(0x14057B7EF767814F))).run(a, b)
            # Halves by which a line may meet one of the same length, of one word more and of one word less.
            halves = [n // 2, (n - 1) // 2]
            keys = []
            for half in halves:
                for side, value in ((1, sums.run(a, a + half)), (2, sums.run(b - half, b))):
                    keys.append(mix(value + half.astype(np.uint64) * np.uint64(4) + np.uint64(side)))
            count = np.where(n < NEAR_WORDS, 0, np.where(n % 2 == 0, 4, 2))
            grid = np.stack(keys, 1) if len(n) else np.zeros((0, 4), np.uint64)
            taken = np.arange(4)[None, :] < count[:, None]
            anchors = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count)].astype(np.int32)),
                                               pa.array(grid[taken].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(place.astype(np.int32)),
                 pa.array((mix(own) + n.astype(np.uint64)).view(np.int64)), pa.array(mix(second).view(np.int64)), anchors],
                names=["doc_id", "version", "line", "h1", "h2", "anchors"])


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """hash and place of the deleted word (-1: the line itself) for lines given as text."""
    for batch in batches:
        for at, data, offsets in text_pieces(batch, "words"):
            starts, ends, rows = spans(~ASCII_SPACE[data], offsets)
            word = stretch(running(_CODES[data]), starts, ends)
            n = np.bincount(rows, minlength=len(offsets) - 1)
            b = np.cumsum(n)
            a = b - n
            sums = _Sums(word)
            skip = np.arange(len(word))
            value = np.r_[sums.run(a, b), sums.without(a[rows], b[rows], skip)]
            row = np.r_[np.arange(len(n)), rows]
            size = np.r_[n, n[rows] - 1].astype(np.uint64)
            place = np.r_[np.full(len(n), -1), skip - a[rows]]
            take = pa.array(at + row)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).take(take) for i in range(3)),
                 pa.array((mix(value) + size).view(np.int64)), pa.array(place.astype(np.int32))],
                names=["doc_id", "version", "line", "variant", "place"])


def _hinted(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if is_small(df, 1_000_000) else df


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the lines ``wanted`` of each text, one space between them."""
    for batch in batches:
        row, lines, words = [], [], []
        for k, (text, places) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
            cut = (text or "").split("\n")
            for i in places:
                row.append(k)
                lines.append(i)
                words.append(b" ".join(cut[i].encode("utf-8").split()).decode("utf-8"))
        take = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(take), batch.column(1).take(take), pa.array(lines, pa.int32()), pa.array(words, pa.string())],
            names=["doc_id", "version", "line", "words"])


#: Where a line stands; the first of several is the least.
_KEYS = ["doc_id", "version", "line"]


def _place(*names: str):
    """A place that compares like the order of documents: those without an id come last."""
    doc, version, line = names or _KEYS
    return F.struct(F.col(doc).isNull().alias("last"), F.col(doc).alias("doc_id"), F.col(version).alias("version"), F.col(line).alias("line"))


def _same_document(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join by id and version, where no id is a value like others; ``right`` brings them as ``_d`` and ``_v``."""
    return left.join(right, left["doc_id"].eqNullSafe(right["_d"]) & (left["version"] == right["_v"]), how).drop("_d", "_v")


def _near(texts: DataFrame, distinct: DataFrame) -> DataFrame:
    """The place of a line (``me``) and of the earliest line that is one edit away and earlier (``near``)."""
    anchors = materialize(distinct.filter(F.size("anchors") > 0).select(*_KEYS, F.explode("anchors").alias("key")), "anchors")
    shared = anchors.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key")
    sifted = materialize(anchors.join(shared, "key", "left_semi").select(*_KEYS).distinct().groupBy("doc_id", "version").agg(
        F.collect_list("line").alias("wanted")), "sifted")
    named = sifted.select(F.col("doc_id").alias("_d"), F.col("version").alias("_v"), "wanted")
    words = materialize(_same_document(texts, _hinted(named), "inner").select("doc_id", "version", "text", "wanted").mapInArrow(
        _wanted, "doc_id long, version long, line int, words string").dropDuplicates(_KEYS), "words")
    variants = materialize(words.mapInArrow(
        _variants, "doc_id long, version long, line int, variant long, place int").withColumn("me", _place()).drop(*_KEYS), "variants")
    first = materialize(variants.groupBy("variant", "place").agg(F.min("me").alias("first"), F.count("*").alias("c")), "first")
    by_variant = first.groupBy("variant").agg(
        F.min(F.when(F.col("place") >= 0, F.col("first"))).alias("longer"), F.min(F.when(F.col("place") < 0, F.col("first"))).alias("whole"),
        F.sum("c").alias("c")).filter("c > 1").drop("c")
    met = variants.join(by_variant, "variant").join(first.select("variant", "place", "first"), ["variant", "place"])
    # A line lacks a word of a longer one, or the other way round, or both lack the word at the same place.
    other = F.when(F.col("place") < 0, F.col("longer")).otherwise(F.least("whole", "first"))
    pairs = met.withColumn("other", other).filter(F.col("other") < F.col("me")).select("me", "other").distinct()
    mine, theirs = (words.select(_place().alias(a), F.col("words").alias(b)) for a, b in (("me", "words"), ("other", "theirs")))
    both = pairs.join(mine, "me").join(theirs, "other")
    return both.filter(_one_edit(F.split("words", " "), F.split("theirs", " "))).groupBy("me").agg(F.min("other").alias("near"))


def _one_edit(a, b):
    """True when the word lists are at most one edit apart."""
    pair = F.zip_with(a, b, lambda x, y: ~F.coalesce(x == y, F.lit(False)))
    first = F.array_position(pair, F.lit(True)).cast("int")
    na, nb = F.size(a), F.size(b)

    def rest(words, n, skip):
        return F.slice(words, first + skip, F.greatest(n - first - skip + 1, F.lit(0)))

    return (F.when(first == 0, True).when(na == nb, rest(a, na, 1) == rest(b, nb, 1))
            .when(na == nb + 1, rest(a, na, 1) == rest(b, nb, 0)).when(nb == na + 1, rest(a, na, 0) == rest(b, nb, 1))
            .otherwise(False))


def _versions(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("version"), "text")


def _repeats(docs: DataFrame) -> DataFrame:
    """Every line that goes: its place (doc_id, version, line), the place that it repeats (``kept``), and edits."""
    text_batches(docs.sparkSession)
    texts = _versions(docs)
    lines = texts.mapInArrow(_described, "doc_id long, version long, line int, h1 long, h2 long, anchors array<long>")
    grouped = lines.groupBy("h1", "h2").agg(F.min(F.struct(_place().alias("at"), "anchors")).alias("first"), F.count("*").alias("c"))
    distinct = materialize(grouped.select("h1", "h2", "c", F.col("first.at").alias("first"), "first.anchors",
                                          *[F.col(f"first.at.{k}").alias(k) for k in _KEYS]), "distinct")
    near = materialize(_near(texts, distinct), "near")
    known = distinct.select("h1", "h2", "c", "first").join(_hinted(near.withColumnRenamed("me", "first")), "first", "left")
    known = materialize(known.filter("c > 1 or near is not null").select("h1", "h2", "first", "near"), "known")
    equal = F.when(F.col("first") < F.col("me"), F.col("first"))
    earlier = F.when(F.col("near") < F.col("first"), F.col("near"))
    out = lines.select(*_KEYS, "h1", "h2").join(_hinted(known), ["h1", "h2"]).withColumn("me", _place()).withColumn(
        "kept", F.least(equal, earlier)).filter("kept is not null")
    return out.select(*_KEYS, "kept", F.when(F.col("kept") == F.col("first"), 0).otherwise(1).alias("edits"))


def repeats(docs: DataFrame) -> DataFrame:
    """Every line that goes: doc_id, line, the earliest line that it repeats (kept_doc_id, kept_line), and edits."""
    return _repeats(docs).select("doc_id", "version", "line", F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.line").alias("kept_line"),
                                 "edits").distinct().drop("version")


def _one_row_each(whole: DataFrame) -> DataFrame:
    """One row (doc_id, version, row) of every document; only the rows of repeated ones are shuffled."""
    more = whole.groupBy("doc_id", "version").agg(F.count("*").alias("c")).filter("c > 1")
    more = materialize(more.select(F.col("doc_id").alias("_d"), F.col("version").alias("_v")), "repeated")
    if more.isEmpty():
        return whole
    once = _same_document(whole, _hinted(more), "left_semi").dropDuplicates(["doc_id", "version"])
    return _same_document(whole, _hinted(more), "left_anti").unionByName(once)


def apply(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines that go taken out of ``text``, one row of each document, without those of which nothing is left."""
    gone = materialize(_repeats(docs).groupBy(F.col("doc_id").alias("_d"), F.col("version").alias("_v")).agg(
        F.collect_set("line").alias("gone")), "gone")
    # The columns of a document travel in one, where no name of theirs can clash.
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("version"))
    joined = _same_document(_one_row_each(whole), _hinted(gone), "left")
    place = F.transform(F.split("row.text", "\n", -1), lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    left = F.array_join(F.transform(F.filter(place, lambda p: ~F.array_contains("gone", p["i"])), lambda p: p["x"]), "\n")
    joined = joined.withColumn("left", F.when(F.col("gone").isNotNull(), left))
    kept = joined.filter(F.col("gone").isNull() | F.col("left").rlike(r"[^\x20\x09-\x0D]"))
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.col("left"))
    return kept.select(*[(text if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns])
