"""N-gram Jaccard join with set-relation skipping.

A document's set holds the hashes of its distinct five-word shingles. Two documents link when
``100 * intersection >= 75 * union``. The join finds the connected components of all links, exactly:

1. Equal sets are one class (128-bit digest); the class is joined once, by its smallest id.
2. Every set lists its prefix, rare shingles first, in an inverted index: sets that link share a shingle of their
   prefixes. Shingles that occur in one set only leave the index at once. The order uses counts of common shingles;
   any order gives the same links.
3. Answer-level skipping. In every index list each set is compared with one leader of its size class only, and takes
   over the leader's answers (its component) when the two are similar enough. A list whose sets all have the same
   answers is skipped from then on, so a group of near copies costs one comparison for each member, not for each pair.
   A second pass moves the class bounds by half a class.
4. Index-level skipping. What is left of the lists is cut into blocks by set size and position. Two blocks of a list
   are read against each other only when sizes and positions leave room for the intersection that a link needs, and
   their answers differ. Pairs of entries then pass the same test exactly, and a count of shared prefix shingles
   bounds the intersection before full sets are read.
5. The remaining pairs are compared: one for each pair of components first, then those whose components still differ.

Nothing is capped. Full sets are computed again from the texts of the documents that are compared, and only those.

Hashes are 64 bits wide, index keys 48 bits (a clash there only adds a comparison).

Defined cases: a null or blank text has an empty set and links with nothing; fewer than five words are one shingle;
rows with equal id and text are one document and come back once for each row; a null id is given back with its count
and a null component unless an equal set has an id; an empty table gives an empty result; further columns, whatever
their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kbvec.llm.components import components
from kbvec.llm.tables import text_batches
from kbvec.llm.textarrays import ASCII_SPACE, codes, mix, running, spans, stretch, text_pieces, windows
from kbvec.session import is_small, materialize

WORDS = 5
#: Rows of the table of common shingles that orders the index; more or fewer change costs, not links.
COMMON_ROWS = 1 << 18
#: A shingle counts as common when so many of the texts that a task counts together (up to so many shingles) hold it.
COMMON_TEXTS, COUNTED_TOGETHER = 3, 1 << 21
#: A set is compared with the leader of its lists when they share this part of its size at least there; whom that
#: leaves out, the last step compares.
LEADER_SHARE = 0.04
_CODES = codes(11)


def _sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """row and hash of the distinct shingles of a piece of texts, ordered by both."""
    starts, ends, rows = spans(~ASCII_SPACE[data], offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    value, at = windows(stretch(running(_CODES[data]), starts, ends), rows, WORDS)
    row = rows[at]
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.r_[True, (row[1:] != row[:-1]) | (value[1:] != value[:-1])]
    return row[new], value[new]


def _digests(row: np.ndarray, value: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Set size and two sums of hashes for every row of the piece."""
    size = np.bincount(row, minlength=n_rows).astype(np.int64)
    sums = []
    for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        total = np.r_[np.zeros(1, np.uint64), np.cumsum(mix(value ^ np.uint64(salt)), dtype=np.uint64)]
        ends = np.cumsum(size)
        sums.append((total[ends] - total[ends - size]).view(np.int64))
    return size, sums[0], sums[1]


def _common(values: list[np.ndarray]) -> pa.RecordBatch:
    """Rows (id null, hash in d1, count in n) for the shingles that several of these texts hold."""
    value, count = np.unique(np.concatenate(values), return_counts=True)
    value, count = value[count >= COMMON_TEXTS], count[count >= COMMON_TEXTS]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.ones(len(value), bool)), pa.nulls(len(value), pa.int64()), pa.array(count.astype(np.int64)),
         pa.array(value.view(np.int64)), pa.array(np.zeros(len(value), np.int64))],
        names=["common", "doc_id", "n", "d1", "d2"])


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every document, and rows for the shingles that are common among texts seen together."""
    seen: list[np.ndarray] = []
    for batch in batches:
        ids = batch.column(0)
        for at, data, offsets in text_pieces(batch):
            row, value = _sets(data, offsets)
            size, d1, d2 = _digests(row, value, len(offsets) - 1)
            seen.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(size), bool)), ids.slice(at, len(size)), pa.array(size), pa.array(d1),
                 pa.array(d2)], names=["common", "doc_id", "n", "d1", "d2"])
            if sum(map(len, seen)) >= COUNTED_TOGETHER:
                yield _common(seen)
                seen = []
    if seen:
        yield _common(seen)


def _prefixes(common):
    """Index entries of the sets of a task; equal sets of a task are listed once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, level = common.value
        listed: set[tuple[int, int]] = set()
        for batch in batches:
            ids = batch.column(0).fill_null(0).to_numpy()
            there = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            for at, data, offsets in text_pieces(batch):
                row, value = _sets(data, offsets)
                rows = len(offsets) - 1
                size, d1, d2 = _digests(row, value, rows)
                fresh = (size > 0) & there[at:at + rows]
                for i in np.flatnonzero(fresh):
                    key = (int(d1[i]), int(d2[i]))
                    fresh[i] = key not in listed
                    listed.add(key)
                row, value = row[fresh[row]], value[fresh[row]]
                place = np.minimum(np.searchsorted(known, value), max(len(known) - 1, 0))
                how = np.where(known[place] == value, level[place], 0) if len(known) else np.zeros(len(value), np.int8)
                order = np.lexsort((value, how, row))
                row, value = row[order], value[order]
                first = np.cumsum(size * fresh) - size * fresh
                pos = np.arange(len(row)) - first[row]
                keep = pos < size[row] - (3 * size[row] + 3) // 4 + 1
                row, value, pos = row[keep], value[keep], pos[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((value >> np.uint64(16)).view(np.int64)), pa.array(ids[at + row]),
                     pa.array(pos.astype(np.int32))], names=["token", "doc_id", "pos"])
    return run


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (x, y, tx, ty) of a task that link, by the sets of both texts."""
    for batch in batches:
        for at, data, offsets in text_pieces(batch, "tx"):
            part = batch.slice(at, len(offsets) - 1)
            row, value = _sets(data, offsets)
            [(_, other, other_offsets)] = text_pieces(part, "ty", 1 << 62)
            row_y, value_y = _sets(other, other_offsets)
            total = np.bincount(np.r_[row, row_y], minlength=len(part))
            rows, values = np.r_[row, row_y], np.r_[value, value_y]
            order = np.lexsort((values, rows))
            rows, values = rows[order], values[order]
            same = (rows[1:] == rows[:-1]) & (values[1:] == values[:-1])
            shared = np.bincount(rows[1:][same], minlength=len(part))
            yield part.select(["x", "y"]).filter(pa.array((7 * shared >= 3 * total) & (total > 0)))


def _needed(nx, ny) -> Column:
    """Smallest intersection of a link of sets of these sizes."""
    return F.ceil((nx + ny) * 3 / 7 - 1e-9)


def _hinted(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if is_small(df, 1_000_000) else df


def _compared(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (x, y) that link, by the full sets of their texts.

    A text of ``x`` is shuffled once, to the text of its ``y``; a ``y`` with very many partners is one row, whose
    partners' side of the join can be split.
    """
    ys = _hinted(pairs.select(F.col("y").alias("doc_id")).distinct())
    right = materialize(texts.join(ys, "doc_id").groupBy(F.col("doc_id").alias("y")).agg(
        F.any_value("text").alias("ty")), "leaders")
    left = texts.join(_hinted(pairs.select(F.col("x").alias("doc_id"), "y")), "doc_id")
    both = left.select(F.col("doc_id").alias("x"), "y", F.col("text").alias("tx")).join(right, "y")
    return both.select("x", "y", "tx", "ty").mapInArrow(_linked, "x long, y long")


class _Links:
    """Links found so far and the components they make."""

    def __init__(self, entries: DataFrame):
        self.entries, self.links, self.labels = entries, None, None

    def add(self, links: DataFrame) -> None:
        found = materialize(links, "found")
        self.links = found if self.links is None else self.links.union(found)
        self.labels = materialize(components(self.links, "x", "y"), "components")

    def component(self, df: DataFrame, key: str, name: str) -> DataFrame:
        """``df`` with the component of the id in ``key``."""
        if self.labels is None:
            return df.withColumn(name, F.col(key))
        labels = self.labels.select(F.col("id").alias(key), F.col("component").alias(name))
        return df.join(labels, key, "left").withColumn(name, F.coalesce(name, key))


def _size_class(n, shift: float = 0.0) -> Column:
    return F.floor(F.log(n.cast("double")) / float(np.log(4 / 3)) + shift).cast("int")


def _leaders(entries: DataFrame, shift: float) -> DataFrame:
    """For every set, the leader it shares most lists with, where their components differ."""
    keyed = entries.withColumn("k", _size_class(F.col("n"), shift))
    lead = keyed.groupBy("token", "k").agg(F.min(F.struct("rep", "comp")).alias("lead"),
                                           F.min("comp").alias("low"), F.max("comp").alias("high"))
    lead = lead.filter("low <> high").select("token", "k", "lead")
    met = keyed.join(lead, ["token", "k"]).filter("comp <> lead.comp").groupBy(
        F.col("rep").alias("x"), F.col("lead.rep").alias("y")).agg(F.count("*").alias("c"), F.first("n").alias("n"))
    met = met.filter(F.col("c") >= F.col("n") * LEADER_SHARE)
    return met.groupBy("x").agg(F.max(F.struct("c", (-F.col("y")).alias("o"), "y")).alias("best")).select("x", "best.y")


def _block_pairs(entries: DataFrame) -> DataFrame:
    """Pairs of sets (x < y) of different components that pass the bounds on size, position and shared prefix."""
    cut = entries.withColumn("s", _size_class(F.col("n"))).withColumn("p", F.floor(16 * F.col("pos") / F.col("n")))
    block = cut.groupBy("token", "s", "p").agg(
        F.min("n").alias("n0"), F.max("n").alias("n1"), F.max(F.col("n") - F.col("pos")).alias("room"),
        F.min("comp").alias("c0"), F.max("comp").alias("c1"))
    left, right = (block.select("token", *[F.col(c).alias(f"{c}_{i}") for c in block.columns[1:]]) for i in (1, 2))
    fits = ((F.col("n0_1") * 3 <= F.col("n1_2") * 4) & (F.col("n0_2") * 3 <= F.col("n1_1") * 4)
            & (F.least("room_1", "room_2") >= _needed(F.col("n0_1"), F.col("n0_2")))
            & ~((F.col("c0_1") == F.col("c1_1")) & (F.col("c0_2") == F.col("c1_2")) & (F.col("c0_1") == F.col("c0_2"))))
    met = left.join(right, "token").filter(fits).select("token", "s_1", "p_1", "s_2", "p_2")
    e = [cut.select("token", *[F.col(c).alias(f"{c}_{i}") for c in ("s", "p", "rep", "n", "pos", "comp")]) for i in (1, 2)]
    rows = met.join(e[0], ["token", "s_1", "p_1"]).join(e[1], ["token", "s_2", "p_2"]).filter(
        (F.col("rep_1") < F.col("rep_2")) & (F.col("comp_1") != F.col("comp_2"))
        & (F.least(F.col("n_1") - F.col("pos_1"), F.col("n_2") - F.col("pos_2")) >= _needed(F.col("n_1"), F.col("n_2"))))
    # The bound on the whole intersection by what the two prefixes share: the prefix that ends first holds all
    # shared shingles up to its end, so no more than the other shingles of its set can follow.
    found = rows.select(F.col("rep_1").alias("x"), F.col("rep_2").alias("y"), F.col("n_1").alias("nx"),
                        F.col("n_2").alias("ny")).distinct()
    listed = entries.groupBy("rep").agg(F.collect_list("token").alias("tokens"))
    both = found.join(listed.select(F.col("rep").alias("x"), F.col("tokens").alias("tx")), "x").join(
        listed.select(F.col("rep").alias("y"), F.col("tokens").alias("ty")), "y")
    after = F.ceil(F.greatest("nx", "ny") * 3 / 4) - 1
    return both.withColumn("c", F.size(F.array_intersect("tx", "ty"))).filter(
        F.col("c") + after >= _needed(F.col("nx"), F.col("ny"))).select("x", "y", "c")


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and class_id (smallest id with an equal set) of every row of ``docs``."""
    spark = docs.sparkSession
    text_batches(spark)
    texts = docs.select("doc_id", "text")
    described = materialize(texts.mapInArrow(
        _describe, "common boolean, doc_id long, n long, d1 long, d2 long"), "described")
    each = described.filter("not common")
    top = described.filter("common").groupBy("d1").agg(F.sum("n").alias("n")).orderBy(
        F.desc("n"), "d1").limit(COMMON_ROWS).toPandas()
    known = top["d1"].to_numpy(np.int64).view(np.uint64)
    level = np.log2(np.maximum(top["n"].to_numpy(np.int64), 1)).astype(np.int8) + np.int8(1)
    order = np.argsort(known)
    common = spark.sparkContext.broadcast((known[order], level[order]))

    # Only sets that several documents have need a class; counts are summed inside the tasks first.
    classes = materialize(each.filter("n > 0").groupBy("d1", "d2", "n").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("c")).filter("c > 1").drop("c"), "classes")
    members = materialize(each.join(_hinted(classes), ["d1", "d2", "n"], "left").select(
        "doc_id", "n", F.when(F.col("n") > 0, F.coalesce("least", "doc_id")).alias("rep")), "members")

    entries = texts.mapInArrow(_prefixes(common), "token long, doc_id long, pos int")
    shared = entries.withColumn("c", F.count("*").over(Window.partitionBy("token"))).filter("c > 1").drop("c")
    reps = members.filter("doc_id is not null and n > 0").select("doc_id", "rep", F.col("n").cast("int")).distinct()
    lists = materialize(shared.join(reps, "doc_id").select("token", "rep", "n", "pos").distinct(), "lists")

    links = _Links(lists)
    for shift in (0.0, 0.5):
        now = links.component(lists, "rep", "comp")
        links.add(_compared(texts, materialize(_leaders(now, shift), "leaders")))
    now = links.component(lists, "rep", "comp")
    mixed = now.groupBy("token").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).filter("a <> b")
    left = materialize(now.join(mixed.select("token"), "token"), "left")
    pairs = materialize(_block_pairs(left), "pairs")
    for first in (True, False):
        open_pairs = links.component(links.component(pairs, "x", "cx"), "y", "cy").filter("cx <> cy")
        if first:
            best = open_pairs.groupBy(F.least("cx", "cy").alias("a"), F.greatest("cx", "cy").alias("b")).agg(
                F.max(F.struct("c", "x", "y")).alias("m"))
            open_pairs = best.select("m.x", "m.y")
        links.add(_compared(texts, materialize(open_pairs.select("x", "y"), "open")))
    out = links.component(members, "rep", "component")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                      F.coalesce("component", "doc_id").alias("component_id"),
                      F.coalesce("rep", "doc_id").alias("class_id"))
