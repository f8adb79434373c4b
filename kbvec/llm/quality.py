"""Quality by ordinal cumulative-link regression on graded ratings.

The chance that a text's grade is at least k is ``sigmoid(w . x - t_k)``: one weight for each hashed feature, shared by
all grades, and ordered thresholds. Features are the words of a text (lower case, without punctuation; present or
not) and the shares of words in capitals, with symbols, that repeat the word before, and that are new to the text,
each as steps. Expected grade and tail probabilities follow; a text is kept when its top grade has at least even
odds.

The model is fitted on a bounded sample of the labelled texts (``FIT_ROWS``, by a hash of the id); equal texts count
once. Only features that are more frequent below some grade than above, by ``LEAST_Z`` standard errors, get a weight:
faults lower the grade, and the many ordinary words of a long text do not make up for them. All texts are scored
whole, where they are: there is no shuffle of texts.

Grades from the labels: 0 toxic, 1 of low quality, 2 neither.

Defined cases: a null or blank text has no features; a label without quality is not used, a null toxic flag is 0;
of several labels of a document the lowest grade counts; with no labels, or labels of one grade, every text gets the
top grade, or that one; repeated rows and null ids give a row each; an empty table gives an empty result; further
columns, whatever their names, are ignored by ``score``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kbvec.llm.tables import text_batches
from kbvec.llm.textarrays import ASCII_SPACE, codes, running, spans, stretch, text_pieces
from kbvec.session import broadcast_if_small, is_small, materialize

FIT_ROWS = 12_000
LEAST_TEXTS, LEAST_Z = 4, 4.5
#: Probability of the top grade from which a text is kept.
EVEN = 0.5
STEPS = np.array([0.005, 0.02, 0.05, 0.1, 0.2, 0.4, 0.6, 0.8])
_CODES = codes(23)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "!|*$%&#@^~<>_=+\\{}[]"]] = True


def _per_row(flags: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, weights=flags, minlength=n)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """row and hash of the distinct features of a piece of texts, by row."""
    n = len(offsets) - 1
    starts, ends, rows = spans(~ASCII_SPACE[data], offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    after_c3 = np.r_[False, data[:-1] == 0xC3]
    upper = ((data >= 65) & (data <= 90)) | (after_c3 & (data >= 0x80) & (data <= 0x9E))
    lower = ((data >= 97) & (data <= 122)) | (after_c3 & (data >= 0x9F) & (data <= 0xBF))
    kept = _LETTER[data]
    total = {name: np.r_[np.zeros(1, np.int32), np.cumsum(flag, dtype=np.int32)] for name, flag in
             (("upper", upper), ("lower", lower), ("symbol", _SYMBOL[data]), ("kept", kept))}
    count = {name: t[ends] - t[starts] for name, t in total.items()}
    # The words without their punctuation, hashed over the bytes that are left.
    plain = data[kept].copy()
    plain[(after_c3 & upper)[kept]] += 0x20
    sums = running(_CODES[plain])
    word = stretch(sums, total["kept"][starts], total["kept"][ends])
    has = count["kept"] > 0
    words = np.bincount(rows, minlength=n).astype(float)
    same = np.r_[False, (word[1:] == word[:-1]) & (rows[1:] == rows[:-1])]
    order = np.lexsort((word, rows))
    r, w = rows[order], word[order]
    new = np.r_[True, (r[1:] != r[:-1]) | (w[1:] != w[:-1])]
    shares = np.stack([
        _per_row((count["upper"] >= 2) & (count["lower"] == 0), rows, n), _per_row(count["symbol"] > 0, rows, n),
        _per_row(same, rows, n), words - np.bincount(r[new], minlength=n)]) / np.maximum(words, 1)
    kind, row, step = np.nonzero(shares[:, :, None] >= STEPS)
    # Words and shares have codes of different ranges: shares stand for the first few numbers.
    has_word = has[order] & new
    return (np.r_[r[has_word], row],
            np.r_[w[has_word] | np.uint64(1 << 63), (kind * len(STEPS) + step).astype(np.uint64)])


@dataclass
class Ordinal:
    """Feature hashes (sorted), their weights, and the thresholds of grades 1, 2, ..."""

    known: np.ndarray
    weight: np.ndarray
    thresholds: np.ndarray

    def tails(self, row: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        """P(grade >= k) of ``n`` texts, for k = 1, 2, ..."""
        sums = np.zeros(n)
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, value), len(self.known) - 1)
            hit = self.known[at] == value
            sums = np.bincount(row[hit], weights=self.weight[at[hit]], minlength=n)
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - sums[:, None], -40, 40)))


def fit(row: np.ndarray, value: np.ndarray, grade: np.ndarray, top: int, rounds: int = 200) -> Ordinal:
    """Fit by gradient steps scaled for each weight on the negative log-likelihood with a small ridge."""
    n = len(grade)
    if not n or len(np.unique(grade)) < 2:
        level = int(grade[0]) if n else top
        return Ordinal(np.zeros(0, np.uint64), np.zeros(0), np.where(np.arange(1, top + 1) <= level, -20.0, 20.0))
    known, inverse, count = np.unique(value, return_inverse=True, return_counts=True)
    z = np.zeros(len(known))
    for k in range(1, top + 1):
        share = float((grade >= k).mean())
        if 0 < share < 1:
            got = np.bincount(inverse, weights=(grade >= k)[row], minlength=len(known))
            z = np.maximum(z, (count * share - got) / np.sqrt(count * share * (1 - share)))
    use = (count >= LEAST_TEXTS) & (z >= LEAST_Z)
    number = np.cumsum(use) - 1
    keep = use[inverse]
    row, col, known = row[keep], number[inverse[keep]], known[use]
    weight = np.zeros(len(known))
    tails = np.array([np.clip((grade >= k).mean(), 1e-3, 1 - 1e-3) for k in range(1, top + 1)])
    # Thresholds as a first one and positive steps keep their order.
    first = -np.log(tails / (1 - tails))
    shape = np.r_[first[0], np.log(np.maximum(np.diff(first), 1e-2))]
    scale = np.full(len(weight) + top, 1e-8)
    for i in range(rounds):
        thresholds = shape[0] + np.r_[0.0, np.cumsum(np.exp(shape[1:]))]
        sums = np.bincount(row, weights=weight[col], minlength=n) if len(row) else np.zeros(n)
        p = 1 / (1 + np.exp(np.clip(thresholds[None, :] - sums[:, None], -40, 40)))
        edge = np.c_[np.ones(n), p, np.zeros(n)]
        chance = np.maximum(edge[np.arange(n), grade] - edge[np.arange(n), grade + 1], 1e-12)
        slope = np.c_[np.zeros(n), p * (1 - p), np.zeros(n)]
        lower, upper = slope[np.arange(n), grade], slope[np.arange(n), grade + 1]
        by_sum = -(lower - upper) / chance / n
        by_threshold = np.array([(np.where(grade == k, lower, 0) - np.where(grade == k - 1, upper, 0)) @ (1 / chance)
                                 for k in range(1, top + 1)]) / n
        g_weight = (np.bincount(col, weights=by_sum[row], minlength=len(weight)) if len(row) else np.zeros(0)) + 1e-5 * weight
        g_shape = np.r_[by_threshold.sum(), [by_threshold[j:].sum() * np.exp(shape[j]) for j in range(1, top)]]
        g = np.r_[g_weight, g_shape]
        scale = 0.9 * scale + 0.1 * g * g if i else g * g + 1e-12
        step = 0.1 / (1 + i / 100) * g / np.sqrt(scale + 1e-12)
        weight -= step[:len(weight)]
        shape -= step[len(weight):]
    return Ordinal(known, weight, shape[0] + np.r_[0.0, np.cumsum(np.exp(shape[1:]))])


def grades(labels: DataFrame) -> DataFrame:
    """doc_id and grade: 0 toxic, 1 of low quality, 2 neither."""
    grade = F.when(F.coalesce("toxic", F.lit(0)) == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    return labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min(grade).alias("grade"))


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, data, offsets in text_pieces(batch):
            row, value = features(data, offsets)
            order = np.lexsort((value, row))
            ends = np.cumsum(np.bincount(row, minlength=len(offsets) - 1))
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)),
                                             pa.array(value[order].view(np.int64)))
            part = batch.slice(at, len(ends)).select(["doc_id", "grade"])
            yield pa.RecordBatch.from_arrays([*part.columns, lists], names=["doc_id", "grade", "features"])


def train(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, top: int = 2) -> Ordinal:
    """A model from at most about ``rows`` labelled texts."""
    text_batches(docs.sparkSession)
    rated = grades(labels)
    total = rated.count()
    nothing = fit(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), top)
    if not total:
        return nothing
    part = min(1.0, rows / total)
    sample = rated.filter(F.pmod(F.xxhash64("doc_id", F.lit(41)), F.lit(1 << 20)) < F.lit(int(part * (1 << 20)) + 1))
    sample = F.broadcast(sample) if is_small(sample, 4 * FIT_ROWS) else sample
    described = materialize(docs.select("doc_id", "text").join(sample, "doc_id").mapInArrow(
        _described, "doc_id long, grade int, features array<bigint>"), "described")
    # Equal texts are listed once.
    texts = materialize(described.groupBy(F.xxhash64("features").alias("a"), F.xxhash64(F.lit(1), "features").alias("b"), "grade").agg(
        F.min("doc_id").alias("doc_id"), F.any_value("features").alias("features")).select("doc_id", "grade", "features"), "texts")
    each = texts.select("doc_id", "grade", F.explode("features").alias("feature"))
    held = {r["grade"]: r["count"] for r in texts.groupBy("grade").count().collect()}
    if not held:
        return nothing
    # Only what ``fit`` gives a weight reaches the driver.
    chosen = broadcast_if_small(materialize(_telling(each, held, top), "features"))
    pairs = each.join(chosen, "feature").select("doc_id", "feature").orderBy("doc_id", "feature").toArrow()
    rated = texts.select("doc_id", "grade").orderBy("doc_id", "grade").toArrow()
    ids = rated["doc_id"].to_numpy()
    return fit(np.searchsorted(ids, pairs["doc_id"].to_numpy()), pairs["feature"].to_numpy().view(np.uint64),
               rated["grade"].to_numpy().astype(np.int64), top)


def _telling(each: DataFrame, held: dict[int, int], top: int) -> DataFrame:
    """The features that ``fit`` gives a weight, by how many texts of each grade hold them."""
    total, z = sum(held.values()), [F.lit(0.0)]
    count = F.count("*")
    for k in range(1, top + 1):
        share = sum(n for g, n in held.items() if g >= k) / total
        if 0 < share < 1:
            got = F.sum((F.col("grade") >= k).cast("long"))
            z.append((count * share - got) / F.sqrt(count * share * (1 - share)))
    counted = each.groupBy("feature").agg(count.alias("n"), F.greatest(*z, F.lit(0.0)).alias("z"))
    return counted.filter((F.col("n") >= LEAST_TEXTS) & (F.col("z") >= LEAST_Z)).select("feature")


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in text_pieces(batch):
                n = len(offsets) - 1
                tails = model.value.tails(*features(data, offsets), n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, n), pa.array(tails.sum(axis=1)), pa.array(tails[:, 0]),
                     pa.array(tails[:, -1]), pa.array(tails[:, -1] >= EVEN)],
                    names=["doc_id", "expected_grade", "p_not_lowest", "p_top", "keep"])
    return run


def score(docs: DataFrame, model: Ordinal) -> DataFrame:
    """doc_id, expected_grade, P(grade > 0), P(top grade) and keep, for every row."""
    text_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(
        _scored(sent), "doc_id long, expected_grade double, p_not_lowest double, p_top double, keep boolean")


def kept(docs: DataFrame, model: Ordinal) -> DataFrame:
    """The rows of ``docs`` that the model keeps, with their own columns."""
    text_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for at, data, offsets in text_pieces(batch):
                tails = sent.value.tails(*features(data, offsets), len(offsets) - 1)
                yield batch.slice(at, len(tails)).filter(pa.array(tails[:, -1] >= EVEN))
    return docs.mapInArrow(run, docs.schema)
