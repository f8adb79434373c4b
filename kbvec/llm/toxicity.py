r"""Toxicity: Levenshtein automata intersected with a trie of learnt terms, and a score of each hit's context.

1. A bounded sample of the labelled texts (``FIT_TOXIC`` toxic and ``FIT_CLEAN`` other ones, by a hash of the id, none
   of them held out) teaches the lexicon: words, and stems that open words, which are far more frequent in toxic texts.
   Of texts that share one of two random shingles, one counts, so groups of copies teach no words of their own.
2. The terms form a trie. Walking all words over it, with one edit allowed from five letters and two from nine
   (letters replaced, added, missing or swapped), is one deterministic automaton: its states are sets of (trie node,
   edits made). All words of a batch walk at once; most leave after two or three letters. Runs of one letter are cut to
   two, and one symbol inside a word is a letter of it, so ``stuuupid`` and ``st*pid`` are one edit away.
3. A misspelling that clean sample texts hold as well is an ordinary word and no hit.
4. Around a hit its context is scored: a hit between quotation marks, and one whose neighbours are words that in the
   sample stand beside hits of clean texts, are counted apart from plain ones.
5. A logistic regression on a document's plain, misspelt and quoted hits (each by its term's weight, which follows from
   the odds of the term) and their share of its words gives the score. It is fitted near given weights, so that few
   labels do not mislead it.

Labels, language, source and id are no input of a score. All texts are scored whole, where they are, without a shuffle.

Defined cases: null and empty texts have the score of a text without hits; a document with several labels is toxic if
one of them says so; a null label is none; rows without an id are not held out and teach nothing; repeated rows give a
row each; without labels, or without terms that stand out, every text has the same low score; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kbvec.llm.tables import text_batches
from kbvec.llm.textarrays import ASCII_SPACE, codes, mix, running, spans, stretch, text_pieces, windows
from kbvec.session import broadcast_if_small, materialize

#: Bounds of the sample; a longer text is not in it.
FIT_TOXIC, FIT_CLEAN, FIT_BYTES = 4_000, 8_000, 1 << 20
#: Letters of a stem; log-likelihood ratio, toxic texts and terms from which, and up to which, terms are taken.
STEM, LEAST_GAIN, LEAST_TEXTS, MOST_TERMS = (3, 9), 24.0, 4, 400
#: Log odds from which a term is taken, and from which it counts whole.
LEAST_ODDS, FULL_ODDS = 2.0, 4.0
THRESHOLD = 0.7
#: Words on either side, and code points of a quotation around a hit.
NEIGHBOURS, QUOTE = 3, 80
OPENING, CLOSING = "\"'“”„«»‘’‹›", "\"'“”«»’‹›"
#: Weights near which the regression stays: constant, plain, misspelt and quoted hits, their share of the words.
PRIOR, RIDGE = np.array([-4.0, 3.0, 1.5, 0.2, 0.5]), 0.02

_BMP = 1 << 16
_LETTER = np.zeros(_BMP, bool)
_FOLD = np.arange(_BMP, dtype=np.uint32)
for _c in range(_BMP):
    _s = chr(_c)
    if _s.isalnum():
        _LETTER[_c] = True
        if len(_s.lower()) == 1:
            _FOLD[_c] = ord(_s.lower())
_INNER = np.zeros(_BMP, bool)
_INNER[[ord(c) for c in "@$*#"]] = True
_SHINGLES = codes(37)


@dataclass
class Words:
    """Folded code points of the words of a piece, where each starts and ends, its row and its place in ``points``."""

    letters: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    at: np.ndarray
    until: np.ndarray
    points: np.ndarray
    bounds: np.ndarray
    sums: np.ndarray = field(init=False)

    def __post_init__(self):
        self.sums = running(mix(self.letters.astype(np.uint64) + np.uint64(0x51ED270B)))

    def hashes(self, which, length=None) -> np.ndarray:
        """Hashes of words, or of their first letters."""
        ends = self.ends[which] if length is None else self.starts[which] + length
        return stretch(self.sums, self.starts[which], ends)

    def string(self, word: int, length: int | None = None) -> str:
        end = self.ends[word] if length is None else self.starts[word] + length
        return "".join(map(chr, self.letters[self.starts[word]:end]))


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
    low = np.where(points < _BMP, points, 0)
    inside = _LETTER[low]
    folded = _FOLD[low]
    first = np.zeros(len(points) + 1, bool)
    first[bounds] = True
    inner = _INNER[low]
    inner[1:] &= inside[:-1] & ~first[1:-1]
    inner[:1] = False
    inner[:-1] &= inside[1:] & ~first[1:-1]
    inner[-1:] = False
    inside = inside | inner
    starts, ends, rows = spans(inside, bounds)
    kept = inside.copy()
    kept[2:] &= (folded[2:] != folded[1:-1]) | (folded[1:-1] != folded[:-2]) | ~inside[1:-1] | ~inside[:-2]
    place = np.r_[0, np.cumsum(kept)]
    return Words(folded[kept], place[starts], place[ends], rows, starts, ends, points, bounds)


def _allowed(length: int) -> int:
    return 0 if length < 5 else 1 if length < 9 else 2


@dataclass
class Automaton:
    """All strings within the allowed edits of a term, or that a stem opens; made from (term, is a stem)."""

    terms: list[tuple[str, bool]]
    letters: np.ndarray = field(init=False)
    table: np.ndarray = field(init=False)
    #: For each state: edits (9: none) and term, for words that end here and for words that may go on.
    whole: np.ndarray = field(init=False)
    opened: np.ndarray = field(init=False)

    def __post_init__(self):
        children, most, ends = [{}], [0], [[]]
        for number, (term, stem) in enumerate(self.terms):
            node, path = 0, [0]
            for c in term:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    most.append(0)
                    ends.append([])
                node = children[node][c]
                path.append(node)
            for p in path:
                most[p] = max(most[p], _allowed(len(term)))
            ends[node].append((number, stem, _allowed(len(term))))
        letters = sorted({c for term, _ in self.terms for c in term})
        self.letters = np.array([ord(c) for c in letters], np.uint32)

        def closed(states):
            """With missing letters added, and only the fewest edits of a node."""
            least, todo = {}, list(states)
            while todo:
                node, edits, held = todo.pop()
                if edits > most[node] or least.get((node, held), 9) <= edits:
                    continue
                least[node, held] = edits
                if held is None:
                    todo += [(child, edits + 1, None) for child in children[node].values()]
            return frozenset((node, edits, held) for (node, held), edits in least.items())

        def step(states, c):
            out = []
            for node, edits, held in states:
                if held is not None:
                    # The letter that was skipped in a swap has to come now.
                    if held == c:
                        out.append((node, edits, None))
                    continue
                if c in children[node]:
                    out.append((children[node][c], edits, None))
                if edits < most[node]:
                    out.append((node, edits + 1, None))
                    for x, child in children[node].items():
                        if x != c:
                            out.append((child, edits + 1, None))
                            if c in children[child]:
                                out.append((children[child][c], edits + 1, x))
            return closed(out)

        start = closed([(0, 0, None)])
        number, order, table = {frozenset(): 0, start: 1}, [frozenset(), start], []
        for states in order:
            row = []
            for c in [None, *letters]:
                after = step(states, c)
                if after not in number:
                    number[after] = len(order)
                    order.append(after)
                row.append(number[after])
            table.append(row)
        self.table = np.array(table, np.int32)
        self.whole, self.opened = (np.tile(np.array([9, -1], np.int32), (len(order), 1)) for _ in range(2))
        for i, states in enumerate(order):
            for node, edits, held in states:
                for term, stem, allowed in ends[node] if held is None else []:
                    if edits <= allowed:
                        for best in (self.whole, self.opened) if stem else (self.whole,):
                            if (edits, term) < (best[i, 0], best[i, 1] if best[i, 1] >= 0 else 1 << 30):
                                best[i] = edits, term

    def hits(self, found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """word, term, edits and letters read, of every word within the edits of a term."""
        n = len(found.starts)
        edits, term, length = np.full(n, 9, np.int32), np.full(n, -1, np.int32), np.zeros(n, np.int64)
        if not self.terms or not n:
            return (np.zeros(0, np.int64),) * 4
        at = np.minimum(np.searchsorted(self.letters, found.letters), len(self.letters) - 1)
        symbol = np.where(self.letters[at] == found.letters, at + 1, 0)
        size = found.ends - found.starts
        alive, state, place = np.flatnonzero(size > 0), None, 0
        state = np.ones(len(alive), np.int32)
        while len(alive):
            state = self.table[state, symbol[found.starts[alive] + place]]
            live = state > 0
            alive, state = alive[live], state[live]
            place += 1
            last = size[alive] == place
            got = np.where(last[:, None], self.whole[state], self.opened[state])
            better = got[:, 0] < edits[alive]
            to = alive[better]
            edits[to], term[to], length[to] = got[better, 0], got[better, 1], place
            alive, state = alive[~last], state[~last]
        hit = np.flatnonzero(term >= 0)
        return hit, term[hit], edits[hit], length[hit]


@dataclass
class Model:
    automaton: Automaton
    #: Weight of each term of the automaton.
    power: np.ndarray
    #: Hashes (sorted) of misspellings that are ordinary words, and of words beside hits of clean texts.
    ordinary: np.ndarray
    reporting: np.ndarray
    weights: np.ndarray


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def _quoted(found: Words, word: int) -> bool:
    """True when an opening mark before the word, and a closing one after it, are nearer than a line's end."""
    low, high = found.bounds[found.rows[word]], found.bounds[found.rows[word] + 1]
    before = "".join(map(chr, found.points[max(low, found.at[word] - QUOTE):found.at[word]])).rpartition("\n")[2]
    after = "".join(map(chr, found.points[found.until[word]:min(high, found.until[word] + QUOTE)])).partition("\n")[0]
    opens = max(before.rfind(c) for c in OPENING)
    # A mark between two letters is an apostrophe.
    if opens < 0 or (opens and before[opens - 1].isalnum()):
        return False
    closes = min((i for i in (after.find(c) for c in CLOSING) if i >= 0), default=-1)
    return closes >= 0 and not after[closes + 1:closes + 2].isalnum()


def _beside(found: Words, word: int) -> list[int]:
    """Places of the words around one, in its text."""
    near = range(max(0, word - NEIGHBOURS), min(len(found.rows), word + NEIGHBOURS + 1))
    return [k for k in near if k != word and found.rows[k] == found.rows[word]]


def _counts(model: Model, found: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``n`` texts: plain, misspelt and quoted hits, by the weights of their terms; and words."""
    hit, term, edits, length = model.automaton.hits(found)
    kept = (edits == 0) | ~_among(found.hashes(hit, length), model.ordinary)
    hit, term, edits = hit[kept], term[kept], edits[kept]
    kind = np.where(edits > 0, 1, 0)
    for i, word in enumerate(hit):
        beside = _beside(found, word) if len(model.reporting) else []
        if _quoted(found, word) or (beside and _among(found.hashes(np.array(beside)), model.reporting).any()):
            kind[i] = 2
    out = np.zeros((n, 3))
    np.add.at(out, (found.rows[hit], kind), model.power[term])
    return out, np.bincount(found.rows, minlength=n)


def _features(counts: np.ndarray, size: np.ndarray) -> np.ndarray:
    share = 100 * (counts[:, 0] + 0.5 * counts[:, 1]) / np.maximum(size, 1)
    return np.c_[np.ones(len(size)), np.log1p(counts), np.log1p(share)]


def _chance(weights: np.ndarray, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ weights, -40, 40)))


def regress(x: np.ndarray, y: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression with observation weights, held near ``PRIOR``, by Newton's steps."""
    weights, total = PRIOR.copy(), max(share.sum(), 1.0)
    for _ in range(40):
        p = _chance(weights, x)
        slope = x.T @ (share * (p - y)) / total + RIDGE * (weights - PRIOR) / np.sqrt(total)
        curve = (x * (share * p * (1 - p))[:, None]).T @ x / total + RIDGE / np.sqrt(total) * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights = weights - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    # More hits never lower a score.
    return np.r_[weights[0], np.maximum(weights[1:], 0.0)]


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with two random shingles of each."""
    for batch in batches:
        keys = [np.zeros(batch.num_rows, np.uint64) for _ in range(2)]
        for at, data, offsets in text_pieces(batch):
            starts, ends, rows = spans(~ASCII_SPACE[data], offsets)
            value, first = windows(stretch(running(_SHINGLES[data]), starts, ends), rows, 5)
            row = rows[first] if len(first) else first
            begin = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else row
            for seed, key in enumerate(keys):
                if len(row):
                    key[at + row[begin]] = np.minimum.reduceat(mix(value + np.uint64(seed * 7919 + 1)), begin)
        yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(k.view(np.int64)) for k in keys)],
                                         names=[*batch.schema.names, "k1", "k2"])


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and stems of a batch, each with the number of toxic and of other texts that hold it."""
    for batch in batches:
        toxic = np.array(batch.column(batch.schema.get_field_index("toxic")).to_pylist(), bool)
        for at, data, offsets in text_pieces(batch):
            found = words(data, offsets)
            size = found.ends - found.starts
            for length in (None, *range(STEM[0], STEM[1] + 1)):
                which = np.flatnonzero(size <= 40 if length is None else size >= length)
                if length is None:
                    which = which[size[which] >= STEM[0]]
                if not len(which):
                    continue
                value, row = found.hashes(which, length), found.rows[which]
                order = np.lexsort((row, value))
                v, r = value[order], row[order]
                new = np.r_[True, (v[1:] != v[:-1]) | (r[1:] != r[:-1])]
                order, v, bad = order[new], v[new], toxic[at + r[new]]
                first = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
                total, held = np.diff(np.r_[first, len(v)]), np.add.reduceat(bad.astype(np.int64), first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([found.string(which[order[k]], length) for k in first], pa.string()),
                     pa.array(np.full(len(first), length is not None)), pa.array(held), pa.array(total - held)],
                    names=["term", "stem", "toxic", "other"])


def gain(toxic: float, other: float, all_toxic: int, all_other: int) -> float:
    """Log-likelihood ratio of a term's counts against equal shares in both classes; 0 where the share is lower."""
    share, total = all_toxic / (all_toxic + all_other), toxic + other
    if toxic <= total * share:
        return 0.0
    return 2 * (toxic * math.log(toxic / (total * share)) + (other * math.log(other / (total * (1 - share))) if other else 0.0))


def lexicon(counted: list[tuple[str, bool, int, int]], all_toxic: int, all_other: int) -> dict[tuple[str, bool], float]:
    """Terms of the most telling candidates (term, stem, toxic texts, other texts) with their weights (up to 1).

    None is covered by another: what opens with a chosen stem is left out, and so is a stem that is not telling without
    the texts of the chosen terms that open with it.
    """
    def odds(toxic: int, other: int) -> float:
        return math.log((toxic + 0.5) / (all_toxic + 1)) - math.log((other + 0.5) / (all_other + 1))

    chosen: dict[tuple[str, bool], tuple[int, int]] = {}
    ranked = sorted(counted, key=lambda c: (-round(gain(c[2], c[3], all_toxic, all_other), 6), -len(c[0]), not c[1], c[0]))
    for term, stem, toxic, other in ranked:
        if len(chosen) >= MOST_TERMS or (term, False) in chosen or any((term[:k], True) in chosen for k in range(1, len(term) + 1)):
            continue
        if odds(toxic, other) < LEAST_ODDS:
            continue
        longer = [n for (t, _), n in chosen.items() if t.startswith(term)] if stem else []
        left = toxic - sum(n for n, _ in longer), max(0, other - sum(n for _, n in longer))
        if longer and (left[0] < LEAST_TEXTS or gain(*left, all_toxic, all_other) < LEAST_GAIN or odds(*left) < LEAST_ODDS):
            continue
        chosen[term, stem] = toxic, other
    return {term: min(1.0, odds(*n) / FULL_ODDS) for term, n in chosen.items()}


def _gain(toxic, other, all_toxic: int, all_other: int):
    """The same gain, as a column."""
    total, share = toxic + other, all_toxic / (all_toxic + all_other)

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    ratio = 2 * (part(toxic, total * F.lit(share)) + part(other, total * F.lit(1 - share)))
    return F.when(toxic > total * F.lit(share), ratio).otherwise(0.0)


def held_out(doc_id):
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def _hits_of(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each text of the sample: words, and term, edits, variant and neighbours of every hit."""
        for batch in batches:
            keys = batch.select(["doc_id", "toxic"])
            for at, data, offsets in text_pieces(batch):
                n = len(offsets) - 1
                found = words(data, offsets)
                hit, term, edits, length = model.automaton.hits(found)
                variant = found.hashes(hit, length).view(np.int64)
                rows = [[] for _ in range(n)]
                for word, t, e, v in zip(hit, term, edits, variant):
                    near = _beside(found, word)
                    rows[found.rows[word]].append({"term": int(t), "edits": int(e), "variant": int(v), "quoted": _quoted(found, word),
                                                   "beside": found.hashes(np.array(near)).view(np.int64).tolist() if near else []})
                kind = pa.list_(pa.struct([("term", pa.int32()), ("edits", pa.int32()), ("variant", pa.int64()), ("quoted", pa.bool_()),
                                           ("beside", pa.list_(pa.int64()))]))
                yield pa.RecordBatch.from_arrays(
                    [*keys.slice(at, n).columns, pa.array(np.bincount(found.rows, minlength=n)), pa.array(rows, kind)],
                    names=["doc_id", "toxic", "size", "hits"])
    return run


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from a bounded sample of the labelled texts that are not held out."""
    spark = docs.sparkSession
    text_batches(spark)
    nothing = Model(Automaton([]), np.zeros(0), np.zeros(0, np.uint64), np.zeros(0, np.uint64), PRIOR)
    rated = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out("doc_id")).groupBy("doc_id").agg(
        (F.max("toxic") > 0).alias("toxic"))
    total = {r["toxic"]: r["count"] for r in rated.groupBy("toxic").count().collect()}
    if not total.get(True) or not total.get(False):
        return nothing
    part = F.when(F.col("toxic"), min(1.0, FIT_TOXIC / total[True])).otherwise(min(1.0, FIT_CLEAN / total[False]))
    sample = rated.filter(F.pmod(F.xxhash64("doc_id", F.lit(67)), F.lit(1 << 20)) < part * (1 << 20))
    texts = docs.filter(F.octet_length("text") <= FIT_BYTES).select("doc_id", "text").join(broadcast_if_small(sample), "doc_id")
    row = F.struct("doc_id", "text", "k2")
    one = materialize(texts.mapInArrow(_sketched, "doc_id long, text string, toxic boolean, k1 long, k2 long").groupBy(
        "k1", "toxic").agg(F.min(row).alias("row")).groupBy("row.k2", "toxic").agg(F.min("row").alias("row")).select(
        "row.doc_id", "row.text", "toxic"), "sample")
    seen = {r["toxic"]: r["count"] for r in one.groupBy("toxic").count().collect()}
    if not seen.get(True) or not seen.get(False):
        return nothing
    counted = one.mapInArrow(_vocabulary, "term string, stem boolean, toxic long, other long").groupBy("term", "stem").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    telling = counted.withColumn("gain", _gain(F.col("toxic"), F.col("other"), seen[True], seen[False])).filter(
        (F.col("toxic") >= LEAST_TEXTS) & (F.col("gain") >= LEAST_GAIN))
    best = telling.orderBy(F.desc("gain"), F.desc(F.length("term")), "term", "stem").limit(20 * MOST_TERMS).collect()
    terms = lexicon([(r["term"], r["stem"], r["toxic"], r["other"]) for r in best], seen[True], seen[False])
    model = Model(Automaton(list(terms)), np.array(list(terms.values())), np.zeros(0, np.uint64), np.zeros(0, np.uint64), PRIOR)
    rows = one.mapInArrow(_hits_of(model), "doc_id long, toxic boolean, size long, hits array<struct<term:int,edits:int,"
                          "variant:bigint,quoted:boolean,beside:array<bigint>>>").select("toxic", "size", "hits", "doc_id").orderBy("doc_id").collect()
    return _fitted(model, rows, {k: total[k] / seen[k] for k in seen})


def _fitted(model: Model, rows: list, share: dict[bool, float]) -> Model:
    """The model with ordinary words, reporting neighbours and weights from the hits of the sample."""
    def known(values) -> np.ndarray:
        return np.sort(np.array(sorted(values), np.int64).view(np.uint64)) if values else np.zeros(0, np.uint64)

    held: dict[int, list[int]] = {}
    near: dict[int, list[int]] = {}
    for r in rows:
        for v in {h["variant"] for h in r["hits"] if h["edits"]}:
            held.setdefault(v, [0, 0])[r["toxic"]] += 1
        for b in {b for h in r["hits"] if not h["edits"] for b in h["beside"]}:
            near.setdefault(b, [0, 0])[r["toxic"]] += 1
    bad = sum(r["toxic"] for r in rows) / max(len(rows), 1)
    # A misspelling in a clean text is an ordinary word unless toxic texts hold it far more often.
    ordinary = {v for v, (clean, toxic) in held.items() if clean and toxic * (1 - bad) < 10 * clean * bad}
    reporting = {b for b, (clean, toxic) in near.items() if clean >= 5 and clean * bad > 10 * toxic * (1 - bad)}
    model.ordinary, model.reporting = known(ordinary), known(reporting)
    counts = np.zeros((len(rows), 3))
    for i, r in enumerate(rows):
        for h in r["hits"]:
            if h["edits"] and h["variant"] in ordinary:
                continue
            counts[i, 2 if h["quoted"] or reporting & set(h["beside"]) else 1 if h["edits"] else 0] += model.power[h["term"]]
    x = _features(counts, np.array([r["size"] for r in rows]))
    y = np.array([r["toxic"] for r in rows], float)
    model.weights = regress(x, y, np.array([share[bool(r["toxic"])] for r in rows]))
    return model


def _scored(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in text_pieces(batch):
                n = len(offsets) - 1
                counts, size = _counts(sent.value, words(data, offsets), n)
                chance = _chance(sent.value.weights, _features(counts, size))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, n), batch.column(1).slice(at, n), pa.array(chance),
                     pa.array((chance >= THRESHOLD).astype(np.int32)), *(pa.array(counts[:, k]) for k in range(3))],
                    names=["doc_id", "held_out", "score", "predicted", "plain", "misspelt", "quoted"])
    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted and the hits that were counted, for every row."""
    text_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", held_out("doc_id").alias("held_out"), "text").mapInArrow(
        _scored(sent), "doc_id long, held_out boolean, score double, predicted int, plain double, misspelt double, quoted double")
