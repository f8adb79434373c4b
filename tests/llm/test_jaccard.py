import random
import re

import pytest

from kbvec.llm import jaccard
from kbvec.llm.components import components


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute(rows):
    sets = {d: shingles(t) for d, t in rows if d is not None}
    own = {d: d for d in sets}

    def root(d):
        while own[d] != d:
            d = own[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                own[max(x, y)] = min(x, y)
    same = {}
    for d in ids:
        same.setdefault(sets[d], d)
    return {d: (len(s), root(d), same[s] if s else d) for d, s in sets.items()}


def edited(words, rng, edits):
    words = list(words)
    for _ in range(edits):
        i = rng.randrange(len(words))
        words[i:i + rng.choice([0, 1, 1])] = [f"n{rng.randrange(10 ** 6)}"] * rng.choice([0, 1, 1])
    return words


def corpus(seed):
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(55)]
    rows = []
    for g in range(25):
        base = [f"{rng.choice('abcd')}{rng.randrange(400)}" for _ in range(rng.randrange(3, 120))]
        if g % 3 == 0:
            base[1:1] = passage
        for k in range(rng.choice([1, 2, 3, 12])):
            rows.append(" ".join(edited(base, rng, rng.choice([0, 0, 1, 2, 4, 9]))))
    chain = [f"c{i}" for i in range(60)]
    for k in range(8):
        rows.append(" ".join(chain[k * 2:] + [f"d{i}" for i in range(k * 2)]))
    rows += ["", None, "  \t", "one two", "ONE  two", "One two é", "one two É", "a b c d e", "A b\nc\x0bd e", "a b c d e a b c d e", "x " * 4000]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_pairs(spark, seed):
    rows = corpus(seed)
    rows.append(rows[4])
    docs = spark.createDataFrame([(d, t, 0, "z") for d, t in rows], "doc_id long, text string, rep int, n string").repartition(5)
    got = jaccard.join(docs).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["class_id"]) for r in got} == brute(rows)


def test_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (None, "other")], "doc_id long, text string")
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.join(docs).collect()}
    assert got == {(None, 2, 3), (3, 2, 3), (None, 1, None)}
    assert jaccard.join(docs.limit(0)).collect() == []


def test_large_group_of_near_copies_makes_few_comparisons(spark):
    """A group of near copies costs about one comparison a member, not one a pair."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(edited(base, rng, 2))) for i in range(300)]
    texts = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    seen = []
    compared = jaccard._compared

    def counted(docs, pairs):
        seen.append(pairs.count())
        return compared(docs, pairs)

    jaccard._compared = counted
    try:
        got = jaccard.join(texts).collect()
    finally:
        jaccard._compared = compared
    assert {r["component_id"] for r in got} == {0} and sum(seen) < 4 * len(rows)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(0, i) for i in range(1, 30)] + [(200, 201), (201, 200), (5, 5)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 0 for i in range(30)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
