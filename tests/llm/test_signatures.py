import math
import random
import re
from collections import Counter

import numpy as np

from kbvec.llm import signatures

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def split(text):
    return ["".join(c.lower() if c < "\x80" else c for c in t) for t in TERM.findall(text or "")]


def brute(docs, items, k):
    counted = [(d, Counter(split(t))) for d, t in docs if split(t)]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(split(t))
    out = []
    for i, wanted in asked.items():
        scores = []
        for d, c in counted:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in wanted)
            if score > 0:
                scores.append((-score, d is None, d))
        out += [(i, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def corpus(seed, docs=500, items=25):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["Éa", "ñ", "日本", "A1", "é"]

    def text(n):
        return rng.choice([" ", ", ", "-"]).join(words[min(int(rng.paretovariate(0.6)) - 1, len(words) - 1)] for _ in range(n))
    rows = [(d, text(int(rng.paretovariate(0.7)) % 400)) for d in range(docs)]
    rows += [(docs + i, rows[3][1]) for i in range(40)] + [rows[5], (None, rows[6][1]), (None, rows[6][1]), (-4, None), (-5, ""), (-6, "?!")]
    asked = [(i, text(12)) for i in range(items)] + [(0, "w1 w2 W2"), (None, "w7"), (98, None), (99, "absent"), (97, rows[3][1])]
    return rows, asked


def run(spark, docs, items, **kw):
    got = signatures.search(spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, item long").repartition(3),
                            spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id long"), **kw)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_against_all_scores(spark):
    for seed, k in ((1, 5), (2, 50)):
        docs, items = corpus(seed)
        assert run(spark, docs, items, k=k) == brute(docs, items, k)


def test_parts_of_items(spark):
    docs, items = corpus(3, docs=80)
    assert run(spark, docs, items, k=4, part_items=10) == brute(docs, items, 4)


def test_bounds_are_never_too_low():
    rng = np.random.default_rng(5)
    docs = []
    for _ in range(70):
        word = np.unique(rng.integers(0, 60, 20)).astype(np.uint64)
        docs.append((word, (rng.pareto(1, len(word)) * 3 + 1).astype(np.int64)))
    lengths = np.array([d[1].sum() for d in docs])
    known = np.arange(60, dtype=np.uint64)
    weight = rng.integers(1, 9000, 60).astype(float)
    queries = signatures.Queries(known, weight, [np.arange(i, 60, 5) for i in range(5)], 70, int(lengths.sum()))
    tight = 0
    for item, bound in enumerate(signatures.bounds(queries, lengths, *signatures.block(docs))):
        for d, (word, count) in enumerate(docs):
            hit = np.isin(word, queries.items[item].astype(np.uint64))
            score = (weight[word[hit].astype(int)] * queries.share(count[hit], lengths[d])).sum()
            assert bound[d] >= score
            tight += bound[d] <= 1.3 * score
    assert tight > 200


def test_empty(spark):
    docs, items = corpus(4, docs=10, items=2)
    assert run(spark, [], items) == [] and run(spark, docs, []) == [] and run(spark, [(1, None)], items) == []
