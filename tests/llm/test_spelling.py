import random
import re
import zlib
from collections import Counter

from kbvec.llm import spelling

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    seen = Counter()
    for doc, text in rows:
        for run in LETTERS.findall(text or ""):
            word = lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 199 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            seen[word] += 1
    n = {w: c for w, c in seen.items() if len(w) >= 6 and c >= 5}
    out = {}
    for w in n:
        others = [v for v in n if near(w, v)]
        best = min(others, key=lambda v: (-n[v], v), default=None)
        out[w] = (n[w], len(others), best if best is not None and n[best] >= 5 * n[w] else None)
    final = []
    for w, (c, k, form) in out.items():
        root = w
        while out[root][2] is not None:
            root = out[root][2]
        final.append((w, c, k, form, n[form] if form else None, root))
    return sorted(final)


def corpus(seed, letters, words=25, docs=400):
    rng = random.Random(seed)
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(6, 12))) for _ in range(words)]

    def edited(word):
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
            i = rng.randrange(len(word) + 1)
            word = rng.choice([word[:i] + rng.choice(letters) + word[i:], word[:i] + word[i + 1:],
                               word[:i] + rng.choice(letters) + word[i + 1:]])
        return word
    return [(d, rng.choice(["  ", ", ", "\n"]).join(rng.choice([str, str.title])(edited(base[min(int(rng.expovariate(0.3)), words - 1)]))
                                                    for _ in range(rng.randrange(30)))) for d in range(docs)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, word string")


def result(spark, rows, **kw):
    got = spelling.variants(frame(spark, rows), **kw)
    assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    return sorted(tuple(r) for r in got.collect())


def test_against_all_pairs(spark):
    for seed, letters in ((1, "ab"), (2, "abÀéÿ×")):
        rows = corpus(seed, letters) + [(None, "Wörter Wörter"), (7, None), (8, ""), (None, "Wörter wörter WöRTER"), (9, "x1 y")]
        want = brute(rows)
        assert result(spark, rows) == want
        assert sum(r[3] is not None for r in want) > 3 and sum(r[2] > 2 for r in want) > 20


def test_split_cells(spark):
    rows = corpus(3, "ab", words=60, docs=300)
    assert result(spark, rows, cell_words=24) == brute(rows)


def test_long_runs_and_nothing(spark):
    long = "ab" * 300
    rows = [(i, f"{long} {long[:-1]}") for i in range(40)] + [(50, "y" * 9_000)] * 5
    got = {r[0]: r for r in result(spark, rows)}
    assert {w: r[1:3] for w, r in got.items()} == {r[0]: r[1:3] for r in brute(rows)} and got["y" * 9_000][2] == 0
    assert result(spark, rows[:0]) == [] and result(spark, [(1, "abcdef")]) == []


def test_chain_to_the_last_form(spark):
    rows = [(i, " ".join(["abcdefgh"] * 200 + ["abcdefg"] * 30 + ["abcdef"] * 5)) for i in (1, 2)]
    got = {r[0]: r for r in result(spark, rows)}
    assert sorted(got.values()) == brute(rows)
    assert got["abcdef"][3] == "abcdefg" and got["abcdef"][5] == "abcdefgh" == got["abcdefg"][3]
