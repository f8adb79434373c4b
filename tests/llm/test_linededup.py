import random


from kbvec.llm import linededup


def near(a, b):
    if a == b:
        return True
    if min(len(a), len(b)) < 5 or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute(rows):
    """(doc, line, kept doc, kept line) for every line with an earlier one that it repeats."""
    lines = sorted({(d is None, d or 0, i, tuple(x.encode().split())) for d, t in rows
                    for i, x in enumerate((t or "").split("\n")) if x.encode().split()})
    out = []
    for k, (last, d, i, words) in enumerate(lines):
        first = next(((None if z else e, j) for z, e, j, w in lines[:k] if near(list(w), list(words))), None)
        if first:
            out.append((None if last else d, i, *first))
    return out


def corpus(seed):
    random.seed(seed)
    words = [f"w{i}" for i in range(9)] + ["é", "☃x"]
    base = [[random.choice(words) for _ in range(random.randrange(3, 16))] for _ in range(12)]
    rows = []
    for d in range(60):
        lines = []
        for _ in range(random.randrange(6)):
            line = list(random.choice(base))
            for _ in range(random.choice([0, 0, 1, 1, 2])):
                i = random.randrange(len(line) + 1)
                random.choice([lambda: line.insert(i, random.choice(words)), lambda: line.pop() if len(line) > 1 else None,
                               lambda: line.__setitem__(min(i, len(line) - 1), random.choice(words))])()
            lines.append(random.choice([" ", "  ", "\t"]).join(line))
        rows.append((d, "\n".join(lines)))
    return rows + [(60, None), (61, ""), (62, "\n\n \n"), (None, rows[0][1]), rows[3], (63, "x " * 3000 + "\n" + "x " * 3000)]


def test_against_all_pairs(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, line int")
        got = [tuple(r)[:4] for r in linededup.repeats(docs).collect()]
        assert sorted(got, key=repr) == sorted(brute(rows), key=repr)


def applied(spark, rows):
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, _gone string")
    got = linededup.apply(docs)
    assert got.columns == docs.columns
    return sorted((tuple(r)[:2] for r in got.collect()), key=repr)


def test_apply(spark):
    long = "one two three four five six"
    rows = [(1, f"{long}\nshort line\nother words stand here now"), (2, f"{long}\nshort line"), (3, f"new words in this text\n{long}\n\nend"),
            (4, "short line"), (5, None), (6, ""), (7, "short line\nnew"), (8, "one two three four five seven\nend\nlast")]
    assert applied(spark, rows) == sorted([rows[0], (3, "new words in this text\n\nend"), (5, None), (6, ""), (7, "new"), (8, "last")], key=repr)
    assert applied(spark, []) == []
    assert linededup.repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_repeated_rows_and_rows_without_an_id(spark):
    long = "one two three four five six"
    rows = [(1, long), (1, long), (None, long), (None, "only here"), (None, "only here"), (2, None), (2, None), (3, "a\nb"), (None, "b\nc")]
    assert applied(spark, rows) == sorted([(1, long), (None, "only here"), (2, None), (3, "a\nb"), (None, "c")], key=repr)


def test_one_id_with_two_texts(spark):
    """Lines found in one text are not cut out of the other."""
    rows = [(1, "words that stand nowhere else at all\nsame line in two texts"), (1, "same line in two texts\nother words that stand nowhere else"),
            (2, "same line in two texts\nthird")]
    got = applied(spark, rows)
    assert sum("same line" in t for _, t in got) == 1 and (2, "third") in got
    assert any("nowhere else at all" in t for _, t in got) and any("other words" in t for _, t in got)


def test_a_variant_of_very_many_lines(spark):
    """Lines that differ in one word are one variant; each of them but the first goes."""
    rows = [(i, f"request number {i} was served in time") for i in range(3000)]
    assert applied(spark, rows) == [rows[0]]
