import random

import numpy as np
import pyarrow as pa

from kbvec.llm import toxicity
from kbvec.llm.tables import table
from kbvec.llm.textarrays import text_pieces

SF = "/root/testdata/sf0.1"


def test_held_out_texts(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = toxicity.score(docs, toxicity.train(docs, labels)).join(labels, "doc_id").filter("held_out").toPandas()
    bad = got["toxic"] == 1
    assert len(got) > 1000 and got.loc[bad, "predicted"].mean() > 0.85 and got.loc[~bad, "predicted"].mean() < 0.01
    assert got.loc[bad, "score"].mean() > got.loc[~bad, "score"].mean() + 0.7


def distance(a, b):
    """Edits with swaps of neighbours that are not edited again."""
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[len(a)][len(b)]


def found_in(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    (_, data, offsets), = text_pieces(batch)
    return toxicity.words(data, offsets)


def test_automaton_against_all_distances():
    rng = random.Random(4)
    terms = [("abcab", False), ("abc", False), ("bbcaacbab", False), ("cabca", True), ("acbbé", False)]
    automaton = toxicity.Automaton(terms)
    strings = ["".join(rng.choice("abcé") for _ in range(rng.randrange(1, 11))) for _ in range(4000)]
    strings += ["".join(rng.choice([t[:i] + t[i + 1:], t[:i] + "é" + t[i:], t[:i] + t[i + 1:i + 2] + t[i:i + 1] + t[i + 2:]]))
                for t, _ in terms for i in range(len(t)) for _ in range(3)]
    strings = [s for s in strings if not any(s[i] == s[i + 1] == s[i + 2] for i in range(len(s) - 2)) and s]
    found = found_in([" ".join(strings)])
    assert [found.string(i) for i in range(len(strings))] == strings
    got = {int(w): int(e) for w, _, e, _ in zip(*automaton.hits(found))}
    for i, s in enumerate(strings):
        best = min((e for t, stem in terms for e in
                    ([distance(s[:k], t) for k in range(1, len(s) + 1)] if stem else [distance(s, t)])
                    if e <= toxicity._allowed(len(t))), default=None)
        assert got.get(i) == best, s
    assert len(got) > 100


def test_words():
    found = found_in(["Stuuupid st*pid ***it's***", "a", "ÉTÉ99 x@ @y", ""])
    assert [found.string(i) for i in range(len(found.starts))] == ["stuupid", "st*pid", "it", "s", "a", "été99", "x", "y"]
    assert found.rows.tolist() == [0, 0, 0, 0, 1, 2, 2, 2]


def rows(n, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text = [f"w{rng.choice('abcdefgh')}{rng.choice('klmnop')}{rng.choice('qrst')}" for _ in range(rng.randrange(15, 60))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                text[rng.randrange(len(text))] = rng.choice(["Grobling", "grobling,", "vermox", "schurkig", "schurkal", "schurkeny"])
        if i % 6 == 1:
            text[5] = "vermok"
        out.append((i, " ".join(text), int(toxic)))
    return out


def frames(spark, n=900):
    docs = spark.createDataFrame([(i, t, 1) for i, t, _ in rows(n)], "doc_id long, text string, toxic int")
    return docs, spark.createDataFrame([(i, x) for i, _, x in rows(n)], "doc_id long, toxic int")


def test_misspelt_and_quoted(spark):
    docs, labels = frames(spark)
    model = toxicity.train(docs, labels)
    assert ("grobling", True) in model.automaton.terms or ("grobling", False) in model.automaton.terms
    assert any(stem and "schurk".startswith(t[:6]) for t, stem in model.automaton.terms)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert sum(got[i]["predicted"] == t for i, _, t in rows(900)) == 900
    plain = " ".join(["wak", "wbl"] * 10)
    more = [(1, f"{plain} grobling vermox {plain} grobling"), (2, f"{plain} groblign gr0bling {plain} groooobling grobing"),
            (3, f'{plain} "grobling" {plain} "you vermox", {plain} «grobling»'), (4, f"{plain} vermok {plain} vermok"),
            (5, f"{plain} schurkomat {plain} schurkoid Schurkung"), (6, plain), (7, None), (8, ""), (None, "grobling grobling vermox"),
            (None, "grobling grobling vermox"), (9, "grobling vermox " * 20_000)]
    seen = toxicity.score(spark.createDataFrame(more, "doc_id long, text string"), model).collect()
    flag = [r["predicted"] for r in sorted(seen, key=lambda r: (r["doc_id"] is None, r["doc_id"]))]
    assert flag == [1, 1, 0, 0, 1, 0, 0, 0, 1, 1, 1]
    by_id = {r["doc_id"]: r for r in seen}
    assert by_id[2]["misspelt"] == 4 and by_id[3]["quoted"] == 3 and by_id[4]["misspelt"] == 0
    assert by_id[7]["score"] == by_id[8]["score"] == by_id[6]["score"] and by_id[6]["score"] < 0.05


def test_labels_that_teach_nothing(spark):
    docs, labels = frames(spark, 40)
    for taught in (labels.limit(0), labels.filter("toxic = 0"), labels.filter("toxic = 1"), labels.selectExpr("doc_id", "cast(null as int) toxic"),
                   labels.limit(4)):
        got = toxicity.score(docs, toxicity.train(docs, taught)).collect()
        assert len(got) == 40 and {r["predicted"] for r in got} == {0}
    assert toxicity.score(docs.limit(0), toxicity.train(docs, labels)).collect() == []


def test_labels_held_out_teach_nothing(spark):
    import zlib
    docs, labels = frames(spark, 300)
    out = [(i, 1 - x) if zlib.crc32(str(i).encode()) % 3 == 1 else (i, x) for i, _, x in rows(300)]
    a = toxicity.score(docs, toxicity.train(docs, labels)).orderBy("doc_id").toPandas()
    b = toxicity.score(docs, toxicity.train(docs, spark.createDataFrame(out, "doc_id long, toxic int"))).orderBy("doc_id").toPandas()
    assert a.equals(b) and a["held_out"].tolist() == [zlib.crc32(str(i).encode()) % 3 == 1 for i in range(300)]


def test_regression_is_a_minimum():
    rng = np.random.default_rng(1)
    x = np.c_[np.ones(500), rng.poisson(1, (500, 4))]
    y = (rng.random(500) < 1 / (1 + np.exp(2 - x[:, 1:] @ [1.5, 0.5, 0.4, 0.3]))).astype(float)

    def loss(w):
        z = x @ w
        near = toxicity.RIDGE / np.sqrt(500) * ((w - toxicity.PRIOR) ** 2).sum() / 2
        return (np.log1p(np.exp(z)) - y * z).mean() + near
    w = toxicity.regress(x, y, np.ones(500))
    assert all(loss(w) < loss(w + s * e) for e in np.eye(5) for s in (-0.05, 0.05))
