import random

import numpy as np
import pytest

from kbvec.llm import quality
from kbvec.llm.tables import table

SF = "/root/testdata/sf0.1"


def test_held_out_grades(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    fitted = quality.train(docs, labels.filter("doc_id % 3 <> 0"))
    got = quality.score(docs, fitted).join(quality.grades(labels.filter("doc_id % 3 = 0")), "doc_id").toPandas()
    right = (got["keep"] == (got["grade"] == 2)).mean()
    assert len(got) > 1000 and right > 0.97
    assert got[got["grade"] == 2]["keep"].mean() > 0.99 and got[got["grade"] == 1]["keep"].mean() < 0.06
    order = got.groupby("grade")["expected_grade"].mean()
    assert order[0] < order[1] < order[2]
    assert np.allclose(got["expected_grade"], got["p_not_lowest"] + got["p_top"]) and (got["p_top"] <= got["p_not_lowest"]).all()


def rows(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = [f"w{rng.randrange(60)}" for _ in range(rng.randrange(3, 40))]
        grade = i % 3
        if grade == 0:
            words[rng.randrange(len(words))] = rng.choice(["awful", "Awful,"])
        elif grade == 1:
            words = [w.upper() + "!!" for w in words]
        out.append((i, " ".join(words), int(grade != 1), int(grade == 0)))
    return out


def frames(spark, n=600):
    docs = spark.createDataFrame([(i, t, "k") for i, t, _, _ in rows(n)], "doc_id long, text string, keep string")
    labels = spark.createDataFrame([(i, q, t) for i, _, q, t in rows(n)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_grades_and_thresholds(spark):
    docs, labels = frames(spark)
    model = quality.train(docs, labels)
    assert (np.diff(model.thresholds) > 0).all()
    got = {r["doc_id"]: r for r in quality.score(docs, model).collect()}
    assert all((got[i]["expected_grade"] > 1.5) == (i % 3 == 2) and got[i]["keep"] == (i % 3 == 2) for i in range(600))
    assert sum((got[i]["p_not_lowest"] > 0.5) == (i % 3 > 0) for i in range(600)) > 590
    left = quality.kept(docs, model)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == list(range(2, 600, 3))


def test_gradient_against_differences():
    """The fit ends near a minimum of the penalised likelihood."""
    rng = np.random.default_rng(3)
    grade = rng.integers(0, 3, 400)
    row = np.flatnonzero(rng.random(400) < np.array([0.9, 0.5, 0.1])[grade])
    model = quality.fit(row, np.full(len(row), 5, np.uint64), grade, 2, rounds=3000)

    def loss(weight, first, second):
        sums = np.zeros(400)
        sums[row] = weight
        p = 1 / (1 + np.exp(np.array([first, second])[None, :] - sums[:, None]))
        edge = np.c_[np.ones(400), p, np.zeros(400)]
        return -np.log(edge[np.arange(400), grade] - edge[np.arange(400), grade + 1]).mean()

    here = loss(model.weight[0], *model.thresholds)
    for step in ((0.2, 0, 0), (-0.2, 0, 0), (0, 0.2, 0), (0, -0.2, 0), (0, 0, 0.2), (0, 0, -0.2)):
        assert loss(model.weight[0] + step[0], model.thresholds[0] + step[1], model.thresholds[1] + step[2]) > here


@pytest.mark.parametrize("labelled, kept", [([], True), ([(0, 1, 0), (1, 1, None)], True), ([(0, 0, 0)], False),
                                            ([(0, None, 1), (None, 0, 0)], True)])
def test_labels_that_teach_nothing(spark, labelled, kept):
    docs, _ = frames(spark, 5)
    model = quality.train(docs, spark.createDataFrame(labelled, "doc_id long, quality int, toxic int"))
    assert {r["keep"] for r in quality.score(docs, model).collect()} == {kept}


def test_odd_texts(spark):
    docs, labels = frames(spark)
    model = quality.train(docs, labels)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "!!! ..."), (None, "w1 w2"), (None, "w1 w2"), (5, "w1 " * 50_000)],
                                "doc_id long, text string")
    got = quality.score(odd, model).collect()
    assert len(got) == 6 and all(0 <= r["expected_grade"] <= 2 for r in got)
    assert quality.score(odd.limit(0), model).collect() == []
