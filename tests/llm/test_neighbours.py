import numpy as np

from kbvec.llm import neighbours


def frame(spark, vectors, first=0):
    return spark.createDataFrame([(first + i, v, 1.5) for i, v in enumerate(vectors)],
                                 "vec_id long, embedding array<float>, score double").repartition(4)


def brute(ids, matrix, queries, k):
    unit = neighbours.unit(matrix.astype(float))
    out = {}
    for q in queries:
        score = unit @ unit[list(ids).index(q)]
        order = sorted((-round(s, 12), i) for s, i in zip(score, ids) if i != q)[:k]
        out[q] = [i for _, i in order]
    return out


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((3000, 48)).astype(np.float32)
    x[:1000] = x[2000] + 0.2 * x[:1000]
    vectors = frame(spark, x.tolist())
    got = result(neighbours.nearest(vectors, vectors.filter("vec_id % 50 = 0"), 5))
    want = brute(range(3000), x, range(0, 3000, 50), 5)
    assert set(got) == set(want) and all([r for r, _, _ in v] == [1, 2, 3, 4, 5] for v in got.values())
    assert np.mean([len(set(want[q]) & {v for _, v, _ in got[q]}) / 5 for q in want]) >= 0.95
    unit = neighbours.unit(x.astype(float))
    assert all(abs(s - unit[q] @ unit[v]) < 1e-12 for q in got for _, v, s in got[q])


def test_scan_keeps_what_may_be_near():
    rng = np.random.default_rng(4)
    x = neighbours.unit(rng.standard_normal((900, 64)))
    of, to = neighbours.scan(x[:40], x, 6)
    exact = np.argsort(-(x[:40] @ x.T), axis=1)[:, :6]
    hit = {(a, b) for a, b in zip(of.tolist(), to.tolist())}
    assert np.mean([(i, j) in hit for i in range(40) for j in exact[i]]) > 0.97 and len(of) < 40 * 8


def test_copies_ties_and_few_candidates(spark):
    x = [[1.0, 0.0]] * 400 + [[0.0, 1.0]] * 3 + [[1.0, 0.001]]
    got = result(neighbours.nearest(frame(spark, x), frame(spark, x).filter("vec_id in (0, 7, 401)"), 5))
    assert [v for _, v, _ in got[0]] == [1, 2, 3, 4, 5] and [v for _, v, _ in got[7]] == [0, 1, 2, 3, 4]
    assert [v for _, v, _ in got[401]][:2] == [400, 402] and len(got[401]) == 5
    two = frame(spark, [[1.0, 2.0], [2.0, 1.0]])
    assert result(neighbours.nearest(two, two, 5)).keys() == {0, 1}
    assert all(len(v) == 1 for v in result(neighbours.nearest(two, two, 5)).values())


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 1.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [1.0, None]), (6, [1.0]),
            (7, [1.0, 0.9]), (None, [1.0, 1.0]), (0, [1.0, 1.0]), (8, []), (9, [-1.0, 1e-30])]
    vectors = spark.createDataFrame([(*r, 2) for r in rows], "vec_id long, embedding array<float>, rank int")
    got = result(neighbours.nearest(vectors, vectors, 5))
    assert {q: [v for _, v, _ in r] for q, r in got.items()} == {0: [7, 9], 7: [0, 9], 9: [0, 7]}
    assert neighbours.nearest(vectors.limit(0), vectors, 5).collect() == []
    assert neighbours.nearest(vectors, vectors.limit(0), 5).collect() == []
