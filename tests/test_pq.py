"""Product quantisation: codes, lists, recall, defined cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kbvec.operators import pq

RNG = np.random.default_rng(6)


def frame(spark, matrix, tenants="ab"):
    rows = [(f"v{i:05d}", tenants[i % len(tenants)], None if x is None else [float(c) for c in x]) for i, x in enumerate(matrix)]
    return spark.createDataFrame(rows, "vector_id string, bot_id string, embedding array<float>")


def clustered(n, dim=18, groups=12):
    centres = RNG.standard_normal((groups, dim))
    return centres[RNG.integers(0, groups, n)] + 0.6 * RNG.standard_normal((n, dim))


def exact(matrix, tenants, q, tenant, k):
    unit = matrix / np.linalg.norm(matrix, axis=1)[:, None]
    at = [i for i in range(len(matrix)) if tenants[i % len(tenants)] == tenant]
    scores = np.round(unit[at] @ (q / np.linalg.norm(q)), 9)
    return [f"v{at[i]:05d}" for i in np.lexsort((at, -scores))[:k]]


def test_recall_and_exact_scores(spark, tmp_path):
    matrix = clustered(3000).astype(np.float32).astype(float)
    quantiser = pq.build_index(frame(spark, matrix), str(tmp_path / "i"), list_rows=200)
    assert len(quantiser.centres) == 15 and [b.shape[1] for b in quantiser.books] == [4, 4, 4, 4, 2]
    asked = clustered(20)
    queries = spark.createDataFrame([(f"q{i}", "ab"[i % 2], [float(x) for x in q]) for i, q in enumerate(asked)],
                                    "query_id string, bot_id string, embedding array<double>")
    found = {}
    for r in pq.search(str(tmp_path / "i"), queries, quantiser, 10, probe=0.5).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vector_id"], r["score"]))
    recall = []
    for i, q in enumerate(asked):
        want = exact(matrix, "ab", q, "ab"[i % 2], 10)
        got = found[f"q{i}"]
        recall.append(len(set(want) & {v for v, _ in got}) / 10)
        for v, s in got:
            x = matrix[int(v[1:])]
            assert abs(s - x @ q / np.linalg.norm(x) / np.linalg.norm(q)) < 1e-9
        assert [s for _, s in got] == sorted((s for _, s in got), reverse=True)
    assert np.mean(recall) > 0.95 and min(recall) >= 0.8
    read = pq.read_bytes(quantiser, 3000, 10, probe=0.5)
    assert read["codes"] == 1600 * 5 and read["codes"] + read["vectors"] < read["exact"] / 2
    # Every row is in the index once, sorted by list in its folder.
    codes = spark.read.parquet(str(tmp_path / "i" / "codes"))
    assert codes.count() == 3000 and codes.select("vector_id").distinct().count() == 3000
    assert codes.agg(F.max(F.length("codes"))).first()[0] == 5


def test_codes_are_the_nearest_entries():
    rows = clustered(900)
    unit = rows / np.linalg.norm(rows, axis=1)[:, None]
    quantiser = pq.Quantiser.fit(rows, 900, list_rows=100)
    near, codes = quantiser.encode(unit)
    rest = unit - quantiser.centres[near]
    assert (near == ((unit[:, None] - quantiser.centres[None]) ** 2).sum(2).argmin(1)).all()
    for i, (cut, book) in enumerate(zip(quantiser.cuts, quantiser.books)):
        gap = ((rest[:, None, cut] - book[None]) ** 2).sum(2)
        assert np.allclose(gap[np.arange(900), codes[:, i]], gap.min(1))
    q = unit[:7]
    back = quantiser.centres[near] + np.concatenate([b[codes[:, i]] for i, b in enumerate(quantiser.books)], 1)
    looked_up = (q @ quantiser.centres.T)[:, near] + quantiser.tables(q)[:, np.arange(codes.shape[1])[None], codes].sum(2)
    assert np.allclose(looked_up, q @ back.T)


def test_defined_cases(spark, tmp_path):
    rows = frame(spark, [[1, 0], [1, 0], None, [0, 0], [0, 1]], "a")
    quantiser = pq.build_index(rows, str(tmp_path / "i"))
    queries = spark.createDataFrame([("x", "a", [2.0, 0.1]), ("none", "a", None), ("zero", "a", [0.0, 0.0]), ("other", "b", [1.0, 0.0])],
                                    "query_id string, bot_id string, embedding array<double>")
    got = [(r["query_id"], r["vector_id"], r["rank"]) for r in pq.search(str(tmp_path / "i"), queries, quantiser, 2).orderBy("rank").collect()]
    assert got == [("x", "v00000", 1), ("x", "v00001", 2)]
    assert pq.search(str(tmp_path / "i"), queries.limit(0), quantiser, 2).count() == 0
    empty = pq.build_index(rows.limit(0), str(tmp_path / "e"))
    assert pq.search(str(tmp_path / "e"), queries.filter("query_id = 'none'"), empty, 2).count() == 0
    many = spark.range(pq.BLOCK + 1).select(F.col("id").alias("query_id"), F.lit("a").alias("bot_id"), F.array(F.lit(1.0)).alias("embedding"))
    with pytest.raises(ValueError, match="at most"):
        pq.search(str(tmp_path / "i"), many, quantiser, 2)
