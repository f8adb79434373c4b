"""Joins over int8 codes: equal to brute force, whatever the chunks, copies and crowds; fewer bytes shuffled."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kbvec.operators import batch, codedjoin
from kbvec.plans import fixtures as fx
from tests.test_batch import agree, as_queries, brute, collected, make

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("metric, chunk_bytes, crowded", [
    ("cosine", 1 << 20, 32), ("cosine", 300, 32), ("cosine", 300, 1), ("l2sq", 400, 2), ("ip", 400, 32)])
def test_both_joins_equal_brute_force(spark, metric, chunk_bytes, crowded):
    """A hot tenant, a third of the rows copies of one vector, zero vectors; clusters closer than their rounding."""
    df, rows = make(spark, 300)
    want = brute(rows, rows, 6, metric)
    found = codedjoin.coded_join(df.repartition(4), as_queries(df), 6, metric, chunk_bytes=chunk_bytes, crowded=crowded)
    agree(collected(found), want)
    agree(collected(codedjoin.coded_self_join(df.repartition(4), 6, metric, chunk_bytes, crowded)), want)


def test_crowded_queries_take_the_plain_join(spark, monkeypatch):
    """One tight cluster: more rows lie within the bounds than a task may keep for a query."""
    rng = np.random.RandomState(1)
    rows = [(f"v{i:03d}", "t", [float(x) for x in (np.r_[1.0, np.zeros(7)] + rng.standard_normal(8) * 1e-4).astype(np.float32)])
            for i in range(120)]
    df = spark.createDataFrame(rows, "vector_id string, bot_id string, embedding array<float>")
    asked = []
    plain = codedjoin.knn_join
    monkeypatch.setattr(codedjoin, "knn_join", lambda v, q, *a: asked.append(q.count()) or plain(v, q, *a))
    agree(collected(codedjoin.coded_self_join(df, 3, chunk_bytes=400, crowded=4)), brute(rows, rows, 3, "cosine"))
    assert asked == [120]
    agree(collected(codedjoin.coded_self_join(df, 3, crowded=1000)), brute(rows, rows, 3, "cosine"))
    assert asked == [120]


def test_bounds_hold(spark):
    """No score lies outside its bounds, for components of any size."""
    rng = np.random.RandomState(2)
    import pyarrow as pa
    for metric in ("cosine", "l2sq", "ip"):
        for size in (1e-6, 1.0, 1e6):
            v = (rng.standard_normal((60, 24)) * size * rng.uniform(0.1, 9, (60, 1)))
            v[:5] = v[5:10]
            df = spark.createDataFrame([("t", str(i), [float(x) for x in r]) for i, r in enumerate(v)],
                                       "bot_id string, class string, embedding array<double>")
            coded = codedjoin._encode(df, metric).toArrow()
            side = codedjoin._Codes(pa.table(coded))
            own = np.array([int(x) for x in side.names.to_pylist()])
            low, high = codedjoin._bounds(side, slice(None), side, slice(None), metric)
            m = v[own] / np.linalg.norm(v[own], axis=1)[:, None] if metric == "cosine" else v[own]
            true = -np.linalg.norm(m[:, None] - m[None], axis=2) if metric == "l2sq" else m @ m.T
            assert (low <= true).all() and (true <= high).all()
            assert np.median(high - low) < 0.1 * np.abs(true).max() + 2 * codedjoin.MARGIN


def test_defined_cases(spark):
    """Nulls, numbers that are not finite, repeated rows, columns of clashing names, empty sides."""
    nan, inf = float("nan"), float("inf")
    rows = [("a", "t", [1.0, 0.0], 1), ("a", "t", [1.0, 0.0], 1), ("b", "t", [0.0, 2.0], 2), ("c", "t", [nan, 1.0], 3),
            ("d", "t", [1.0, inf], 4), ("e", "t", [None, 1.0], 5), ("f", "t", None, 6), (None, "t", [1.0, 1.0], 7),
            ("g", None, [1.0, 1.0], 8), ("h", "t", [0.0, 0.0], 9)]
    df = spark.createDataFrame(rows, "vector_id string, bot_id string, embedding array<double>, class int")
    df = df.withColumns({"q": F.lit(1), "v": F.lit("x"), "n": F.lit(2), "code": F.lit(0)})
    asked = df.filter("vector_id in ('a', 'b', 'h')").dropDuplicates(["vector_id"]).withColumnRenamed("vector_id", "query_id")
    got = [tuple(r) for r in codedjoin.coded_join(df, asked, 5).orderBy("query_id", "rank").collect()]
    assert got == [("a", "a", 1.0, 1), ("a", "a", 1.0, 2), ("a", "b", 0.0, 3), ("b", "b", 1.0, 1), ("b", "a", 0.0, 2), ("b", "a", 0.0, 3)]
    assert codedjoin.coded_join(df.limit(0), asked, 5).count() == 0
    assert codedjoin.coded_join(df, asked.limit(0), 5).count() == 0
    assert codedjoin.coded_self_join(df.limit(0), 5).count() == 0


def shuffled(spark) -> int:
    """Bytes that this application has written to shuffles so far."""
    found = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(found.apply(i).totalShuffleWrite() for i in range(found.size()))


def test_fewer_bytes_are_shuffled(spark):
    """Both joins with chunks of one size, which cut each tenant many times; few pairs meet their floats."""
    rows = fx.kb_vectors(spark, SF, content=False).select("vector_id", "bot_id", "embedding").cache()
    n, k, chunk = rows.count(), 5, 2048
    start = shuffled(spark)
    plain = collected(batch.knn_join(rows, as_queries(rows), k, chunk_bytes=chunk))
    middle = shuffled(spark)
    agree(collected(codedjoin.coded_self_join(rows, k, chunk_bytes=chunk)), plain)
    assert 0 < shuffled(spark) - middle < (middle - start) / 2
    ids = codedjoin._members(rows.withColumnRenamed("vector_id", "id"), "ids")
    codes = codedjoin._encode(codedjoin._classes(ids, "classes"), "cosine")
    left = codedjoin._still_open(codedjoin._one_sided(codes, k, "cosine", chunk, 32 * k), k).count()
    assert n * k <= left < 4 * n * k
    rows.unpersist()


def test_shuffle_follows_the_rows(spark):
    """Twice the rows, of a size that cuts them into many chunks: about twice the bytes, for both joins."""
    plain, coded = [], []
    for n in (800, 1600):
        rng = np.random.RandomState(n)
        df = spark.createDataFrame([(f"v{i:04d}", "t", [float(x) for x in rng.standard_normal(32).astype(np.float32)])
                                    for i in range(n)], "vector_id string, bot_id string, embedding array<float>").cache()
        df.count()
        for used, run in ((plain, lambda: batch.knn_join(df, as_queries(df), 3, chunk_bytes=2048)),
                          (coded, lambda: codedjoin.coded_self_join(df, 3, chunk_bytes=512))):
            start = shuffled(spark)
            run().collect()
            used.append(shuffled(spark) - start)
        df.unpersist()
    assert plain[1] < 2.7 * plain[0] and coded[1] < 2.7 * coded[0], (plain, coded)
