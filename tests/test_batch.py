"""Batch searches against brute force, with hot tenants, copies and zero vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kbvec.operators import ann, batch, bm25, hybrid, textindex
from kbvec.operators.filters import tenant_rows
from kbvec.operators.search import rerank_groups
from kbvec.schema import conform


def make(spark, n=400, dim=8, seed=3):
    """Two thirds of the rows in one tenant, a third of them copies of one vector, some zero vectors."""
    rng = np.random.RandomState(seed)
    centers = rng.standard_normal((6, dim)) * 3
    rows = []
    for i in range(n):
        v = centers[i % 6] + rng.standard_normal(dim) * 0.2
        if i % 3 == 0:
            v = centers[0]
        if i % 50 == 7:
            v = np.zeros(dim)
        tenant = "hot" if i % 3 < 2 else f"t{i % 4}"
        rows.append((f"v{i:04d}", tenant, [float(x) for x in v.astype(np.float32)]))
    return spark.createDataFrame(rows, "vector_id string, bot_id string, embedding array<float>"), rows


def brute(rows, queries, k, metric):
    out = {}
    for qid, qt, q in queries:
        q, scored = np.array(q, dtype=np.float64), []
        for vid, t, v in rows:
            if t != qt:
                continue
            v = np.array(v, dtype=np.float64)
            if metric == "cosine":
                norm = np.linalg.norm(v) * np.linalg.norm(q)
                if norm == 0:
                    continue
                s = v @ q / norm
            else:
                s = -np.linalg.norm(v - q) if metric == "l2sq" else v @ q
            scored.append((-round(s, 9), vid))
        for rank, (s, vid) in enumerate(sorted(scored)[:k], 1):
            out[qid, rank] = (vid, -s + 0.0)
    return out


def agree(got, want):
    assert {key: v for key, (v, _) in got.items()} == {key: v for key, (v, _) in want.items()}
    assert all(abs(got[key][1] - want[key][1]) < 1e-8 for key in want)


def collected(df):
    return {(r["query_id"], r["rank"]): (r["vector_id"], r["score"]) for r in df.collect()}


def as_queries(df):
    return df.withColumnRenamed("vector_id", "query_id")


@pytest.mark.parametrize("metric", ["cosine", "l2sq", "ip"])
def test_search_batch(spark, metric):
    df, rows = make(spark, 150)
    got = collected(batch.search_batch(df.repartition(5), as_queries(df), 7, metric))
    agree(got, brute(rows, rows, 7, metric))


@pytest.mark.parametrize("metric", ["cosine", "l2sq"])
def test_packed_vectors(spark, metric):
    df, rows = make(spark, 150)
    packed = batch.pack(df.repartition(3))
    assert packed.columns == df.columns and packed.schema["embedding"].dataType.typeName() == "binary"
    want = brute(rows, rows, 5, metric)
    agree(collected(batch.search_batch(packed, as_queries(df), 5, metric)), want)
    agree(collected(batch.knn_join(packed, as_queries(packed), 5, metric, chunk_bytes=700)), want)


def test_search_batch_without_queries(spark):
    df, _ = make(spark, 20)
    assert batch.search_batch(df, as_queries(df).limit(0), 3).count() == 0


@pytest.mark.parametrize("metric, chunk_bytes", [("cosine", 1 << 20), ("cosine", 1000), ("l2sq", 2000), ("ip", 1500)])
def test_knn_join(spark, metric, chunk_bytes):
    df, rows = make(spark)
    got = collected(batch.knn_join(df.repartition(4), as_queries(df), 6, metric, chunk_bytes=chunk_bytes))
    agree(got, brute(rows, rows, 6, metric))


def test_knn_join_chunks_are_bounded(spark):
    """A tenant with two thirds of the rows is cut into chunks; none is much larger than asked for."""
    df, _ = make(spark, 3000)
    packed = batch.pack(df)
    plan = {r["bot_id"]: r["v_chunks"] for r in batch._chunks(packed, 3200, "v_chunks").collect()}
    assert plan["hot"] == 20 and max(plan[t] for t in plan if t != "hot") <= 4
    sizes = packed.filter("bot_id = 'hot'").groupBy(F.pmod(F.xxhash64("vector_id"), F.lit(20)).alias("v")).count()
    assert sizes.agg(F.max("count")).first()[0] < 2 * 100


def by_source(rows, urls, queries, k):
    """Brute force, best row per source."""
    full, out = brute(rows, queries, len(rows), "cosine"), {}
    for qid, _, _ in queries:
        seen, rank = set(), 0
        for n in range(1, len(rows) + 1):
            if (qid, n) in full and rank < k:
                source = urls.get(full[qid, n][0]) or full[qid, n][0]
                if source not in seen:
                    seen.add(source)
                    rank += 1
                    out[qid, rank] = full[qid, n]
    return out


@pytest.mark.parametrize("block", [2048, 30])
def test_batch_with_filter_and_dedup(spark, block):
    df, rows = make(spark, 150)
    number = F.substring("vector_id", 2, 9).cast("int")
    url = F.when(number % 4 == 0, "").otherwise(F.concat(F.lit("u"), (number / 7).cast("int").cast("string")))
    typed = df.withColumns({"source_url": url, "content_type": F.when(number % 5 == 0, "page").otherwise("post")})
    urls = {r["vector_id"]: r["source_url"] for r in typed.collect()}
    got = collected(batch.search_batch(typed, as_queries(df), 6, dedup=True, block=block))
    agree(got, by_source(rows, urls, rows, 6))
    posts = [r for r in rows if int(r[0][1:]) % 5]
    got = collected(batch.search_batch(typed, as_queries(df), 6, spec={"type": {"$eq": "post"}}, block=block))
    agree(got, brute(posts, rows, 6, "cosine"))
    same = collected(batch.search_collapsed(typed, as_queries(df), 6, spec={"type": {"$eq": "post"}}).drop("key"))
    agree(same, brute(posts, rows, 6, "cosine"))


def test_mixed_dimensions_are_refused(spark):
    df = spark.createDataFrame([("a", "t", [1.0, 2.0, 3.0]), ("b", "t", [4.0])], "vector_id string, bot_id string, embedding array<float>")
    asked = spark.createDataFrame([("q", "t", [1.0, 2.0])], "query_id string, bot_id string, embedding array<double>")
    with pytest.raises(Exception, match="1 to 3 components"):
        batch.search_batch(df.coalesce(1), asked, 2).collect()


def test_hybrid_batch_equals_single_searches(spark, vectors):
    asked = spark.createDataFrame([("1", "default", [1.0, 0.2, 0.0], "gamma beta"), ("2", "default", [0.0, 1.0, 0.0], "delta"),
                                   ("3", "other", [1.0, 0.0, 0.0], "alpha"), ("4", "default", [1.0, 0.0, 0.0], None),
                                   ("5", "default", [0.3, 0.2, 0.0], "absent")],
                                  "query_id string, bot_id string, embedding array<double>, query_text string")
    for dedup in (False, True):
        for spec in (None, {"type": {"$in": ["post", "page"]}}):
            got = collected(hybrid.hybrid_batch(vectors, asked, 3, spec=spec, dedup=dedup))
            for r in asked.collect():
                one = hybrid.hybrid_search(vectors, r["embedding"], r["query_text"], 3, r["bot_id"], spec, dedup=dedup).collect()
                agree({k: v for k, v in got.items() if k[0] == r["query_id"]},
                      {(r["query_id"], i): (x["vector_id"], x["score"]) for i, x in enumerate(one, 1)})


def test_knn_join_with_more_neighbours_than_rows(spark):
    df, rows = make(spark, 60)
    got = collected(batch.knn_join(df, as_queries(df), 50, chunk_bytes=400))
    agree(got, brute(rows, rows, 50, "cosine"))


@pytest.mark.parametrize("metric", ["cosine", "ip"])
def test_large_query_sets(spark, metric):
    df, rows = make(spark, 120)
    got = collected(batch.search_batch(df, as_queries(df), 4, metric, block=50))
    agree(got, brute(rows, rows, 4, metric))


def test_equal_queries_are_searched_once(spark):
    df, rows = make(spark, 60)
    asked = as_queries(df).filter("query_id = 'v0001'").crossJoin(spark.range(30)).select(
        F.col("id").cast("string").alias("query_id"), "bot_id", "embedding")
    got = batch.search_collapsed(df, asked, 3)
    assert got.select("key").distinct().count() == 1 and got.count() == 90
    want = brute(rows, [r for r in rows if r[0] == "v0001"], 3, "cosine")
    assert {(r["rank"], r["vector_id"]) for r in got.collect()} == {(rank, v) for (_, rank), (v, _) in want.items()}


def test_rerank_per_query(spark):
    df, _ = make(spark, 60)
    found = batch.search_batch(df, as_queries(df), 3).drop("rank")

    def worst_first(pdf):
        return pdf.assign(score=-pdf["score"]).sort_values("score", ascending=False).head(1)
    got = rerank_groups(found, worst_first, found.schema)
    assert got.count() == found.select("query_id").distinct().count()


def test_ann_recall_grows_to_one(spark, tmp_path):
    df, _ = make(spark)
    exact = batch.search_batch(df, as_queries(df), 5)
    wide = ann.HyperplaneHash(8, tables=12, bits=2)
    ann.build_index(df, wide, str(tmp_path / "index"))
    found = ann.ann_search(str(tmp_path / "index"), as_queries(df), wide, 5)
    assert found.groupBy("query_id", "vector_id").count().filter("count > 1").count() == 0
    assert ann.recall(found, exact).agg(F.avg("recall")).first()[0] > 0.95


# --- text --------------------------------------------------------------------------------------

def corpus(spark):
    texts = ["the cat sat", "the dog sat on the cat", "birds", "the the the", "cat cat dog", "", None] + ["the same copy"] * 20
    return spark.createDataFrame([(f"d{i:02d}", t) for i, t in enumerate(texts)], "vector_id string, content string")


ASKED = [("q1", "the cat"), ("q2", "dog"), ("q3", "absent"), ("q4", "copy same the"), ("q5", "")]


def test_single_and_batch_bm25_agree(spark):
    docs = corpus(spark)
    asked = spark.createDataFrame(ASKED, "query_id string, query_text string")
    got = collected(bm25.bm25_batch(docs, asked, 8))
    assert {q for q, _ in got} == {"q1", "q2", "q4"}
    for qid, text in ASKED:
        want = bm25.bm25_top(docs, text, 8).collect()
        agree({k: v for k, v in got.items() if k[0] == qid},
              {(qid, i): (r["vector_id"], r["score"]) for i, r in enumerate(want, 1)})
    assert [got["q4", i][0] for i in (1, 2, 3)] == ["d07", "d08", "d09"]  # equal copies: by id


def test_bm25_in_blocks(spark):
    docs, asked = corpus(spark), spark.createDataFrame(ASKED, "query_id string, query_text string")
    assert collected(bm25.bm25_batch(docs, asked, 8, block=2)) == collected(bm25.bm25_batch(docs, asked, 8))


def test_bm25_counts_texts_once_for_all_blocks(spark, monkeypatch):
    runs, stage = [], bm25._stage
    monkeypatch.setattr(bm25, "_stage", lambda *a: runs.append(1) or stage(*a))
    bm25.bm25_batch(corpus(spark), spark.createDataFrame(ASKED, "query_id string, query_text string"), 8, block=1).count()
    assert len(runs) == 1


def test_bm25_value(spark):
    got = bm25.bm25_top(corpus(spark), "birds", 5).collect()
    n, df, dl, avgdl = 27, 1, 1, (3 + 6 + 1 + 3 + 3 + 60) / 27
    idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
    assert [r["vector_id"] for r in got] == ["d02"]
    assert got[0]["score"] == pytest.approx(idf * 2.2 / (1 + 1.2 * (0.25 + 0.75 * dl / avgdl)))


def test_text_index_equals_live_text(spark, vectors, tmp_path):
    path = str(tmp_path / "index")
    textindex.build_index(vectors, path, buckets=4)
    for text in ("alpha beta", "delta", "absent", ""):
        for spec in (None, {"type": {"$in": ["post", "page"]}}):
            own = tenant_rows(vectors, "default", spec)
            live = bm25.bm25_top(vectors, text, 5, own).collect()
            stored = textindex.index_top(spark, path, text, 5, "default", spec).collect()
            assert [r["vector_id"] for r in stored] == [r["vector_id"] for r in live]
            assert [r["score"] for r in stored] == pytest.approx([r["score"] for r in live])
    textindex.build_index(vectors, path + "-7", buckets=4, version=7)
    assert textindex.index_top(spark, path + "-7", "delta", 5, version=7).count() > 0
    for stale in (None, 8):
        with pytest.raises(ValueError, match="version 7"):
            textindex.index_top(spark, path + "-7", "delta", 5, version=stale)
    q = [1.0, 0.2, 0.0]
    live = hybrid.hybrid_search(vectors, q, "gamma beta", 5).collect()
    stored = hybrid.hybrid_search(vectors, q, "gamma beta", 5, text_index=path).collect()
    assert [r["vector_id"] for r in stored] == [r["vector_id"] for r in live]


def test_text_index_reads_only_its_buckets(spark, vectors, tmp_path):
    path = str(tmp_path / "index")
    textindex.build_index(vectors, path, buckets=4)
    plan = textindex.index_scores(spark, path, ["alpha"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [(bucket" in plan
    assert "EqualTo(word,alpha)" in plan


def test_hybrid_invariants(vectors):
    q = [1.0, 0.2, 0.0]
    ids = lambda df: [r["vector_id"] for r in df.collect()]
    plain = ids(hybrid.hybrid_search(vectors, q, "", 5))
    assert ids(hybrid.hybrid_search(vectors, q, "gamma", 5, alpha=1.0)) == plain
    assert ids(hybrid.hybrid_search(vectors, q, "gamma", 5, text_available=False)) == plain
    pulled = hybrid.hybrid_search(vectors, q, "delta", 5, alpha=0.1)
    assert ids(pulled)[0] == "d" and all(0 <= r["score"] <= 1 for r in pulled.collect())
    # No text hit: the vector leg is still normalised and weighted.
    unmatched = hybrid.hybrid_search(vectors, q, "absent", 5, alpha=0.5).collect()
    assert unmatched[0]["score"] == 0.5
    # Rows found by text only are no candidates of the vector leg's tenant and filter.
    assert "b" not in ids(hybrid.hybrid_search(vectors, q, "gamma", 5, spec={"type": {"$eq": "post"}}))
    assert len([u for u in hybrid.hybrid_search(vectors, q, "alpha", 5, dedup=True).collect() if u["source_url"] == "u/a"]) == 1


def test_hybrid_dedup_is_complete(spark):
    """One source fills the legs many times over; the other sources come all the same."""
    near = [(f"a{i:04d}", [1.0, i / 1e6], "alpha beta", "u/a") for i in range(900)]
    far = [(f"b{i}", [0.5 - i / 100, 1.0], "alpha gamma", f"u/b{i}") for i in range(6)]
    rows = conform(spark.createDataFrame([(v, "default", e, c, u) for v, e, c, u in near + far],
                                         "vector_id string, bot_id string, embedding array<double>, content string, source_url string"))
    got = hybrid.hybrid_search(rows, [1.0, 0.0], "alpha", 5, dedup=True).collect()
    assert [r["source_url"] for r in got] == ["u/a", "u/b0", "u/b1", "u/b2", "u/b3"]
    assert [r["source_url"] for r in hybrid.hybrid_search(rows, [1.0, 0.0], "alpha", 9, dedup=True).collect()] == [
        "u/a", *[f"u/b{i}" for i in range(6)]]
    asked = spark.createDataFrame([("q", "default", [1.0, 0.0], "alpha"), ("r", "default", [0.0, 1.0], "gamma"), ("s", "default", [1.0, 0.0], "")],
                                  "query_id string, bot_id string, embedding array<double>, query_text string")
    found = {}
    for r in hybrid.hybrid_batch(rows, asked, 5, dedup=True).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r["vector_id"])
    assert found["q"] == [r["vector_id"] for r in got] and found["r"][0] == "b5" and {len(v) for v in found.values()} == {5}


def test_text_index_parts_follow_the_texts(spark, tmp_path, monkeypatch):
    """More text is more files of a bucket, counted some words at a time; scores stay those of the whole table."""
    monkeypatch.setattr(textindex, "PART_BYTES", 200)
    monkeypatch.setattr(textindex, "WORDS_AT_ONCE", 7)
    files, found = [], []
    for n in (40, 160):
        rows = [(f"v{i:03d}", "default", f"alpha w{i % 9} w{i % 5} " + "beta " * (i % 4), f"u/{i}", "public", "post", None)
                for i in range(n)] + [("none", "default", None, "", "public", "post", None)]
        df = spark.createDataFrame(rows, "vector_id string, bot_id string, content string, source_url string, "
                                   "role_restriction string, content_type string, chunk_index int")
        path = f"{tmp_path}/{n}"
        textindex.build_index(df, path, buckets=2)
        files.append(len(list((tmp_path / str(n)).glob("postings/*/*.parquet"))))
        stored = textindex.index_top(spark, path, "beta w3", 8).collect()
        live = bm25.bm25_top(df, "beta w3", 8).select("vector_id", F.round("score", 9).alias("score")).collect()
        found.append([(r["vector_id"], round(r["score"], 8)) for r in stored] == [(r["vector_id"], round(r["score"], 8)) for r in live])
    assert all(found) and files[0] > 2 and files[1] > 2 * files[0], (files, found)
