"""The plans are the ones intended."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from kbvec.operators import ann, mutate, replicate
from kbvec.operators.search import dedup_sources, search
from kbvec.plans import search_queries

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_flagship_stays_in_the_jvm(spark):
    text = plan(search_queries.flagship(spark, SF))
    assert "TakeOrderedAndProject" in text
    for bad in ("ArrowEvalPython", "MapInArrow", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


def test_search_reads_and_filters_at_the_scan(spark, vectors, tmp_path):
    path = str(tmp_path / "v")
    vectors.write.partitionBy("bot_id").parquet(path)
    found = search(spark.read.parquet(path), [1.0, 0.0, 0.0], 5, spec={"type": {"$eq": "post"}})
    text = plan(found.select("vector_id", "score"))
    assert "PartitionFilters: [isnotnull(bot_id" in text and "EqualTo(content_type,post)" in text
    schema = [line for line in text.splitlines() if line.startswith("ReadSchema")][0]
    assert "content:" not in schema and "source_url" not in schema


def test_ranks_are_pruned_before_the_shuffle(spark, vectors):
    for df in (dedup_sources(vectors.withColumn("score", F.lit(1.0)), 5),
               mutate.last_per_id(vectors.withColumn("seq", F.lit(1)), "seq"),
               replicate.latest_changes(vectors.withColumn("seq", F.lit(1)).withColumn("op", F.lit("upsert")))):
        assert "WindowGroupLimit" in plan(df)


def test_ann_reads_only_its_buckets(spark, vectors, tmp_path):
    hashing = ann.HyperplaneHash(3, tables=2, bits=2)
    ann.build_index(vectors, hashing, str(tmp_path / "i"))
    asked = vectors.limit(1).withColumnRenamed("vector_id", "query_id")
    found = ann.ann_search(str(tmp_path / "i"), asked, hashing, 2)
    assert found.count() > 0 and "CartesianProduct" not in plan(found)
    stored = spark.read.parquet(str(tmp_path / "i/vectors"))
    assert stored.count() == vectors.filter("embedding is not null").count()  # each vector once
    assert "embedding" not in spark.read.parquet(str(tmp_path / "i/postings")).columns
    assert ann.HyperplaneHash.for_rows(3, 10).bits == 1 and ann.HyperplaneHash.for_rows(3, 256 << 10).bits == 10


def test_tenant_search_reads_one_folder(spark):
    text = plan(search_queries.knn_tenant(spark, SF))
    assert "PartitionFilters: [isnotnull(bot_id" in text


def test_signature_is_aggregated_before_the_shuffle(spark, vectors):
    text = plan(replicate.tenant_signature(vectors))
    assert "partial_sum" in text and "collect_list" not in text


def test_row_diff_shuffles_hashes_only(spark, vectors):
    text = plan(replicate.row_diff(vectors, vectors.withColumn("content", F.lit("x"))))
    exchanged = [block for block in text.split("\n\n") if "Exchange" in block.split("\n")[0]]
    assert exchanged and not any("content" in block or "embedding" in block for block in exchanged)
