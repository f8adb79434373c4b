"""The versioned store, and streams that write into it."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kbvec.schema import conform
from kbvec.sources.store import VectorStore
from kbvec.sources.tables import read_vectors, write_vectors
from kbvec.streaming import ingest as live
from kbvec.streaming import latency

NOW = "timestamp_ntz'2024-01-02 00:00:00'"


def held(store, version=None):
    return {r["vector_id"]: (r["bot_id"], r["content"]) for r in store.read(version).collect()}


def rows(spark, *data):
    df = spark.createDataFrame(list(data), "vector_id string, bot_id string, content string")
    return df.withColumn("embedding", F.array(F.lit(1.0)))


def test_versions(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path / "s"), buckets=2)
    assert store.read().count() == 0 and store.versions() == []
    store.upsert(rows(spark, ("a", "t/1: x", "1"), ("b", "t/1: x", "1"), ("c", "u", "1")))
    store.upsert(rows(spark, ("a", "t/1: x", "2"), ("c", "t/1: x", "2"), ("d", None, "2"), ("e", "", "2")))
    want = {"a": ("t/1: x", "2"), "b": ("t/1: x", "1"), "c": ("t/1: x", "2"), "d": ("default", "2"), "e": ("default", "2")}
    assert held(store) == want
    assert held(store, 1) == {"a": ("t/1: x", "1"), "b": ("t/1: x", "1"), "c": ("u", "1")}
    store.upsert(rows(spark, ("a", "t/1: x", "2")))
    assert held(store) == want and store.versions() == [1, 2, 3]


def test_upsert_counts_accepted_rows(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path / "s"), buckets=2)
    data = rows(spark, ("a", "t", "1"), ("a", "t", "2"), ("", "t", "x")).withColumn("seq", F.monotonically_increasing_id())
    assert store.upsert(data, "seq") == 2 and held(store) == {"a": ("t", "2")}
    assert store.upsert(data.limit(0), "seq") == 0 and store.versions() == [1]


def test_deletes_empty_their_partitions(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path / "s"), buckets=2)
    store.upsert(rows(spark, ("a", "t", "1"), ("b", "u", "1"), ("c", "u", "1")))
    ids = rows(spark, ("a", "", ""), ("b", "", ""), ("no", "", "")).select("vector_id")
    assert store.delete_ids(ids, "t") == {"requested": 3, "deleted": 1}
    assert set(held(store)) == {"b", "c"} and len(held(store, 1)) == 3
    assert store.delete_url("", "t") == 0 and store.delete_url("", "u") == 2 and held(store) == {}
    store.upsert(rows(spark, ("z", "t", "1")))
    assert set(held(store)) == {"z"}


def test_bulk_delete_and_compaction(spark, vectors, tmp_path):
    store = VectorStore(spark, str(tmp_path / "s"), buckets=2)
    store.upsert(vectors)
    entries = spark.createDataFrame([("a1", "pinecone", "u/a", "true"), ("b", "pinecone", None, None), ("c", "wordpress", "", "false")],
                                    "id string, source string, sourceUrl string, isGroup string")
    assert store.delete_entries(entries) == 3 and set(held(store)) == {"c", "d", "z", "x"}
    alive = spark.createDataFrame([(1, "nothing")], "id long, source_url string")
    now = dt.datetime(2024, 1, 1)
    assert store.compact(alive, 3, last_load=now, now=now)["ok"] is False
    assert store.compact(alive)["ok"] is False  # the store itself was written just now
    later = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(hours=2)
    assert store.compact(alive, 3, now=later) == {"ok": True, "deleted": 3} and set(held(store)) == {"z"}


def test_restore(spark, vectors, tmp_path):
    store = VectorStore(spark, str(tmp_path / "s"), buckets=2)
    own = rows(spark, ("a1", "default", "other text"), ("own", "default", "stays"))
    store.upsert(own.withColumn("embedding", F.array(F.lit(1.0), F.lit(2.0), F.lit(0.0))))
    write_vectors(vectors, str(tmp_path / "backup"))
    assert store.restore(str(tmp_path / "backup")) == 7
    assert held(store)["a1"] == ("default", "alpha beta") and "own" in held(store) and len(held(store)) == 8


def test_untouched_partitions_are_not_rewritten(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path / "s"), buckets=1)
    store.upsert(rows(spark, ("a", "t", "1"), ("b", "u", "1")))
    store.upsert(rows(spark, ("b", "u", "2")))
    files = store.read().select(F.input_file_name().alias("f"), "bot_id").distinct().collect()
    assert {("00000001" in r["f"].split("/data/")[1], r["bot_id"]) for r in files} == {(True, "t"), (False, "u")}


def test_version_conflict(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path / "s"))
    store.upsert(rows(spark, ("a", "t", "1")))
    with pytest.raises(RuntimeError, match="someone else"):
        store._publish(1, 1, {})


def test_interleaved_writers_lose_nothing(spark, tmp_path):
    """Another writer publishes between this one's data and its version: this one fails, the other's rows stay."""
    store, other = (VectorStore(spark, str(tmp_path / "s"), buckets=1) for _ in range(2))
    store.upsert(rows(spark, ("a", "t", "1")))
    publish = store._publish

    def late(*args):
        other.upsert(rows(spark, ("b", "t", "theirs")))
        publish(*args)

    store._publish = late
    with pytest.raises(RuntimeError, match="someone else"):
        store.upsert(rows(spark, ("c", "t", "mine")))
    store._publish = publish
    assert set(held(store)) == {"a", "b"}
    store.upsert(rows(spark, ("c", "t", "mine")))
    assert set(held(store)) == {"a", "b", "c"}


def test_dimension_of_the_store(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path / "s"), buckets=2)
    store.upsert(rows(spark, ("a", "t", "1")))
    two = rows(spark, ("b", "t", "2")).withColumn("embedding", F.array(F.lit(1.0), F.lit(2.0)))
    for write in (store.upsert, lambda r: store.apply_changes(r.withColumn("op", F.lit("upsert")).withColumn("seq", F.lit(1)))):
        with pytest.raises(ValueError, match="dimension"):
            write(two)
    with pytest.raises(ValueError, match="dimension"):
        store.upsert(rows(spark, ("c", "t", "1")).unionByName(two))
    assert set(held(store)) == {"a"} and store.versions() == [1]


def test_a_write_reads_only_its_buckets(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path / "s"), buckets=64)
    store.upsert(rows(spark, *[(f"v{i}", f"t{i % 3}", "1") for i in range(200)]))
    one_id = rows(spark, ("v7", "t1", "2"))
    files = store.around(one_id).inputFiles()
    assert 0 < len(files) <= 3 and len({f.split("bucket=")[1].split("/")[0] for f in files}) == 1
    for i in range(4):
        store.upsert(rows(spark, (f"v{i}", "t0", "3")))
    assert store.read()._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_int8_store(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path / "s"), storage="int8", buckets=1)
    store.upsert(rows(spark, ("a", "t", "1")).withColumn("embedding", F.array(F.lit(0.5), F.lit(-2.0))))
    assert store.read().first()["embedding"] == [64, -128]
    with pytest.raises(ValueError, match="int8"):
        VectorStore(spark, str(tmp_path / "s"), buckets=1).read()


def test_export_import_is_the_identity(spark, vectors, tmp_path):
    path = str(tmp_path / "backup")
    assert write_vectors(vectors, path) == 7
    assert write_vectors(vectors.limit(0), path + "-empty") == 0
    assert sorted(map(str, read_vectors(spark, path).collect())) == sorted(map(str, vectors.collect()))


def kb_batch(spark, path, *data):
    (spark.createDataFrame([(i, u, c, "a:1:{i:0;d:1.0;}", "public", "post", t) for i, u, c, t in data],
                           "id long, source_url string, article_content string, embedding_vector string, "
                           "role_restriction string, content_type string, timestamp timestamp_ntz")
     .coalesce(1).write.mode("append").parquet(path))


def test_stream_ignores_replays_and_older_rows(spark, tmp_path):
    source, day = str(tmp_path / "kb"), dt.datetime(2024, 1, 1)
    store = VectorStore(spark, str(tmp_path / "s"), buckets=1)

    def run():
        stream = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", 1).parquet(source)
        live.stream_kb(stream, store, 1, str(tmp_path / "c"), str(tmp_path / "rejects")).awaitTermination()

    kb_batch(spark, source, (1, "u", "new", day + dt.timedelta(hours=2)), (2, "", "only", day), (1, "u", "old", day))
    run()
    kb_batch(spark, source, (1, "u", "late", day + dt.timedelta(hours=1)), (2, "", "same time", day))
    run()
    kb_batch(spark, source, (1, "u", "newest", day + dt.timedelta(hours=3)))
    run()
    assert sorted(c for _, c in held(store).values()) == ["newest", "same time"]
    # A row of another length is set aside; the others of its batch arrive.
    kb_batch(spark, source, (3, "", "three", day))
    bad = spark.read.parquet(source).limit(1).withColumn("embedding_vector", F.lit("a:2:{i:0;d:1;i:1;d:1;}"))
    bad.withColumn("id", F.lit(9).cast("long")).coalesce(1).write.mode("append").parquet(source)
    run()
    assert "three" in {c for _, c in held(store).values()}
    assert [r["source_row"] for r in spark.read.parquet(str(tmp_path / "rejects")).collect()] == [9]


def requests(spark, path, n=600, files=4):
    """A request log in several files, in time order."""
    df = spark.range(n).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id * 3 AS int)) AS ts",
        "IF(id % 3 = 0, 1, id % 4) AS namespace", "id * 37 % 101 AS latency_ms")
    for f in range(files):
        df.filter((F.col("event_id") >= f * n // files) & (F.col("event_id") < (f + 1) * n // files)) \
            .coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return df, stream


def same(left, right):
    return sorted(map(str, left.collect())) == sorted(map(str, right.collect()))


@pytest.mark.parametrize("build", [
    lambda df: latency.latency_windows(df, "1 hour"), lambda df: latency.latency_windows(df, "1 hour", "15 minutes"),
    lambda df: latency.quota_windows(df, 4, "1 hour")])
def test_windows_equal_batch(spark, tmp_path, build):
    df, stream = requests(spark, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    windows = build(stream)
    (windows.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
     .trigger(availableNow=True).start(out).awaitTermination())
    closed = df.agg(F.max("ts") - F.expr("INTERVAL 10 MINUTES")).first()[0]
    end = F.col("window_start") + F.expr("INTERVAL 1 HOUR")
    want = build(df).filter(end <= F.lit(closed).cast("timestamp_ntz"))
    assert want.count() > 5 and same(spark.read.schema(windows.schema).parquet(out), want)
