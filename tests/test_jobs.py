"""Jobs from source to store."""

import datetime as dt

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from kbvec.operators.batch import search_batch
from kbvec.operators.search import search
from kbvec.plans import jobs
from kbvec.sources.store import VectorStore
from tests.test_golden import GOOD, kb, records

DAY = dt.datetime(2024, 1, 1)


@pytest.fixture
def store(spark, tmp_path):
    return VectorStore(spark, str(tmp_path / "store"), buckets=2)


def ids(store):
    return {r["vector_id"]: r["content"] for r in store.read().collect()}


def test_full_and_incremental_load(spark, store):
    rows = kb(spark, (1, "", "one", GOOD, None, None, DAY), (2, "", "two", "", None, None, DAY),
              (3, "u", "older", GOOD, None, None, DAY), (4, "u", "newer", GOOD, None, None, DAY))
    assert jobs.full_load(store, rows, 3) == {"scanned": 4, "upserted": 3, "skipped": 1, "flagged": True}
    md5 = rows.select(F.md5(F.lit("u"))).first()[0]
    assert ids(store) == {"kb_1": "one", md5: "newer"}
    again = jobs.full_load(store, rows, 3)
    assert again["upserted"] == 3 and len(ids(store)) == 2
    later = kb(spark, (1, "", "one, edited", GOOD, None, None, DAY + dt.timedelta(hours=2)),
               (5, "", "five", GOOD, None, None, DAY))
    assert jobs.incremental_load(store, later, DAY + dt.timedelta(hours=1), 3)["upserted"] == 1
    assert ids(store)["kb_1"] == "one, edited" and "kb_5" not in ids(store)
    assert jobs.full_load(store, rows.limit(0), 3) == {"scanned": 0, "upserted": 0, "skipped": 0, "flagged": False}


def test_a_malformed_row_leaves_the_store_as_it_was(spark, store):
    rows = kb(spark, (1, "", "one", GOOD, None, None, DAY))
    jobs.full_load(store, rows, 3)
    with pytest.raises(SparkRuntimeException):
        jobs.full_load(store, kb(spark, (9, "", "x", "a:1:{i:0;d:1.0;}", None, None, DAY)), 3)
    assert ids(store) == {"kb_1": "one"} and store.versions() == [1]


def test_import_records(spark, store):
    got = jobs.import_records(store, records(spark, ("a", [1.0], {"text": "t"}), ("b", None, None)), 1, "ns")
    assert got == {"copied": 1, "failed": 1, "namespace": "ns"} and ids(store) == {"a": "t"}


def test_posts(spark, store):
    posts = spark.createDataFrame([(1, "T", "<p>x</p>", "post", "publish", "u1"), (2, "", "", "post", "publish", "u2"),
                                   (3, "T", "x", "post", "draft", "u3")],
                                  "ID long, post_title string, post_content string, post_type string, post_status string, permalink string")
    embed = lambda df: df.withColumn("embedding", F.array(F.length("content").cast("double")))
    assert jobs.load_posts(store, posts, ["post"], embed, 1) == {"processed": 1, "failed": 1, "total": 2}
    assert list(ids(store).values()) == ["T\n\nx"]


def change(spark, *rows):
    df = spark.createDataFrame(list(rows), "seq long, vector_id string, op string, queued_at long, retries int, payload string, ok boolean")
    return df.select("*", F.lit("t").alias("bot_id"), F.array(F.lit(1.0)).alias("embedding"), F.col("payload").alias("content"))


def test_drain_job(spark, store):
    queue = change(spark, (1, "a", "upsert", 1, 0, "x", True), (2, "a", "upsert", 2, 0, "y", True),
                   (3, "b", "upsert", 3, 9, "z", False), (4, "c", "upsert", 4, 0, "z", False), (5, "d", "upsert", 5, 0, "z", True))
    left, aside, totals = jobs.drain(store, queue, F.col("ok"), cap=4)
    assert ids(store) == {"a": "y"}
    assert sorted((r["seq"], r["retries"]) for r in left.collect()) == [(4, 1), (5, 0)]
    assert [r["seq"] for r in aside.collect()] == [3]
    assert totals == {"drained": 2, "retried": 1, "quarantined": 1, "remaining": 2}
    left, _, totals = jobs.drain(store, left, F.lit(True))
    assert ids(store) == {"a": "y", "c": "z", "d": "z"} and left.count() == 0 and totals["drained"] == 2


def test_bootstrap_and_drift(spark, store, vectors):
    assert jobs.bootstrap(store, vectors.filter("bot_id = 'default'")) == 6
    found = jobs.drift_check(vectors, store.read(), pending=0)
    assert found["status"] == "drifted" and [r["bot_id"] for r in found["tenants"].collect()] == ["other"]
    assert jobs.drift_check(vectors, store.read(), pending=1)["drainable"] is True
    assert jobs.bootstrap(store, vectors) == 1 and jobs.bootstrap(store, vectors) == 0
    assert jobs.drift_check(vectors, store.read(), 0, "drifted")["status"] == "active"


def test_health(spark, vectors):
    log = spark.createDataFrame([(DAY, "searches"), (DAY, "query_cache_hit")], "ts timestamp_ntz, op string")
    queue = spark.createDataFrame([("retry",), ("quarantine",), ("waiting",)], "state string")
    stamp = lambda h: F.lit(DAY + dt.timedelta(hours=h)).cast("timestamp_ntz")
    options = {"now": stamp(2), "last_load": stamp(1)}
    got = jobs.health(lambda: vectors, log, queue, **options)
    assert got == {"enabled": True, "count": 6, "searches": 1, "cache_hits": 1, "cache_hit_rate": 0.5, "pending_count": 2,
                   "quarantine_count": 1, "last_load_age_s": 3600, "status": "healthy"}
    assert jobs.health(lambda: vectors, log, queue, enabled=False, **options)["status"] == "disabled"
    broken = jobs.health(lambda: spark.read.parquet("/tmp/kbvec-no-such-table"), log, queue, **options)
    assert broken["status"] == "error" and "kbvec-no-such-table" in broken["error"]


@pytest.mark.parametrize("metric", ["cosine", "l2sq", "ip"])
def test_search_over_int8_storage(spark, tmp_path, vectors, metric):
    exact, small = vectors.filter("vector_id <> 'z'"), VectorStore(spark, str(tmp_path / "s8"), storage="int8", buckets=1)
    small.upsert(exact)
    q = [0.7, 0.3, 0.1]
    want = {r["vector_id"]: r["score"] for r in search(exact, q, 9, metric=metric).collect()}
    got = {r["vector_id"]: r["score"] for r in search(small.read(), q, 9, metric=metric).collect()}
    asked = spark.createDataFrame([("q", "default", q)], "query_id string, bot_id string, embedding array<double>")
    block = {r["vector_id"]: r["score"] for r in search_batch(small.read(), asked, 9, metric).collect()}
    assert got.keys() == want.keys() == block.keys()
    assert all(abs(got[i] - want[i]) < 0.02 and abs(got[i] - block[i]) < 1e-9 for i in want)
