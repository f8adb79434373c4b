"""Streams with keyed state: the rolling window and the change stream."""

import datetime as dt

from pyspark.sql import functions as F

from kbvec.sources.store import VectorStore
from kbvec.streaming import changes, latency

START = dt.datetime(2024, 1, 1)
ENTRY = "seq long, vector_id string, op string, content string, retries int, ok boolean"


def requests(spark, path, *data):
    """Requests of (seconds after the start, namespace, latency), one file."""
    df = spark.createDataFrame([(i, START + dt.timedelta(seconds=s), n, ms) for i, (s, n, ms) in enumerate(data)],
                               "event_id long, ts timestamp_ntz, namespace string, latency_ms long")
    df.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def rolling(spark, checkpoint, seconds):
    now = F.lit(START + dt.timedelta(seconds=seconds)).cast("timestamp_ntz")
    return {r["namespace"]: tuple(r)[1:] for r in latency.rolling_percentiles(spark, checkpoint, now).collect()}


def test_rolling_window_equals_plain_counting(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "c")
    parts = [[(p * 4000 + i * 7, "ab"[i % 3 == 0], (i * 37 + p) % 101 - 3) for i in range(500)] for p in range(3)]
    for p, part in enumerate(parts):
        latency.run_rolling(requests(spark, source, *part), checkpoint, shards=2).awaitTermination()
        now = max(s for s, _, _ in part)
        for namespace, got in rolling(spark, checkpoint, now).items():
            v = sorted(max(0, ms) for q in parts[:p + 1] for s, n, ms in q if n == namespace and now - 3600 <= s <= now)
            assert got == (v[len(v) // 2], v[min(len(v) - 1, int(len(v) * .95))], v[min(len(v) - 1, int(len(v) * .99))], len(v))
    # Minutes that the watermark has left an hour behind are gone from the state.
    state = spark.read.format("statestore").option("stateVarName", "minutes").load(checkpoint)
    assert state.agg(F.min("user_map_key.minute")).first()[0] >= START.replace(tzinfo=dt.timezone.utc).timestamp() // 60 + (8000 + 499 * 7 - 600 - 3600) // 60 - 1


def test_late_samples_count_within_the_window(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "c")
    for part in ([(0, "a", 5), (3000, "a", 7)], [(2500, "a", 9), (2999, "b", -4)], [(3001, "a", 7)]):
        latency.run_rolling(requests(spark, source, *part), checkpoint).awaitTermination()
    assert rolling(spark, checkpoint, 3001) == {"a": (7, 9, 9, 4), "b": (0, 0, 0, 1)}
    assert rolling(spark, checkpoint, 3601) == {"a": (7, 9, 9, 3), "b": (0, 0, 0, 1)}


def held(store):
    return {r["vector_id"]: (r["bot_id"], r["content"]) for r in store.read().collect()}


class Replica:
    """A store, and runs of its change stream that start from the checkpoint each."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, path
        self.store = VectorStore(spark, str(path / "s"), buckets=2)

    def run(self, *data, files=1, **options):
        df = self.spark.createDataFrame(list(data), ENTRY)
        whole = df.select("*", F.lit("t").alias("bot_id"), F.array(F.lit(0.1)).alias("embedding"),
                          F.when(F.col("content") == "none", "").otherwise("p").alias("payload"), F.col("seq").alias("queued_at"),
                          F.lit("2024-01-01 00:00:00.123456").cast("timestamp_ntz").alias("updated_at"))
        self.schema = whole.schema
        whole.repartition(files).write.mode("append").parquet(str(self.path / "in"))
        stream = self.spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(str(self.path / "in"))
        changes.stream_changes(stream, self.store, F.col("ok"), str(self.path / "aside"), str(self.path / "c"),
                               **options).awaitTermination()

    def waiting(self):
        return {(r["vector_id"], r["seq"]): r["retries"] for r in changes.waiting(self.spark, str(self.path / "c"), self.schema).collect()}

    def aside(self):
        rows = self.spark.read.schema(self.schema).parquet(str(self.path / "aside" / "batch=*")).collect()
        return sorted((r["vector_id"], r["seq"], r["retries"]) for r in rows)


def test_changes_and_failures(spark, tmp_path):
    replica = Replica(spark, tmp_path)
    replica.run((1, "a", "upsert", "1", 0, True), (2, "b", "upsert", "1", 0, True), (3, "a", "upsert", "2", 0, True),
                (4, "b", "delete", "x", 0, True), (5, "c", "upsert", "2", 0, False), (6, "d", "upsert", "2", 9, False),
                (7, "e", "upsert", "none", 0, True), (8, "f", "upsert", "2", None, None))
    assert held(replica.store) == {"a": ("t", "2")}
    assert replica.waiting() == {("c", 5): 1, ("f", 8): 1} and replica.aside() == [("d", 6, 10)]
    row = replica.store.read().first()
    assert row["updated_at"] == dt.datetime(2024, 1, 1, 0, 0, 0, 123456) and abs(row["embedding"][0] - 0.1) < 1e-8
    seen = {r["vector_id"]: r["seq"] for r in changes.applied(spark, str(tmp_path / "c")).collect()}
    assert seen == {"a": 3, "b": 4}


def test_older_changes_that_arrive_late_are_skipped(spark, tmp_path):
    replica = Replica(spark, tmp_path)
    replica.run((9, "a", "upsert", "new", 0, True), (8, "b", "delete", "", 0, True))
    replica.run((3, "a", "upsert", "old", 0, True), (4, "b", "upsert", "old", 0, True), files=2)
    assert held(replica.store) == {"a": ("t", "new")}
    replica.run((2, "c", "delete", "", 0, True), (7, "b", "upsert", "old", 0, True), (11, "b", "upsert", "again", 0, True),
                (10, "c", "upsert", "c", 0, True))
    assert held(replica.store) == {"a": ("t", "new"), "b": ("t", "again"), "c": ("t", "c")}


def test_failed_changes_are_tried_until_they_are_set_aside(spark, tmp_path):
    replica, seen = Replica(spark, tmp_path), []
    for i in range(4):
        replica.run(*([(1, "a", "upsert", "x", 7, False)] if i == 0 else [(i + 1, "b", "upsert", str(i), 0, True)]))
        seen.append((list(replica.waiting().values()), replica.aside()))
    gone = [("a", 1, 10)]
    # An entry that comes with the batch in which another one of its id is due has had one try.
    other = Replica(spark, tmp_path / "other")
    other.run((1, "a", "upsert", "x", 0, False))
    other.run((2, "a", "upsert", "y", 0, False))
    assert other.waiting() == {("a", 1): 2, ("a", 2): 1}
    assert seen == [([8], []), ([9], []), ([], gone), ([], gone)] and held(replica.store) == {"b": ("t", "3")}


def test_a_retry_that_succeeds(spark, tmp_path):
    replica = Replica(spark, tmp_path)
    replica.run((1, "a", "upsert", "first", 0, False), (2, "b", "upsert", "stale", 0, False))
    assert held(replica.store) == {} and len(replica.waiting()) == 2
    replica.run((3, "b", "upsert", "fresh", 0, True), attempt=lambda entry: entry["content"] != "first")
    assert held(replica.store) == {"b": ("t", "fresh")} and replica.waiting() == {("a", 1): 2}
    replica.run((4, "z", "upsert", "z", 0, True), attempt=lambda entry: True)
    assert held(replica.store) == {"a": ("t", "first"), "b": ("t", "fresh"), "z": ("t", "z")} and replica.waiting() == {}
