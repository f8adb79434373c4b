"""Registered metrics over the request log, in batch and as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from kbvec.operators import metrics, replicate, sketches
from kbvec.plans import fixtures as fx
from kbvec.plans.registry import HAS_VECTOR, kb_sql, register, vector_sql
from kbvec.plans.table_queries import APPLIED, CHANGED, LOG, _digest
from kbvec.schema import conform
from kbvec.session import materialize, scratch_path
from kbvec.sources.store import VectorStore
from kbvec.streaming import ingest as live
from kbvec.streaming import changes, latency

REQUESTS = """rq AS (SELECT event_id, ts, user_id % 4 AS namespace, floor(value)::BIGINT AS latency_ms,
  CASE event_type WHEN 'error' THEN 'errors' WHEN 'view' THEN 'query_cache_hit' ELSE 'searches' END AS op FROM events)"""


def _now(log):
    """The log's own clock: its last request."""
    return log.agg(F.max("ts")).scalar()


@register("latency_snapshot", f"""WITH {REQUESTS}, s AS (
  SELECT list(greatest(0, latency_ms) ORDER BY latency_ms) AS v FROM (
    SELECT * FROM rq WHERE op = 'searches' AND ts >= (SELECT max(ts) FROM rq) - INTERVAL 3600 SECONDS))
SELECT v[floor(len(v) * 0.5)::INTEGER + 1] AS p50_ms, v[least(len(v) - 1, floor(len(v) * 0.95))::INTEGER + 1] AS p95_ms,
  v[least(len(v) - 1, floor(len(v) * 0.99))::INTEGER + 1] AS p99_ms, len(v) AS sample_count FROM s""")
def latency_snapshot(spark, sf):
    log = fx.request_log(spark, sf)
    return metrics.latency_snapshot(log, _now(log))


@register("metric_counters", f"WITH {REQUESTS} SELECT op, count(*) AS n FROM rq GROUP BY op")
def metric_counters(spark, sf):
    return metrics.metric_counters(fx.request_log(spark, sf))


@register("latency_sketches", f"""WITH {REQUESTS}
SELECT namespace, count(*) AS samples, true AS within, count(DISTINCT date_trunc('hour', ts)) AS minutes FROM rq GROUP BY namespace""")
def latency_sketches(spark, sf):
    """Quantiles of all requests from one sketch an hour (the log is sparse), stored in two loads and merged.

    ``within``: the exact rank of each quantile is off by less than a hundredth of the samples.
    """
    log, path = fx.request_log(spark, sf), scratch_path(spark, "sketches")
    loads = [sketches.sketch_minutes(log.filter(F.col("event_id") % 2 == i), unit="hour") for i in (0, 1)]
    sketches.add_sketches(*loads).write.parquet(path)
    stored = spark.read.schema(loads[0].schema).parquet(path)
    errors = sketches.rank_errors(materialize(sketches.latency_quantiles(stored), "quantiles"), log)
    within = (F.col("rank_error") < sketches.RANK_ERROR).alias("within")
    return errors.select("namespace", "samples", within).join(
        stored.groupBy("namespace").agg(F.count("*").alias("minutes")), "namespace")


@register("busy_minutes", f"""WITH {REQUESTS}
SELECT namespace, date_trunc('hour', ts) AS minute, count(*) AS requests, count(*) - 3 AS refused FROM rq
GROUP BY ALL HAVING count(*) > 3""")
def busy_minutes(spark, sf):
    """Hours over quota, read from the sketches' own counts."""
    return sketches.busy_minutes(sketches.sketch_minutes(fx.request_log(spark, sf), unit="hour"), 3)


HITS = """(SELECT count(*) FILTER (op = 'searches') AS searches, count(*) FILTER (op = 'query_cache_hit') AS cache_hits FROM rq)"""
RATE = "CASE WHEN searches > 0 THEN round(cache_hits / greatest(1, searches + cache_hits), 3) ELSE 0.0 END"


@register("cache_hit_rate", f"WITH {REQUESTS} SELECT searches, cache_hits, {RATE} AS cache_hit_rate FROM {HITS}")
def cache_hit_rate(spark, sf):
    return metrics.cache_hit_rate(fx.request_log(spark, sf))


@register("slow_queries", f"""WITH {REQUESTS}
SELECT event_id, ts, namespace, latency_ms FROM rq WHERE op = 'searches' AND latency_ms >= 100""")
def slow_queries(spark, sf):
    slow = metrics.slow_queries(fx.request_log(spark, sf), 100)
    return slow.select("event_id", "ts", "namespace", "latency_ms")


@register("quota_report", f"""WITH {REQUESTS}
SELECT namespace, date_trunc('hour', ts) AS minute, count(*) AS requests, least(count(*), any_value(mx)) AS admitted,
  count(*) - least(count(*), any_value(mx)) AS refused
FROM rq JOIN (SELECT unnest([0, 1, 2, 3]) AS namespace, unnest([2, 3, 4, 3]) AS mx) l USING (namespace) GROUP BY ALL""")
def quota_report(spark, sf):
    """Per hour, as the log is sparse; namespaces have their own limits, one of them the default."""
    log = fx.request_log(spark, sf)
    limits = spark.createDataFrame([(0, 2), (1, 3), (2, 4)], "namespace long, max int")
    return metrics.quota_report(log, 3, limits, unit="hour")


@register("quota_flags", f"""WITH {REQUESTS}
SELECT event_id, namespace, row_number() OVER (PARTITION BY namespace, date_trunc('hour', ts) ORDER BY ts, event_id) > 3 AS over
FROM rq""")
def quota_flags(spark, sf):
    return metrics.flag_over_quota(fx.request_log(spark, sf), 3, unit="hour").select("event_id", "namespace", "over")


@register("health_summary", kb_sql(f"""
SELECT true AS enabled, (SELECT count(*) FROM kb WHERE bot_id = 'default') AS count, searches, cache_hits,
  {RATE} AS cache_hit_rate,
  (SELECT count(*) FROM events WHERE event_type = 'error' AND NOT (value >= 50 AND event_id % 10 = 9)) AS pending_count,
  (SELECT count(*) FROM events WHERE event_type = 'error' AND value >= 50 AND event_id % 10 = 9) AS quarantine_count,
  epoch(date_trunc('second', (SELECT max(ts) FROM rq)))::BIGINT - epoch(TIMESTAMP '2024-01-01')::BIGINT AS last_load_age_s,
  'healthy' AS status FROM {HITS}""", REQUESTS))
def health_summary(spark, sf):
    log, events = fx.request_log(spark, sf), fx.table(spark, sf, "events")
    queue = replicate.drain_step(fx.pending(events), F.col("ok"))
    loaded = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return metrics.health_summary(fx.kb_vectors(spark, sf, content=False), log, queue, _now(log), loaded)


# --- streams -----------------------------------------------------------------------------------

DELAY = "10 minutes"


def _append(stream, label):
    """Run an append-mode stream over what is there and read back what it wrote."""
    spark = stream.sparkSession
    out, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-checkpoint")
    (stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start(out).awaitTermination())
    return spark.read.schema(stream.schema).parquet(out)


def _closed(end: str) -> str:
    """Windows the watermark has passed."""
    return f"{end} <= date_trunc('milliseconds', (SELECT max(ts) FROM rq)) - INTERVAL 10 MINUTES"


STATS = "count(*) AS n, round(avg(latency_ms), 6) AS avg_ms, max(latency_ms) AS max_ms"


def _rounded(windows):
    return windows.select("namespace", "window_start", "n", F.round("avg_ms", 6).alias("avg_ms"), "max_ms")


@register("stream_latency_tumbling", f"""WITH {REQUESTS} SELECT * FROM (
  SELECT namespace, date_trunc('hour', ts) AS window_start, {STATS} FROM rq GROUP BY ALL)
WHERE {_closed("window_start + INTERVAL 1 HOUR")}""")
def stream_latency_tumbling(spark, sf):
    windows = latency.latency_windows(fx.request_log(spark, sf, stream=True), delay=DELAY)
    return _rounded(_append(windows, "tumbling"))


@register("stream_latency_sliding", f"""WITH {REQUESTS} SELECT * FROM (
  SELECT namespace, time_bucket(INTERVAL 15 MINUTES, ts) - to_minutes(15 * k) AS window_start, {STATS}
  FROM rq, (SELECT unnest([0, 1, 2, 3]) AS k) GROUP BY ALL)
WHERE {_closed("window_start + INTERVAL 1 HOUR")}""")
def stream_latency_sliding(spark, sf):
    windows = latency.latency_windows(fx.request_log(spark, sf, stream=True), slide="15 minutes", delay=DELAY)
    return _rounded(_append(windows, "sliding"))


@register("stream_quota", f"""WITH {REQUESTS} SELECT * FROM (
  SELECT namespace, date_trunc('hour', ts) AS window_start, count(*) AS requests, count(*) - 1 AS refused
  FROM rq GROUP BY ALL HAVING count(*) > 1)
WHERE {_closed("window_start + INTERVAL 1 HOUR")}""")
def stream_quota(spark, sf):
    windows = latency.quota_windows(fx.request_log(spark, sf, stream=True), limit=1, length="1 hour", delay=DELAY)
    return _append(windows, "quota")


@register("stream_latency_stateful", f"""WITH {REQUESTS}, s AS (
  SELECT 'ns ' || namespace AS namespace, list(greatest(0, latency_ms) ORDER BY latency_ms) AS v FROM rq WHERE op = 'searches'
    AND floor(epoch(ts)) >= floor(epoch((SELECT max(ts) FROM rq))) - 3600 GROUP BY ALL)
SELECT namespace, v[floor(len(v) * 0.5)::INTEGER + 1] AS p50_ms, v[least(len(v) - 1, floor(len(v) * 0.95))::INTEGER + 1] AS p95_ms,
  v[least(len(v) - 1, floor(len(v) * 0.99))::INTEGER + 1] AS p99_ms, len(v) AS sample_count FROM s""")
def stream_latency_stateful(spark, sf):
    """The log, of a month, arrives in three parts, in order of time; the stream starts again from its checkpoint for
    each. What is left of it is the last hour."""
    log = fx.request_log(spark, sf)
    low, high = log.agg(F.min("ts"), F.max("ts")).first()
    named = log.withColumn("namespace", F.concat(F.lit("ns "), F.col("namespace").cast("string")))
    part = F.floor(3 * (F.unix_seconds(F.col("ts").cast("timestamp")) - int(low.timestamp())) / ((high - low).total_seconds() + 1))
    source, checkpoint = scratch_path(spark, "log"), scratch_path(spark, "rolling-checkpoint")
    for i in range(3):
        named.filter(part == i).write.mode("append").parquet(source)
        stream = spark.readStream.schema(named.schema).parquet(source).filter(F.col("op") == metrics.SEARCH)
        latency.run_rolling(stream, checkpoint).awaitTermination()
    return latency.rolling_percentiles(spark, checkpoint, _now(log))


@register("stream_kb_ingest", kb_sql(f"""
SELECT vector_id, bot_id, role_restriction, updated_at + INTERVAL 1 DAY AS updated_at, md5(content) AS content_md5, {vector_sql()}
FROM (SELECT * REPLACE ('members' AS role_restriction) FROM kb WHERE label = 2 AND {HAS_VECTOR})
UNION ALL SELECT vector_id, bot_id, role_restriction, updated_at, md5(content), {vector_sql()} FROM kb
WHERE label <> 2 AND {HAS_VECTOR}""", source=True))
def stream_kb_ingest(spark, sf):
    """All source rows, and a later version of one category; each arrives in its own files."""
    rows = fx.kb_rows(fx.kb_source(spark, sf))
    later = fx.kb_rows(fx.kb_source(spark, sf).filter(F.col("label") == 2)).withColumn(
        "role_restriction", F.lit("members")).withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 DAY"))
    source, checkpoint = scratch_path(spark, "kb"), scratch_path(spark, "kb-checkpoint")
    for part in (later, rows):
        part.write.mode("append").parquet(source)
    store = VectorStore(spark, scratch_path(spark, "store"), buckets=4)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(source)
    live.stream_kb(stream, store, fx.DIM, checkpoint, scratch_path(spark, "rejects")).awaitTermination()
    return store.read().select("vector_id", "bot_id", "role_restriction", "updated_at", F.md5("content").alias("content_md5"),
                               *fx.vector_digest())


# Three parts, the newest changes first: an entry of part p fails when it arrives and in every later run.
FAILED = "lg.retries + 1 + seq % 3"


@register("stream_apply_changes", kb_sql(f"""
SELECT *, NULL::VARCHAR AS state, NULL::BIGINT AS retries FROM ({APPLIED})
UNION ALL BY NAME SELECT seq::VARCHAR AS vector_id, CASE WHEN {FAILED} >= 10 THEN 'quarantine' ELSE 'retry' END AS state,
  least(10, {FAILED}) AS retries FROM lg WHERE value >= 50""",
    LOG, CHANGED.format("(SELECT * FROM lg WHERE value >= 5 AND value < 50)")))
def stream_apply_changes(spark, sf):
    """The change log as a stream in three parts, out of order, into a replica; it starts again from its checkpoint for
    each part.

    Older entries that arrive late do not overwrite newer ones; entries that fail are tried again with every batch
    and come back with their state and tries, which are read from the stream's own state.
    """
    vectors = fx.kb_vectors(spark, sf)
    log = materialize(fx.change_log(vectors, fx.table(spark, sf, "events")), "log")
    source, checkpoint = scratch_path(spark, "changes"), scratch_path(spark, "changes-checkpoint")
    store, aside = VectorStore(spark, scratch_path(spark, "replica"), buckets=4), scratch_path(spark, "quarantine")
    store.upsert(conform(vectors))
    for third in (2, 1, 0):
        log.filter(F.col("seq") % 3 == third).write.mode("append").parquet(source)
        stream = spark.readStream.schema(log.schema).parquet(source)
        changes.stream_changes(stream, store, F.col("ok"), aside, checkpoint).awaitTermination()
    rows = _digest(store.read()).withColumns({"state": F.lit(None).cast("string"), "retries": F.lit(None).cast("long")})
    given_up = spark.read.schema(log.schema).parquet(f"{aside}/batch=*").withColumn("state", F.lit("quarantine"))
    waiting = changes.waiting(spark, checkpoint, log.schema).withColumn("state", F.lit("retry"))
    failed = given_up.unionByName(waiting).select(F.col("seq").cast("string").alias("vector_id"), "state", "retries")
    return rows.unionByName(failed, allowMissingColumns=True)
