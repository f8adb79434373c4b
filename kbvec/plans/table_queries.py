"""Registered table work: upsert, deletes, compaction, lookups, replication, drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from kbvec.operators import digests, lookup, mutate, replicate
from kbvec.plans import fixtures as fx
from kbvec.plans.registry import kb_sql, register, vector_sql
from kbvec.schema import conform
from kbvec.session import scratch_path
from kbvec.sources import clustered
from kbvec.sources.store import VectorStore


def _table(spark, sf):
    return conform(fx.kb_vectors(spark, sf))


# --- writes ------------------------------------------------------------------------------------

# The log: what to put in or take out, by event; the last entry per id wins.
LOG = """lg AS (SELECT e.event_id AS seq, kb.* EXCLUDE (content),
  CASE WHEN e.event_type = 'error' THEN 'delete' ELSE 'upsert' END AS op,
  e.event_type || ' ' || e.event_id AS content, e.ts, e.value, e.props, e.event_id % 10 AS retries
  FROM events e JOIN kb ON kb.kb_id = e.user_id)"""


def _digest(rows, *more):
    """All columns of a vector row, long ones as digests."""
    return rows.select(*more, "vector_id", "bot_id", "source_url", "role_restriction", "content_type", "chunk_index",
                       "total_chunks", "is_chunked", F.md5("content").alias("content_md5"), *fx.vector_digest())


DIGEST = f"""vector_id, bot_id, source_url, role_restriction, content_type, chunk_index, total_chunks, is_chunked,
  md5(content) AS content_md5, {vector_sql()}"""


@register("upsert_vectors", kb_sql(f"""
SELECT {DIGEST} FROM kb WHERE vector_id NOT IN (SELECT vector_id FROM up)
UNION ALL SELECT {DIGEST} FROM up""", LOG, """up AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vector_id ORDER BY seq DESC) AS rn FROM lg WHERE op = 'upsert')
  WHERE rn = 1)"""))
def upsert_vectors(spark, sf):
    """Every event but errors rewrites its user's row; written through the store in two versions."""
    vectors = fx.kb_vectors(spark, sf)
    log = fx.change_log(vectors, fx.table(spark, sf, "events"))
    store = VectorStore(spark, scratch_path(spark, "store"), buckets=4)
    store.upsert(conform(vectors))
    store.upsert(log.filter(F.col("op") == "upsert"), "seq")
    return _digest(store.read())


@register("delete_by_ids", kb_sql(f"""
SELECT {DIGEST} FROM kb
WHERE NOT (bot_id = 'default' AND kb_id IN (SELECT user_id FROM events WHERE event_type = 'error'))"""))
def delete_by_ids(spark, sf):
    """The rows of every user with an error go, in the default tenant; other tenants' rows stay."""
    vectors = fx.kb_vectors(spark, sf)
    users = fx.table(spark, sf, "events").filter(F.col("event_type") == "error").select(F.col("user_id").alias("kb_id"))
    ids = vectors.join(users.distinct(), "kb_id").select("vector_id")
    return _digest(mutate.delete_by_ids(vectors, ids))


URL = "https://kb.example/d/1"


@register("delete_by_source_url", kb_sql(
    f"SELECT {DIGEST} FROM kb WHERE NOT (bot_id = 'default' AND source_url = '{URL}')"))
def delete_by_source_url(spark, sf):
    return _digest(mutate.delete_by_url(_table(spark, sf), URL))


@register("bulk_delete", kb_sql(f"""
SELECT {DIGEST} FROM kb WHERE NOT (bot_id = 'default' AND (
  source_url IN (SELECT source_url FROM en WHERE is_chunked AND source_url <> '')
  OR vector_id IN (SELECT vector_id FROM en WHERE NOT (is_chunked AND source_url <> ''))))""",
    "en AS (SELECT * FROM kb WHERE label = 9 AND content_type <> 'product')"))
def bulk_delete(spark, sf):
    vectors = fx.kb_vectors(spark, sf)
    return _digest(mutate.bulk_delete(vectors, fx.delete_entries(vectors)))


ALIVE = "alive AS (SELECT DISTINCT CASE WHEN source_url = '' THEN 'kb_' || kb_id ELSE md5(source_url) END AS base FROM kb WHERE label <> 3)"
ORPHAN = "regexp_replace(vector_id, '_chunk_\\d+$', '') NOT IN (SELECT base FROM alive)"


def _alive(vectors):
    """Source rows that still exist: one category was removed."""
    return vectors.filter(F.col("label") != 3).select(F.col("kb_id").alias("id"), "source_url")


@register("orphan_vectors", kb_sql(f"""
SELECT vector_id, {ORPHAN} AS orphan, vector_id NOT IN (SELECT base FROM alive) AS orphan_by_whole_id
FROM kb WHERE {ORPHAN} OR vector_id NOT IN (SELECT base FROM alive)""", ALIVE))
def orphan_vectors(spark, sf):
    vectors = fx.kb_vectors(spark, sf, content=False)
    ids, alive = vectors.select("vector_id"), _alive(vectors)
    loose = mutate.orphans(ids, alive).withColumn("orphan", F.lit(True))
    strict = mutate.orphans(ids, alive, strict_ids=True).withColumn("orphan_by_whole_id", F.lit(True))
    return loose.join(strict, "vector_id", "full_outer").na.fill(False)


@register("compact", kb_sql(f"""
SELECT {DIGEST} FROM kb WHERE NOT ({ORPHAN})""", ALIVE))
def compact(spark, sf):
    vectors = fx.kb_vectors(spark, sf)
    return _digest(mutate.compact(vectors, _alive(vectors)))


# --- lookups -----------------------------------------------------------------------------------

@register("count_by_tenant", kb_sql("SELECT bot_id, count(*) AS rows FROM kb GROUP BY bot_id"))
def count_by_tenant(spark, sf):
    return lookup.count_by_tenant(fx.kb_vectors(spark, sf, content=False))


@register("list_ids_prefix", kb_sql("""
SELECT vector_id FROM kb WHERE bot_id = 'default' AND starts_with(vector_id, 'kb_')
ORDER BY updated_at DESC, vector_id"""))
def list_ids_prefix(spark, sf):
    return lookup.list_ids(fx.kb_vectors(spark, sf, content=False), limit=None, prefix="kb_")


@register("list_ids_page", kb_sql("""
SELECT vector_id FROM kb WHERE bot_id = 'support_fr' ORDER BY updated_at DESC, vector_id LIMIT 25 OFFSET 50"""))
def list_ids_page(spark, sf):
    return lookup.list_ids(fx.kb_vectors(spark, sf, content=False), "support_fr", limit=25, offset=50)


@register("fetch_by_ids", kb_sql("""
SELECT vector_id AS id, md5(content) AS text_md5, source_url, content_type AS type, chunk_index, is_chunked
FROM kb WHERE bot_id = 'support_en' AND kb_id IN (SELECT user_id FROM events)"""))
def fetch_by_ids(spark, sf):
    """The rows of every user seen in the log; users whose row is elsewhere are absent."""
    vectors = fx.kb_vectors(spark, sf)
    users = fx.table(spark, sf, "events").select(F.col("user_id").alias("kb_id")).distinct()
    ids = vectors.join(users, "kb_id").select("vector_id")
    rows = lookup.fetch_by_ids(vectors, ids, "support_en")
    return rows.select("id", F.md5("metadata.text").alias("text_md5"), "metadata.source_url", "metadata.type",
                       "metadata.chunk_index", "metadata.is_chunked")


BUSIEST = 40


@register("fetch_by_ids_clustered", kb_sql(f"""
SELECT vector_id AS id, md5(content) AS text_md5, source_url, content_type AS type, updated_at::VARCHAR AS updated_at
FROM kb WHERE bot_id = 'support_en' AND (kb_id IN (
    SELECT user_id FROM events GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT {BUSIEST})
  OR source_url = (SELECT max(source_url) FROM kb WHERE bot_id = 'support_en'))"""))
def fetch_by_ids_clustered(spark, sf):
    """From the whole table, sorted by id and with bloom filters: the rows of the busiest users, and those of the last URL."""
    vectors, path = fx.kb_vectors(spark, sf), scratch_path(spark, "clustered")
    clustered.write(vectors, path)
    stored = clustered.read(spark, path, vectors)
    busiest = fx.table(spark, sf, "events").groupBy(F.col("user_id").alias("kb_id")).count().orderBy(
        F.desc("count"), "kb_id").limit(BUSIEST)
    # At most one id for each of the users.
    ids = [r["vector_id"] for r in stored.join(F.broadcast(busiest), "kb_id").select("vector_id").collect()]
    last = stored.filter("bot_id = 'support_en'").agg(F.max("source_url")).first()[0]
    found = clustered.by_ids(stored, ids, "support_en").unionByName(clustered.by_url(stored, last or "", "support_en"))
    return found.dropDuplicates(["vector_id"]).select(
        F.col("vector_id").alias("id"), F.md5("content").alias("text_md5"), "source_url",
        F.col("content_type").alias("type"), F.col("updated_at").cast("string").alias("updated_at"))


@register("chunk_reassembly", kb_sql("""
SELECT bot_id, source_url, count(*) AS chunks,
  md5(string_agg(content, chr(10) ORDER BY chunk_index)) AS text_md5
FROM kb WHERE is_chunked GROUP BY ALL"""))
def chunk_reassembly(spark, sf):
    return lookup.reassemble(fx.kb_vectors(spark, sf)).select(
        "bot_id", "source_url", "chunks", F.md5("text").alias("text_md5"))


@register("storage_estimate", kb_sql(
    "SELECT count(*) AS rows, count(*) * (64 * 4 + 200) AS bytes_estimate, 64 AS dim, 'float32' AS storage FROM kb"))
def storage_estimate(spark, sf):
    return lookup.storage_estimate(fx.kb_vectors(spark, sf, content=False), fx.DIM)


@register("table_stats", kb_sql(
    "SELECT count(*) AS rows, count(DISTINCT bot_id) AS tenants, max(updated_at) AS last_update FROM kb"))
def table_stats(spark, sf):
    return lookup.table_stats(fx.kb_vectors(spark, sf, content=False))


# --- copies ------------------------------------------------------------------------------------

REPLICA = "rp AS (SELECT * REPLACE (CASE WHEN label = 5 THEN 'older text' ELSE content END AS content) FROM kb WHERE label <> 7)"


@register("copy_batch", kb_sql("""
SELECT max(vector_id) AS last_vector_id, count(*) AS batch_rows, count(*) AS processed_count,
  (SELECT count(*) FROM kb) AS target_count, count(*) >= (SELECT count(*) FROM kb) AS done
FROM (SELECT vector_id FROM kb WHERE vector_id > '8' ORDER BY vector_id LIMIT 200)"""))
def copy_batch(spark, sf):
    vectors = fx.kb_vectors(spark, sf, content=False)
    batch = replicate.copy_batch(vectors.select("vector_id"), cursor="8", size=200)
    return replicate.copy_state(batch, 0, vectors.count(), "8")


@register("copy_missing", kb_sql(f"""
SELECT {DIGEST}, label = 7 AS copied FROM (SELECT * FROM rp UNION ALL SELECT * FROM kb WHERE label = 7)""", REPLICA))
def copy_missing(spark, sf):
    vectors = fx.kb_vectors(spark, sf)
    replica = fx.replica(vectors).withColumn("copied", F.lit(False))
    whole = replicate.copy_missing(vectors.withColumn("copied", F.lit(True)), replica)
    return _digest(whole, "copied")


CHANGED = """last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vector_id ORDER BY seq DESC) AS rn FROM {0}) WHERE rn = 1)"""
APPLIED = f"""SELECT {DIGEST} FROM kb WHERE vector_id NOT IN (SELECT vector_id FROM last)
UNION ALL SELECT {DIGEST} FROM last WHERE op = 'upsert'"""


@register("apply_change_log", kb_sql(APPLIED, LOG, CHANGED.format("lg")))
def apply_change_log(spark, sf):
    vectors = fx.kb_vectors(spark, sf)
    log = fx.change_log(vectors, fx.table(spark, sf, "events"))
    out = replicate.apply_change_log(conform(vectors), log)
    return _digest(out)


@register("drain_step", """
SELECT seq, state, CASE WHEN state IN ('retry', 'quarantine') THEN retries + 1 ELSE retries END AS retries FROM (
  SELECT *, CASE WHEN value < 5 THEN 'dropped' WHEN value < 50 THEN 'done'
                 WHEN retries + 1 >= 10 THEN 'quarantine' ELSE 'retry' END AS state
  FROM (SELECT event_id AS seq, value, event_id % 10 AS retries FROM events WHERE event_type = 'error'))""")
def drain_step(spark, sf):
    waiting = fx.pending(fx.table(spark, sf, "events"))
    return replicate.drain_step(waiting, F.col("ok")).select("seq", "state", "retries")


def _signature_sql(source: str) -> str:
    words = ", ".join(f"sum(('0x' || substr(md5(vector_id), {1 + 8 * i}, 8))::BIGINT)::VARCHAR" for i in range(4))
    return (f"SELECT bot_id, count(*) AS rows, md5(concat_ws(',', count(*)::VARCHAR, {words})) AS sig "
            f"FROM {source} GROUP BY bot_id")


@register("tenant_signature", kb_sql(_signature_sql("kb")))
def tenant_signature(spark, sf):
    return replicate.tenant_signature(fx.kb_vectors(spark, sf, content=False))


DRIFT = (f"dr AS (SELECT coalesce(p.bot_id, r.bot_id) AS bot_id, coalesce(p.rows, 0) AS primary_rows, "
         f"coalesce(r.rows, 0) AS replica_rows FROM ({_signature_sql('kb')}) p FULL JOIN ({_signature_sql('rp')}) r "
         "ON p.bot_id = r.bot_id WHERE p.sig IS DISTINCT FROM r.sig)")


def _drift(spark, sf):
    vectors = fx.kb_vectors(spark, sf, content=False)
    return replicate.compare_signatures(replicate.tenant_signature(vectors),
                                        replicate.tenant_signature(fx.replica(vectors)))


@register("drift_tenants", kb_sql("SELECT * FROM dr", REPLICA, DRIFT))
def drift_tenants(spark, sf):
    return _drift(spark, sf)


@register("drift_status", kb_sql("""
SELECT n AS drifted_tenants, n > 0 AND pending > 0 AND near AS drainable,
  CASE WHEN n > 0 AND NOT (pending > 0 AND near) THEN 'drifted' ELSE 'active' END AS status
FROM (SELECT count(*) AS n, coalesce(bool_and(abs(primary_rows - replica_rows) <= 50), true) AS near FROM dr),
  (SELECT count(*) AS pending FROM events WHERE event_type = 'error')""", REPLICA, DRIFT))
def drift_status(spark, sf):
    waiting = fx.pending(fx.table(spark, sf, "events")).count()
    return replicate.drift_status(_drift(spark, sf), waiting)


@register("row_diff", kb_sql("""
SELECT coalesce(k.vector_id, r.vector_id) AS vector_id,
  CASE WHEN r.vector_id IS NULL THEN 'missing' WHEN k.vector_id IS NULL THEN 'extra' ELSE 'changed' END AS change
FROM kb k FULL JOIN rp r ON k.vector_id = r.vector_id
WHERE r.vector_id IS NULL OR k.vector_id IS NULL OR k.content <> r.content""", REPLICA))
def row_diff(spark, sf):
    vectors = fx.kb_vectors(spark, sf)
    return replicate.row_diff(vectors, fx.replica(vectors))


@register("row_diff_tree", kb_sql("""
SELECT coalesce(k.vector_id, r.vector_id) AS vector_id,
  CASE WHEN r.vector_id IS NULL THEN 'missing' WHEN k.vector_id IS NULL THEN 'extra' ELSE 'changed' END AS change
FROM kb k FULL JOIN rp r ON k.vector_id = r.vector_id
WHERE r.vector_id IS NULL OR k.vector_id IS NULL OR k.content <> r.content""", REPLICA))
def row_diff_tree(spark, sf):
    """The same difference between stored copies, found from their digests; equal leaves are not read."""
    vectors, paths = fx.kb_vectors(spark, sf), [scratch_path(spark, "copy") for _ in range(2)]
    for rows, path in zip((vectors, fx.replica(vectors)), paths):
        digests.write_copy(rows, path)
    return digests.tree_diff(spark, *paths)
