"""Registered loads: sources, parsing, ids, validation, full and incremental loads, posts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from kbvec.functions.ids import vector_id
from kbvec.functions.text import chunk_header, parse_serialized_vector
from kbvec.operators import ingest
from kbvec.plans import fixtures as fx
from kbvec.plans import jobs
from kbvec.plans.registry import HAS_VECTOR, kb_sql, register, vector_sql
from kbvec.schema import conform
from kbvec.session import scratch_path
from kbvec.sources import tables
from kbvec.sources.store import VectorStore

VECTOR_COLUMNS = ("vector_id", "bot_id", "source_url", "role_restriction", "content_type",
                  "chunk_index", "total_chunks", "is_chunked")
COLS = ", ".join(VECTOR_COLUMNS)


def _checked(rows):
    return rows.select(*VECTOR_COLUMNS, *fx.vector_digest(), F.md5("content").alias("content_md5"))


CHECKED_SQL = f"SELECT {COLS}, {vector_sql()}, md5(content) AS content_md5 FROM kb"


def _kb(spark, sf):
    return fx.kb_rows(fx.kb_source(spark, sf))


# --- sources -----------------------------------------------------------------------------------

@register("parquet_restore", kb_sql(CHECKED_SQL))
def parquet_restore(spark, sf):
    """An older backup (no ``updated_at``) read back into the current layout."""
    path = scratch_path(spark, "backup")
    tables.write_vectors(conform(fx.kb_vectors(spark, sf)).drop("updated_at"), path)
    return _checked(tables.read_vectors(spark, path))


@register("parquet_export_roundtrip", kb_sql("""
SELECT count(*) AS reported, count(*) AS rows, count(DISTINCT vector_id) AS ids,
  round(sum(list_sum(embedding)), 3) AS component_sum FROM kb"""))
def parquet_export_roundtrip(spark, sf):
    path = scratch_path(spark, "export")
    n = tables.write_vectors(conform(fx.kb_vectors(spark, sf)), path)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return tables.read_vectors(spark, path).agg(
        F.lit(n).cast("long").alias("reported"), F.count("*").alias("rows"),
        F.countDistinct("vector_id").alias("ids"), F.round(F.sum(total), 3).alias("component_sum"))


@register("kb_source_scan", kb_sql(f"""
SELECT kb_id AS id, source_url, role_restriction, content_type, bot_id, updated_at AS stamp,
  md5(CASE WHEN is_chunked THEN '{{"document_type":"chunked","chunk_index":' || chunk_index || ',"total_chunks":' ||
    total_chunks || '}}' || chr(10) || '---' || chr(10) || content ELSE content END) AS article_md5,
  CASE WHEN {HAS_VECTOR} THEN 64 ELSE CASE kb_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 1 END END AS components FROM kb""",
    source=True))
def kb_source_scan(spark, sf):
    raw = _kb(spark, sf).withColumnRenamed("source_url", "url")
    rows = tables.kb_rows(raw)
    return rows.select("id", "source_url", "role_restriction", "content_type", "bot_id",
                       F.col("timestamp").alias("stamp"), F.md5("article_content").alias("article_md5"),
                       F.regexp_count("embedding_vector", F.lit("d:")).alias("components"))


@register("vector_export_load", kb_sql("""
SELECT vector_id, 'default' AS bot_id, md5(content) AS content_md5, source_url, role_restriction, content_type,
  chunk_index, total_chunks, is_chunked, """ + vector_sql() + f" FROM kb WHERE {HAS_VECTOR}"))
def vector_export_load(spark, sf):
    """The table as service records in JSON lines, under canonical and alias keys, and back."""
    path = scratch_path(spark, "records")
    _records(fx.kb_vectors(spark, sf), "export").write.json(path)
    rows, _ = tables.load_export(tables.read_export(spark, path))
    return rows.select("vector_id", "bot_id", F.md5("content").alias("content_md5"), "source_url",
                       "role_restriction", "content_type", "chunk_index", "total_chunks", "is_chunked",
                       *fx.vector_digest())


def _records(vectors, aliases: str):
    """Service records; some use the alias keys of the given set, some have no values."""
    third = F.col("content_type") == "product"
    names = {"export": {"content": ("text", "content"), "source_url": ("source_url", "url"),
                        "content_type": ("type", "content_type"), "chunk_index": ("chunk_index",) * 2,
                        "total_chunks": ("total_chunks",) * 2},
             "request": {"content": ("text",) * 2, "source_url": ("source_url", "source"),
                         "content_type": ("type",) * 2, "chunk_index": ("chunk_index", "part_index"),
                         "total_chunks": ("total_chunks", "part_total")}}[aliases]
    entries = [F.struct(F.when(third, F.lit(alias)).otherwise(F.lit(plain)).alias("key"),
                        F.col(c).cast("string").alias("value")) for c, (plain, alias) in names.items()]
    entries += [F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value"))
                for c in ("role_restriction", "is_chunked")]
    present = F.filter(F.array(*entries), lambda e: e["value"].isNotNull())
    return vectors.select(
        F.col("vector_id").alias("id"),
        F.when(fx.has_vector(), F.col("embedding").cast("array<double>")).alias("values"),
        F.map_from_entries(present).alias("metadata"))


@register("metadata_alias_map", kb_sql(f"""
SELECT vector_id, 'default' AS bot_id, md5(content) AS content_md5, source_url, role_restriction, content_type,
  chunk_index, total_chunks, is_chunked, {HAS_VECTOR} AS usable FROM kb"""))
def metadata_alias_map(spark, sf):
    rows = ingest.map_metadata(_records(fx.kb_vectors(spark, sf), "request"), ingest.REQUEST_ALIASES)
    return rows.select("vector_id", "bot_id", F.md5("content").alias("content_md5"), "source_url",
                       "role_restriction", "content_type", "chunk_index", "total_chunks", "is_chunked",
                       F.col("embedding").isNotNull().alias("usable"))


@register("conform_schema", kb_sql("""
SELECT vector_id, bot_id, '' AS source_url, 'public' AS role_restriction, content_type, NULL::INTEGER AS chunk_index,
  is_chunked, round(list_sum(list_transform(embedding, lambda x: greatest(-128.0, least(127.0, round(x * 127.0))))), 0)
  AS component_sum, TIMESTAMP '2024-02-01' AS updated_at FROM kb"""))
def conform_schema(spark, sf):
    """An older, partial frame with its columns in another order, brought to int8 storage; twice."""
    old = fx.kb_vectors(spark, sf).select("content_type", "embedding", F.lit(None).cast("string").alias("source_url"),
                                          "is_chunked", "bot_id", "vector_id", F.lit(1).alias("unknown"))
    now = F.expr("timestamp_ntz'2024-02-01 00:00:00'")
    rows = conform(conform(old, "int8", now), "int8", now)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return rows.select("vector_id", "bot_id", "source_url", "role_restriction", "content_type", "chunk_index",
                       "is_chunked", total.alias("component_sum"), "updated_at")


POSTS = """posts AS (SELECT page_id AS id, url AS permalink, html,
  regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title,
  CASE page_id % 3 WHEN 0 THEN 'post' WHEN 1 THEN 'page' ELSE 'FAQ Entry' END AS post_type,
  CASE WHEN page_id % 20 = 0 THEN 'draft' ELSE 'publish' END AS status FROM pages)"""
PLAIN = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
  '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', '', 'g'), '(?s)<!--.*?(?:-->|\z)', '', 'g'),
  '(?s)<[^\s"''>](?:"[^"]*(?:"|\z)|''[^'']*(?:''|\z)|[^"''>])*(?:>|\z)', '', 'g'), '[\r\n\t ]+', ' ', 'g'))"""
TITLE = r"trim(regexp_replace(title, '^[\r\n\t]+|[\r\n\t]+$', ' ', 'g'))"
TEXT = f"CASE WHEN {TITLE} <> '' THEN {TITLE} || chr(10) || chr(10) || {PLAIN} ELSE {PLAIN} END"
KIND = r"""CASE WHEN post_type IN ('post', 'page', 'product') THEN post_type
  ELSE coalesce(nullif(regexp_replace(lower(post_type), '[^a-z0-9_\-]', '', 'g'), ''), 'content') END"""


@register("posts_source_scan", f"WITH {POSTS} SELECT id, permalink, post_type FROM posts "
          "WHERE status = 'publish' AND post_type IN ('post', 'page')")
def posts_source_scan(spark, sf):
    rows = tables.published(fx.posts(spark, sf), ["post", "page"])
    return rows.select(F.col("ID").alias("id"), "permalink", "post_type")


@register("build_post_content", f"WITH {POSTS} SELECT id, length({TEXT}) AS n, md5({TEXT}) AS text_md5 FROM posts")
def build_post_content(spark, sf):
    posts = fx.posts(spark, sf)
    text = ingest.build_post_content(posts)
    return posts.select(F.col("ID").alias("id"), F.length(text).cast("long").alias("n"), F.md5(text).alias("text_md5"))


@register("map_content_type", f"WITH {POSTS} SELECT id, {KIND} AS content_type FROM posts")
def map_content_type(spark, sf):
    return fx.posts(spark, sf).select(F.col("ID").alias("id"),
                                      ingest.map_content_type(F.col("post_type")).alias("content_type"))


@register("posts_load_summary", f"""WITH {POSTS}, loaded AS (
  SELECT trim({TEXT}) = '' OR coalesce(permalink, '') = '' AS failed FROM posts WHERE status = 'publish')
SELECT count(*) FILTER (NOT failed) AS processed, count(*) FILTER (failed) AS failed, count(*) AS total FROM loaded""")
def posts_load_summary(spark, sf):
    published = tables.published(fx.posts(spark, sf), ["post", "page", "FAQ Entry"])
    return ingest.posts_summary(ingest.load_posts(published))


# --- parsing and validation --------------------------------------------------------------------

@register("parse_serialized_embedding", kb_sql(f"""
SELECT kb_id AS id, CASE WHEN {HAS_VECTOR} THEN len(embedding) END AS dim,
  CASE WHEN {HAS_VECTOR} THEN round(list_sum(embedding), 4) END AS component_sum FROM kb""", source=True))
def parse_serialized_embedding(spark, sf):
    vec = parse_serialized_vector(F.col("embedding_vector")).cast("array<float>")
    parsed = _kb(spark, sf).select("id", vec.alias("v"))
    return parsed.select("id", F.when(F.col("v").isNotNull(), F.size("v")).cast("long").alias("dim"),
                         F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double")), 4).alias("component_sum"))


@register("parse_chunk_header", kb_sql(
    "SELECT kb_id AS id, is_chunked, chunk_index, total_chunks, md5(content) AS body_md5 FROM kb", source=True))
def parse_chunk_header(spark, sf):
    parts = chunk_header(F.col("article_content"))
    return _kb(spark, sf).select("id", parts["is_chunked"].alias("is_chunked"), parts["chunk_index"].alias("chunk_index"),
                                 parts["total_chunks"].alias("total_chunks"), F.md5(parts["body"]).alias("body_md5"))


@register("vector_ids", kb_sql("""
SELECT kb_id AS id, vector_id, CASE WHEN source_url = '' THEN 'kb_' || kb_id ELSE md5(source_url) END AS base_id FROM kb""", source=True))
def vector_ids(spark, sf):
    head = chunk_header(F.col("article_content"))
    return _kb(spark, sf).select(
        "id", vector_id(F.col("id"), F.col("source_url"), head["is_chunked"], head["chunk_index"]).alias("vector_id"),
        vector_id(F.col("id"), F.col("source_url")).alias("base_id"))


@register("resolve_tenant", kb_sql("""
SELECT kb_id AS id, bot_id AS own, 'default' AS absent,
  CASE WHEN role_restriction = 'subscriber' THEN 'members' ELSE 'default' END AS overridden FROM kb""", source=True))
def resolve_tenant(spark, sf):
    rows = _kb(spark, sf).withColumn("bot_id", F.nullif("bot_id", F.lit("default")))
    by_role = lambda df: F.when(F.col("role_restriction") == "subscriber", "members").otherwise("")
    return rows.select("id", ingest.resolve_tenant(rows).alias("own"),
                       ingest.resolve_tenant(rows.drop("bot_id")).alias("absent"),
                       ingest.resolve_tenant(rows, by_role).alias("overridden"))


@register("validate_vectors", kb_sql(f"""
SELECT vector_id, NOT (content_type = 'product') AS accepted FROM kb WHERE {HAS_VECTOR}""", source=True))
def validate_vectors(spark, sf):
    """Products carry vectors cut short by one component; they are split off, empty ones are skipped."""
    short = F.when(F.col("content_type") == "product", F.slice("embedding", 1, fx.DIM - 1)).otherwise(F.col("embedding"))
    rows = ingest.kb_to_vectors(_kb(spark, sf)).withColumn("embedding", short)
    good, bad = ingest.validate(rows, fx.DIM, mode="quarantine")
    return (good.select("vector_id", F.lit(True).alias("accepted"))
            .unionByName(bad.select("vector_id", F.lit(False).alias("accepted"))))


@register("ingest_skip_report", kb_sql(f"""
SELECT count(*) AS scanned, count(*) FILTER ({HAS_VECTOR}) AS upserted, count(*) FILTER (NOT ({HAS_VECTOR})) AS skipped,
  count(*) FILTER (NOT ({HAS_VECTOR})) > 0.01 * count(*) AS flagged FROM kb""", source=True))
def ingest_skip_report(spark, sf):
    return ingest.skip_report(ingest.kb_to_vectors(_kb(spark, sf)))


LOADED = f"{CHECKED_SQL} WHERE {HAS_VECTOR}"


@register("kb_full_load", kb_sql(LOADED, source=True))
def kb_full_load(spark, sf):
    return _checked(ingest.load_kb(_kb(spark, sf), fx.DIM).withColumn("embedding", F.col("embedding").cast("array<float>")))


def _store(spark, label):
    return VectorStore(spark, scratch_path(spark, label), buckets=4)


REPORT = f"""SELECT count(*) AS scanned, count(*) FILTER ({HAS_VECTOR}) AS upserted,
  count(*) FILTER (NOT ({HAS_VECTOR})) AS skipped FROM kb"""


@register("job_full_load", kb_sql(f"SELECT * FROM ({LOADED}), ({REPORT})", source=True))
def job_full_load(spark, sf):
    """The source table through the load job into a store; what the job reports stands beside every row."""
    store = _store(spark, "full-load")
    done = jobs.full_load(store, _kb(spark, sf), fx.DIM)
    report = [F.lit(done[c]).cast("long").alias(c) for c in ("scanned", "upserted", "skipped")]
    return _checked(store.read()).select("*", *report)


@register("job_import_records", kb_sql(f"""
SELECT vector_id, 'default' AS bot_id, md5(content) AS content_md5, {vector_sql()}, copied, failed FROM kb, (
  SELECT count(*) FILTER ({HAS_VECTOR}) AS copied, count(*) FILTER (NOT ({HAS_VECTOR})) AS failed FROM kb) t
WHERE {HAS_VECTOR}""", source=True))
def job_import_records(spark, sf):
    """Every source row as a service record, imported into a store."""
    store = _store(spark, "import")
    done = jobs.import_records(store, _records(fx.kb_source(spark, sf), "export"), fx.DIM)
    return store.read().select("vector_id", "bot_id", F.md5("content").alias("content_md5"), *fx.vector_digest(),
                               F.lit(done["copied"]).cast("long").alias("copied"),
                               F.lit(done["failed"]).cast("long").alias("failed"))


@register("job_restore", kb_sql(f"{CHECKED_SQL} WHERE label <> 7 UNION ALL {CHECKED_SQL} WHERE label = 7"))
def job_restore(spark, sf):
    """A backup put back into a store that lost a category and holds older text for another."""
    vectors, store, path = conform(fx.kb_vectors(spark, sf)), _store(spark, "restore"), scratch_path(spark, "backup")
    tables.write_vectors(vectors, path)
    store.upsert(conform(fx.replica(fx.kb_vectors(spark, sf))))
    store.restore(path)
    return _checked(store.read())


@register("job_bootstrap_drift", kb_sql("""
SELECT bot_id, count(*) AS rows, count(*) FILTER (label = 7) AS copied, 0::BIGINT AS drifted_tenants,
  'active' AS status FROM kb GROUP BY bot_id"""))
def job_bootstrap_drift(spark, sf):
    """A replica without one category is filled up and then compared with its source."""
    vectors, store = fx.kb_vectors(spark, sf), _store(spark, "bootstrap")
    store.upsert(conform(vectors.filter(F.col("label") != 7)))
    jobs.bootstrap(store, conform(vectors))
    drift = jobs.drift_check(vectors, store.read(), 0, "drifted")
    copied = vectors.filter(F.col("label") == 7).select("vector_id").withColumn("new", F.lit(1))
    return store.read().join(copied, "vector_id", "left").groupBy("bot_id").agg(
        F.count("*").alias("rows"), F.count("new").alias("copied"),
        F.lit(drift["drifted_tenants"]).cast("long").alias("drifted_tenants"), F.lit(drift["status"]).alias("status"))


LAST_LOAD = dt.datetime(2024, 1, 1, 5, 1, 0)


@register("kb_incremental_load", kb_sql(
    f"{CHECKED_SQL} WHERE {HAS_VECTOR} AND updated_at >= TIMESTAMP '2024-01-01 05:01:00' - INTERVAL 120 SECONDS", source=True))
def kb_incremental_load(spark, sf):
    rows = ingest.load_kb_since(_kb(spark, sf), LAST_LOAD, fx.DIM)
    return _checked(rows.withColumn("embedding", F.col("embedding").cast("array<float>")))
