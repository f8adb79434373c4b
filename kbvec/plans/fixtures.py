"""Views of the given tables in the shapes the operators take. Each covers the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kbvec.functions.ids import vector_id
from kbvec.functions.text import words
from kbvec.operators.metrics import ERROR, HIT, SEARCH

DIM = 64

SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table; its schema is known, so no job is spent on inferring it."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


# Groups of five rows take turns: no URL, chunks of one URL, one URL per row.
SOURCE = ("*", "(vec_id div 5) % 3 = 1 AS is_chunked", """CASE (vec_id div 5) % 3
  WHEN 0 THEN '' WHEN 1 THEN concat('https://kb.example/d/', vec_id div 5)
  ELSE concat('https://kb.example/p/', vec_id) END AS source_url""")
REST = ("*", "vec_id AS kb_id", "IF(is_chunked, cast(vec_id % 5 AS int), null) AS chunk_index",
        "IF(is_chunked, 5, null) AS total_chunks", "coalesce(text, '') AS content",
        "CASE label % 3 WHEN 0 THEN 'default' WHEN 1 THEN 'support_en' ELSE 'support_fr' END AS bot_id",
        "IF(vec_id % 4 = 0, 'subscriber', 'public') AS role_restriction",
        "CASE vec_id % 3 WHEN 0 THEN 'post' WHEN 1 THEN 'page' ELSE 'product' END AS content_type",
        """timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(vec_id div 1440 AS int), 0,
          cast(vec_id % 1440 AS int)) AS updated_at""")


def _kb(base: DataFrame) -> DataFrame:
    rows = base.selectExpr(*SOURCE).selectExpr(*REST)
    ident = vector_id(F.col("kb_id"), F.col("source_url"), F.col("is_chunked"), F.col("chunk_index"))
    return rows.withColumn("vector_id", ident).select(
        "kb_id", "label", "vector_id", "bot_id", "embedding", "content", "source_url", "role_restriction",
        "content_type", "chunk_index", "total_chunks", "is_chunked", F.col("updated_at").alias("created_at"),
        "updated_at")


def kb_vectors(spark: SparkSession, sf: str, content: bool = True) -> DataFrame:
    """The vector table: every embedding, with its document's text where there is one."""
    base = table(spark, sf, "embeddings")
    if content:
        docs = table(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), "text")
        base = base.join(docs, "vec_id", "left")
    else:
        base = base.withColumn("text", F.lit(""))
    return _kb(base)


def kb_source(spark: SparkSession, sf: str) -> DataFrame:
    """What the source table is made of: every document and every embedding; most documents have no vector."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    both = table(spark, sf, "embeddings").join(docs, "vec_id", "full_outer")
    return _kb(both.withColumn("label", F.expr("coalesce(label, cast(vec_id % 10 AS int))")))


def vector_digest(vector: str = "embedding") -> list:
    """Digest of all components: their sum, and their sum weighted by place."""
    zero = F.lit(0.0)
    weighted = F.transform(vector, lambda x, i: x.cast("double") * (i + 1))
    return [F.round(F.aggregate(vector, zero, lambda a, x: a + x.cast("double")), 4).alias("vector_sum"),
            F.round(F.aggregate(weighted, zero, lambda a, x: a + x), 3).alias("vector_weighted")]


def query_vector(spark: SparkSession, sf: str, vec_id: int = 0) -> list[float]:
    """The embedding asked with: that of one stored row ("more like this")."""
    row = table(spark, sf, "embeddings").filter(F.col("vec_id") == vec_id).select("embedding").first()
    return [float(x) for x in row["embedding"]]


def query_text(spark: SparkSession, sf: str, item_id: int = 0) -> str:
    """The text asked with: that of one benchmark item, whole."""
    return table(spark, sf, "benchmark").filter(F.col("item_id") == item_id).select("text").first()[0]


def benchmark_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Every benchmark item as a query, with the vector and the tenant of the row of its number."""
    rows = kb_vectors(spark, sf, content=False).select(F.col("kb_id").alias("item_id"), "bot_id", "embedding")
    return table(spark, sf, "benchmark").join(rows, "item_id").select(
        F.col("item_id").cast("string").alias("query_id"), "bot_id", "embedding", F.col("text").alias("query_text"))


def centroids(vectors: DataFrame) -> DataFrame:
    """One query per tenant and label: the mean of its vectors, summed component by component."""
    parts = (vectors.select("bot_id", "label", F.posexplode("embedding").alias("i", "x"))
             .groupBy("bot_id", "label", "i").agg(F.avg(F.col("x").cast("double")).alias("x")))
    lists = parts.groupBy("bot_id", "label").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("c"))
    return lists.select(F.col("label").cast("string").alias("query_id"), "bot_id",
                        F.transform("c", lambda s: s["x"]).alias("embedding"))


def serialized(embedding: Column) -> Column:
    """``a:N:{i:0;d:...;}`` text of a vector."""
    parts = F.transform(embedding, lambda x, i: F.concat(
        F.lit("i:"), i.cast("string"), F.lit(";d:"), x.cast("string"), F.lit(";")))
    return F.concat(F.lit("a:"), F.size(embedding).cast("string"), F.lit(":{"),
                    F.array_join(parts, ""), F.lit("}"))


def has_vector() -> Column:
    """False for documents without an embedding and for the products of one category, whose embedding call failed."""
    return F.col("embedding").isNotNull() & ((F.col("label") != 8) | (F.col("content_type") != "product"))


def broken_vector() -> Column:
    """What such rows hold instead: nothing, a number that is none, or too few components."""
    return F.expr("""CASE kb_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'a:2:{i:0;d:0.5;i:1;d:1-2;}'
      ELSE 'a:64:{i:0;d:0.25;}' END""")


def kb_rows(vectors: DataFrame) -> DataFrame:
    """The source table the vectors came from."""
    header = F.concat(F.lit('{"document_type":"chunked","chunk_index":'), F.col("chunk_index").cast("string"),
                      F.lit(',"total_chunks":'), F.col("total_chunks").cast("string"), F.lit("}\n---\n"))
    return vectors.select(
        F.col("kb_id").alias("id"), "source_url",
        F.when(F.col("is_chunked"), F.concat(header, F.col("content"))).otherwise(F.col("content")).alias("article_content"),
        F.when(has_vector(), serialized(F.col("embedding"))).otherwise(broken_vector()).alias("embedding_vector"),
        "role_restriction", "content_type", F.col("updated_at").alias("timestamp"), "bot_id")


def replica(vectors: DataFrame) -> DataFrame:
    """A copy that missed one category and holds older text for another."""
    stale = F.when(F.col("label") == 5, F.lit("older text")).otherwise(F.col("content"))
    return vectors.filter(F.col("label") != 7).withColumn("content", stale)


def request_log(spark: SparkSession, sf: str, stream: bool = False) -> DataFrame:
    """Events as requests."""
    if stream:
        events = spark.readStream.schema(SCHEMAS["events"]).option("pathGlobFilter", "events.parquet").parquet(sf)
    else:
        events = table(spark, sf, "events")
    op = (F.when(F.col("event_type") == "error", ERROR).when(F.col("event_type") == "view", HIT)
          .otherwise(SEARCH))
    return events.select("event_id", "ts", "user_id", (F.col("user_id") % 4).alias("namespace"),
                         op.alias("op"), F.floor("value").cast("long").alias("latency_ms"))


def change_log(vectors: DataFrame, events: DataFrame) -> DataFrame:
    """Events as writes to the vector numbered like their user: errors delete it, others replace its text."""
    e = events.select("event_id", "ts", "event_type", "value", "props", F.col("user_id").alias("kb_id"))
    return e.join(vectors.drop("created_at", "updated_at", "content", "label"), "kb_id").select(
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "error", "delete").otherwise("upsert").alias("op"),
        *[c for c in vectors.columns if c not in ("kb_id", "label", "created_at", "updated_at", "content")],
        F.concat_ws(" ", "event_type", F.col("event_id").cast("string")).alias("content"),
        F.col("ts").alias("created_at"), F.col("ts").alias("updated_at"),
        F.col("ts").alias("queued_at"), (F.col("event_id") % 10).alias("retries"),
        F.when(F.col("value") < 5, F.lit("")).otherwise(F.col("props")).alias("payload"),
        (F.col("value") < 50).alias("ok"))


def pending(events: DataFrame) -> DataFrame:
    """Failed writes waiting for a retry: one per error event."""
    e = events.filter(F.col("event_type") == "error")
    return e.select(F.col("event_id").alias("seq"), F.col("ts").alias("queued_at"),
                    (F.col("event_id") % 10).alias("retries"),
                    F.when(F.col("value") < 5, F.lit("")).otherwise(F.col("props")).alias("payload"),
                    (F.col("value") < 50).alias("ok"))


def posts(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "pages")
    return p.select(
        F.col("page_id").alias("ID"),
        F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1).alias("post_title"),
        F.col("html").alias("post_content"), F.expr("CASE page_id % 3 WHEN 0 THEN 'post' WHEN 1 THEN 'page' ELSE 'FAQ Entry' END AS post_type"),
        F.when(F.col("page_id") % 20 == 0, "draft").otherwise("publish").alias("post_status"),
        F.col("url").alias("permalink"))


def delete_entries(vectors: DataFrame) -> DataFrame:
    """The deletion of one category, as the host lists it."""
    return vectors.filter(F.col("label") == 9).select(
        F.col("vector_id").alias("id"),
        F.when(F.col("content_type") == "product", "wordpress").otherwise("pinecone").alias("source"),
        F.col("source_url").alias("sourceUrl"), F.col("is_chunked").cast("string").alias("isGroup"))


def documents_as_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as a text row."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("vector_id"), F.col("text").alias("content"), "lang", "source")
