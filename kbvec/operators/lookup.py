"""Counts, id listings, fetches, chunk reassembly, size and state of the vector table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from kbvec.operators.search import to_matches
from kbvec.schema import DEFAULT_TENANT
from kbvec.session import broadcast_if_small

# Page size, and bytes per row beside the embedding.
PAGE = 100
ROW_OVERHEAD_BYTES = 200
COMPONENT_BYTES = {"float32": 4, "int8": 1}


def count_by_tenant(vectors: DataFrame) -> DataFrame:
    return vectors.groupBy("bot_id").agg(F.count("*").alias("rows"))


def list_ids(vectors: DataFrame, tenant: str = DEFAULT_TENANT, limit: int | None = PAGE, offset: int = 0,
             prefix: str | None = None, after: tuple | None = None) -> DataFrame:
    """Ids, newest first; ``prefix`` is compared literally, ``limit=None`` lists all.

    ``after`` is the (created_at, vector_id) of the last row of the page before: the next page then reads no more
    rows than the first, while ``offset`` ships all rows it skips.
    """
    rows = vectors.filter(F.col("bot_id") == F.lit(tenant))
    if prefix:
        rows = rows.filter(F.col("vector_id").startswith(F.lit(prefix)))
    if after:
        stamp, last = after
        rows = rows.filter((F.col("created_at") < F.lit(stamp))
                           | ((F.col("created_at") == F.lit(stamp)) & (F.col("vector_id") > F.lit(last))))
    page = rows.select("vector_id", "created_at").orderBy(F.desc("created_at"), "vector_id")
    if offset:
        page = page.offset(offset)
    return (page if limit is None else page.limit(limit)).select("vector_id")


def fetch_by_ids(vectors: DataFrame, ids: DataFrame, tenant: str = DEFAULT_TENANT) -> DataFrame:
    """Match rows without a score; ids that do not exist in the tenant are absent."""
    wanted = broadcast_if_small(ids.select("vector_id").distinct())
    return to_matches(vectors.filter(F.col("bot_id") == F.lit(tenant)).join(wanted, "vector_id"))


def chunks_of_url(vectors: DataFrame, url: str, tenant: str = DEFAULT_TENANT) -> DataFrame:
    """The chunk rows of one URL in reading order."""
    own = (F.col("bot_id") == F.lit(tenant)) & (F.col("source_url") == F.lit(url))
    return vectors.filter(own & F.col("is_chunked")).orderBy("chunk_index", "vector_id")


def reassemble(vectors: DataFrame, separator: str = "\n", part_chunks: int | None = None) -> DataFrame:
    """Text of every chunked URL, joined by chunk index (missing ones first) and id.

    One row for each source. With ``part_chunks`` a source comes back as consecutive parts of so many chunks, for
    sources whose text does not fit one row.
    """
    key = ["bot_id", "source_url"]
    chunks = vectors.filter(F.col("is_chunked")).select(
        *key, F.struct("chunk_index", "vector_id", F.coalesce("content", F.lit("")).alias("content")).alias("c"))
    if part_chunks is not None:
        order = Window.partitionBy(*key).orderBy(F.col("c.chunk_index").asc_nulls_first(), "c.vector_id")
        chunks = chunks.withColumn("part", F.floor((F.row_number().over(order) - 1) / part_chunks).cast("int"))
        key.append("part")
    return chunks.groupBy(*key).agg(
        F.count("*").alias("chunks"),
        F.array_join(F.transform(F.sort_array(F.collect_list("c")), lambda c: c["content"]), separator).alias("text"))


def storage_estimate(vectors: DataFrame, dim: int, storage: str = "float32") -> DataFrame:
    per_row = dim * COMPONENT_BYTES[storage] + ROW_OVERHEAD_BYTES
    return vectors.agg(F.count("*").alias("rows")).select(
        "rows", (F.col("rows") * F.lit(per_row).cast("long")).alias("bytes_estimate"),
        F.lit(dim).alias("dim"), F.lit(storage).alias("storage"))


def table_stats(vectors: DataFrame) -> DataFrame:
    return vectors.agg(F.count("*").alias("rows"), F.countDistinct("bot_id").alias("tenants"),
                       F.max("updated_at").alias("last_update"))


def table_info(spark: SparkSession, path: str) -> DataFrame | None:
    """Stats of a Parquet table, or None where there is no table."""
    try:
        return table_stats(spark.read.parquet(path))
    except AnalysisException:
        return None
