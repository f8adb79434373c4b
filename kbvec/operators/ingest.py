"""From source rows to vector rows: parsing, tenants, ids, aliases, validation, loads."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kbvec.functions.ids import vector_id
from kbvec.functions.text import chunk_header, parse_serialized_vector, strip_markup
from kbvec.schema import DEFAULT_ROLE, DEFAULT_TENANT, DEFAULT_TYPE

# Overlap of an incremental load, and the share of skipped rows worth a warning.
OVERLAP_SECONDS = 120
SKIP_WARNING_SHARE = 0.01

# Metadata keys per target column, first present key wins.
REQUEST_ALIASES = {
    "content": ("text",),
    "source_url": ("source_url", "source"),
    "role_restriction": ("role_restriction",),
    "content_type": ("type",),
    "chunk_index": ("chunk_index", "part_index"),
    "total_chunks": ("total_chunks", "part_total"),
    "is_chunked": ("is_chunked",),
}
EXPORT_ALIASES = {
    "content": ("text", "content"),
    "source_url": ("source_url", "url"),
    "role_restriction": ("role_restriction",),
    "content_type": ("type", "content_type"),
    "chunk_index": ("chunk_index",),
    "total_chunks": ("total_chunks",),
    "is_chunked": ("is_chunked",),
}

# Post types kept under their own name.
KNOWN_POST_TYPES = ("post", "page", "product")

ColumnRule = Callable[[DataFrame], Column]


def resolve_tenant(df: DataFrame, override: ColumnRule | None = None) -> Column:
    """Tenant of a source row: ``bot_id`` where the column exists and is filled, else the default.

    ``override`` may derive another tenant from the row; an empty result falls back to the default.
    """
    if override is not None:
        own = override(df)
    elif "bot_id" in df.columns:
        own = F.col("bot_id")
    else:
        return F.lit(DEFAULT_TENANT)
    return F.coalesce(F.nullif(own, F.lit("")), F.lit(DEFAULT_TENANT))


def kb_to_vectors(rows: DataFrame, prefix: str = "kb_", tenant: ColumnRule | None = None,
                  embedding: ColumnRule | None = None) -> DataFrame:
    """Knowledge-base rows to vector rows, keeping rows without a usable embedding (null).

    ``embedding`` supplies the vector where the source does not hold it as serialised text.
    """
    parsed = chunk_header(F.col("article_content"))
    vec = embedding(rows) if embedding else parse_serialized_vector(F.col("embedding_vector"))
    staged = rows.select(
        "*",
        resolve_tenant(rows, tenant).alias("_tenant"),
        vec.alias("_embedding"),
        *[c.alias(f"_{name}") for name, c in parsed.items()],
    )
    carried = [c for c in ("timestamp",) if c in rows.columns]
    return staged.select(
        vector_id(F.col("id"), F.col("source_url"), F.col("_is_chunked"), F.col("_chunk_index"),
                  prefix).alias("vector_id"),
        F.col("_tenant").alias("bot_id"),
        F.col("_embedding").alias("embedding"),
        F.col("_body").alias("content"),
        F.coalesce("source_url", F.lit("")).alias("source_url"),
        F.coalesce("role_restriction", F.lit(DEFAULT_ROLE)).alias("role_restriction"),
        F.coalesce("content_type", F.lit(DEFAULT_TYPE)).alias("content_type"),
        F.col("_chunk_index").alias("chunk_index"),
        F.col("_total_chunks").alias("total_chunks"),
        F.col("_is_chunked").alias("is_chunked"),
        F.col("id").alias("source_row"),
        *carried,
    )


def map_metadata(records: DataFrame, aliases: dict[str, tuple[str, ...]],
                 tenant: str = DEFAULT_TENANT) -> DataFrame:
    """Service records ``id, values, metadata`` to vector rows through an alias set; unknown keys go."""
    def first(name: str) -> Column:
        return F.coalesce(*[F.col("metadata").getItem(k) for k in aliases[name]])

    def whole_number(name: str) -> Column:
        raw = first(name)
        return F.when(raw.isNotNull(),
                      F.coalesce(raw.try_cast("double").try_cast("int"), F.lit(0)))

    flag = F.lower(F.coalesce(first("is_chunked"), F.lit("")))
    return records.select(
        F.coalesce(F.col("id"), F.lit("")).alias("vector_id"),
        F.lit(tenant or DEFAULT_TENANT).alias("bot_id"),
        F.when(F.size("values") > 0, F.col("values")).alias("embedding"),
        F.coalesce(first("content"), F.lit("")).alias("content"),
        F.coalesce(first("source_url"), F.lit("")).alias("source_url"),
        F.coalesce(first("role_restriction"), F.lit(DEFAULT_ROLE)).alias("role_restriction"),
        F.coalesce(first("content_type"), F.lit(DEFAULT_TYPE)).alias("content_type"),
        whole_number("chunk_index").alias("chunk_index"),
        whole_number("total_chunks").alias("total_chunks"),
        (~flag.isin("", "0", "false")).alias("is_chunked"),
    )


def missing_parts() -> Column:
    """True for rows that are skipped: no id, or no embedding at all."""
    return (F.coalesce(F.col("vector_id"), F.lit("")) == "") | F.col("embedding").isNull()


def malformed(dim: int) -> Column:
    """True for rows whose embedding has the wrong length or a component that is not a number."""
    bad_part = F.exists("embedding", lambda x: x.isNull() | F.isnan(x.cast("double")))
    return (F.size("embedding") != dim) | bad_part


def validate(df: DataFrame, dim: int, mode: str = "fail") -> DataFrame | tuple[DataFrame, DataFrame]:
    """Drop skipped rows; on malformed ones stop the job, or split them off with ``quarantine``."""
    present = df.filter(~missing_parts())
    if mode == "quarantine":
        return present.filter(~malformed(dim)), present.filter(malformed(dim))
    if mode != "fail":
        raise ValueError(f"mode must be 'fail' or 'quarantine', got {mode!r}")
    message = F.concat(F.lit("bad embedding for vector_id="), F.col("vector_id"),
                       F.lit(f": expected {dim} numbers, got size "), F.size("embedding"))
    checked = F.when(malformed(dim), F.raise_error(message)).otherwise(F.col("embedding"))
    return present.withColumn("embedding", checked)


def skip_report(df: DataFrame) -> DataFrame:
    """One row: scanned, upserted, skipped, and whether the skipped share needs attention."""
    skipped = F.sum(F.when(missing_parts(), 1).otherwise(0))
    counts = df.agg(F.count("*").alias("scanned"), F.coalesce(skipped, F.lit(0)).alias("skipped"))
    share = F.try_divide(F.col("skipped"), F.col("scanned"))
    return counts.select(
        "scanned",
        (F.col("scanned") - F.col("skipped")).alias("upserted"),
        "skipped",
        F.coalesce(share > SKIP_WARNING_SHARE, F.lit(False)).alias("flagged"),
    )


def load_kb(rows: DataFrame, dim: int, **options) -> DataFrame:
    """Full load: source rows to validated vector rows, ready for the upsert."""
    return validate(kb_to_vectors(rows, **options), dim)


def changed_since(rows: DataFrame, last_load: dt.datetime | None) -> DataFrame:
    """Rows stamped at or after the last load less the overlap that absorbs clock skew."""
    if last_load is None:
        return rows
    cutoff = max(last_load - dt.timedelta(seconds=OVERLAP_SECONDS), dt.datetime(1970, 1, 1))
    return rows.filter(F.col("timestamp") >= F.lit(cutoff).cast("timestamp_ntz"))


def load_kb_since(rows: DataFrame, last_load: dt.datetime | None, dim: int, **options) -> DataFrame:
    return load_kb(changed_since(rows, last_load), dim, **options)


def map_content_type(post_type: Column) -> Column:
    """Post, page and product as they are; others as lower-case keys; an empty key is ``content``."""
    key = F.regexp_replace(F.lower(post_type), r"[^a-z0-9_\-]", "")
    return F.when(post_type.isin(*KNOWN_POST_TYPES), post_type).otherwise(
        F.coalesce(F.nullif(key, F.lit("")), F.lit(DEFAULT_TYPE)))


def build_post_content(posts: DataFrame, override: ColumnRule | None = None) -> Column:
    """Title, a blank line and the plain text; the text alone where there is no title."""
    if override is not None:
        return override(posts)
    title = F.trim(F.regexp_replace(F.coalesce("post_title", F.lit("")), r"^[\r\n\t]+|[\r\n\t]+$", " "))
    body = strip_markup(F.coalesce("post_content", F.lit("")))
    return F.when(title != "", F.concat(title, F.lit("\n\n"), body)).otherwise(body)


def load_posts(posts: DataFrame, tenant: str = DEFAULT_TENANT,
               content: ColumnRule | None = None) -> DataFrame:
    """Posts to rows that only lack an embedding; ``failed`` marks empty content or a missing link."""
    text = build_post_content(posts, content)
    staged = posts.select("*", text.alias("_content"))
    link = F.coalesce("permalink", F.lit(""))
    blank = F.trim(F.regexp_replace(F.coalesce("_content", F.lit("")), r"[\r\n\t]", " ")) == ""
    return staged.select(
        F.col("ID").alias("post_id"),
        F.md5(link).alias("vector_id"),
        F.lit(tenant).alias("bot_id"),
        F.col("_content").alias("content"),
        link.alias("source_url"),
        map_content_type(F.col("post_type")).alias("content_type"),
        (blank | (link == "")).alias("failed"),
    )


def posts_summary(loaded: DataFrame) -> DataFrame:
    failed = F.coalesce(F.sum(F.col("failed").cast("int")), F.lit(0))
    return loaded.agg(
        (F.count("*") - failed).alias("processed"), failed.alias("failed"), F.count("*").alias("total"))
