"""Readers and writers: vector Parquet, knowledge-base tables, service exports, posts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kbvec.operators.ingest import EXPORT_ALIASES, map_metadata
from kbvec.schema import DEFAULT_TENANT, EXPORT_SCHEMA, KB_SCHEMA, conform


def read_vectors(spark: SparkSession, path: str, storage: str = "float32") -> DataFrame:
    """Vector Parquet in the current layout, matched by column name; older files gain new columns."""
    return conform(spark.read.parquet(path), storage)


def write_vectors(df: DataFrame, path: str, compression: str = "zstd") -> int:
    """Write the table as Parquet and return its row count, observed on the same pass."""
    seen = Observation()
    (df.observe(seen, F.count(F.lit(1)).alias("rows"))
     .write.option("compression", compression).parquet(path))
    # A plan known to be empty is never run and observes nothing.
    return 0 if df.sparkSession.read.schema(df.schema).parquet(path).isEmpty() else seen.get["rows"]


def jdbc_options(url: str, table: str, lower: int, upper: int, partitions: int,
                 **extra: str) -> dict[str, str]:
    """Options of a knowledge-base read split into id ranges, one connection per range."""
    if partitions < 1 or upper < lower:
        raise ValueError("need at least one partition and lower <= upper")
    return {"url": url, "dbtable": table, "partitionColumn": "id", "lowerBound": str(lower),
            "upperBound": str(upper), "numPartitions": str(partitions), "fetchsize": "10000", **extra}


def read_kb_jdbc(spark: SparkSession, **options) -> DataFrame:
    """Knowledge-base rows over JDBC; the driver jar is the cluster's."""
    return kb_rows(spark.read.format("jdbc").options(**jdbc_options(**options)).load())


def kb_rows(raw: DataFrame) -> DataFrame:
    """The knowledge-base columns of a raw table; ``bot_id`` and ``timestamp`` only where present."""
    if "source_url" not in raw.columns and "url" in raw.columns:
        raw = raw.withColumnRenamed("url", "source_url")
    optional = {"bot_id", "timestamp"}
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in KB_SCHEMA.fields
                        if f.name not in optional or f.name in raw.columns])


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """Service records ``{id, values, metadata}`` from newline-delimited JSON."""
    return spark.read.schema(EXPORT_SCHEMA).json(path)


def load_export(records: DataFrame, tenant: str = DEFAULT_TENANT) -> tuple[DataFrame, DataFrame]:
    """Vector rows, and a one-row summary; records without values count as failed."""
    rows = map_metadata(records, EXPORT_ALIASES, tenant)
    failed = F.coalesce(F.sum(F.col("embedding").isNull().cast("int")), F.lit(0))
    summary = rows.agg((F.count("*") - failed).alias("copied"), failed.alias("failed"),
                       F.lit(tenant).alias("namespace"))
    return rows.filter(F.col("embedding").isNotNull()), summary


def published(posts: DataFrame, types: Sequence[str]) -> DataFrame:
    """Published posts of the given types."""
    return posts.filter((F.col("post_status") == "publish") & F.col("post_type").isin(*types))
