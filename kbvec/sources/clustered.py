"""A vector table laid out for point lookups: sorted by id, with bloom filters for ids and source URLs.

``write`` cuts each tenant into ranges of ids, so that the statistics of a row group exclude most ids, and lets the
Parquet writer add bloom filters, which exclude the row groups of URLs (scattered over the ranges) and of absent ids.
A hot tenant is many ranges. ``by_ids`` and ``by_url`` push equalities, which is what those filters answer; a long IN
list would reach the reader as one range from its least to its greatest value.

Rows with a null id sort first and are never found by id; repeated ids are all returned; an empty list of ids finds
nothing; an empty table can be written and read; further columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kbvec.schema import DEFAULT_TENANT

#: Ids of one lookup, at most; a larger set is a frame and goes through ``lookup.fetch_by_ids``.
MOST_IDS = 256
#: Distinct values that a row group's filters are sized for, and bytes of a row group.
VALUES, GROUP_BYTES = 1_000_000, 128 * 1024 * 1024
KEYS = ("vector_id", "source_url")


def write(vectors: DataFrame, path: str, ranges: int | None = None, values: int = VALUES,
          group_bytes: int = GROUP_BYTES) -> None:
    """Write ``vectors`` by tenant and range of ids; ``ranges`` (default: Spark's partitions) are files over all tenants."""
    order = ["bot_id", "vector_id"]
    spread = vectors.repartitionByRange(*([ranges] if ranges else []), *order).sortWithinPartitions(*order)
    writer = spread.write.partitionBy("bot_id").option("parquet.block.size", group_bytes)
    for key in (k for k in KEYS if k in vectors.columns):
        # Filters shrink to the values a row group really holds.
        writer = (writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
                  .option(f"parquet.bloom.filter.expected.ndv#{key}", values)
                  .option("parquet.bloom.filter.adaptive.enabled", "true"))
    writer.parquet(path)


def read(spark, path: str, like: DataFrame) -> DataFrame:
    """The table at ``path`` with the columns of ``like``, in their order."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def _any_of(tests: list[Column]) -> Column:
    """A balanced disjunction, so that plans of many ids stay flat."""
    if len(tests) == 1:
        return tests[0]
    half = len(tests) // 2
    return _any_of(tests[:half]) | _any_of(tests[half:])


def by_ids(table: DataFrame, ids: Iterable[str], tenant: str = DEFAULT_TENANT) -> DataFrame:
    """The tenant's rows with one of ``ids``; only row groups that may hold one are read."""
    wanted = sorted({i for i in ids if i is not None})
    if len(wanted) > MOST_IDS:
        raise ValueError(f"{len(wanted)} ids in one lookup of at most {MOST_IDS}; use a frame and fetch_by_ids")
    own = table.filter(F.col("bot_id") == F.lit(tenant))
    return own.filter(_any_of([F.col("vector_id") == F.lit(i) for i in wanted])) if wanted else own.limit(0)


def by_url(table: DataFrame, url: str, tenant: str = DEFAULT_TENANT) -> DataFrame:
    """The tenant's rows of one source URL."""
    return table.filter((F.col("bot_id") == F.lit(tenant)) & (F.col("source_url") == F.lit(url)))
