"""Sharding by fixed virtual slots.

Every record hashes into one of a fixed number of slots; bytes are summed per slot, and a versioned table maps slots
to shards. Version 1 deals the slots out in turn. A rebalance writes the next version: each shard keeps its largest
slots up to a share of the even load, and the rest go, largest first, to the least loaded shard. Records never move
between slots, so a rebalance edits a table of ``SLOTS`` rows and no record is hashed again.

All of it is DataFrame functions. The only rows brought together in one task are the ``SLOTS`` rows of the map, a
number that does not depend on the input.

Defined cases: a null text has no bytes (size 16, crc 0); records are placed by id and text checksum, so null or
repeated ids spread like any other; equal rows are placed alike; an empty table gives an empty result and an
unedited map; a column of the input that carries the name of a result column is ignored.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kbvec.session import materialize

SLOTS = 4096
RECORD_OVERHEAD = 16
KEEP_SHARE = 0.9
#: Rows that one numbering bucket holds on average, at most.
BUCKET_ROWS = 50_000


def records(docs: DataFrame, *carry: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, size, checksum and virtual slot of every record, and the columns ``carry``."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"),
                       (F.octet_length(body) + RECORD_OVERHEAD).cast("long").alias("size"),
                       F.crc32(body).cast("long").alias("text_crc32"), *carry)
    hashed = F.xxhash64("doc_id", "text_crc32", "size")
    return rows.select("*", F.pmod(hashed, F.lit(SLOTS)).cast("int").alias("vslot"),
                       F.shiftrightunsigned(hashed, 32).alias("spread"))


def slot_bytes(rows: DataFrame) -> DataFrame:
    """Rows and bytes of every slot, summed inside the tasks before they are shuffled."""
    return rows.groupBy("vslot").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))


def initial_map(spark: SparkSession, shards: int) -> DataFrame:
    """Version 1: slots dealt out in turn."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    slots = spark.range(SLOTS, numPartitions=1)
    return slots.select(F.lit(1).alias("version"), F.col("id").cast("int").alias("vslot"),
                        (F.col("id") % shards).cast("int").alias("shard"))


def _least_loaded(moves: Column, loads: Column) -> Column:
    """Give every slot in the array ``moves`` to the shard that is least loaded by then; pairs of slot and shard."""
    start = F.struct(loads.alias("loads"),
                     F.array().cast("array<struct<vslot:int,shard:int>>").alias("given"))

    def give(state, move):
        to = F.array_position(state["loads"], F.array_min(state["loads"])).cast("int")
        loads = F.transform(state["loads"], lambda x, i: F.when(i + 1 == to, x + move["bytes"]).otherwise(x))
        given = F.concat(state["given"], F.array(F.struct(move["vslot"].alias("vslot"), (to - 1).alias("shard"))))
        return F.struct(loads.alias("loads"), given.alias("given"))

    return F.aggregate(moves, start, give, lambda s: s["given"])


def rebalance(slot_map: DataFrame, measured: DataFrame, shards: int, keep_share: float = KEEP_SHARE) -> DataFrame:
    """The next version of ``slot_map`` for ``shards`` shards, by the bytes in ``measured``.

    A slot stays where it is while the slots of its shard that are larger fit into ``keep_share`` of the even load.
    With more shards than before, the new ones start empty and take moved slots only.
    """
    loaded = slot_map.join(F.broadcast(measured.select("vslot", "bytes")), "vslot", "left").fillna(0, ["bytes"])
    heavy_first = Window.partitionBy("shard").orderBy(F.col("bytes").desc(), "vslot")
    even = F.sum("bytes").over(Window.partitionBy(F.lit(0))) / F.lit(shards)
    kept = (F.sum("bytes").over(heavy_first.rowsBetween(Window.unboundedPreceding, 0)) <= even * F.lit(keep_share))
    # A slot without records stays too, as moving it evens out nothing.
    stays = (kept | (F.col("bytes") == 0)) & (F.col("shard") < shards)
    judged = loaded.select("version", "vslot", "shard", "bytes", stays.alias("stays"))
    one = judged.agg(
        F.max("version").alias("version"),
        F.sort_array(F.collect_list(F.when(F.col("stays"), F.struct("vslot", "shard")))).alias("staying"),
        F.collect_list(F.when(F.col("stays"), F.struct("shard", "bytes"))).alias("held"),
        F.sort_array(F.collect_list(F.when(~F.col("stays"), F.struct(
            (-F.col("bytes")).alias("order"), "vslot", "bytes")))).alias("moves"))
    loads = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.aggregate(
        F.filter("held", lambda h: h["shard"] == s), F.lit(0).cast("long"), lambda a, h: a + h["bytes"]))
    moved = _least_loaded(F.col("moves"), F.col("loads"))
    return (one.withColumn("loads", loads)
            .select((F.col("version") + 1).alias("version"), F.explode(F.concat("staying", moved)).alias("to"))
            .select("version", "to.vslot", "to.shard"))


def place(rows: DataFrame, slot_map: DataFrame, *carry: str) -> DataFrame:
    """shard and, within it, a gapless position for every record, and the columns ``carry``.

    Positions come from row counts of buckets (a slot, divided further where slots are large) and the rank inside one
    bucket, so no task sorts a whole shard.
    """
    placed = rows.join(F.broadcast(slot_map.select("vslot", "shard")), "vslot")
    total = rows.count()
    parts = total // (SLOTS * BUCKET_ROWS) + 1
    placed = placed.withColumn("part", F.pmod("spread", F.lit(parts)))
    counts = placed.groupBy("shard", "vslot", "part").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("vslot", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("vslot", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    rank = F.row_number().over(Window.partitionBy("vslot", "part").orderBy("doc_id", "text_crc32", "size"))
    return placed.withColumn("rank", rank).join(starts, ["vslot", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("rank") - 1).cast("long").alias("slot"),
        "vslot", *carry)


def stored_map(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest version of the map below ``path``; None where there is none yet."""
    try:
        kept = spark.read.schema("vslot int, shard int, version int").parquet(path)
        newest = kept.agg(F.max("version")).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return kept.filter(F.col("version") == newest).select("version", "vslot", "shard") if newest is not None else None


def shard_documents(docs: DataFrame, shards: int = 40, version_path: str | None = None) -> DataFrame:
    """Place all ``docs``: shards of nearly equal bytes (law ``bytes``).

    ``version_path`` keeps the map as Parquet (version, vslot, shard): its newest version is read, edited for these
    documents and number of shards, and the next version is added; without any, slots dealt out in turn are the first.
    A version is a folder of its own and no older one is touched; one writer at a time.
    """
    spark = docs.sparkSession
    # Narrow rows, written once: the texts are read a single time.
    rows = materialize(records(docs), "records")
    before = stored_map(spark, version_path) if version_path else None
    first = initial_map(spark, shards) if before is None else before
    balanced = rebalance(first, slot_bytes(rows), shards)
    if version_path:
        added = first.unionByName(balanced) if before is None else balanced
        added.write.mode("append").partitionBy("version").parquet(version_path)
        balanced = stored_map(spark, version_path)
    return place(rows, balanced)


def write_shards(docs: DataFrame, slot_map: DataFrame, path: str) -> None:
    """Records as Parquet with their shard and slot, one folder for each shard; the tasks of a shard write files of
    their own. Columns of ``docs`` by those two names are replaced.

    A record's shard follows from its own hash, so repeated rows and rows without an id are written once each.
    """
    whole = docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row"))
    placed = place(records(whole, "_row"), slot_map, "_row")
    columns = [F.col("_row").getField(c).alias(c) for c in docs.columns if c not in ("shard", "slot")]
    placed.select(*columns, "slot", "shard").write.partitionBy("shard").parquet(path)
