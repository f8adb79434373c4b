"""The streaming form of the polling load: knowledge-base rows into a store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kbvec.operators.ingest import kb_to_vectors, validate
from kbvec.operators.mutate import last_per_id
from kbvec.session import broadcast_if_small, materialize
from kbvec.sources.store import VectorStore


def newer_than_stored(rows: DataFrame, store: VectorStore) -> DataFrame:
    """Rows at least as recent as the stored row of their id; a replay or an overlap thus does no harm."""
    ids = rows.select("vector_id")
    known = store.around(ids).select("vector_id", F.col("updated_at").alias("_stored")).join(
        broadcast_if_small(ids), "vector_id", "left_semi")
    return (rows.join(known, "vector_id", "left")
            .filter(F.col("_stored").isNull() | (F.col("updated_at") >= F.col("_stored"))).drop("_stored"))


def stream_kb(rows: DataFrame, store: VectorStore, dim: int, checkpoint: str, rejects: str,
              **options) -> StreamingQuery:
    """Load a stream of knowledge-base rows into ``store``, the last version per id by ``timestamp``.

    Rows with a malformed embedding go to ``rejects``, by batch, and do not hold up the others.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        good, bad = validate(kb_to_vectors(batch, **options), dim, mode="quarantine")
        bad.write.mode("overwrite").parquet(f"{rejects}/batch={batch_id}")
        stamped = (last_per_id(good.withColumn("_seq", F.struct("timestamp", "source_row")), "_seq")
                   .withColumn("created_at", F.col("timestamp"))
                   .withColumn("updated_at", F.col("timestamp")))
        store.upsert(newer_than_stored(materialize(stamped, "batch"), store))

    return (rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
