"""Two copies of one table: copying, change logs, retry queues, drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kbvec.operators.ingest import missing_parts
from kbvec.schema import conform
from kbvec.session import broadcast_if_small, materialize

# Copy batch, retry limit, drift small enough to wait for the queue.
COPY_BATCH = 1000
RETRY_LIMIT = 10
SMALL_DIFFERENCE = 50


def copy_batch(source: DataFrame, cursor: str = "", size: int = COPY_BATCH) -> DataFrame:
    """The next ``size`` rows after ``cursor`` in id order."""
    return source.filter(F.col("vector_id") > F.lit(cursor)).orderBy("vector_id").limit(size)


def copy_state(batch: DataFrame, replica_rows: int, target_rows: int, cursor: str = "") -> DataFrame:
    """State after a batch: new cursor, rows read, and whether the replica has reached its target."""
    new_rows = F.count("*")
    return batch.agg(
        F.coalesce(F.max("vector_id"), F.lit(cursor)).alias("last_vector_id"),
        new_rows.alias("batch_rows"),
        (F.lit(replica_rows) + new_rows).alias("processed_count"),
        F.lit(target_rows).cast("long").alias("target_count"),
        (F.lit(replica_rows) + new_rows >= F.lit(target_rows)).alias("done"))


def missing_rows(source: DataFrame, replica: DataFrame) -> DataFrame:
    """Rows of ``source`` whose id the replica lacks: the whole copy as one anti join."""
    return source.join(replica.select("vector_id"), "vector_id", "left_anti").select(*source.columns)


def copy_missing(source: DataFrame, replica: DataFrame) -> DataFrame:
    return replica.unionByName(missing_rows(source, replica).select(*replica.columns))


def latest_changes(log: DataFrame) -> DataFrame:
    """The last entry per id of ``log(seq, vector_id, op, ...)``; older ones are pruned in each task.

    Upserts without id or embedding are skipped, as by any upsert.
    """
    valid = log.filter((F.col("op") == "delete") | ((F.col("op") == "upsert") & ~missing_parts()))
    w = Window.partitionBy("vector_id").orderBy(F.col("seq").desc())
    return valid.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") == 1).drop("_n")


def apply_change_log(replica: DataFrame, log: DataFrame, storage: str = "float32", now=None) -> DataFrame:
    """Replay upserts and deletes; only the last entry of an id counts, so a replay changes nothing."""
    last = latest_changes(log)
    ids = broadcast_if_small(last.select("vector_id"))
    fresh = conform(last.filter(F.col("op") == "upsert"), storage, now)
    return replica.join(ids, "vector_id", "left_anti").select(*fresh.columns).unionByName(fresh)


def drain_step(pending: DataFrame, ok: Column, cap: int | None = None) -> DataFrame:
    """One pass over the retry queue ``(seq, payload, queued_at, retries)``: all entries, or the oldest ``cap``.

    Every entry comes back with a ``state``: done, dropped (empty payload), retry (one more try
    spent), quarantine (tries used up) or waiting (beyond this pass). ``ok`` tells whether replaying
    an entry succeeds.
    """
    if cap is None:
        marked = pending.withColumn("_due", F.lit(True))
    else:
        head = materialize(pending.select("queued_at", "seq").orderBy("queued_at", "seq").limit(cap), "due")
        marked = pending.join(broadcast_if_small(head.withColumn("_due", F.lit(True))), ["queued_at", "seq"], "left")
    tries = F.col("retries") + 1
    due = F.coalesce("_due", F.lit(False))
    failed = due & (F.coalesce("payload", F.lit("")) != "") & ~F.coalesce(ok, F.lit(False))
    state = (F.when(~due, "waiting")
             .when(F.coalesce("payload", F.lit("")) == "", "dropped")
             .when(~failed, "done")
             .when(tries >= RETRY_LIMIT, "quarantine")
             .otherwise("retry"))
    return (marked.withColumn("state", state)
            .withColumn("retries", F.when(failed, tries).otherwise(F.col("retries")))
            .drop("_due"))


def enqueue(pending: DataFrame, failed: DataFrame, max_queue: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The queue with failed writes appended (up to ``max_queue``), and the writes that found it full."""
    fresh = failed.withColumn("retries", F.lit(0)).select(*pending.columns)
    if max_queue is None:
        return pending.unionByName(fresh), fresh.limit(0)
    taken = materialize(fresh.orderBy("queued_at", "seq").limit(max(0, max_queue - pending.count())), "taken")
    rest = fresh.join(broadcast_if_small(taken.select("queued_at", "seq")), ["queued_at", "seq"], "left_anti")
    return pending.unionByName(taken), rest.select(*pending.columns)


def drain_totals(drained: DataFrame) -> DataFrame:
    def n(*states):
        return F.coalesce(F.sum(F.col("state").isin(*states).cast("int")), F.lit(0))
    return drained.agg(n("done").alias("drained"), n("retry").alias("retried"),
                       n("quarantine").alias("quarantined"), n("retry", "waiting").alias("remaining"))


# --- drift -------------------------------------------------------------------------------------

def tenant_signature(vectors: DataFrame) -> DataFrame:
    """``bot_id, rows, sig``: equal when a tenant holds the same ids on both sides, and otherwise but for a clash of
    128-bit sums.

    The digest adds up the four 32-bit words of every id's md5 (a multiset hash) and so needs no
    order: tasks send four partial sums per tenant, however many rows one tenant has.
    """
    digest = F.md5("vector_id")
    words = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)") for i in range(4)]
    sums = [F.sum(w).cast("string") for w in words]
    rows = F.count("*")
    return vectors.groupBy("bot_id").agg(
        rows.alias("rows"), F.md5(F.concat_ws(",", rows.cast("string"), *sums)).alias("sig"))


def compare_signatures(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Tenants whose count or signature differ, with both counts; a missing side counts 0 rows."""
    p = primary.select("bot_id", F.col("rows").alias("primary_rows"), F.col("sig").alias("_p"))
    r = replica.select("bot_id", F.col("rows").alias("replica_rows"), F.col("sig").alias("_r"))
    both = p.join(r, "bot_id", "full_outer").na.fill(0, ["primary_rows", "replica_rows"])
    differs = (F.col("primary_rows") != F.col("replica_rows")) | ~F.col("_p").eqNullSafe(F.col("_r"))
    return both.filter(differs).select("bot_id", "primary_rows", "replica_rows").orderBy("bot_id")


def drift_status(drifted: DataFrame, pending: int, previous: str = "active") -> DataFrame:
    """One row: drifted tenants, whether the queue will close the gap, and the resulting status.

    Without drift only a previous ``drifted`` turns to ``active``; other states are left alone.
    """
    near = F.coalesce(F.bool_and(
        F.abs(F.col("primary_rows") - F.col("replica_rows")) <= SMALL_DIFFERENCE), F.lit(True))
    recovered = "active" if previous == "drifted" else previous
    return drifted.agg(F.count("*").alias("drifted_tenants"), near.alias("_near")).select(
        "drifted_tenants",
        ((F.col("drifted_tenants") > 0) & F.lit(pending > 0) & F.col("_near")).alias("drainable"),
    ).withColumn("status", F.when(F.col("drifted_tenants") == 0, recovered)
                 .when(F.col("drainable"), previous).otherwise("drifted"))


def row_diff(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """``vector_id, change``: ids on one side only, and ids whose rows differ in any shared column.

    Only ids and two 64-bit row hashes are shuffled.
    """
    shared = [c for c in primary.columns if c in replica.columns and c != "vector_id"]

    def hashed(df: DataFrame, name: str) -> DataFrame:
        # A null flag per column keeps (null, x) and (x, null) apart, which plain hashing would not.
        cols = [x for c in shared for x in (F.col(c).isNull(), F.col(c))]
        return df.select("vector_id", F.struct(F.xxhash64(*cols), F.xxhash64(F.lit(1), *cols)).alias(name))

    both = hashed(primary, "_p").join(hashed(replica, "_r"), "vector_id", "full_outer")
    change = (F.when(F.col("_r").isNull(), "missing").when(F.col("_p").isNull(), "extra")
              .when(F.col("_p") != F.col("_r"), "changed"))
    return both.select("vector_id", change.alias("change")).filter(F.col("change").isNotNull())
