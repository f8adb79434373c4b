"""Operational metrics over a request log ``(ts, namespace, op, latency_ms)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rolling window, slow-query threshold, quota per minute.
WINDOW_SECONDS = 3600
SLOW_MS = 500
QUOTA_PER_MINUTE = 120
SEARCH, HIT, ERROR = "searches", "query_cache_hit", "errors"


def sample_count(counts: Column) -> Column:
    """Number of samples in an array of (ms, n)."""
    return F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x["n"])


def percentile_of_counts(counts: Column, p: float) -> Column:
    """The sample at place ``int(n * p)`` of all in order, at most the last; 0 without any.

    ``counts`` holds (ms, n) by rising ms: as long as there are different latencies, however many samples.
    """
    total = sample_count(counts)
    place = F.least(total - 1, F.floor(total * F.lit(p)))
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("ms"))

    def step(s, x):
        found = F.when(s["ms"].isNull() & (s["seen"] + x["n"] > place), x["ms"].cast("long"))
        return F.struct((s["seen"] + x["n"]).alias("seen"), F.coalesce(s["ms"], found).alias("ms"))

    return F.coalesce(F.aggregate(counts, start, step, lambda s: s["ms"]), F.lit(0))


def percentiles(counts: Column) -> list[Column]:
    return [percentile_of_counts(counts, p).alias(f"p{round(p * 100)}_ms") for p in (0.50, 0.95, 0.99)]


def count_values(samples: DataFrame, *by: str) -> DataFrame:
    """``by`` and counts: how often each latency (negatives as 0) occurs, summed inside the tasks first."""
    each = samples.groupBy(*by, F.greatest(F.lit(0), F.col("latency_ms")).cast("long").alias("ms")).agg(
        F.count("*").alias("n"))
    return each.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("ms", "n"))).alias("counts"))


def latency_snapshot(log: DataFrame, now: Column, newest: int | None = None) -> DataFrame:
    """One row: p50, p95, p99 of the samples of the rolling window; of its ``newest`` ones where that is asked for."""
    cutoff = now - F.expr(f"INTERVAL {WINDOW_SECONDS} SECONDS")
    samples = log.filter((F.col("op") == SEARCH) & (F.col("ts") >= cutoff) & (F.col("ts") <= now))
    if newest is not None:
        order = [F.col(c).desc() for c in ("event_id",) if c in log.columns]
        samples = samples.orderBy(F.col("ts").desc(), *order).limit(newest)
    return count_values(samples).select(*percentiles(F.col("counts")), sample_count(F.col("counts")).alias("sample_count"))


def metric_counters(log: DataFrame) -> DataFrame:
    weight = F.col("delta") if "delta" in log.columns else F.lit(1)
    return log.groupBy("op").agg(F.sum(weight).cast("long").alias("n"))


def cache_hit_rate(log: DataFrame) -> DataFrame:
    """``hits / (searches + hits)`` to three digits, 0 without searches; searches are cache misses."""
    def n(op):
        return F.coalesce(F.sum((F.col("op") == op).cast("int")), F.lit(0))
    rate = F.round(F.col("cache_hits") / F.greatest(F.lit(1), F.col("searches") + F.col("cache_hits")), 3)
    return log.agg(n(SEARCH).alias("searches"), n(HIT).alias("cache_hits")).select(
        "searches", "cache_hits",
        F.when(F.col("searches") > 0, rate).otherwise(F.lit(0.0)).alias("cache_hit_rate"))


def slow_queries(log: DataFrame, threshold_ms: int = SLOW_MS) -> DataFrame:
    """Searches at or above the threshold; a threshold of 0 or less reports nothing."""
    slow = (F.col("op") == SEARCH) & (F.col("latency_ms") >= threshold_ms)
    return log.filter(slow if threshold_ms > 0 else F.lit(False))


def _with_limit(df: DataFrame, limit: int, limits: DataFrame | None) -> DataFrame:
    if limits is None:
        return df.withColumn("_max", F.lit(limit))
    return (df.join(limits.select("namespace", F.col("max").alias("_max")), "namespace", "left")
            .na.fill({"_max": limit}))


def quota_report(log: DataFrame, limit: int = QUOTA_PER_MINUTE, limits: DataFrame | None = None,
                 unit: str = "minute") -> DataFrame:
    """Requests, admitted and refused per namespace and minute; a limit of 0 admits all.

    The first ``limit`` requests of a minute are the admitted ones, so counting suffices and tasks
    send one partial count per group.
    """
    counted = log.groupBy("namespace", F.date_trunc(unit, F.col("ts")).cast("timestamp_ntz").alias("minute")).agg(
        F.count("*").alias("requests"))
    capped = _with_limit(counted, limit, limits)
    admitted = F.when(F.col("_max") > 0, F.least("requests", "_max")).otherwise(F.col("requests"))
    return capped.select("namespace", "minute", "requests", admitted.alias("admitted"),
                         (F.col("requests") - admitted).alias("refused"))


def flag_over_quota(log: DataFrame, limit: int = QUOTA_PER_MINUTE, unit: str = "minute") -> DataFrame:
    """Every request with ``over``: true beyond the first ``limit`` of its namespace and minute.

    Only the ``limit`` earliest requests of a group are ranked (the rest is pruned in each task); the
    last of them is the threshold each request is compared with.
    """
    if limit <= 0:
        return log.withColumn("over", F.lit(False))
    slot = F.date_trunc(unit, F.col("ts")).cast("timestamp_ntz")
    keyed = log.withColumn("_slot", slot)
    w = Window.partitionBy("namespace", "_slot").orderBy("ts", "event_id")
    last = (keyed.select("namespace", "_slot", "ts", "event_id")
            .withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= limit)
            .filter(F.col("_n") == limit)
            .select("namespace", "_slot", F.struct("ts", "event_id").alias("_last")))
    over = F.coalesce(F.struct("ts", "event_id") > F.col("_last"), F.lit(False))
    return (keyed.join(last, ["namespace", "_slot"], "left").withColumn("over", over)
            .drop("_slot", "_last"))


def health_summary(vectors: DataFrame, log: DataFrame, queue: DataFrame, now: Column, last_load: Column,
                   enabled: bool = True, tenant: str = "default") -> DataFrame:
    """One row: table size, log counters, queue state and status."""
    table = vectors.filter(F.col("bot_id") == F.lit(tenant)).agg(F.count("*")).scalar()

    def entries(quarantined: bool):
        return queue.filter((F.col("state") == "quarantine") == quarantined).agg(F.count("*")).scalar()

    age = F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(last_load.cast("timestamp"))
    return cache_hit_rate(log).select(
        F.lit(enabled).alias("enabled"), table.alias("count"), "searches", "cache_hits", "cache_hit_rate",
        entries(False).alias("pending_count"), entries(True).alias("quarantine_count"),
        age.alias("last_load_age_s"), F.lit("healthy" if enabled else "disabled").alias("status"))
