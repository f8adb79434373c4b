"""Windowed and stateful latency and quota metrics over a request stream."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from kbvec.operators.metrics import QUOTA_PER_MINUTE, WINDOW_SECONDS, percentiles, sample_count
from kbvec.streaming.state import keyed_state

SHARDS = 8


def _windowed(log: DataFrame, length: str, slide: str | None, delay: str) -> GroupedData:
    """``log`` grouped by its window ``w``. Watermarks need zoned timestamps; the session zone is UTC."""
    stamped = log.withColumn("ts", F.col("ts").cast("timestamp"))
    late = stamped.withWatermark("ts", delay) if log.isStreaming else stamped
    return late.groupBy(F.window("ts", length, slide).alias("w"), "namespace")


def _edge(name: str):
    return F.col(f"w.{name}").cast("timestamp_ntz").alias(f"window_{name}")


def latency_windows(log: DataFrame, length: str = "1 hour", slide: str | None = None,
                    delay: str = "10 minutes") -> DataFrame:
    """Count, mean and maximum latency per namespace and window; tumbling, or sliding with ``slide``."""
    return (_windowed(log, length, slide, delay)
            .agg(F.count("*").alias("n"), F.avg("latency_ms").alias("avg_ms"),
                 F.max("latency_ms").alias("max_ms"))
            .select("namespace", _edge("start"), _edge("end"), "n", "avg_ms", "max_ms"))


def quota_windows(log: DataFrame, limit: int = QUOTA_PER_MINUTE, length: str = "1 minute",
                  delay: str = "10 minutes") -> DataFrame:
    """Windows in which a namespace went over its quota."""
    return (_windowed(log, length, None, delay)
            .agg(F.count("*").alias("requests")).filter(F.col("requests") > limit)
            .select("namespace", _edge("start"), "requests", (F.col("requests") - limit).alias("refused")))


class RollingCounts(StatefulProcessor):
    """State: by minute, how often each latency occurs in each of its seconds.

    A timer in event time drops a minute once the watermark has left it behind by the window.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.minutes = handle.getMapState("minutes", "minute long", "second array<long>, ms array<long>, n array<long>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        fresh: dict[int, Counter] = {}
        for frame in rows:
            for (second, ms), n in frame.groupby(["second", "ms"]).size().items():
                fresh.setdefault(int(second) // 60, Counter())[int(second), int(ms)] += int(n)
        for minute, counts in fresh.items():
            held = self.minutes.getValue((minute,))
            if held is None:
                self.handle.registerTimer(((minute + 1) * 60 + WINDOW_SECONDS) * 1000)
            else:
                for second, ms, n in zip(*held):
                    counts[int(second), int(ms)] += int(n)
            self.minutes.updateValue((minute,), ([k[0] for k in counts], [k[1] for k in counts], list(counts.values())))
        yield pd.DataFrame({"namespace": [key[0]] * len(fresh), "shard": [key[1]] * len(fresh), "minute": list(fresh),
                            "samples": [sum(c.values()) for c in fresh.values()]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        minute = expiredTimerInfo.getExpiryTimeInMs() // 60_000 - WINDOW_SECONDS // 60 - 1
        self.minutes.removeKey((minute,))
        yield from ()

    def close(self) -> None:
        pass


def rolling_samples(log: DataFrame, shards: int = SHARDS, delay: str = "10 minutes") -> DataFrame:
    """Keep the latencies of the rolling window as state, by (namespace, shard); the stream tells minutes that changed.

    The state grows with the different latencies of the window's seconds and is dropped as the watermark passes. A busy
    namespace is spread over ``shards`` keys, which add up.
    """
    kind = log.schema["namespace"].dataType.simpleString()
    stamped = log.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    keyed = stamped.select(
        "ts", "namespace", F.pmod(F.xxhash64("event_id"), F.lit(shards)).cast("int").alias("shard"),
        F.unix_seconds("ts").alias("second"), F.greatest(F.lit(0), F.col("latency_ms")).cast("long").alias("ms"))
    return keyed.groupBy("namespace", "shard").transformWithStateInPandas(
        RollingCounts(), f"namespace {kind}, shard int, minute long, samples long", "update", "eventtime")


def run_rolling(log: DataFrame, checkpoint: str, **options) -> StreamingQuery:
    """Bring the state below ``checkpoint`` up to date with the log; what is asked about is the state itself."""
    keyed_state(log.sparkSession)
    return (rolling_samples(log, **options).writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def rolling_percentiles(spark: SparkSession, checkpoint: str, now: Column) -> DataFrame:
    """p50, p95, p99 per namespace over the window up to ``now`` (whole seconds), from the state of ``run_rolling``."""
    state = spark.read.format("statestore").option("stateVarName", "minutes").load(checkpoint)
    each = state.select("key.namespace", F.inline(F.arrays_zip("user_map_value.second", "user_map_value.ms", "user_map_value.n")))
    last = F.unix_seconds(now.cast("timestamp"))
    window = each.filter((F.col("second") >= last - WINDOW_SECONDS) & (F.col("second") <= last))
    summed = window.groupBy("namespace", "ms").agg(F.sum("n").alias("n"))
    counts = summed.groupBy("namespace").agg(F.array_sort(F.collect_list(F.struct("ms", "n"))).alias("counts"))
    return counts.select("namespace", *percentiles(F.col("counts")), sample_count(F.col("counts")).alias("sample_count"))
