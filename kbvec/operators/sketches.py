"""Latency quantiles from mergeable sketches: one KLL sketch for each namespace and minute, stored, merged for any window.

A sketch is some kilobytes however many samples it has seen, so a window of a year over billions of requests reads and
merges sketches only. Its quantiles are approximate: their rank is off by about 2.3 / k of the samples, ``RANK_ERROR``
at most in nearly all cases for the default ``K``. Exact percentiles of bounded windows are in ``metrics``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kbvec.session import broadcast_if_small

#: Size of a sketch, and the share of ranks by which its quantiles may be off.
K, RANK_ERROR = 1_000, 0.01
RANKS = (0.50, 0.95, 0.99)


def sketch_minutes(log: DataFrame, *by: str, unit: str = "minute", k: int = K) -> DataFrame:
    """namespace, minute, ``by``, samples and sketch of the latencies (negatives as 0) of each minute.

    Tasks sketch their own rows first, so a busy namespace's minute is merged from a sketch for each task.
    """
    ms = F.greatest(F.lit(0), F.col("latency_ms")).cast("bigint")
    minute = F.date_trunc(unit, F.col("ts")).cast("timestamp_ntz").alias("minute")
    counted = log.filter(F.col("latency_ms").isNotNull())
    return counted.groupBy("namespace", minute, *by).agg(
        F.count("*").alias("samples"), F.kll_sketch_agg_bigint(ms, F.lit(k)).alias("sketch"))


def merge_sketches(sketches: DataFrame, *by: str, start=None, end=None, k: int = K) -> DataFrame:
    """``by``, samples and sketch over the minutes from ``start`` until before ``end`` (all, where not given)."""
    kept = sketches
    if start is not None:
        kept = kept.filter(F.col("minute") >= F.lit(start))
    if end is not None:
        kept = kept.filter(F.col("minute") < F.lit(end))
    return kept.groupBy(*by).agg(F.sum("samples").alias("samples"), F.kll_merge_agg_bigint("sketch", F.lit(k)).alias("sketch"))


def add_sketches(stored: DataFrame, fresh: DataFrame, k: int = K) -> DataFrame:
    """Stored minutes with those of a later load: minutes that are on both sides are merged."""
    return merge_sketches(stored.unionByName(fresh), "namespace", "minute", k=k).select(*stored.columns)


def quantiles(sketch: Column, ranks: tuple[float, ...] = RANKS) -> list[Column]:
    """p50_ms, p95_ms, p99_ms of a sketch."""
    return [F.kll_sketch_get_quantile_bigint(sketch, F.lit(p)).alias(f"p{round(p * 100)}_ms") for p in ranks]


def latency_quantiles(sketches: DataFrame, start=None, end=None) -> DataFrame:
    """samples, p50, p95 and p99 per namespace of a window of whole minutes."""
    merged = merge_sketches(sketches, "namespace", start=start, end=end)
    return merged.select("namespace", "samples", *quantiles(F.col("sketch")))


def busy_minutes(sketches: DataFrame, limit: int) -> DataFrame:
    """Minutes in which a namespace asked more than ``limit`` times, with what was refused; read from the sketches alone."""
    requests = F.kll_sketch_get_n_bigint("sketch")
    return sketches.filter(requests > limit).select("namespace", "minute", requests.alias("requests"),
                                                    (requests - limit).alias("refused"))


def rank_errors(found: DataFrame, log: DataFrame, ranks: tuple[float, ...] = RANKS) -> DataFrame:
    """For each namespace of ``found`` (``latency_quantiles``), the largest distance of a quantile from its rank.

    A value that occurs often holds a range of ranks; the distance is to the nearest of them. One pass over the log.
    """
    columns = [f"p{round(p * 100)}_ms" for p in ranks]
    samples = log.filter(F.col("latency_ms").isNotNull()).select("namespace", F.greatest(F.lit(0), F.col("latency_ms")).alias("_ms"))
    joined = samples.join(broadcast_if_small(found.select("namespace", *columns)), "namespace")
    below = [F.avg((F.col("_ms") < F.col(c)).cast("double")).alias(f"_l{i}") for i, c in enumerate(columns)]
    upto = [F.avg((F.col("_ms") <= F.col(c)).cast("double")).alias(f"_u{i}") for i, c in enumerate(columns)]
    off = [F.greatest(F.lit(0.0), F.col(f"_l{i}") - F.lit(p), F.lit(p) - F.col(f"_u{i}")) for i, p in enumerate(ranks)]
    return joined.groupBy("namespace").agg(F.count("*").alias("samples"), *below, *upto).select(
        "namespace", "samples", F.greatest(*off).alias("rank_error"))
