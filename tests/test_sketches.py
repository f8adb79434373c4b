"""Sketches of latencies: windows, later loads, errors of ranks."""

import datetime as dt
import random

from kbvec.operators import sketches

START = dt.datetime(2024, 1, 1)


def log(spark, data):
    rows = [(START + dt.timedelta(seconds=s), n, ms) for s, n, ms in data]
    return spark.createDataFrame(rows, "ts timestamp_ntz, namespace string, latency_ms long")


def sample(n=6000, seed=2):
    rng = random.Random(seed)
    return [(rng.randrange(7200), rng.choice("aaab"), int(rng.lognormvariate(4, 1))) for _ in range(n)]


def test_windows_and_rank_errors(spark):
    data = sample()
    stored = sketches.sketch_minutes(log(spark, data))
    assert stored.count() == len({(s // 60, n) for s, n, _ in data})
    end = START + dt.timedelta(seconds=3600)
    for first, last, inside in ((None, None, data), (None, end, [d for d in data if d[0] < 3600]), (end, None, [d for d in data if d[0] >= 3600])):
        found = sketches.latency_quantiles(stored, first, last)
        assert {r["namespace"]: r["samples"] for r in found.collect()} == {n: sum(d[1] == n for d in inside) for n in "ab"}
        errors = sketches.rank_errors(found, log(spark, inside)).collect()
        assert len(errors) == 2 and all(r["rank_error"] < sketches.RANK_ERROR for r in errors)


def test_few_samples_are_exact(spark):
    found = sketches.latency_quantiles(sketches.sketch_minutes(log(spark, [(i, "a", i) for i in range(100)] + [(0, "b", -9), (1, "c", None)])))
    got = {r["namespace"]: tuple(r)[1:] for r in found.collect()}
    assert got["b"] == (1, 0, 0, 0) and got["a"][0] == 100 and "c" not in got
    assert all(abs(x - y) <= 1 for x, y in zip(got["a"][1:], (50, 95, 99)))
    assert sketches.latency_quantiles(sketches.sketch_minutes(log(spark, []))).collect() == []


def test_a_wrong_quantile_shows(spark):
    data = log(spark, [(i, "a", i) for i in range(1000)])
    wrong = spark.createDataFrame([("a", 1000, 700, 950, 990)], "namespace string, samples long, p50_ms long, p95_ms long, p99_ms long")
    assert abs(sketches.rank_errors(wrong, data).first()["rank_error"] - 0.2) < 1e-9


def test_later_loads_and_busy_minutes(spark):
    data = sample(400)
    both = sketches.add_sketches(sketches.sketch_minutes(log(spark, data[:250])), sketches.sketch_minutes(log(spark, data[250:])))
    whole = {(r["namespace"], r["minute"]): r["samples"] for r in sketches.sketch_minutes(log(spark, data)).collect()}
    assert {(r["namespace"], r["minute"]): r["samples"] for r in both.collect()} == whole
    busy = {(r["namespace"], r["minute"]): (r["requests"], r["refused"]) for r in sketches.busy_minutes(both, 4).collect()}
    assert busy == {k: (n, n - 4) for k, n in whole.items() if n > 4} and busy
