"""Times searches over many more vectors than the given tables hold, and prints one JSON line.

The given vectors are copied with seeded noise to BENCH_ROWS rows of one tenant (100,000 and 1,000,000 unless set).
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from kbvec.operators import batch, replicate
from kbvec.operators.search import search
from kbvec.plans import fixtures as fx
from kbvec.session import build_session, release_scratch, scratch_path

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ROWS = [int(n) for n in os.environ.get("BENCH_ROWS", "100000,1000000").split(",")]
QUERIES = 2000


def vectors(spark, n: int) -> str:
    """A folder of ``n`` rows of one tenant, packed for scans."""
    path = scratch_path(spark, "bench")
    base = fx.table(spark, SF_DIR, "embeddings").select("vec_id", "embedding")
    count = base.count()
    noise = F.transform("embedding", lambda x, i: (x + F.sin(F.col("id") * 0.37 + i * 1.7) * 0.05).cast("float"))
    rows = spark.range(n, numPartitions=int(CPUS) * 4).withColumn("vec_id", F.col("id") % count).join(
        F.broadcast(base), "vec_id").select(F.format_string("v%09d", "id").alias("vector_id"), F.lit("t").alias("bot_id"),
                                       noise.alias("embedding"))
    rows.write.parquet(path)
    batch.pack(spark.read.parquet(path)).write.parquet(f"{path}-packed")
    return path


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    out = {}
    for n in ROWS:
        path = vectors(spark, n)
        rows, packed = spark.read.parquet(path), spark.read.parquet(f"{path}-packed")
        asked = rows.limit(QUERIES).withColumnRenamed("vector_id", "query_id")
        one = [float(x) for x in rows.first()["embedding"]]
        runs = {"knn_one": lambda: search(rows, one, 10, "t"),
                "knn_one_packed": lambda: batch.search_batch(packed, asked.limit(1), 10),
                f"knn_batch_{QUERIES}": lambda: batch.search_batch(packed, asked, 10),
                "tenant_signature": lambda: replicate.tenant_signature(rows)}
        for name, run in runs.items():
            seconds(run)
            out[f"{name}_{n}"] = seconds(run)
    release_scratch(spark)
    print(json.dumps({"metric": "searches over copied vectors, warm", "unit": "sec", "cpus": int(CPUS), "queries": out}))
    spark.stop()


if __name__ == "__main__":
    main()
