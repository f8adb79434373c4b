from pathlib import Path
from types import SimpleNamespace
from urllib.parse import urlparse

import pytest

from pyspark.sql import functions as F

from kbvec.session import broadcast_if_small, is_small, materialize, release_scratch, scratch_path, shared_dir


def test_shared_folder_is_the_clusters():
    spark = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: "hdfs://nn/shared/"),
                            sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, applicationId="app-1"))
    assert shared_dir(spark) == "hdfs://nn/shared"
    assert scratch_path(spark, "x").startswith("hdfs://nn/shared/kbvec/app-1/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_local_folder_only_where_none_is_named():
    made = []
    context = SimpleNamespace(getCheckpointDir=lambda: made[-1] if made else None, setCheckpointDir=made.append,
                              master="local[4]")
    spark = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context)
    assert shared_dir(spark) == shared_dir(spark) == made[0] and len(made) == 1
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        made.clear()
        context.master = master
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(spark)


def test_scratch_is_released(spark):
    df = materialize(spark.range(3).toDF("id"), "gone")
    folder = Path(urlparse(df.inputFiles()[0]).path).parent
    assert df.count() == 3 and folder.exists()
    release_scratch(spark)
    assert not folder.exists()


def test_small_is_measured_in_rows_and_bytes(spark):
    df = spark.range(100).withColumn("s", F.repeat(F.lit("x"), 1000))
    assert is_small(df) and not is_small(df, 99) and not is_small(df, 100, 50_000)
    assert is_small(df.limit(0))


def test_broadcast_hint_follows_the_measure(spark):
    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(broadcast_if_small(spark.range(5))) and not hinted(broadcast_if_small(spark.range(50), 10))


def test_materialize_cuts_the_plan(spark):
    df = materialize(spark.range(10).groupBy((F.col("id") % 3).alias("g")).count(), "t")
    assert df.count() == 3 and "Aggregate" not in df._jdf.queryExecution().analyzed().toString()
