"""Session helpers: configuration, shared scratch space, size-checked broadcast."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_CONF = "spark.checkpoint.dir"
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024


def build_session(app: str = "kbvec", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library is written for; ``conf`` overrides any of them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Ranks up to this bound are pruned inside each task before rows of a group meet.
        "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
        # Call-site capture costs several JVM round trips per expression built in Python.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **{k: str(v) for k, v in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Where neither the settings nor the context name one, a local folder is made if the master is local (tests, a
    laptop); on a cluster that is an error, as executors would not see each other's files.
    """
    context = spark.sparkContext
    base = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="kbvec-"))
        base = context.getCheckpointDir()
    return base.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below this application's part of the shared folder."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/kbvec/{spark.sparkContext.applicationId}"


def release_scratch(spark: SparkSession) -> None:
    """Delete what this application has put below the shared folder, once the results that read it are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage by writing ``df`` below the shared folder and reading it back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _width(field: T.StructField):
    """Approximate bytes of one value."""
    col = F.col(field.name)
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(col), F.lit(0)) + 16
    if isinstance(field.dataType, T.ArrayType):
        return F.coalesce(F.size(col), F.lit(0)) * 8 + 16
    return F.lit(8)


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when ``df`` stays within both bounds; reads no more than ``max_rows`` and one rows."""
    width = reduce(add, [_width(f) for f in df.schema.fields])
    seen = df.limit(max_rows + 1).agg(F.count("*"), F.sum(width)).first()
    return seen[0] <= max_rows and (seen[1] or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after measuring; beyond the bounds Spark shuffles both sides."""
    return F.broadcast(df) if is_small(df, max_rows) else df
