"""A digest tree over a vector table: two copies are compared from the top, and only parts that differ are read.

Ids are hashed; the first bits of the hash are a row's leaf, and fewer of them its place on each level above. A node's
digest is the number of its rows and the sums of the 32-bit words of two row hashes, so a parent's digest is the sum of
its children's, a table's is made in one pass, and no order of rows is needed. A copy is stored with its digests, and
its rows by leaf: what a comparison does not need is skipped by folder and by the files' statistics.

Rows that differ have equal digests by chance once in 2**128 pairs of leaves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kbvec.operators.replicate import row_diff
from kbvec.session import broadcast_if_small, materialize

#: Bits of the id's hash on each level; the first is also that of the folders, the last that of the leaves.
LEVELS = (6, 10, 14)
_WORDS = ("w0", "w1", "w2", "w3")
_NODE = "node long, rows long, w0 long, w1 long, w2 long, w3 long"


def leaf_of(bits: int) -> Column:
    """The first ``bits`` bits of the hash of the id."""
    return F.shiftrightunsigned(F.xxhash64("vector_id"), 64 - bits)


def _row_words(columns: list[str]) -> list[Column]:
    # A null flag for each column keeps (null, x) and (x, null) apart.
    cols = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    hashes = [F.xxhash64("vector_id", *cols), F.xxhash64(F.lit(1), "vector_id", *cols)]
    low = F.lit((1 << 32) - 1)
    return [word for h in hashes for word in (h.bitwiseAND(low), F.shiftrightunsigned(h, 32))]


def leaf_digests(rows: DataFrame, columns: list[str] | None = None, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """leaf, rows and w0 to w3, of the leaves that hold any; tasks send one partial sum for each leaf."""
    columns = sorted(columns or [c for c in rows.columns if c != "vector_id"])
    worded = rows.select(leaf_of(levels[-1]).alias("leaf"), *[w.alias(n) for n, w in zip(_WORDS, _row_words(columns))])
    return worded.groupBy("leaf").agg(F.count("*").alias("rows"), *[F.sum(n).alias(n) for n in _WORDS])


def write_copy(rows: DataFrame, path: str, columns: list[str] | None = None, levels: tuple[int, ...] = LEVELS) -> None:
    """Store rows by leaf below ``path``/rows, and the digests of all levels below ``path``/digests.

    ``columns`` are those compared (default: all but the id).
    """
    top = F.shiftright("leaf", levels[-1] - levels[0])
    (rows.withColumn("leaf", leaf_of(levels[-1])).withColumn("top", top)
     .hint("rebalance", "top").sortWithinPartitions("top", "leaf").write.option("compression", "zstd")
     .partitionBy("top").parquet(f"{path}/rows"))
    # A copy without rows has no files to tell its columns.
    rows.limit(0).write.parquet(f"{path}/columns")
    leaves = materialize(leaf_digests(rows, columns, levels), "leaves")
    for depth, bits in enumerate(levels):
        node = F.shiftright("leaf", levels[-1] - bits).alias("node")
        (leaves.groupBy(node).agg(*[F.sum(c).alias(c) for c in ("rows", *_WORDS)])
         .repartition(1 if depth + 1 < len(levels) else 8, "node").sortWithinPartitions("node").write.parquet(f"{path}/digests/level={depth}"))


def differing_leaves(spark: SparkSession, left: str, right: str, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """leaf of every leaf that differs; on each level only the children of nodes that differ are looked at."""
    found = None
    for depth, bits in enumerate(levels):
        sides = [spark.read.schema(_NODE).parquet(f"{path}/digests/level={depth}") for path in (left, right)]
        if found is not None:
            above = broadcast_if_small(found.withColumnRenamed("node", "_up"))
            step = bits - levels[depth - 1]
            sides = [s.join(above, F.shiftright("node", step) == F.col("_up"), "left_semi") for s in sides]
        a, b = (s.select("node", F.struct("rows", *_WORDS).alias(name)) for s, name in zip(sides, ("_a", "_b")))
        found = materialize(a.join(b, "node", "full_outer").filter(~F.col("_a").eqNullSafe(F.col("_b"))).select("node"), "differing")
    return found.withColumnRenamed("node", "leaf")


def rows_of(spark: SparkSession, path: str, leaves: DataFrame, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """The rows of a stored copy that are in ``leaves``; other folders are not listed, and other leaves skipped where
    files or their parts hold none."""
    top = F.shiftright("leaf", levels[-1] - levels[0])
    # At most 2 ** levels[0] folders.
    folders = sorted(r[0] for r in leaves.select(top.alias("top")).distinct().collect())
    schema = spark.read.parquet(f"{path}/columns").schema.add("leaf", "long").add("top", "long")
    rows = spark.read.schema(schema).parquet(f"{path}/rows")
    kept = rows.filter(F.col("top").isin(folders)) if folders else rows.limit(0)
    low, high = leaves.agg(F.min("leaf"), F.max("leaf")).first()
    if low is not None:
        kept = kept.filter(F.col("leaf").between(low, high))
    return kept.join(broadcast_if_small(leaves), "leaf", "left_semi").drop("leaf", "top")


def tree_diff(spark: SparkSession, left: str, right: str, columns: list[str] | None = None, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """``vector_id, change`` as by ``row_diff``, between two stored copies."""
    leaves = differing_leaves(spark, left, right, levels)
    sides = [rows_of(spark, path, leaves, levels) for path in (left, right)]
    return row_diff(*(s.select("vector_id", *columns) if columns else s for s in sides))
