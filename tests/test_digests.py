"""Digest trees: differences, what is read, defined cases."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from kbvec.operators import digests

SMALL = (2, 4, 8)


def frame(spark, rows):
    return spark.createDataFrame([(f"v{i}", c, None if c is None else [1.0, float(len(c))]) for i, c in rows],
                                 "vector_id string, content string, embedding array<float>")


def stored(spark, path, rows):
    digests.write_copy(frame(spark, rows), str(path), levels=SMALL)
    return str(path)


def test_difference_equals_plain_comparison(spark, tmp_path):
    left = {i: f"text {i}" if i % 7 else None for i in range(600)}
    right = {**{i: c for i, c in left.items() if i not in (5, 77)}, 100: "changed", 7: "", 900: "new"}
    a, b = stored(spark, tmp_path / "a", left.items()), stored(spark, tmp_path / "b", right.items())
    got = sorted(tuple(r) for r in digests.tree_diff(spark, a, b, levels=SMALL).collect())
    assert got == [("v100", "changed"), ("v5", "missing"), ("v7", "changed"), ("v77", "missing"), ("v900", "extra")]
    leaves = digests.differing_leaves(spark, a, b, SMALL)
    ids = spark.createDataFrame([(f"v{i}",) for i in (100, 5, 7, 77, 900)], "vector_id string")
    assert {r[0] for r in leaves.collect()} == {r[0] for r in ids.select(digests.leaf_of(8)).collect()}
    assert digests.rows_of(spark, a, leaves, SMALL).count() < 60


def test_equal_copies_read_no_rows(spark, tmp_path):
    rows = [(i, f"text {i}") for i in range(300)]
    a, b = stored(spark, tmp_path / "a", rows), stored(spark, tmp_path / "b", rows[::-1])
    leaves = digests.differing_leaves(spark, a, b, SMALL)
    assert leaves.count() == 0 and digests.tree_diff(spark, a, b, levels=SMALL).collect() == []
    empty = stored(spark, tmp_path / "e", [])
    assert {r["change"] for r in digests.tree_diff(spark, a, empty, levels=SMALL).collect()} == {"missing"}
    assert digests.tree_diff(spark, empty, empty, levels=SMALL).collect() == []


def test_only_folders_that_differ_are_read(spark, tmp_path):
    rows = [(i, f"text {i}") for i in range(400)]
    a, b = stored(spark, tmp_path / "a", rows), stored(spark, tmp_path / "b", rows[:9] + [(9, "other")] + rows[10:])
    leaves = digests.differing_leaves(spark, a, b, SMALL)
    kept, out = digests.rows_of(spark, a, leaves, SMALL), io.StringIO()
    with redirect_stdout(out):
        kept.explain("formatted")
    assert "PartitionFilters: [" in out.getvalue() and "GreaterThanOrEqual(leaf," in out.getvalue()
    assert {f.split("top=")[1].split("/")[0] for f in spark.read.parquet(f"{a}/rows").filter(
        F.col("top").isin([r[0] >> 6 for r in leaves.collect()])).inputFiles()} >= {str(r[0] >> 6) for r in leaves.collect()}
    assert [tuple(r) for r in digests.tree_diff(spark, a, b, levels=SMALL).collect()] == [("v9", "changed")]


def test_parents_are_sums_of_their_children(spark, tmp_path):
    a = stored(spark, tmp_path / "a", [(i, f"text {i}") for i in range(500)])
    levels = [spark.read.parquet(f"{a}/digests/level={d}") for d in range(3)]
    total = [tuple(x.agg(*[F.sum(c) for c in ("rows", "w0", "w1", "w2", "w3")]).first()) for x in levels]
    assert total[0] == total[1] == total[2] and total[0][0] == 500
    assert [x.count() <= 2 ** b for x, b in zip(levels, SMALL)] == [True] * 3
