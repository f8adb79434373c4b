"""Point lookups read the row groups that may hold the key, and no others."""

import pytest
from pyspark.sql import functions as F

from kbvec.sources import clustered

ROWS, GROUPS = 40_000, 8


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Two tenants, one with three quarters of the rows; URLs of four rows each lie scattered over the ids."""
    rows = spark.range(ROWS).select(
        F.md5(F.col("id").cast("string")).alias("vector_id"), F.when(F.col("id") % 4 == 0, "small").otherwise("default").alias("bot_id"),
        F.concat(F.lit("https://u/"), (F.col("id") % (ROWS // 4)).cast("string")).alias("source_url"),
        F.repeat(F.sha2(F.col("id").cast("string"), 256), 4).alias("content"))
    path = str(tmp_path_factory.mktemp("clustered") / "t")
    clustered.write(rows, path, ranges=GROUPS, values=ROWS)
    return rows, clustered.read(spark, path, rows)


def scanned(df) -> int:
    """Rows that the scan has handed on."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    return plan.collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def same(found, want):
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))


def test_absent_ids_and_urls_read_no_rows(stored):
    _, table = stored
    # Within the range of the stored ids: the statistics cannot exclude it, the filter does.
    assert scanned(clustered.by_ids(table, ["7fffffff" * 4])) == 0
    assert scanned(clustered.by_url(table, "https://u/absent")) == 0
    # A column without a filter: an absent value within its range is looked for in every row group.
    assert scanned(table.filter(F.col("content") == "7fffffff" * 32)) > 0


def test_lookups_read_few_rows_and_equal_a_filter(stored):
    rows, table = stored
    ids = [r[0] for r in rows.filter("bot_id = 'default'").select("vector_id").orderBy("content").limit(2).collect()]
    asked = clustered.by_ids(table, [*ids, None, "absent", ids[0]])
    assert 0 < scanned(asked) <= ROWS // GROUPS * 2 * 1.5
    same(asked, rows.filter(F.col("vector_id").isin(ids)))
    url = "https://u/5"
    asked = clustered.by_url(table, url)
    assert 0 < scanned(asked) < ROWS * 3 // 4
    same(asked, rows.filter((F.col("source_url") == url) & (F.col("bot_id") == "default")))
    many = [r[0] for r in rows.filter("bot_id = 'small'").select("vector_id").limit(200).collect()]
    same(clustered.by_ids(table, many, "small"), rows.filter(F.col("vector_id").isin(many)))
    assert clustered.by_ids(table, many).count() == 0


def test_defined_cases(spark, tmp_path, stored):
    _, table = stored
    assert clustered.by_ids(table, []).count() == 0 and clustered.by_ids(table, [None]).count() == 0
    with pytest.raises(ValueError, match="at most"):
        clustered.by_ids(table, map(str, range(1000)))
    rows = spark.createDataFrame([("a", "default", "u", 1), ("a", "default", "u", 1), (None, "default", None, 2), ("b", None, "u", 3)],
                                 "vector_id string, bot_id string, source_url string, n int")
    for name, df in (("few", rows), ("none", rows.limit(0))):
        clustered.write(df, str(tmp_path / name))
        back = clustered.read(spark, str(tmp_path / name), df)
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
        assert clustered.by_ids(back, ["a", "b"]).count() == (2 if name == "few" else 0)
        assert clustered.by_url(back, "u").count() == (2 if name == "few" else 0)
        assert back.columns == df.columns
