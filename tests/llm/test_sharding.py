import zlib

import pytest
from pyspark.sql import functions as F

from kbvec.llm import sharding


@pytest.fixture
def docs(spark):
    rows = [(i % 290, None if i % 50 == 0 else "é" * (i * 37 % 400)) for i in range(3000)] + [(None, "x"), (None, "x"), (7, "")]
    return spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, shard int").repartition(4)


def test_sizes_checksums_and_positions(spark, docs):
    got = sharding.shard_documents(docs, shards=6).collect()
    want = sorted((str(d), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, _ in docs.collect())
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == want
    load = {}
    for r in got:
        load.setdefault(r["shard"], []).append(r)
    assert sorted(load) == list(range(6))
    for rows in load.values():
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    sizes = [sum(r["size"] for r in rows) for rows in load.values()]
    assert max(sizes) / min(sizes) < 1.02


def test_versions_and_growth(spark, docs, tmp_path):
    path = str(tmp_path / "map")
    sharding.shard_documents(docs, shards=6, version_path=path)
    kept = spark.read.parquet(path)
    assert {r["version"]: r["count"] for r in kept.groupBy("version").count().collect()} == {
        1: sharding.SLOTS, 2: sharding.SLOTS}
    rows = sharding.records(docs)
    before = kept.filter("version = 2")
    # With all slots staying where they fit, one more shard takes slots only into itself.
    grown = sharding.rebalance(before, sharding.slot_bytes(rows), 7, keep_share=1.0)
    moved = before.alias("b").join(grown.alias("g"), "vslot").filter("b.shard <> g.shard")
    assert grown.agg(F.max("version")).first()[0] == 3
    assert moved.count() > 0 and moved.filter("g.shard = 6").count() > 0


def test_empty_table_and_plan(spark, docs):
    empty = sharding.shard_documents(docs.limit(0), shards=3)
    assert empty.collect() == []
    assert "Python" not in sharding.shard_documents(docs)._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        sharding.initial_map(spark, 0)


def test_a_stored_map_is_edited(spark, docs, tmp_path):
    """The next documents are placed by the newest version, of which most slots stay where they are."""
    path = str(tmp_path / "map")
    sharding.shard_documents(docs, shards=6, version_path=path)
    second = {r["vslot"]: r["shard"] for r in sharding.stored_map(spark, path).collect()}
    placed = sharding.shard_documents(docs.unionByName(docs.limit(300)), shards=7, version_path=path)
    newest = sharding.stored_map(spark, path)
    third = {r["vslot"]: r["shard"] for r in newest.collect()}
    assert newest.first()["version"] == 3 and spark.read.parquet(path).count() == 3 * sharding.SLOTS
    assert {r["shard"] for r in placed.collect()} == set(range(7))
    stayed = sum(second[v] == third[v] for v in second)
    assert stayed > 0.6 * sharding.SLOTS and all(third[v] == s for v, s in {r["vslot"]: r["shard"] for r in placed.collect()}.items())
    assert sharding.stored_map(spark, str(tmp_path / "none")) is None


def test_written_shards_hold_every_row_once(spark, docs, tmp_path):
    sharding.shard_documents(docs, shards=5, version_path=str(tmp_path / "map"))
    out = str(tmp_path / "out")
    sharding.write_shards(docs, sharding.stored_map(spark, str(tmp_path / "map")), out)
    got = spark.read.parquet(out)
    assert sorted(map(str, got.select("doc_id", "text").collect())) == sorted(map(str, docs.select("doc_id", "text").collect()))
    places = {}
    for r in got.collect():
        places.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(places) == list(range(5)) and all(sorted(v) == list(range(len(v))) for v in places.values())
