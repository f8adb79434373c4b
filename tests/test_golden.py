"""Known inputs with known results."""

import datetime as dt

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from kbvec.functions.ids import vector_id, without_chunk_suffix
from kbvec.functions.text import chunk_header, parse_serialized_vector, strip_markup, words
from kbvec.functions.vectors import dequantize_int8, quantize_int8, roundtrip_cosine
from kbvec.operators import hybrid, ingest, lookup, metrics, mutate, replicate
from kbvec.operators.filters import compile_filter
from kbvec.operators.search import dedup_sources, scored, search, to_matches
from kbvec.schema import conform
from kbvec.sources import tables


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def vec(values):
    return F.array(*[F.lit(float(v)) for v in values])


@pytest.mark.parametrize("given, want", [
    ([0, 0, 0], [0, 0, 0]), ([1.0], [127]), ([-1.0], [-127]), ([1.5, 2, 10], [127] * 3),
    ([-1.5, -2, -100], [-128] * 3), ([0.5 / 127, -0.5 / 127], [1, -1])])
def test_quantize(spark, given, want):
    assert one(spark, quantize_int8(vec(given))) == want


def test_dequantize(spark):
    assert one(spark, dequantize_int8(F.array(F.lit(127), F.lit(-127), F.lit(0)))) == [1.0, -1.0, 0.0]
    assert one(spark, roundtrip_cosine(vec([0.6, -0.8, 0.01]))) > 0.99


def test_normalize(spark):
    rows = spark.createDataFrame([(1, "a", 10.0), (1, "b", 5.0), (1, "c", 0.0), (2, "d", 4.2), (2, "e", 4.2)],
                                 "query_id int, vector_id string, score double")
    got = {r["vector_id"]: r["score"] for r in hybrid.normalize(rows).collect()}
    assert got == {"a": 1.0, "b": 0.5, "c": 0.0, "d": 1.0, "e": 1.0}
    assert hybrid.normalize(rows.limit(0)).count() == 0


def matches(spark, *rows):
    return spark.createDataFrame(list(rows), "vector_id string, score double, source_url string")


def test_dedup_keeps_best_per_source_and_every_row_without_one(spark):
    rows = matches(spark, ("1", 0.9, "a"), ("2", 0.8, "a"), ("3", 0.7, "b"), ("4", 0.6, ""), ("5", 0.5, ""))
    assert [r["vector_id"] for r in dedup_sources(rows, 10).collect()] == ["1", "3", "4", "5"]
    assert [r["vector_id"] for r in dedup_sources(rows, 2).collect()] == ["1", "3"]


HEADER = '{"document_type":"chunked","chunk_index":2,"total_chunks":5,"source_url":"u"}\n---\nbody\n---\nmore'


@pytest.mark.parametrize("text, want", [
    (HEADER, (True, 2, 5, "body\n---\nmore")),
    ('{"document_type":"chunked"}\n---\nx', (True, 0, 1, "x")),
    ('{"document_type":"chunked","chunk_index":"7","total_chunks":"n"}\n---\nx', (True, 7, 0, "x")),
    ('{"document_type":"other"}\n---\nx', (False, None, None, '{"document_type":"other"}\n---\nx')),
    ('{"document_type" broken\n---\nx', (False, None, None, '{"document_type" broken\n---\nx')),
    ('{"document_type":"chunked"} x', (False, None, None, '{"document_type":"chunked"} x')),
    ("plain", (False, None, None, "plain")), (None, (False, None, None, ""))])
def test_chunk_header(spark, text, want):
    parts = chunk_header(F.lit(text).cast("string"))
    got = spark.range(1).select(*[c.alias(n) for n, c in parts.items()]).first()
    assert (got["is_chunked"], got["chunk_index"], got["total_chunks"], got["body"]) == want


def test_vector_ids(spark):
    url = F.lit("https://e.x/a")
    md5 = one(spark, F.md5(url))
    assert one(spark, vector_id(F.lit(3), url, F.lit(True), F.lit(2))) == f"{md5}_chunk_2"
    assert one(spark, vector_id(F.lit(3), url, F.lit(True), F.lit(None).cast("int"))) == f"{md5}_chunk_0"
    assert one(spark, vector_id(F.lit(3), url)) == md5
    assert one(spark, vector_id(F.lit(3), F.lit(""), prefix="row_")) == "row_3"
    assert one(spark, without_chunk_suffix(F.lit(f"{md5}_chunk_12"))) == md5


def test_serialized_vector(spark):
    assert one(spark, parse_serialized_vector(F.lit("a:2:{i:0;d:0.5;i:1;d:-1.5E-2;}"))) == [0.5, -0.015]
    assert one(spark, parse_serialized_vector(F.lit('s:3:"abc";'))) is None
    assert one(spark, parse_serialized_vector(F.lit(""))) is None
    # A number that is none, one that is missing, one too many for a double: no vector, and no failure.
    for text in ("a:1:{i:0;d:1-2;}", "a:2:{i:0;d:1.0;}", "a:1:{i:0;d:1e999;}", "a:1:{i:0;d:;}", "a:1:{i:0;d:NAN;}"):
        assert one(spark, parse_serialized_vector(F.lit(text))) is None


@pytest.mark.parametrize("html, want", [
    ("<p>a</p>\n <b>b</b>", "a b"), ("<script>var x='</p>'</script>t<style>p{}</style>", "t"),
    ('<a title="x>y">z</a>', "z"), ("a < b", "a < b"), ("a<!-- <b> -->c", "ac"), ("a<b unclosed", "a")])
def test_strip_markup(spark, html, want):
    assert one(spark, strip_markup(F.lit(html))) == want


def test_strip_markup_long_tag(spark):
    assert one(spark, F.length(strip_markup(F.lit("<a b='" + "x y" * 200_000 + "'>ok")))) == 2


def test_words(spark):
    assert one(spark, words(F.lit("Étude-42, naïve; x"))) == ["étude", "42", "naïve", "x"]


def kb(spark, *rows):
    return spark.createDataFrame(list(rows), "id long, source_url string, article_content string, "
                                 "embedding_vector string, role_restriction string, content_type string, "
                                 "timestamp timestamp_ntz")


GOOD = "a:3:{i:0;d:0.1;i:1;d:0.2;i:2;d:0.3;}"


def test_load_skips_rows_without_a_vector(spark):
    now = dt.datetime(2024, 1, 1)
    rows = kb(spark, (1, "u", "t", GOOD, None, None, now), (2, "v", "t", "", None, None, now),
              (3, "w", "t", "b:0;", None, None, now))
    loaded = ingest.load_kb(rows, 3).collect()
    assert [(r["bot_id"], r["role_restriction"], r["content_type"]) for r in loaded] == [("default", "public", "content")]
    report = ingest.skip_report(ingest.kb_to_vectors(rows)).first()
    assert (report["scanned"], report["upserted"], report["skipped"], report["flagged"]) == (3, 1, 2, True)
    assert ingest.skip_report(ingest.kb_to_vectors(rows.limit(0))).first()["flagged"] is False


def test_wrong_dimension_stops_the_load(spark):
    rows = kb(spark, (1, "u", "t", GOOD, None, None, None))
    with pytest.raises(SparkRuntimeException, match="bad embedding"):
        ingest.load_kb(rows, 4).collect()
    good, bad = ingest.validate(ingest.kb_to_vectors(rows), 4, mode="quarantine")
    assert (good.count(), bad.count()) == (0, 1)


def test_incremental_cutoff(spark):
    last = dt.datetime.fromtimestamp(1700000000, dt.UTC).replace(tzinfo=None)
    edge = dt.datetime.fromtimestamp(1699999880, dt.UTC).replace(tzinfo=None)
    rows = kb(spark, (1, "u", "t", GOOD, None, None, edge),
              (2, "v", "t", GOOD, None, None, edge - dt.timedelta(seconds=1)))
    assert [r["id"] for r in ingest.changed_since(rows, last).collect()] == [1]


def records(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, values array<double>, metadata map<string,string>")


def test_metadata_aliases(spark):
    rows = records(spark,
                   ("a", [1.0], {"text": "t", "source": "s", "part_index": "2", "part_total": "9", "is_chunked": "1"}),
                   ("b", [1.0], {"source_url": "s1", "source": "s2", "chunk_index": "0", "part_index": "5"}),
                   ("c", [1.0], None))
    got = {r["vector_id"]: r for r in ingest.map_metadata(rows, ingest.REQUEST_ALIASES, "ns").collect()}
    assert (got["a"]["source_url"], got["a"]["chunk_index"], got["a"]["total_chunks"], got["a"]["is_chunked"]) == ("s", 2, 9, True)
    assert (got["b"]["source_url"], got["b"]["chunk_index"], got["b"]["total_chunks"]) == ("s1", 0, None)
    assert (got["c"]["content"], got["c"]["role_restriction"], got["c"]["content_type"], got["c"]["bot_id"]) == ("", "public", "content", "ns")


def test_export_records_without_values_fail(spark):
    rows, summary = tables.load_export(records(
        spark, ("a", [1.0], {"content": "t", "url": "u", "content_type": "post"}), ("b", [], {}), ("c", None, None)))
    assert [(r["content"], r["source_url"], r["content_type"]) for r in rows.collect()] == [("t", "u", "post")]
    assert (summary.first()["copied"], summary.first()["failed"]) == (1, 2)


def test_posts(spark):
    posts = spark.createDataFrame(
        [(1, " T ", "<p>x</p>", "post", "publish", "u1"), (2, "", " <p> </p> ", "page", "publish", "u2"),
         (3, "", "y", "FAQ Entry!", "publish", None), (4, "", "y", "!!", "publish", "u4")],
        "ID long, post_title string, post_content string, post_type string, post_status string, permalink string")
    loaded = ingest.load_posts(posts)
    got = {r["post_id"]: r for r in loaded.collect()}
    assert got[1]["content"] == "T\n\nx"
    assert [got[i]["failed"] for i in (1, 2, 3, 4)] == [False, True, True, False]
    assert [got[i]["content_type"] for i in (1, 2, 3, 4)] == ["post", "page", "faqentry", "content"]
    assert tuple(ingest.posts_summary(loaded).first()) == (2, 2, 4)


def test_filter_compiler(spark, vectors):
    def ids(spec):
        predicate, _ = compile_filter(spec)
        return sorted(r["vector_id"] for r in vectors.filter(predicate).collect())
    assert ids({"type": {"$eq": "page"}}) == ["b"]
    assert ids({"type": {"$ne": "post"}, "source_url": {"$eq": ""}}) == ["c", "d"]
    assert ids({"chunk_index": {"$gte": 0, "$lt": 1}}) == ["a1"]
    assert ids({"chunk_index": {"$gt": 0, "$lte": 1}}) == ["a2"]
    assert ids({"role_restriction": {"$in": ["subscriber"]}}) == ["b"]
    assert ids({"chunk_index": {"$nin": [0]}}) == ["a2"]  # a null never passes
    predicate, ignored = compile_filter({"nope": {"$eq": 1}, "type": {"$like": "x", "$in": []}, "source_url": "u"})
    assert predicate is None
    assert ignored == ["field:nope", "operator:type.$like", "empty:type.$in", "field:source_url"]


def test_search(vectors):
    got = search(vectors, [1.0, 0.0, 0.0], k=3, dim=3, dedup=True).collect()
    assert [r["vector_id"] for r in got] == ["a1", "b", "c"]
    assert [r["vector_id"] for r in search(vectors, [1.0, 0.0, 0.0], k=9).collect()] == ["a1", "a2", "b", "c", "d"]
    assert [r["vector_id"] for r in search(vectors, [1.0, 0.0, 0.0], k=9, tenant="other").collect()] == ["x"]
    nearest = search(vectors, [0.0, 0.0, 0.0], k=1, metric="l2sq").first()
    assert (nearest["vector_id"], nearest["score"]) == ("z", 0.0)
    with pytest.raises(ValueError, match="expected 3, got 2"):
        scored(vectors, [1.0, 0.0], dim=3)


def test_match_defaults(spark):
    bare = spark.createDataFrame([("i", None, None, None, None, None, None, None)],
                                 "vector_id string, content string, source_url string, role_restriction string, "
                                 "content_type string, chunk_index int, total_chunks int, is_chunked boolean")
    got = to_matches(bare).first()
    assert got["id"] == "i" and "score" not in got
    assert tuple(got["metadata"]) == ("", "", "public", "content", None, None, False)


def test_conform(spark):
    old = spark.createDataFrame([("i", [0.5, 1.0])], "vector_id string, embedding array<double>")
    new = conform(old)
    row = new.first()
    assert (row["bot_id"], row["content"], row["is_chunked"], row["chunk_index"]) == ("default", "", False, None)
    assert conform(new).schema == new.schema
    assert conform(old, "int8").first()["embedding"] == [64, 127]
    with pytest.raises(TypeError, match="chunk_index"):
        conform(old.withColumn("chunk_index", F.array(F.lit(1))))
    with pytest.raises(ValueError):
        conform(old.drop("vector_id"))


def test_upsert_last_wins_and_is_idempotent(spark, vectors):
    rows = spark.createDataFrame([("b", [1.0, 1.0, 1.0], "old", 1), ("b", [1.0, 1.0, 1.0], "new", 2),
                                  ("n", [0.0, 0.0, 1.0], "n", 1), ("", [1.0, 0.0, 0.0], "no id", 1),
                                  ("m", None, "no vector", 1)],
                                 "vector_id string, embedding array<double>, content string, seq int")
    now = F.expr("timestamp_ntz'2024-01-02 00:00:00'")
    once = mutate.upsert(vectors, rows, "seq", now=now)
    got = {r["vector_id"]: r["content"] for r in once.collect()}
    assert got["b"] == "new" and got["n"] == "n" and len(got) == 8
    assert sorted(map(str, mutate.upsert(once, rows, "seq", now=now).collect())) == sorted(map(str, once.collect()))


def test_deletes(spark, vectors):
    ids = spark.createDataFrame([("a1",), ("x",), ("absent",)], "vector_id string")
    assert {r["vector_id"] for r in mutate.delete_by_ids(vectors, ids).collect()} == {"a2", "b", "c", "d", "z", "x"}
    assert {r["vector_id"] for r in mutate.delete_by_url(vectors, "u/a").collect()} == {"b", "c", "d", "z", "x"}


def test_bulk_delete_routes_entries(spark, vectors):
    entries = spark.createDataFrame(
        [("a1", "pinecone", "u/a", "true"), ("b", "pinecone", "u/b", "false"), ("c", "wordpress", "", "false"),
         ("d", "pinecone", "", "true"), ("", "pinecone", "", "false"), ("b", "pinecone", None, None)],
        "id string, source string, sourceUrl string, isGroup string")
    ids, urls = mutate.split_entries(entries)
    assert sorted(r[0] for r in ids.collect()) == ["b", "d"] and [r[0] for r in urls.collect()] == ["u/a"]
    assert {r["vector_id"] for r in mutate.bulk_delete(vectors, entries).collect()} == {"c", "z", "x"}


def test_compaction(spark):
    alive = spark.createDataFrame([(1, "u/1"), (2, "")], "id long, source_url string")
    md5 = alive.select(F.md5(F.lit("u/1"))).first()[0]
    rows = spark.createDataFrame([(md5,), (f"{md5}_chunk_3",), ("kb_2",), ("gone",), ("kb_9",)], "vector_id string")
    assert {r[0] for r in mutate.compact(rows, alive).collect()} == {md5, f"{md5}_chunk_3", "kb_2"}
    strict = mutate.compact(rows, alive, strict_ids=True)
    assert {r[0] for r in strict.collect()} == {md5, "kb_2"}
    many = spark.range(5200).select(F.format_string("o%04d", "id").alias("vector_id"))
    left = sorted(r[0] for r in mutate.compact(many, alive, 100).collect())
    assert len(left) == 5100 and left[0] == "o0100"
    assert mutate.compact(many, alive).count() == 0
    now = dt.datetime(2024, 1, 1, 12)
    assert not mutate.may_compact(now - dt.timedelta(seconds=3599), now)
    assert mutate.may_compact(now - dt.timedelta(seconds=3600), now) and mutate.may_compact(None, now)


def test_list_prefix_is_literal(spark):
    rows = spark.createDataFrame([(r"50%off_\path1",), (r"50xoffy\path2",)], "vector_id string").selectExpr(
        "vector_id", "'default' bot_id", "timestamp_ntz'2024-01-01 00:00:00' created_at")
    assert [r[0] for r in lookup.list_ids(rows, prefix=r"50%off_\path").collect()] == [r"50%off_\path1"]
    many = spark.range(1500).selectExpr("format_string('v%04d', id) vector_id", "'default' bot_id",
                                        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id div 2 AS int)) created_at")
    whole = [r[0] for r in lookup.list_ids(many, limit=None).collect()]
    assert len(whole) == 1500 and len(lookup.list_ids(many, limit=1200).collect()) == 1200
    last = many.filter(F.col("vector_id") == whole[99]).first()
    paged = lookup.list_ids(many, limit=50, after=(last["created_at"], last["vector_id"])).collect()
    assert [r[0] for r in paged] == whole[100:150]


def test_reassembly_of_long_sources(spark):
    """Several thousand chunks, with indices that repeat and are missing: one text, in order."""
    rows = spark.range(5000).selectExpr(
        "'default' bot_id", "'u' source_url", "true is_chunked", "IF(id % 50 = 0, null, cast(id div 2 AS int)) chunk_index",
        "format_string('u_chunk_%05d', id) vector_id", "cast(id AS string) content")
    got = lookup.reassemble(rows.repartition(7), "|").collect()
    want = [i for i in range(5000) if i % 50 == 0] + [i for i in range(5000) if i % 50]
    assert len(got) == 1 and got[0]["chunks"] == 5000 and [int(x) for x in got[0]["text"].split("|")] == want
    parts = {r["part"]: r["text"] for r in lookup.reassemble(rows, "|", part_chunks=2000).collect()}
    assert [int(x) for p in sorted(parts) for x in parts[p].split("|")] == want and len(parts) == 3


def test_reassembly_in_parts(spark):
    rows = spark.range(7).selectExpr("'default' bot_id", "'u' source_url", "true is_chunked", "cast(id as int) chunk_index",
                                     "concat('u_chunk_', id) vector_id", "cast(id as string) content")
    got = {r["part"]: r["text"] for r in lookup.reassemble(rows, "|", part_chunks=3).collect()}
    assert got == {0: "0|1|2", 1: "3|4|5", 2: "6"}
    piled = lookup.reassemble(rows.withColumn("chunk_index", F.lit(None).cast("int")), "|", part_chunks=3)
    assert {r["part"]: r["text"] for r in piled.collect()} == got


def test_storage_estimate(spark):
    rows = spark.range(1000)
    assert lookup.storage_estimate(rows, 1536).first()["bytes_estimate"] == 6_344_000
    assert lookup.storage_estimate(rows, 1536, "int8").first()["bytes_estimate"] == 1_736_000
    assert lookup.table_info(spark, "/tmp/kbvec-no-such-table") is None


def log(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                                 "event_id long, ts timestamp_ntz, namespace string, op string, latency_ms long")


def test_latency_snapshot(spark):
    now = dt.datetime(2024, 1, 1, 12)
    fresh = [(now - dt.timedelta(minutes=i), "n", "searches", 10 * i) for i in range(1, 11)]
    stale = [(now - dt.timedelta(seconds=3601), "n", "searches", 9999)]
    stamp = F.lit(now).cast("timestamp_ntz")
    got = metrics.latency_snapshot(log(spark, *fresh, *stale), stamp).first()
    assert tuple(got) == (60, 100, 100, 10)
    negative = metrics.latency_snapshot(log(spark, (now, "n", "searches", -5)), stamp).first()
    assert tuple(negative) == (0, 0, 0, 1)
    assert tuple(metrics.latency_snapshot(log(spark, *fresh).limit(0), stamp).first()) == (0, 0, 0, 0)
    many = [(now - dt.timedelta(seconds=i), "n", "searches", i) for i in range(700)]
    assert tuple(metrics.latency_snapshot(log(spark, *many), stamp).first()) == (350, 665, 693, 700)
    assert tuple(metrics.latency_snapshot(log(spark, *many), stamp, newest=500).first()) == (250, 475, 495, 500)


def test_hit_rate_and_counters(spark):
    now = dt.datetime(2024, 1, 1)
    rows = log(spark, (now, "n", "searches", 1), (now, "n", "query_cache_hit", 1))
    assert tuple(metrics.cache_hit_rate(rows).first()) == (1, 1, 0.5)
    assert metrics.cache_hit_rate(rows.filter("op <> 'searches'")).first()["cache_hit_rate"] == 0.0
    assert metrics.slow_queries(rows, 0).count() == 0 and metrics.slow_queries(rows, 1).count() == 1


def test_quota(spark):
    start = dt.datetime(2024, 1, 1)
    rows = log(spark, *[(start + dt.timedelta(seconds=i), "a", "searches", 1) for i in range(5)], (start, "b", "searches", 1))
    report = {r["namespace"]: tuple(r)[2:] for r in metrics.quota_report(rows, 3).collect()}
    assert report == {"a": (5, 3, 2), "b": (1, 1, 0)}
    assert sorted(r["event_id"] for r in metrics.flag_over_quota(rows, 3).filter("over").collect()) == [3, 4]
    assert metrics.quota_report(rows, 0).agg(F.sum("refused")).first()[0] == 0
    own = spark.createDataFrame([("a", 0)], "namespace string, max int")
    assert metrics.quota_report(rows, 3, own).agg(F.sum("refused")).first()[0] == 0


def queue(spark, *rows):
    return spark.createDataFrame(list(rows), "seq long, queued_at long, payload string, retries int, ok boolean")


def test_drain(spark):
    rows = queue(spark, (1, 1, "p", 0, True), (2, 2, "p", 9, False), (3, 3, "p", 3, False), (4, 4, "", 0, True), (5, 5, "p", 0, True))
    out = replicate.drain_step(rows, F.col("ok"), cap=4)
    got = {r["seq"]: (r["state"], r["retries"]) for r in out.collect()}
    assert got == {1: ("done", 0), 2: ("quarantine", 10), 3: ("retry", 4), 4: ("dropped", 0), 5: ("waiting", 0)}
    assert tuple(replicate.drain_totals(out).first()) == (1, 1, 1, 2)


def test_queue_bound(spark):
    held = queue(spark, (1, 1, "p", 3, True))
    new = queue(spark, (2, 2, "q", 7, True), (3, 3, "r", 0, True))
    kept, full = replicate.enqueue(held, new, max_queue=2)
    assert sorted((r["seq"], r["retries"]) for r in kept.collect()) == [(1, 3), (2, 0)]
    assert [r["seq"] for r in full.collect()] == [3]
    kept, full = replicate.enqueue(held, new)
    assert sorted(r["seq"] for r in kept.collect()) == [1, 2, 3] and full.count() == 0
    long_queue = spark.range(6000).selectExpr("id AS seq", "id AS queued_at", "'p' AS payload", "0 AS retries", "true AS ok")
    assert replicate.drain_step(long_queue, F.col("ok")).filter("state = 'done'").count() == 6000
    assert replicate.copy_batch(long_queue.selectExpr("format_string('%05d', seq) AS vector_id"), size=5500).count() == 5500


def ids(spark, **tenants):
    return spark.createDataFrame([(b, i) for b, held in tenants.items() for i in held] or [],
                                 "bot_id string, vector_id string")


def test_drift(spark):
    full, same = ids(spark, a="pqr", b="xy"), ids(spark, b="yx", a="rqp")
    sign = replicate.tenant_signature
    assert replicate.compare_signatures(sign(full), sign(same)).count() == 0
    gap = ids(spark, a="pq", c="k")
    got = [tuple(r) for r in replicate.compare_signatures(sign(full), sign(gap)).collect()]
    assert got == [("a", 3, 2), ("b", 2, 0), ("c", 0, 1)]
    swapped = replicate.compare_signatures(sign(full), sign(ids(spark, a="pqz", b="xy")))
    assert [tuple(r) for r in swapped.collect()] == [("a", 3, 3)]
    assert tuple(replicate.drift_status(swapped, 1, "active").first()) == (1, True, "active")
    assert tuple(replicate.drift_status(swapped, 0, "active").first()) == (1, False, "drifted")
    assert replicate.drift_status(swapped.limit(0), 0, "drifted").first()["status"] == "active"
    assert replicate.drift_status(swapped.limit(0), 0, "error").first()["status"] == "error"
    big = spark.createDataFrame([("a", 100, 49)], "bot_id string, primary_rows long, replica_rows long")
    assert replicate.drift_status(big, 5).first()["drainable"] is False


def test_signature_of_large_tenants(spark):
    many = spark.range(120_000).select(F.lit("a").alias("bot_id"), F.col("id").cast("string").alias("vector_id"))
    one_gone = many.filter("vector_id <> '77777'").union(many.limit(1).select("bot_id", F.lit("other").alias("vector_id")))
    sign = replicate.tenant_signature
    assert replicate.compare_signatures(sign(many), sign(many.repartition(3))).count() == 0
    assert replicate.compare_signatures(sign(many), sign(one_gone)).count() == 1


def test_last_row_without_a_sequence_is_the_same_in_any_order(spark):
    rows = spark.createDataFrame([("a", "x", [1.0]), ("a", "y", [2.0]), ("a", None, [3.0]), ("b", "z", [1.0])],
                                 "vector_id string, content string, embedding array<double>")
    for n in (1, 3):
        got = {r["vector_id"]: r["content"] for r in mutate.last_per_id(rows.repartition(n)).collect()}
        assert got == {"a": "y", "b": "z"}


def test_copies(spark, vectors):
    first = replicate.copy_batch(vectors, "", 3)
    state = replicate.copy_state(first, 0, 7).first()
    assert tuple(state) == ("b", 3, 3, 7, False)
    rest = replicate.copy_batch(vectors, "b", 10)
    assert tuple(replicate.copy_state(rest, 3, 7, "b").first()) == ("z", 4, 7, 7, True)
    assert replicate.copy_state(rest.limit(0), 0, 0).first()["done"] is True
    once = replicate.copy_missing(vectors, first)
    assert once.count() == 7 and replicate.missing_rows(vectors, once).count() == 0


def test_change_log_replay(spark, vectors):
    log_rows = spark.createDataFrame(
        [(1, "b", "delete", None, None), (2, "b", "upsert", [1.0, 0.0, 0.0], "again"), (3, "a1", "upsert", [1.0, 0.0, 0.0], "x"),
         (4, "a1", "delete", None, None)], "seq long, vector_id string, op string, embedding array<double>, content string")
    now = F.expr("timestamp_ntz'2024-01-02 00:00:00'")
    once = replicate.apply_change_log(vectors, log_rows, now=now)
    got = {r["vector_id"]: r["content"] for r in once.collect()}
    assert "a1" not in got and got["b"] == "again"
    twice = replicate.apply_change_log(once, log_rows, now=now)
    assert sorted(map(str, twice.collect())) == sorted(map(str, once.collect()))


def test_row_diff_tells_nulls_apart(spark):
    schema = "vector_id string, a string, b string"
    left = spark.createDataFrame([("1", None, "x"), ("2", "s", "t"), ("3", "s", "t")], schema)
    right = spark.createDataFrame([("1", "x", None), ("2", "s", "t"), ("4", "s", "t")], schema)
    assert {tuple(r) for r in replicate.row_diff(left, right).collect()} == {("1", "changed"), ("3", "missing"), ("4", "extra")}


def test_jdbc_options():
    got = tables.jdbc_options("jdbc:mysql://h/db", "kb", 1, 100, 4, user="u")
    assert (got["partitionColumn"], got["numPartitions"], got["user"]) == ("id", "4", "u")
    with pytest.raises(ValueError):
        tables.jdbc_options("u", "t", 5, 1, 1)
