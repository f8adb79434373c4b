"""Registered queries of the corpus operators, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kbvec.llm import (chat, contamination, jaccard, linededup, neighbours, pieces, quality, secrets, sharding, signatures,
                       spelling, tokencounts, toxicity)
from kbvec.llm.tables import table
from kbvec.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql.strip()
        return fn
    return add


@register("op1_ngram_jaccard_join", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct([array_to_string(words[i:i + 4], ' ') for i in range(1, len(words) - 3)]) END AS grams FROM w),
g AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s),
l AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM g a JOIN g b ON a.gram = b.gram
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, l.y FROM r JOIN l ON l.x = r.other)
SELECT s.doc_id, CAST(len(grams) AS BIGINT) AS n_shingles, m.component_id, e.class_id
FROM s JOIN (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id) m USING (doc_id)
JOIN (SELECT list_sort(grams) AS k, min(doc_id) AS class_id, list(doc_id) AS ids FROM s WHERE len(grams) > 0 GROUP BY k
      UNION ALL SELECT [], doc_id, [doc_id] FROM s WHERE len(grams) = 0) e ON list_contains(e.ids, s.doc_id)""")
def op1(spark, sf_dir):
    return jaccard.join(table(spark, sf_dir, "documents"))


@register("op3_sharding")
def op3(spark, sf_dir):
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), shards=40, version_path=scratch_path(spark, "slot-map"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "vslot")


#: The conversation that holds the template's own markers.
MARKED = r"\### Assistant: </turn> ok"


@register("op4_chat_formatting", r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
r AS (
  SELECT *, row_number() OVER w - 1 AS pos, lag(role) OVER w AS before,
    replace(replace(replace(replace(text, '\', '\b'), '<', '\l'), '#', '\h'), ':', '\c') AS escaped
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
j AS (
  SELECT *, NOT CASE WHEN pos = 0 THEN role IN ('system', 'user')
    WHEN before = 'user' THEN role = 'assistant' ELSE role = 'user' END AS refused FROM r)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(role) + length(escaped) + 14) AS BIGINT) AS formatted_chars,
  NOT bool_or(refused) AND arg_max(role, pos) = 'assistant' AS valid,
  CAST(min(pos) FILTER (refused) AS INTEGER) AS refused_at
FROM j GROUP BY conv_id""")
def op4(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    marked = spark.createDataFrame([(-7, 0, "user", MARKED), (-7, 1, "assistant", MARKED)], turns.schema)
    return chat.digest(chat.format_chats(turns.unionByName(marked)))


@register("op5_token_counts")
def op5(spark, sf_dir):
    return tokencounts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@register("op10_sentencepiece")
def op10(spark, sf_dir):
    return pieces.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@register("op6_secret_scans")
def op6(spark, sf_dir):
    return secrets.digest(table(spark, sf_dir, "documents"))


@register("op9_nearest_neighbours")
def op9(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


@register("op8_quality_classifier")
def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@register("op2_decontamination")
def op2(spark, sf_dir):
    return contamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op7_line_dedup", r"""
WITH w AS (
  SELECT doc_id, i - 1 AS line, list_filter(string_split_regex(string_split(text, chr(10))[i], '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS words
  FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents WHERE text IS NOT NULL)),
l AS (SELECT doc_id, line, words, len(words) AS n FROM w WHERE len(words) > 0),
v AS (
  SELECT doc_id, line, words, n, p, CASE WHEN p = 0 THEN words ELSE words[1:p - 1] || words[p + 1:n] END AS variant
  FROM (SELECT *, unnest(range(CASE WHEN n >= 5 THEN n + 1 ELSE 1 END)) AS p FROM l)),
near AS (
  SELECT a.doc_id, a.line, b.doc_id AS kept_doc_id, b.line AS kept_line, CASE WHEN a.words = b.words THEN 0 ELSE 1 END AS edits
  FROM v a JOIN v b ON a.variant = b.variant AND (b.doc_id < a.doc_id OR b.doc_id = a.doc_id AND b.line < a.line)
    AND (a.p = b.p OR a.p = 0 AND a.n >= 5 AND b.n >= 5 OR b.p = 0 AND a.n >= 5 AND b.n >= 5))
SELECT doc_id, CAST(line AS INTEGER) AS line, kept_doc_id, CAST(kept_line AS INTEGER) AS kept_line, edits FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY kept_doc_id, kept_line, edits) AS r FROM near) WHERE r = 1""")
def op7(spark, sf_dir):
    return linededup.repeats(table(spark, sf_dir, "documents"))


@register("op11_spelling_variants", r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: xor(c >> 1, 3988292384 * (c & 1)))) AS t),
r AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS w FROM documents),
d AS (SELECT id, w, count(*) AS n, hex(encode(id || ':' || w)) AS b FROM r WHERE length(w) >= 6 GROUP BY id, w),
h AS (
  SELECT w, n, xor(4294967295, list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(range(length(b) // 2),
    lambda i: CAST('0x' || b[2 * i + 1:2 * i + 2] AS BIGINT)),
    lambda c, x: xor(crc.t[(xor(c, x) & 255) + 1], c >> 8))) AS h FROM d, crc),
v AS (
  SELECT w AS word, CAST(sum(n) AS BIGINT) AS n, length(w) AS len FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN w[1:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS w FROM h)
  WHERE length(w) >= 6 GROUP BY w HAVING sum(n) >= 5),
x AS (
  SELECT word, n, p, word[1:p - 1] || word[p + 1:] AS cut FROM (SELECT *, unnest(range(1, len + 1)) AS p FROM v)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM x a JOIN x b ON a.cut = b.cut AND a.p = b.p AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM x a JOIN v b ON a.cut = b.word
  UNION SELECT b.word, a.word, a.n FROM x a JOIN v b ON a.cut = b.word),
c AS (
  SELECT v.word, any_value(v.n) AS n, count(other) AS n_near, max(near.n) AS most FROM v LEFT JOIN near USING (word) GROUP BY v.word),
f AS (
  SELECT c.word, c.n, c.n_near, CASE WHEN most >= 5 * c.n THEN most END AS form_n,
    CASE WHEN most >= 5 * c.n THEN (SELECT min(other) FROM near WHERE near.word = c.word AND near.n = c.most) END AS form FROM c),
walk(word, root) AS (SELECT word, word FROM f UNION SELECT walk.word, f.form FROM walk JOIN f ON f.word = walk.root WHERE f.form IS NOT NULL)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, walk.root
FROM f JOIN walk USING (word) JOIN f AS last ON last.word = walk.root AND last.form IS NULL""")
def op11(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))


@register("op13_ranked_search", r"""
WITH t AS (
  SELECT doc_id, row, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT *, row_number() OVER () AS row FROM documents)),
p AS (SELECT doc_id, row, term, count(*) AS tf FROM t GROUP BY ALL),
d AS (SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM p GROUP BY row),
s AS (SELECT count(*) AS n, CAST(sum(n) AS BIGINT) AS l FROM d),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(s.n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM p, s WHERE term IN (SELECT term FROM q) GROUP BY term),
r AS (
  SELECT q.item_id, p.row, p.doc_id,
    CAST(sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 20 * (100 - 50 + (50 * d.n * s.n) // s.l)))) AS BIGINT) AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN d USING (row), s GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM r WHERE score > 0)
WHERE rank <= 50""")
def op13(spark, sf_dir):
    return signatures.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


@register("op12_toxicity")
def op12(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
