"""A corpus pipeline of five stages over ``documents``; each works on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a frame, which ``run`` writes as Parquet below the shared folder
and reads again for the next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from kbvec.llm import contamination, jaccard, linededup, pieces, quality
from kbvec.llm.tables import table
from kbvec.session import is_small, materialize


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier rejects. It is fitted on labelled rows of the documents given."""
    return quality.kept(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines that repeat an earlier one; n_chars follows the text where there is one."""
    left = linededup.apply(docs)
    return left.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars")).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group of near duplicates."""
    found = jaccard.join(docs)
    gone = materialize(found.filter("doc_id <> component_id").select("doc_id").distinct(), "copies")
    return docs.join(F.broadcast(gone) if is_small(gone, 1_000_000) else gone, "doc_id", "left_anti").select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold questions of the benchmark."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their sampled pieces."""
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("quality", keep_quality), ("line_dedup", drop_repeated_lines), ("ngram_jaccard", keep_one_of_each_group),
          ("decontamination", drop_benchmark_leaks), ("sentencepiece", encode_pieces)]

#: SQL expresses neither the fitted classifier nor the sampling; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs


QUERIES = {"pipeline": run}
SQL = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
