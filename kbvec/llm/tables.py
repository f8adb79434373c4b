"""The given corpus tables, with known schemas so that no job is spent on inferring them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


#: Rows of an Arrow batch of texts, at most: some megabytes of ordinary documents.
BATCH_ROWS = 1_000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def text_batches(spark: SparkSession) -> None:
    """Let the session's Arrow batches hold few rows, as texts are long; a smaller setting stays as it is.

    Both sides of a task hold a whole batch, so the usual 10,000 rows would be tens of megabytes several times over.
    """
    rows = int(spark.conf.get(ARROW_ROWS))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")
