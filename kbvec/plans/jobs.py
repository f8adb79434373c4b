"""Whole jobs from a source to the store; each returns what it did."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, SparkRuntimeException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kbvec.operators import ingest, metrics, replicate
from kbvec.schema import DEFAULT_TENANT
from kbvec.session import materialize
from kbvec.sources.store import VectorStore
from kbvec.sources.tables import published


def _load(store: VectorStore, vectors: DataFrame, dim: int, seq: str | None = None) -> dict:
    """Validate and upsert; the skip report is observed on the pass that writes."""
    seen = Observation()
    counted = vectors.observe(seen, F.count(F.lit(1)).alias("scanned"),
                              F.sum(ingest.missing_parts().cast("int")).alias("skipped"))
    upserted = store.upsert(ingest.validate(counted, dim), seq)
    if not upserted and vectors.isEmpty():
        return {"scanned": 0, "upserted": 0, "skipped": 0, "flagged": False}
    scanned, skipped = seen.get["scanned"], seen.get["skipped"] or 0
    return {"scanned": scanned, "upserted": upserted, "skipped": skipped,
            "flagged": skipped > scanned * ingest.SKIP_WARNING_SHARE}


def full_load(store: VectorStore, rows: DataFrame, dim: int, **options) -> dict:
    """Every knowledge-base row into the store; of rows that share an id the one with the largest row id stays."""
    return _load(store, ingest.kb_to_vectors(rows, **options), dim, "source_row")


def incremental_load(store: VectorStore, rows: DataFrame, last_load: dt.datetime | None, dim: int,
                     **options) -> dict:
    """Rows changed since the last load, with its overlap."""
    return full_load(store, ingest.changed_since(rows, last_load), dim, **options)


def import_records(store: VectorStore, records: DataFrame, dim: int, tenant: str = DEFAULT_TENANT) -> dict:
    """Service records into one tenant; records without values are reported as failed."""
    done = _load(store, ingest.map_metadata(records, ingest.EXPORT_ALIASES, tenant), dim)
    return {"copied": done["upserted"], "failed": done["skipped"], "namespace": tenant}


def load_posts(store: VectorStore, posts: DataFrame, types: Sequence[str],
               embed: Callable[[DataFrame], DataFrame], dim: int, tenant: str = DEFAULT_TENANT,
               content: ingest.ColumnRule | None = None) -> dict:
    """Published posts into the store; ``embed`` adds the ``embedding`` column to rows with content."""
    loaded = materialize(ingest.load_posts(published(posts, types), tenant, content), "posts")
    _load(store, embed(loaded.filter(~F.col("failed"))), dim, "post_id")
    return ingest.posts_summary(loaded).first().asDict()


def drain(store: VectorStore, pending: DataFrame, ok: Column, cap: int | None = None
          ) -> tuple[DataFrame, DataFrame, dict]:
    """One pass over a retry queue of changes: apply the replayable ones, keep, retry or set aside the rest.

    Returns the queue that remains, the entries put into quarantine, and the totals.
    """
    drained = materialize(replicate.drain_step(pending, ok, cap), "drained")
    done = drained.filter(F.col("state") == "done")
    if not done.isEmpty():
        store.apply_changes(done)
    left = drained.filter(F.col("state").isin("retry", "waiting")).select(*pending.columns)
    aside = drained.filter(F.col("state") == "quarantine").select(*pending.columns)
    return left, aside, replicate.drain_totals(drained).first().asDict()


def bootstrap(store: VectorStore, source: DataFrame) -> int:
    """Copy into a replica whatever rows of the source it lacks; a second run copies nothing."""
    return store.upsert(replicate.missing_rows(source, store.read()))


def health(read: Callable[[], DataFrame], log: DataFrame, queue: DataFrame, **options) -> dict:
    """The health summary as a dict; a table that cannot be read is reported, not raised."""
    try:
        return metrics.health_summary(read(), log, queue, **options).first().asDict()
    except (AnalysisException, SparkRuntimeException, Py4JJavaError) as error:
        return {"status": "error", "error": str(error).splitlines()[0]}


def drift_check(primary: DataFrame, replica: DataFrame, pending: int, previous: str = "active") -> dict:
    """Compare both sides tenant by tenant; the drifted tenants and the resulting status."""
    drifted = materialize(replicate.compare_signatures(
        replicate.tenant_signature(primary), replicate.tenant_signature(replica)), "drift")
    return {**replicate.drift_status(drifted, pending, previous).first().asDict(), "tenants": drifted}
