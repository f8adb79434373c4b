"""Vector table on plain Parquet: immutable versions, partitioned by tenant and id bucket.

A version is a small JSON list of partition folders. A write makes new folders only for the
partitions it touches and lists the old ones for the rest; nothing that is being read is ever
overwritten, and a failed or repeated write leaves the previous version in place.

Concurrent writers are told apart by the rename that publishes a version: one wins, the others fail and
can try again. That needs a file system whose rename refuses an existing target, such as HDFS; on object
stores and local disks let one writer at a time work.
"""

from __future__ import annotations

import datetime as dt
import json
import urllib.parse
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kbvec.operators.ingest import missing_parts
from kbvec.operators.mutate import compaction_list, last_per_id, may_compact, split_entries
from kbvec.operators.replicate import latest_changes
from kbvec.schema import DEFAULT_TENANT, conform, vector_schema
from kbvec.session import broadcast_if_small, materialize

Part = tuple[str, int]


class VectorStore:
    """``buckets`` splits each tenant by id hash, so a write to a large tenant stays local."""

    def __init__(self, spark: SparkSession, root: str, storage: str = "float32", buckets: int = 16):
        self.spark, self.root, self.storage, self.buckets = spark, root.rstrip("/"), storage, buckets
        self._path = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # --- versions ---

    def _version_files(self) -> list:
        folder = self._path(f"{self.root}/versions")
        found = self._fs.listStatus(folder) if self._fs.exists(folder) else []
        named = [(s.getPath().getName(), s) for s in found]
        return sorted((int(n[:-5]), s.getModificationTime()) for n, s in named if n.endswith(".json") and n[0] != ".")

    def versions(self) -> list[int]:
        return [v for v, _ in self._version_files()]

    def last_write(self) -> dt.datetime | None:
        """When the newest version was published (UTC, without zone)."""
        files = self._version_files()
        if not files:
            return None
        return dt.datetime.fromtimestamp(files[-1][1] / 1000, dt.timezone.utc).replace(tzinfo=None)

    def _meta(self, version: int) -> dict:
        if version == 0:
            return {"dim": None, "folders": {}}
        stream = self._fs.open(self._path(f"{self.root}/versions/{version:08d}.json"))
        try:
            meta = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        if meta["storage"] != self.storage or meta["buckets"] != self.buckets:
            raise ValueError(f"store holds {meta['storage']} in {meta['buckets']} buckets")
        return {"dim": meta["dim"], "folders": {(t, b): f for t, b, f in meta["folders"]}}

    def _newest(self) -> int:
        held = self.versions()
        return held[-1] if held else 0

    def _publish(self, version: int, dim: int | None, folders: dict[Part, str]) -> None:
        """Make a version visible by one rename; a concurrent writer of the same number fails."""
        draft = self._path(f"{self.root}/versions/.{version:08d}-{uuid.uuid4().hex}.draft")
        final = self._path(f"{self.root}/versions/{version:08d}.json")
        self._fs.mkdirs(draft.getParent())
        body = json.dumps({"storage": self.storage, "buckets": self.buckets, "dim": dim,
                           "folders": [[t, b, f] for (t, b), f in sorted(folders.items())]})
        out = self._fs.create(draft, False)
        out.write(bytearray(body.encode()))
        out.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            raise RuntimeError(f"version {version} was written by someone else")

    # --- reads ---

    def read(self, version: int | None = None, only: set[Part] | None = None) -> DataFrame:
        """The table as of a version (default: newest); ``only`` narrows to (tenant, bucket) partitions.

        One reader takes the folders of all writes: they stand below one base path.
        """
        folders = self._meta(self._newest() if version is None else version)["folders"]
        paths = [f"{self.root}/data/{f}" for part, f in sorted(folders.items()) if only is None or part in only]
        wanted = [f.name for f in vector_schema(self.storage).fields]
        schema = vector_schema(self.storage).add("v", T.StringType()).add("bucket", T.IntegerType())
        if not paths:
            return self.spark.createDataFrame([], schema).select(*wanted)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*paths).select(*wanted)

    def around(self, ids: DataFrame) -> DataFrame:
        """The rows of all tenants in the buckets that ``ids`` fall into; other buckets are not read."""
        buckets = {r["bucket"] for r in self._placed(ids.select("vector_id")).select("bucket").distinct().collect()}
        parts = self._meta(self._newest())["folders"]
        return self.read(only={p for p in parts if p[1] in buckets})

    # --- writes ---

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64("vector_id"), F.lit(self.buckets)).cast("int"))

    def _touched(self, rows: DataFrame) -> set[Part]:
        return {(r["bot_id"], r["bucket"]) for r in self._placed(rows).select("bot_id", "bucket").distinct().collect()}

    def _checked_dim(self, fresh: DataFrame, dim: int | None) -> int | None:
        """The dimension of the store, which all rows that are written must have."""
        size = fresh.agg(F.min(F.size("embedding")).alias("low"), F.max(F.size("embedding")).alias("high")).first()
        if size["low"] is None:
            return dim
        want = size["low"] if dim is None else dim
        if size["low"] != want or size["high"] != want:
            raise ValueError(f"embedding dimension mismatch: expected {want}, got {size['low']} to {size['high']}")
        return want

    def _replace(self, touched: set[Part], rows: DataFrame, dim: int | None) -> int:
        """Write the new content of the touched partitions and publish the next version."""
        held = self._newest()
        folders, version = self._meta(held)["folders"], held + 1
        own = f"v={version:08d}-{uuid.uuid4().hex[:8]}"
        (self._placed(rows).hint("rebalance", "bot_id", "bucket")
         .write.option("compression", "zstd").partitionBy("bot_id", "bucket").parquet(f"{self.root}/data/{own}"))
        written = {}
        for tenant in self._fs.listStatus(self._path(f"{self.root}/data/{own}")):
            name = tenant.getPath().getName()
            for bucket in self._fs.listStatus(tenant.getPath()) if tenant.isDirectory() else []:
                part = bucket.getPath().getName()
                written[urllib.parse.unquote(name.split("=", 1)[1]), int(part.split("=", 1)[1])] = f"{own}/{name}/{part}"
        kept = {p: f for p, f in folders.items() if p not in touched}
        self._publish(version, dim, {**kept, **written})
        return version

    def upsert(self, rows: DataFrame, seq: str | None = None) -> int:
        """Replace or insert by id; of several input rows with one id the last wins (see ``last_per_id``).

        Rows without id or embedding are skipped; the number of the others is returned. A row whose embedding has
        another length than the store's stops the write.
        """
        seen = Observation()
        accepted = rows.filter(~missing_parts()).observe(seen, F.count(F.lit(1)).alias("rows"))
        fresh = materialize(conform(last_per_id(accepted, seq), self.storage), "fresh")
        if fresh.isEmpty():  # a plan known to be empty is never run and observes nothing
            return 0
        self._swap(fresh.select("vector_id"), fresh)
        return seen.get["rows"]

    def restore(self, path: str) -> int:
        """Put a Parquet backup back: equal ids are replaced, other rows stay, an empty file does nothing."""
        return self.upsert(self.spark.read.parquet(path))

    def apply_changes(self, log: DataFrame) -> None:
        """Replay ``log(seq, vector_id, op, ...)``: the last entry per id is put in or taken out."""
        last = materialize(latest_changes(log), "changes")
        fresh = materialize(conform(last.filter(F.col("op") == "upsert"), self.storage), "fresh")
        if not last.isEmpty():
            self._swap(last.select("vector_id"), fresh)

    def _swap(self, ids: DataFrame, fresh: DataFrame) -> None:
        """Take ``ids`` out, in whatever tenant they are, and put ``fresh`` in. Both are written frames."""
        dim = self._checked_dim(fresh, self._meta(self._newest())["dim"])
        hint = broadcast_if_small(ids)
        touched = self._touched(fresh) | self._touched(self.around(ids).select("vector_id", "bot_id").join(
            hint, "vector_id", "left_semi"))
        rest = self.read(only=touched).join(hint, "vector_id", "left_anti")
        self._replace(touched, rest.unionByName(fresh), dim)

    def _remove(self, hits: DataFrame) -> int:
        """Delete rows given by ``vector_id, bot_id``; returns how many there were."""
        hits = materialize(hits.select("vector_id", "bot_id"), "hits")
        n = hits.count()
        if n:
            touched = self._touched(hits)
            gone = broadcast_if_small(hits.select("vector_id"))
            self._replace(touched, self.read(only=touched).join(gone, "vector_id", "left_anti"),
                          self._meta(self._newest())["dim"])
        return n

    def delete_ids(self, ids: DataFrame, tenant: str = DEFAULT_TENANT) -> dict[str, int]:
        """Delete by id in one tenant; reports ids asked for and rows removed."""
        ids = materialize(ids.select("vector_id").distinct(), "ids")
        own = self.read().filter(F.col("bot_id") == F.lit(tenant))
        return {"requested": ids.count(),
                "deleted": self._remove(own.join(broadcast_if_small(ids), "vector_id", "left_semi"))}

    def delete_url(self, url: str, tenant: str = DEFAULT_TENANT) -> int:
        """Delete the base row and every chunk of one URL in one tenant."""
        return self._remove(self.read().filter((F.col("bot_id") == F.lit(tenant)) & (F.col("source_url") == F.lit(url))))

    def delete_entries(self, entries: DataFrame, tenant: str = DEFAULT_TENANT) -> int:
        """Delete what a bulk list names: whole URLs for groups, single ids otherwise."""
        ids, urls = split_entries(entries)
        own = self.read().filter(F.col("bot_id") == F.lit(tenant))
        by_id = own.join(broadcast_if_small(ids), "vector_id", "left_semi").select("vector_id", "bot_id")
        by_url = own.join(broadcast_if_small(urls), "source_url", "left_semi").select("vector_id", "bot_id")
        return self._remove(by_id.unionByName(by_url).distinct())

    def compact(self, alive: DataFrame, max_deletes: int | None = None, last_load: dt.datetime | None = None,
                now: dt.datetime | None = None, **options) -> dict:
        """Delete the rows without a living source row (at most ``max_deletes``), unless the load is too recent.

        The load's time is ``last_load``, or the time of the last write to the store; ``now`` is the clock's.
        """
        now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        if not may_compact(last_load or self.last_write(), now):
            return {"ok": False, "reason": "last load too recent", "deleted": 0}
        ids = broadcast_if_small(materialize(compaction_list(self.read(), alive, max_deletes, **options), "orphans"))
        return {"ok": True, "deleted": self._remove(self.read().join(ids, "vector_id", "left_semi"))}
