"""A replica's change stream as keyed state: what was last applied to an id, and which of its entries wait for a retry.

Every id is a key of its own in the state store, which Spark partitions, checkpoints and restores; a trigger reads and
writes the state of the ids it touches, and of those whose retry is due. There is no folder of all ids.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from kbvec.operators.replicate import RETRY_LIMIT
from kbvec.session import materialize
from kbvec.sources.store import VectorStore
from kbvec.streaming.state import keyed_state, no_empty_batches

#: Milliseconds (processing time) until a failed entry is tried again: with the next trigger.
RETRY_AFTER_MS = 1
#: Times keep their microseconds.
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_OUT = "vector_id string, seq long, state string, retries long, entry string"

Attempt = Callable[[dict], bool]


class ChangeState(StatefulProcessor):
    """Decides what becomes of the entries of one id.

    State: ``applied``, the sequence number last applied (dropped after ``keep_ms``, if that is given), and
    ``waiting``, by sequence number, the tries and the entry. Output: entries to apply (``done``; only the newest of a
    trigger, and none that an applied one has overtaken), and those set aside (``quarantine``).
    """

    def __init__(self, attempt: Attempt | None, retry_ms: int, keep_ms: int | None):
        self.attempt, self.retry_ms, self.keep_ms = attempt, retry_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.applied = handle.getValueState("applied", "seq long", self.keep_ms)
        self.waiting = handle.getMapState("waiting", "seq long", "retries long, due long, entry string")

    def _settle(self, key, ready: list[tuple[int, str]], gone: list[tuple[int, int, str]]) -> Iterator[pd.DataFrame]:
        last = self.applied.get()[0] if self.applied.exists() else None
        newest = max(ready, default=None, key=lambda e: e[0])
        out = [(key[0], seq, "quarantine", tries, entry) for seq, tries, entry in gone]
        if newest and (last is None or newest[0] > last):
            self.applied.update((newest[0],))
            out.append((key[0], newest[0], "done", 0, newest[1]))
        if out:
            yield pd.DataFrame(out, columns=["vector_id", "seq", "state", "retries", "entry"])

    def _failed(self, seq: int, tries: int, entry: str, now: int, gone: list) -> bool:
        """Keep a failed entry for another try, or set it aside."""
        if tries >= RETRY_LIMIT:
            gone.append((seq, tries, entry))
            return False
        self.waiting.updateValue((seq,), (tries, now + self.retry_ms, entry))
        return True

    def _wake(self, now: int) -> None:
        if not any(True for _ in self.handle.listTimers()):
            self.handle.registerTimer(now + self.retry_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now, ready, gone, kept = timerValues.getCurrentProcessingTimeInMs(), [], [], False
        for frame in rows:
            for seq, ok, tries, entry in zip(frame["seq"], frame["ok"], frame["retries"], frame["entry"]):
                if ok:
                    ready.append((int(seq), entry))
                else:
                    kept |= self._failed(int(seq), int(tries) + 1, entry, now, gone)
        if kept:
            self._wake(now)
        yield from self._settle(key, ready, gone)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, ready, gone, kept = timerValues.getCurrentProcessingTimeInMs(), [], [], False
        for (seq,), (tries, due, entry) in list(self.waiting.iterator()):
            if due > now:  # it came with this very batch
                kept = True
            elif self.attempt is not None and self.attempt(json.loads(entry)):
                self.waiting.removeKey((seq,))
                ready.append((seq, entry))
            elif self._failed(seq, tries + 1, entry, now, gone):
                kept = True
            else:
                self.waiting.removeKey((seq,))
        if kept:
            self.handle.registerTimer(now + self.retry_ms)
        yield from self._settle(key, ready, gone)

    def close(self) -> None:
        pass


def decided(log: DataFrame, ok: Column, attempt: Attempt | None = None, retry_ms: int = RETRY_AFTER_MS,
            keep_ms: int | None = None) -> DataFrame:
    """vector_id, seq, state (done, quarantine), retries and the entry as JSON, of a stream of change entries.

    ``ok`` tells whether an entry can be applied when it arrives; ``attempt`` is asked again, with the entry as a dict,
    at every retry (without it, retries fail). Entries without a payload are dropped.
    """
    rows = log.filter(F.coalesce("payload", F.lit("")) != "").select(
        "vector_id", F.col("seq").cast("long").alias("seq"), F.coalesce(ok, F.lit(False)).alias("ok"),
        F.coalesce(F.col("retries"), F.lit(0)).cast("long").alias("retries"),
        F.to_json(F.struct(*log.columns), JSON).alias("entry"))
    return rows.groupBy("vector_id").transformWithStateInPandas(
        ChangeState(attempt, retry_ms, keep_ms), _OUT, "append", "processingTime")


def entries(rows: DataFrame, schema) -> DataFrame:
    """The change entries in ``rows``, with the tries they have had."""
    parsed = rows.select(F.from_json("entry", schema, JSON).alias("e"), F.col("retries").alias("_tries"))
    kind = schema["retries"].dataType
    return parsed.select("e.*", "_tries").withColumn("retries", F.col("_tries").cast(kind)).drop("_tries")


def stream_changes(log: DataFrame, store: VectorStore, ok: Column, quarantine: str, checkpoint: str,
                   **options) -> StreamingQuery:
    """Apply a stream of change entries to a replica.

    Entries that fail are tried again by timers of their ids, once in every later batch at most, until their tries are
    used up; then they are written below ``quarantine``, in a folder for each batch, so a repeated batch replaces its
    own. Applying twice what a batch says changes nothing.
    """
    keyed_state(log.sparkSession)
    schema = log.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        # Reading the batch itself twice would take the state's step twice.
        held = materialize(batch, "decided")
        entries(held.filter("state = 'quarantine'"), schema).write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")
        store.apply_changes(entries(held.filter("state = 'done'"), schema))

    writer = (decided(log, ok, **options).writeStream.foreachBatch(write).outputMode("append")
              .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    # A waiting timer would start one more batch after another, and a run would end with the last try only.
    with no_empty_batches(log.sparkSession):
        return writer.start()


def waiting(spark: SparkSession, checkpoint: str, schema) -> DataFrame:
    """The entries that wait for a retry, read from the state of the last finished batch."""
    rows = spark.read.format("statestore").option("stateVarName", "waiting").load(checkpoint)
    return entries(rows.select("user_map_value.entry", "user_map_value.retries"), schema)


def applied(spark: SparkSession, checkpoint: str) -> DataFrame:
    """vector_id and the sequence number last applied to it."""
    rows = spark.read.format("statestore").option("stateVarName", "applied").load(checkpoint)
    return rows.select(F.col("key.vector_id").alias("vector_id"), F.col("value.seq").alias("seq"))
