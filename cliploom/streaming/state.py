"""State of jobs as a stateful stream: updates are merged field by field, and a job that falls silent is reported.

Each update (job, at, fields) may hold any of the fields; of each field the value of the latest update counts, whatever the order of
arrival. The merged row of a job is emitted in each batch that has an update of it. A job that has not ended gets a timer: when the watermark has passed
its last update by `quiet`, one row with the state `lost` is emitted. State lives in the state store, so a stream that starts anew goes on
where it was; it takes the RocksDB store (spark.sql.streaming.stateStore.providerClass).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ENDED = ("done", "error", "stopped")


class JobMerge(StatefulProcessor):
    """fields: names of fields; quiet: milliseconds, 0 for no timers."""

    def __init__(self, fields: tuple[str, ...], quiet: int = 0):
        self.fields, self.quiet = fields, quiet

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        columns = [StructField("last", LongType()), *(StructField(f, StringType()) for f in self.fields), *(StructField(f"{f}_at", LongType()) for f in self.fields)]
        self.kept = handle.getValueState("job", StructType(columns))

    def _row(self, job: str, held: dict) -> Row:
        return Row(job=job, at=held["last"], **{f: held[f] for f in self.fields})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        n, empty = len(self.fields), [None] * len(self.fields)
        held = list(self.kept.get()) if self.kept.exists() else [None, *empty, *empty]
        state = {"last": held[0]} | dict(zip(self.fields, held[1 : n + 1], strict=True))
        at = dict(zip(self.fields, held[n + 1 :], strict=True))
        for r in rows:
            state["last"] = r["at_ms"] if state["last"] is None else max(state["last"], r["at_ms"])
            for f in self.fields:
                if r[f] is not None and (at[f] is None or r["at_ms"] >= at[f]):
                    state[f], at[f] = r[f], r["at_ms"]
        self.kept.update((state["last"], *(state[f] for f in self.fields), *(at[f] for f in self.fields)))
        if self.quiet:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            if state.get("state") not in ENDED:
                self.handle.registerTimer(state["last"] + self.quiet)
        yield self._row(key[0], state)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.kept.exists():
            held = list(self.kept.get())
            yield self._row(key[0], {"last": held[0]} | dict(zip(self.fields, held[1 : len(self.fields) + 1], strict=True)) | {"state": "lost"})

    def close(self) -> None:
        pass


def merged(updates: DataFrame, fields: tuple[str, ...], quiet: str | None = None, late: str = "10 minutes") -> DataFrame:
    """(job, at, fields as text) of a stream of updates (job, at timestamp, fields), in update mode. quiet: seconds of silence, as a number, after which a job is lost."""
    x = updates.select(F.col("job").cast("string").alias("job"), F.col("at").cast("timestamp").alias("at"), F.unix_millis(F.col("at").cast("timestamp")).alias("at_ms"), *[F.col(f).cast("string").alias(f) for f in fields])
    x = x.withWatermark("at", late) if quiet else x
    out = StructType([StructField("job", StringType()), StructField("at", LongType()), *(StructField(f, StringType()) for f in fields)])
    merge = JobMerge(tuple(fields), int(float(quiet) * 1000) if quiet else 0)
    return x.groupBy("job").transformWithState(merge, out, "Update", "EventTime" if quiet else "None")
