"""Per-key state of streams: contents seen before, and the status of each document."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Statuses in the order of the work.
STATUSES = ["pending", "classifying", "extracting", "verifying", "review_ready", "needs_profile", "failed"]
#: Which status may follow which; "" is a document that is not known yet.
TRANSITIONS = {
    "": {"pending", "needs_profile", "failed"},
    "pending": {"classifying", "failed"},
    "needs_profile": {"pending", "failed"},
    "classifying": {"extracting", "review_ready", "failed"},
    "extracting": {"verifying", "failed"},
    "verifying": {"review_ready", "failed"},
    "failed": {"pending"},
    "review_ready": set(),
}
#: In these a document is worked on, and can get stuck.
AT_WORK = ("classifying", "extracting", "verifying")

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, whose size isn't bound by memory."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


class _FirstContent(StatefulProcessor):
    """Lets the first batch's least path of each key pass; failed rows pass and are not remembered."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "path string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first = None
        for r in rows:
            if r.error is not None:
                yield r
            elif first is None or r.path < first.path:
                first = r
        if first is not None and self.seen.get() is None:
            self.seen.update((first.path,))
            yield first

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.seen.update((initialState.path,))

    def close(self) -> None:
        pass


def first_contents(ingested: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """A stream of ingestions with equal contents once over all its batches: that of the least path in the first batch
    which has them. Failed rows pass, and neither hide nor are hidden.

    The state is keyed by hash, so what a batch costs depends on its rows and not on what came before. ``history`` is
    what other runs ingested; it becomes the first batch's state.
    """
    # Failed rows only pass through, so a few keys do for all of them.
    key = F.when(F.col("error").isNull(), F.col("sha256")).otherwise(F.concat(F.lit("failed "), F.pmod(F.xxhash64("path"), F.lit(1024)).cast("string")))
    seen = history.where("error is null").groupBy(F.col("sha256").alias("key")).agg(F.min("path").alias("path")).groupBy("key") if history is not None else None
    keyed = ingested.withColumn("key", key)
    return keyed.groupBy("key").transformWithState(_FirstContent(), keyed.schema, "Append", "None", seen).drop("key")


_CHANGE = Row("sha256", "status", "error", "at", "refused")


class _Status(StatefulProcessor):
    def __init__(self, limit_ms: int):
        self.limit_ms = limit_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("status", "status string, error string, changed_ms long")

    def _deadline(self, now: tuple) -> int | None:
        return now[2] + self.limit_ms if now[0] in AT_WORK else None

    def _move(self, old: tuple, new: tuple) -> None:
        if old[0] in AT_WORK:
            self.handle.deleteTimer(self._deadline(old))
        self.state.update(new)
        if new[0] in AT_WORK:
            self.handle.registerTimer(self._deadline(new))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        begun = now = self.state.get() or ("", None, 0)
        for r in sorted(rows, key=lambda r: (r.at, r.status is None, r.status or "")):
            ms = r.at // 1000
            refused = "late" if ms < now[2] else None if r.status in TRANSITIONS[now[0]] else f"{now[0] or 'nothing'} can't become {r.status}"
            yield _CHANGE(key[0], r.status, r.error, r.at, refused)
            if refused is None:
                now = (r.status, r.error, ms)
        if now is not begun:
            self._move(begun, now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = self.state.get() or ("", None, 0)
        due = expiredTimerInfo.getExpiryTimeInMs()
        if self._deadline(now) == due:
            error = f"no change from {now[0]} in {self.limit_ms // 1000} s"
            self.state.update(("failed", error, due))
            yield _CHANGE(key[0], "failed", error, due * 1000, None)

    def close(self) -> None:
        pass


def status_changes(changes: DataFrame, delay: str = "1 day", limit_seconds: int = 43_200) -> DataFrame:
    """A stream of ``changes(sha256, status, error, changed_at)`` with ``refused``, the reason why one isn't taken.

    A change is refused where its status can't follow the document's present one, or where it is older than the last
    that was taken. Changes of one batch are taken in the order of their times. A document that stays at work for
    ``limit_seconds`` after its last change, by the time of the stream (which runs ``delay`` behind the latest
    change), fails, and may be pending again later. Changes older than that time are dropped by the stream.
    """
    # Times are passed as numbers, which no time zone changes.
    rows = changes.select("sha256", "status", "error", "changed_at", F.unix_micros("changed_at").alias("at")).withWatermark("changed_at", delay)
    told = rows.groupBy("sha256").transformWithState(_Status(limit_seconds * 1000), "sha256 string, status string, error string, at long, refused string", "Append", "EventTime")
    return told.select("sha256", "status", "error", F.timestamp_micros("at").alias("changed_at"), "refused")
