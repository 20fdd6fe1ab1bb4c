"""The seen history and the cache's sliding life as keyed state with timers: streams of the tables that state.upserted,
state.retained and state.pruned make in batches.

Each key holds one row in the state store (RocksDB, so that state isn't bounded by memory) and one timer in event time. A
row of input brings the key up to date and moves its timer; when the watermark passes the timer, the key goes and a
row says so. A table is what each key's last row says, without those that expired. The history before the stream is
given as initial state.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, datetime, timedelta, timezone
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.window import Window as W

from ..operators import state

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SEEN = "key string, resolved_url string, fingerprint string, first_seen_date string, last_seen_date string, expired boolean"
CACHE = "fingerprint string, entry string, at bigint, expired boolean"


def _millis(day: str, days: int) -> int:
    """Midnight (UTC) so many days after a day."""
    at = datetime.combine(date.fromisoformat(day) + timedelta(days=days), datetime.min.time(), timezone.utc)
    return int(at.timestamp() * 1000)


class _Timed(StatefulProcessor):
    """One value and one timer a key."""

    def __init__(self, days: int):
        self.days = days

    def _due(self, millis: int) -> None:
        for at in list(self.handle.listTimers()):
            if at != millis:
                self.handle.deleteTimer(at)
        self.handle.registerTimer(millis)

    def close(self) -> None:
        pass


class SeenHistory(_Timed):
    """The first and last day of each article: first the least, last the greatest, whatever the order of input."""

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getValueState("seen", "resolved_url string, fingerprint string, first_seen_date string, last_seen_date string")

    def _take(self, url: str, print_: str, first: str, last: str) -> tuple:
        had = self.held.get() if self.held.exists() else None
        if had is not None and _millis(had[3], self.days) >= _millis(last, 0):  # else it had gone, though its timer wasn't up yet
            had_url, had_print, had_first, had_last = had
            url = min((had_first, had_url), (first, url))[1]
            print_, first, last = max(had_print, print_), min(had_first, first), max(had_last, last)
        self.held.update((url, print_, first, last))
        self._due(_millis(last, self.days + 1))  # the day of the last mention counts, and so do as many after it
        return url, print_, first, last

    def handleInitialState(self, key: Any, initialState: Row, timerValues) -> None:
        self._take(initialState.resolved_url or "", initialState.fingerprint or "", initialState.first_seen_date, initialState.last_seen_date)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        for r in rows:
            now = self._take(r.resolved_url or "", r.fingerprint or "", r.day, r.day)
        yield Row(key=key[0], resolved_url=now[0], fingerprint=now[1], first_seen_date=now[2], last_seen_date=now[3], expired=False)

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[Row]:
        url, print_, first, last = self.held.get()
        self.held.clear()
        yield Row(key=key[0], resolved_url=url, fingerprint=print_, first_seen_date=first, last_seen_date=last, expired=True)


class SlidingCache(_Timed):
    """The latest entry of each fingerprint, which lives on for so many days after its last use. Times are microseconds."""

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getValueState("cache", "entry string, at bigint")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        entry, at = self.held.get() if self.held.exists() else (None, None)
        for r in sorted(rows, key=lambda r: r.at):
            if at is not None and r.at > at + self.days * 86_400_000_000:
                entry = None  # it had gone, though its timer wasn't up yet
            if at is None or r.at >= at:
                entry, at = (r.entry if r.entry is not None else entry), r.at  # a hit brings no entry of its own
        if entry is not None:
            self.held.update((entry, at))
            self._due(at // 1000 + self.days * 86_400_000)
        yield Row(fingerprint=key[0], entry=entry, at=at, expired=entry is None)

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[Row]:
        entry, at = self.held.get()
        self.held.clear()
        yield Row(fingerprint=key[0], entry=entry, at=at, expired=True)


def seen_history(items: DataFrame, ts: str = "published_at", days: int = state.RETENTION_DAYS, late: str = "0 seconds", before: DataFrame | None = None) -> DataFrame:
    """SEEN: changes of the seen history by a stream of items (resolved_url, fingerprint and a time). before: the history so far."""
    items.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    keyed = items.withColumns({"key": state.seen_key("resolved_url", "fingerprint"), "day": F.date_format(ts, "yyyy-MM-dd")})
    rows = keyed.filter("key is not null").select("key", "resolved_url", "fingerprint", "day", ts).withWatermark(ts, late)
    held = None
    if before is not None:
        held = before.withColumn("key", state.seen_key("resolved_url", "fingerprint")).filter("key is not null").select("key", "resolved_url", "fingerprint", "first_seen_date", "last_seen_date").groupBy("key")
    return rows.groupBy("key").transformWithState(SeenHistory(days), SEEN, "Update", "EventTime", held)


def sliding_cache(uses: DataFrame, days: int = state.CACHE_DAYS, late: str = "0 seconds") -> DataFrame:
    """fingerprint, entry, updated_at, expired: changes of the cache by a stream of uses (fingerprint, entry: null for a hit, updated_at: a timestamp)."""
    uses.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    timed = uses.filter("fingerprint is not null and updated_at is not null").select("fingerprint", "entry", F.unix_micros("updated_at").alias("at"), "updated_at").withWatermark("updated_at", late)
    changes = timed.groupBy("fingerprint").transformWithState(SlidingCache(days), CACHE, "Update", "EventTime")
    return changes.select("fingerprint", "entry", F.timestamp_micros("at").alias("updated_at"), "expired")


def table_of(changes: DataFrame, key: str, batch: str) -> DataFrame:
    """The table that changes leave: each key's last row by batch, without those that expired. Changes are written with their batch."""
    last = changes.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy(F.desc(batch), F.asc("expired"))))
    return last.filter("_n = 1 and not expired").drop("_n", "expired", batch)
