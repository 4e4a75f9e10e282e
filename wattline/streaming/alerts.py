"""Alerts that the stream itself raises (T7, T9): stale feeds and missed windows, by event-time timers.

Readings are first reduced to closed 5-minute windows for each (feed, node): an append-mode aggregate,
combined in each task before the shuffle, so a node with a third of all readings sends a few rows a batch.
The closed windows reach a keyed processor in event-time order, ``BUCKETS`` groups of (feed, node) by hash: it
works on all nodes of a group at once, as a call for each node costs more than the work on its few windows.  It
keeps four values for each (feed, node) in the state store and a timer for the group's next alert:

* ``stale``: no reading for longer than the feed allows.  Raised at last reading + limit.
* ``missed``: a window without readings.  Raised at the end of the first one.

A timer is set to the end of the window that holds the alert's time: by then the watermark has closed all
windows that could hold a reading before it, so no alert is raised that a reading would have prevented.  The
next reading clears what is open (``missed`` with the number of windows).  Alerts therefore don't depend on
how the readings were cut into micro-batches, and a restart on the same checkpoint finds its timers.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wattline.streaming.ingest import WATERMARK

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # executors need not have the package

WINDOW_US = 300_000_000
EVENTS = "feed string, node_id string, alert string, event string, at_us long, last_us long, n_missed long"
#: Groups of (feed, node) that share a state row; a checkpoint keeps their number for good.
BUCKETS = 1024
_STATE = "feed array<string>, node_id array<string>, last_us array<long>, end_us array<long>, stale array<boolean>, missed array<boolean>"
_COLUMNS = ["feed", "node_id", "last_us", "end_us", "stale", "missed"]
_EVENT_COLUMNS = ["feed", "node_id", "alert", "event", "at_us", "last_us", "n_missed"]
_STORE = {"spark.sql.streaming.stateStore.providerClass":
          "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class Watch(StatefulProcessor):
    """State of a group: last reading of each (feed, node), end of its window, and which alerts are open."""

    def __init__(self, limits_us: Mapping[str, int]):
        self.limits_us = dict(limits_us)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", _STATE)

    def close(self) -> None:
        pass

    def _load(self) -> pd.DataFrame:
        held = self.seen.get() if self.seen.exists() else [[]] * len(_COLUMNS)
        types = {"last_us": "int64", "end_us": "int64", "stale": bool, "missed": bool}
        return pd.DataFrame({c: list(v) for c, v in zip(_COLUMNS, held)}).astype(types)

    def _keep(self, state: pd.DataFrame) -> None:
        """Store the state, and the time at which the next alert is to be raised."""
        self.seen.update(tuple(state[c].tolist() for c in _COLUMNS))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        at = [self._timer(due)[~state[alert]] for alert, due in self._due(state).items()]
        if any(len(t) for t in at):
            self.handle.registerTimer(int(min(t.min() for t in at if len(t))) // 1000)

    def _due(self, state: pd.DataFrame) -> dict[str, pd.Series]:
        """When each alert is due if no more readings come."""
        return {"stale": state["last_us"] + state["feed"].map(self.limits_us).astype("int64"), "missed": state["end_us"] + WINDOW_US}

    def _timer(self, due: pd.Series) -> pd.Series:
        """End of the window that holds the alert's time."""
        return -(-due // WINDOW_US) * WINDOW_US

    def _events(self, rows: pd.DataFrame, alert: str, event: str, at, last, n=None) -> pd.DataFrame:
        out = rows[["feed", "node_id"]].assign(alert=alert, event=event, at_us=at, last_us=last)
        return out.assign(n_missed=pd.Series(n, index=rows.index, dtype="Int64"))[_EVENT_COLUMNS]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self._load()
        closed = pd.concat(list(rows), ignore_index=True)[["feed", "node_id", "end_us", "first_us", "last_us"]]
        # each window beside the reading before it: that of the window before, or what the state holds
        both = pd.concat([state.assign(first_us=0), closed.assign(stale=False, missed=False)], ignore_index=True)
        both = both.sort_values(["feed", "node_id", "end_us"], ignore_index=True)
        node = both.groupby(["feed", "node_id"], sort=False)
        before = both[["feed"]].join(node[["last_us", "end_us"]].shift(fill_value=0)).join(node[["stale", "missed"]].shift(fill_value=False))
        later = node.cumcount() > 0
        new, was = both[later], before[later]
        events = []
        for alert, due in self._due(was).items():
            past = new["first_us" if alert == "stale" else "end_us"] > due
            n = (new["end_us"] - was["end_us"]) // WINDOW_US - 1 if alert == "missed" else None
            for event, which in (("raised", past & ~was[alert]), ("cleared", past)):
                some = new[which]
                events.append(self._events(some, alert, event, due[which] if event == "raised" else some["first_us"], was["last_us"][which],
                                           n[which] if event == "cleared" and n is not None else None))
        self._keep(node.tail(1)[_COLUMNS])
        events = [e for e in events if len(e)]
        if events:
            yield pd.concat(events, ignore_index=True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """All that the watermark has passed, not only this timer's alert."""
        state, now = self._load(), timerValues.getCurrentWatermarkInMs() * 1000
        events = []
        for alert, due in self._due(state).items():
            past = ~state[alert] & (self._timer(due) < now)
            events.append(self._events(state[past], alert, "raised", due[past], state["last_us"][past]))
            state[alert] |= past
        self._keep(state)
        events = [e for e in events if len(e)]
        if events:
            yield pd.concat(events, ignore_index=True)


def alerts(readings: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Stream of (feed, node_id, timestamp) -> alert events; ``limits``: minutes after which a feed is stale.

    Columns: feed, node_id, alert (stale, missed), event (raised, cleared), event_at, last_seen (the reading before
    the alert), n_missed (windows missed, on clearing).  Readings without node or time, and feeds that have no
    limit, take no part."""
    known = readings.filter(F.col("feed").isin(list(limits)) & F.col("node_id").isNotNull() & F.col("timestamp").isNotNull())
    t = F.unix_micros("timestamp")
    windows = (known.withWatermark("timestamp", WATERMARK)
               .groupBy(F.window("timestamp", f"{WINDOW_US // 60_000_000} minutes").alias("window"), "feed", "node_id")
               .agg(F.min(t).alias("first_us"), F.max(t).alias("last_us"))
               .select(F.pmod(F.xxhash64("feed", "node_id"), F.lit(BUCKETS)).cast("int").alias("bucket"), "feed", "node_id",
                       F.unix_micros("window.end").alias("end_us"), "first_us", "last_us"))
    events = windows.groupBy("bucket").transformWithStateInPandas(
        Watch({f: m * 60_000_000 for f, m in limits.items()}), EVENTS, "Append", "EventTime")
    return events.select("feed", "node_id", "alert", "event", F.timestamp_micros("at_us").alias("event_at"),
                         F.timestamp_micros("last_us").alias("last_seen"), "n_missed")


#: Input bytes of a state partition: a checkpoint keeps its number of partitions for good.
STATE_BYTES = 64 << 20


def use_disk_state(spark: SparkSession, input_bytes: int | None = None) -> dict[str, str | None]:
    """Keyed processors need the RocksDB store; returns the settings that were there before.  With ``input_bytes``,
    what the stream is expected to read, no more state partitions than that needs (and one for each core)."""
    settings = dict(_STORE)
    if input_bytes is not None:
        n = max(spark.sparkContext.defaultParallelism, -(-input_bytes // STATE_BYTES))
        settings["spark.sql.shuffle.partitions"] = str(min(n, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    return before


def restore(spark: SparkSession, before: Mapping[str, str | None]) -> None:
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)
