"""What is remembered about a visitor, a visitor's day and a session, as keyed state of Spark's state operator.

Each state is one small value per key in the session's state store; a micro-batch reads and writes the keys that it
has and no others. Rows come to the operator with the few columns that the rule needs. Where a key is new, its rows of this
one micro-batch are held together, as the earliest of them decides; afterwards they only pass through.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.times import ms_to_timestamp
from ..operators import logs
from ..session import keyed_state

DAY_MS = 24 * 60 * 60 * 1000
# The driver's own worker of the state operator sees no shipped files: processors travel by value.
register_pickle_by_value(sys.modules[__name__])
#: Slots among which the visitors of a day, and the sessions, are dealt; a task takes whole slots.
SLOTS = 512


def _earliest(rows: pd.DataFrame) -> pd.Series:
    """The first row by time, then by arrival."""
    return rows.sort_values(["ts", "seq"], kind="stable").iloc[0]


class FirstDay(StatefulProcessor):
    """A visitor's first day, settled once by the first record: its own day if that calls the visitor new, else the day before."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first_day", "day int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if self.first.exists():
            day = self.first.get()[0]
        else:
            rows = list(rows)
            record = _earliest(pd.concat(rows))
            day = int(record["day"]) - (record["is_new"] != "1")
            self.first.update((day,))
        for part in rows:
            stale = (part["is_new"] == "1") & (part["day"] != day)
            yield pd.DataFrame({"seq": part["seq"], "value": part["value"], "stale": stale})

    def close(self) -> None:
        pass


def fixed_logs(topic: DataFrame) -> DataFrame:
    """Parsed logs of a topic with the new-visitor flag corrected, by state that is kept for every visitor."""
    keyed_state(topic.sparkSession)
    parsed = logs.parse_logs(topic.withColumn("whole", F.col("value")))
    lean = parsed.select("mid", "seq", "ts", "is_new", F.unix_date(logs.day_of()).alias("day"), F.col("whole").alias("value"))
    marked = lean.groupBy("mid").transformWithStateInPandas(
        FirstDay(), outputStructType="seq long, value string, stale boolean", outputMode="Append", timeMode="None"
    )
    return logs.clear_flags(logs.parse_logs(marked), F.col("stale")).drop("stale")


class Opening(StatefulProcessor):
    """Marks the first view of each name of a slot in the column ``flag``; a name is forgotten ``keep_ms`` after its last view.

    A slot holds many names, so that Python is entered and rows are handed on by slot and not by name. A map has when each
    name may go; a micro-batch reads and writes the names that it has and no others. One event-time timer per slot removes what
    is due, at most ``SWEEPS`` times while a name is kept. A view that comes after its name was due finds it forgotten,
    whether or not the timer was there yet. Rows without a name open nothing.
    """

    SWEEPS = 8

    def __init__(self, flag: str, keep_ms: int, name: str = "mid"):
        self.flag, self.keep_ms, self.name = flag, keep_ms, name

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.until = handle.getMapState(f"{self.flag}_until", "name string", "until bigint")
        self.wake = handle.getValueState(f"{self.flag}_wake", "wake bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        until: dict[str, int | None] = {}
        last: dict[str, int] = {}
        first: dict[str, tuple[int, int]] = {}  # of names that may open
        held = []
        for part in rows:
            views = list(zip(part[self.name].tolist(), part["ts"].tolist(), part["seq"].tolist(), strict=True))
            for name, ts, seq in views:
                if name is None:
                    continue
                if name not in until:
                    found = self.until.getValue((name,))
                    until[name], last[name] = found and found[0], ts
                    if found is None or found[0] <= now:
                        first[name] = (ts, seq)
                else:
                    last[name] = max(last[name], ts)
                    if name in first:
                        first[name] = min(first[name], (ts, seq))
            # Names that are known pass through.
            opens = [name in first for name, _, _ in views]
            if all(opens):
                held.append(part)
                continue
            if any(opens):
                held.append(part[opens])
                part = part[[not held_back for held_back in opens]]
            yield part.assign(**{self.flag: 0})
        first = {name: view for name, view in first.items() if until[name] is None or until[name] < view[0]}
        for part in held:
            views = zip(part[self.name].tolist(), part["ts"].tolist(), part["seq"].tolist(), strict=True)
            yield part.assign(**{self.flag: [int(first.get(name) == (ts, seq)) for name, ts, seq in views]})
        for name, ts in last.items():
            if until[name] is None or ts + self.keep_ms > until[name]:
                self.until.updateValue((name,), (ts + self.keep_ms,))
        if last and not self.wake.exists():
            self._wake_at(min(last.values()) + self.keep_ms, now)

    def _wake_at(self, due: int, now: int) -> None:
        """One timer per slot, at the end of the sweep's time in which something is due."""
        sweep = max(1, self.keep_ms // self.SWEEPS)
        wake = max(due, now + 1) // sweep * sweep + sweep
        self.handle.registerTimer(wake)
        self.wake.update((wake,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        gone, left = [], []
        for (name,), (until,) in self.until.iterator():
            (left if until > now else gone).append((name, until))
        # The fewer of both are handled one by one.
        if len(left) < len(gone):
            self.until.clear()
            for name, until in left:
                self.until.updateValue((name,), (until,))
        else:
            for name, _ in gone:
                self.until.removeKey((name,))
        if left:
            self._wake_at(min(until for _, until in left), now)
        else:
            self.wake.clear()
        return iter(())

    def close(self) -> None:
        pass


VIEW = "seq long, ts long, mid string, sid string, vc string, ch string, ar string, is_new string, dur long"


def flagged_views(pages: DataFrame, delay: str, day_kept_ms: int = 2 * DAY_MS, session_kept_ms: int = 30 * DAY_MS) -> DataFrame:
    """Page views (:func:`rtdw.operators.traffic.parse_pages`) with ``uv`` and ``sv`` by two state steps, and event time ``et``.

    A visitor's day is remembered for two days of event time, a session until it had no view for 30 days. Views behind
    the watermark are dropped, as by the windows that follow.
    """
    keyed_state(pages.sparkSession)
    slot = lambda *name: F.pmod(F.xxhash64(*name), F.lit(SLOTS)).cast("int")
    visit = F.concat_ws(" ", F.unix_date(logs.day_of()), "mid")
    timed = pages.withColumns({"et": ms_to_timestamp("ts"), "visit": visit, "slot": slot(visit)}).withWatermark("et", delay)
    by_day = timed.groupBy("slot").transformWithStateInPandas(
        Opening("uv", day_kept_ms, "visit"), f"{VIEW}, et timestamp, uv long", "Append", "EventTime", eventTimeColumnName="et"
    )
    # Views without a session are dealt out by their number.
    in_session = by_day.withColumn("slot", slot("sid", F.when(F.col("sid").isNull(), F.col("seq"))))
    by_session = in_session.groupBy("slot").transformWithStateInPandas(
        Opening("sv", session_kept_ms, "sid"), f"{VIEW}, et timestamp, uv long, sv long", "Append", "EventTime", eventTimeColumnName="et"
    )
    return by_session
