"""Changes that arrive before their route: they wait in keyed state until it comes, or until their time is over."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.times import ms_to_timestamp, seconds_to_timestamp
from ..session import keyed_state
from ..sources.changelog import image

# The driver's own worker of the state operator sees no shipped files: processors travel by value.
register_pickle_by_value(sys.modules[__name__])
ROUTED = "seq long, `table` string, `type` string, value string, sink_table string, sink_columns string"
#: Tasks among which the changes of one table are dealt; each has its own copy of the route.
SLOTS = 16
#: Waiting changes of one hour that stand in one value of the state.
HELD = 1000
HOUR_MS = 60 * 60 * 1000


class Waiting(StatefulProcessor):
    """The route of one table and type, and the changes that wait for it. Changes whose wait ends come out without a route.

    The changes stand in a map by the hour at which their wait ends: what is due is read and removed, the rest is left alone.
    """

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.route = handle.getValueState("route", "sink_table string, sink_columns string")
        self.held = handle.getMapState("held", "due bigint, first bigint", "seqs array<bigint>, texts array<string>")
        self.next = handle.getValueState("next", "due bigint")

    def _out(self, key, seqs, values, route=(None, None)) -> pd.DataFrame:
        n = len(seqs)
        columns = [list(seqs), [key[0]] * n, [key[1]] * n, list(values), [route[0]] * n, [route[1]] * n]
        names = ("seq", "table", "type", "value", "sink_table", "sink_columns")
        return pd.DataFrame({name: pd.Series(c, dtype="int64" if name == "seq" else "object") for name, c in zip(names, columns, strict=True)})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        part = pd.concat(list(rows))
        news = part[part["value"].isnull()]
        if len(news):
            last = news.sort_values("seq", kind="stable").iloc[-1]
            if last["sink_table"] is None:
                self.route.clear()
            else:
                self.route.update((last["sink_table"], last["sink_columns"]))
        changes = part[part["value"].notnull()]
        if self.route.exists():
            route = self.route.get()
            if self.next.exists():
                yield from self._release_all(key, route)
                self.handle.deleteTimer(self.next.get()[0])
                self.next.clear()
            yield self._out(key, changes["seq"], changes["value"], route)
        elif len(changes):
            # Whole hours, so that what is due can be found by few keys.
            due = (changes["ms"] + self.keep_ms) // HOUR_MS * HOUR_MS + HOUR_MS
            for moment, rows in changes.groupby(due.to_numpy()):
                seqs, texts = rows["seq"].tolist(), rows["value"].tolist()
                for at in range(0, len(seqs), HELD):
                    self.held.updateValue((int(moment), seqs[at]), (seqs[at : at + HELD], texts[at : at + HELD]))
            self._wake(int(due.min()))

    def _wake(self, due: int) -> None:
        """One timer per key, for what is due first."""
        now = self.next.get()[0] if self.next.exists() else None
        if now is None or due < now:
            if now is not None:
                self.handle.deleteTimer(now)
            self.handle.registerTimer(due)
            self.next.update((due,))

    def _release(self, key, entries, *route) -> Iterator[pd.DataFrame]:
        """Some hours' changes, about ``HELD`` rows at a time."""
        seqs, texts = [], []
        for some_seqs, some_texts in entries:
            seqs += some_seqs
            texts += some_texts
            if len(seqs) >= HELD:
                yield self._out(key, seqs, texts, *route)
                seqs, texts = [], []
        if seqs:
            yield self._out(key, seqs, texts, *route)

    def _release_all(self, key, *route) -> Iterator[pd.DataFrame]:
        yield from self._release(key, self.held.values(), *route)
        self.held.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        self.next.clear()
        places = list(self.held.keys())
        left = [place[0] for place in places if place[0] > now]
        if not left:
            yield from self._release_all(key)
            return
        self._wake(min(left))
        gone = [place for place in places if place[0] <= now]
        yield from self._release(key, (self.held.getValue(place) for place in gone))
        for place in gone:
            self.held.removeKey(place)

    def close(self) -> None:
        pass


def route_changes(facts: DataFrame, captures: DataFrame, delay: str = "5 seconds", keep_ms: int = 24 * HOUR_MS, slots: int = SLOTS) -> DataFrame:
    """Streams of facts and of captured routes as ``ROUTED`` rows: ``value`` is the fact's data as JSON.

    A fact takes the route that is in force when it comes. Without one it waits, for ``keep_ms`` of event time, and takes the
    first that comes; what waits longer comes out with no ``sink_table``. A table's facts are dealt to ``slots`` keys, each of which
    gets every route.
    """
    keyed_state(facts.sparkSession)
    none = F.lit(None).cast("string")
    waiting = facts.select(
        "seq", "table", "type", F.pmod("seq", F.lit(slots)).cast("int").alias("slot"), (F.col("ts") * 1000).alias("ms"),
        seconds_to_timestamp("ts").alias("et"), F.to_json("data").alias("value"), none.alias("sink_table"), none.alias("sink_columns"),
    )
    row, gone = F.col("row"), F.col("op") == "d"
    routes = image(captures).select(
        "seq", row["source_table"].alias("table"), row["source_type"].alias("type"),
        F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"), F.col("ts_ms").alias("ms"), ms_to_timestamp("ts_ms").alias("et"),
        none.alias("value"), F.when(~gone, row["sink_table"]).alias("sink_table"), F.when(~gone, row["sink_columns"]).alias("sink_columns"),
    )
    both = waiting.unionByName(routes).withWatermark("et", delay)
    return both.groupBy("table", "type", "slot").transformWithStateInPandas(Waiting(keep_ms), ROUTED, "Append", "EventTime")
