"""Keyed state in sessions that were not built here, and in Python workers that do not find this package."""

import subprocess
import sys

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from rtdw import session
from rtdw.plans import adapters
from rtdw.sources import schemas, topics
from rtdw.streaming import held, jobs, runner, visitors
from tests.test_streams import PARTS, put, source

DEFAULT_STORE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


@pytest.mark.parametrize("processor", [visitors.FirstDay(), visitors.Opening("uv", 1), held.Waiting(1)], ids=lambda p: type(p).__name__)
def test_processors_load_without_the_package(processor):
    """As in the driver's worker of the state operator, whose path has no shipped files."""
    code = "import pickle, sys; print(type(pickle.load(sys.stdin.buffer)).__name__)"
    done = subprocess.run([sys.executable, "-I", "-c", code], input=cloudpickle.dumps(processor), capture_output=True, cwd="/", check=False)
    assert done.stdout.decode().strip() == type(processor).__name__, done.stderr.decode()


def test_a_session_with_the_default_store_keeps_state(spark, root):
    put(spark, root, 0, PARTS[0])
    plain = spark.newSession()
    plain.conf.set(session.PROVIDER, DEFAULT_STORE)
    rows = visitors.fixed_logs(topics.read_topic(plain, path=f"{root}/in/*")).select("seq", "is_new")
    runner.finish(runner.run_file_sink(rows, f"{root}/flags", f"{root}/_checkpoints/flags"))
    assert spark.read.parquet(f"{root}/flags").count() == 20


def test_a_chosen_store_stays(spark):
    other = spark.newSession()
    other.conf.set(session.PROVIDER, "org.example.OwnProvider")
    session.keyed_state(other)
    assert other.conf.get(session.PROVIDER) == "org.example.OwnProvider"


def change(seq, hour, kind="insert", table="t"):
    return (seq, {"database": "shop", "table": table, "type": kind, "data": {"id": str(seq)}, "ts": hour * 3600})


def capture(spark, root, part, hour, op="c"):
    rows = spark.createDataFrame([("t", "insert", "sink", "id")], schemas.FACT_ROUTE)
    adapters.route_captures(rows, "routes", op, hour * held.HOUR_MS).write.parquet(f"{root}/config/part={part}")


def test_waiting_changes_leave_by_their_hour(spark, root):
    """Only what is due leaves without a route; the rest waits on and takes the route; nothing is lost or told twice."""
    many = [change(i, 1) for i in range(2 * held.HELD + 5)]
    parts = [[*many, change(9001, 3), change(9002, 3, "update")], [change(9003, 8, table="-")], [change(9004, 8)], [change(9005, 40, table="-")]]
    for number, part in enumerate(parts):
        put(spark, root, number, part)
        capture(spark, root, number, 8 if number == 2 else 0, "c" if number == 2 else "d")
        stream, config = source(spark, root), topics.read_topic(spark, path=f"{root}/config/*")
        runner.finish(jobs.route_late_facts(stream, config, root, "shop", keep_ms=4 * held.HOUR_MS, slots=1))
    out = {r.seq: r.sink_table for r in spark.read.schema(held.ROUTED).parquet(f"{root}/routed").collect()}
    assert spark.read.schema(held.ROUTED).parquet(f"{root}/routed").count() == len(out)
    assert out == {**{seq: None for seq, _ in many}, 9001: "sink", 9002: None, 9003: None, 9004: "sink"}


def test_a_wake_does_not_read_what_is_not_due():
    """A thousand hours that end one by one: each is read once (a whole list was read at every timer)."""

    class Value:
        now = None

        def exists(self):
            return self.now is not None

        def get(self):
            return self.now

        def update(self, value):
            self.now = value

        def clear(self):
            self.now = None

    class Map(dict):
        read = 0

        def getValue(self, key):
            self.read += 1
            return self[key]

        def values(self):
            self.read += len(self)
            return list(super().values())

        removeKey, updateValue = dict.pop, dict.__setitem__

    class Handle(set):
        registerTimer, deleteTimer = set.add, set.discard

    waiting = held.Waiting(0)
    waiting.handle, waiting.route, waiting.held, waiting.next = Handle(), Value(), Map(), Value()
    n = 1000
    rows = pd.DataFrame({"seq": range(n), "ms": [i * held.HOUR_MS for i in range(n)], "value": "v", "sink_table": None, "sink_columns": None})
    assert list(waiting.handleInputRows(("t", "insert"), iter([rows]), None)) == []
    seqs = []
    while waiting.handle:
        moment = waiting.handle.pop()
        for out in waiting.handleExpiredTimer(("t", "insert"), TimerValues(0, moment), ExpiredTimerInfo(moment)):
            seqs += out["seq"].tolist()
    assert seqs == list(range(n)) and waiting.held.read == n and not waiting.held
