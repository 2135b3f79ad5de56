"""Lookups as of a time and snapshots by chunks against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from rtdw.operators.versions import lookup_as_of
from rtdw.sources.changelog import latest_rows, merge_chunks

CAPTURE = (
    "seq bigint, op string, before map<string,string>, after map<string,string>, "
    "source struct<db: string, `table`: string>, ts_ms bigint"
)


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_lookup_as_of(spark, width):
    """Ties in time, times before all versions, one key with most rows, rows without key or time, versions without either."""
    rng = random.Random(width)
    versions = [(rng.choice("abc"), t, f"v{t}") for t in rng.sample(range(-50, 200), 40)]
    versions += [("a", 60, "x"), ("a", 60, "y"), (None, 5, "n"), ("b", None, "n")]
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", "d", None]), rng.choice([None, *range(-60, 260)])) for i in range(400)]
    rows += [(900, "a", 60), (900, "a", 60)]
    found = lookup_as_of(
        spark.createDataFrame(rows, "id int, k string, at bigint"),
        spark.createDataFrame(versions, "k string, since bigint, name string"),
        ["k"], "at", "since", "dic", width,
    )
    got = sorted((r.id, r.k or "", -999 if r.at is None else r.at, r.dic.name if r.dic else "") for r in found.collect())

    def expected(key, at):
        known = [(since, name) for k, since, name in versions if key is not None and k == key and since is not None and at is not None and since <= at]
        return max(known)[1] if known else ""

    assert got == sorted((i, k or "", -999 if at is None else at, expected(k, at)) for i, k, at in rows)


def test_lookup_as_of_in_empty_tables(spark):
    rows = spark.createDataFrame([(1, "a", 5)], "id int, k string, at bigint")
    versions = spark.createDataFrame([("a", 1, "n")], "k string, since bigint, name string")
    assert [r.dic for r in lookup_as_of(rows, versions.limit(0), ["k"], "at", "since", "dic", 10).collect()] == [None]
    assert lookup_as_of(rows.limit(0), versions, ["k"], "at", "since", "dic", 10).count() == 0


@pytest.mark.parametrize("size", [1, 3, 50])
def test_chunks_give_the_table(spark, size):
    """Chunks are read while rows are put, deleted and put again; reads see any part of their window."""
    rng = random.Random(size)
    start = {k: f"s{k}" for k in range(20)}
    log = []
    for seq in range(300):
        key = rng.randrange(24)
        log.append((seq, rng.choice("cuud"), key))
    marks, chunks = [], []
    for chunk in range(24 // size + 1):
        low = chunk * 300 // (24 // size + 1) - 1
        high = low + 10
        read = rng.randint(low, high)
        marks.append((chunk, low, high))
        state = dict(start)
        for seq, op, key in log:
            if seq <= read:
                state.pop(key, None) if op == "d" else state.update({key: f"n{seq}"})
        for key, name in state.items():
            if key // size == chunk:
                chunks.append((-1, "r", None, {"id": str(key), "name": name}, ("shop", "t"), 0, chunk))
    final = dict(start)
    captures = []
    for seq, op, key in log:
        final.pop(key, None) if op == "d" else final.update({key: f"n{seq}"})
        row = {"id": str(key), "name": f"n{seq}"}
        captures.append((seq, op, row if op == "d" else None, None if op == "d" else row, ("shop", "t"), 0))
    history = merge_chunks(
        spark.createDataFrame(chunks, CAPTURE + ", chunk bigint"),
        spark.createDataFrame(marks, "chunk bigint, low bigint, high bigint"),
        spark.createDataFrame(captures, CAPTURE),
        "id",
        F.floor(F.col("key").cast("bigint") / size),
    )
    last = latest_rows(history, "id").where("op <> 'd'").collect()
    assert {int(r.key): r.row["name"] for r in last} == final
