"""First views of visitors' days and of sessions: by slots of many names, with few calls a name."""

import pandas as pd
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from rtdw import session
from rtdw.operators import logs, traffic
from rtdw.sources import topics
from rtdw.streaming import runner, visitors
from tests.test_streams import DAY, put, rows_of, source


class Value:
    now = None

    def exists(self):
        return self.now is not None

    def update(self, value):
        self.now = value

    def clear(self):
        self.now = None


class Map(dict):
    read = written = 0

    def getValue(self, key):
        self.read += 1
        return self.get(key)

    def updateValue(self, key, value):
        self.written += 1
        self[key] = value

    def iterator(self):
        return iter(list(self.items()))

    removeKey = dict.pop


class Handle(set):
    registerTimer = set.add


def opening(keep_ms):
    processor = visitors.Opening("sv", keep_ms, "sid")
    processor.handle, processor.until, processor.wake = Handle(), Map(), Value()
    return processor


def flags(processor, views, now=0):
    """The flags of ``(sid, ts)`` views, numbered from 0, and how many frames came."""
    rows = pd.DataFrame({"sid": [sid for sid, _ in views], "ts": [ts for _, ts in views], "seq": range(len(views))})
    half = len(rows) // 2
    frames = list(processor.handleInputRows((0,), iter([rows[:half], rows[half:]]), TimerValues(0, now)))
    found = pd.concat(frames).set_index("seq")["sv"]
    return [int(found[i]) for i in range(len(views))], len(frames)


def test_a_slot_takes_many_names_in_few_frames_and_calls():
    """One state call to read and one to write a name, and as many frames as came in; a frame and six calls per name before."""
    processor = opening(100)
    views = [(f"s{i % 500}", 1000 - i) for i in range(1000)]
    found, frames = flags(processor, views)
    assert found == [0] * 500 + [1] * 500  # the later rows are the earlier views
    assert frames == 2 and processor.until.read == processor.until.written == 500 and len(processor.handle) == 1
    assert flags(processor, views)[0] == [0] * 1000
    assert processor.until.written == 500 and len(processor.handle) == 1


def test_rows_without_a_name_open_nothing():
    processor = opening(100)
    assert flags(processor, [(None, 5), ("a", 7), ("a", 6), (None, 1)])[0] == [0, 0, 1, 0]
    assert list(processor.until) == [("a",)]
    assert flags(processor, [(None, 5), (None, 6)])[0] == [0, 0]


def test_a_name_is_forgotten_by_its_last_view_wherever_the_timer_stands():
    processor = opening(100)
    assert flags(processor, [("a", 0), ("b", 0)])[0] == [1, 1]
    assert flags(processor, [("b", 60)], now=50)[0] == [0]
    # Both at 130, where a was due at 100 and b is at 160; the timer has not been there.
    assert flags(processor, [("a", 130), ("b", 130), ("a", 131)], now=120)[0] == [1, 0, 0]
    # Not forgotten while a view comes that is not behind its time.
    assert flags(processor, [("a", 231)], now=240)[0] == [0]


def test_sweeps_remove_what_is_due_and_end():
    for n_late in (3, 40):
        processor = opening(80)
        flags(processor, [(f"a{i}", 10) for i in range(20)] + [(f"b{i}", 70) for i in range(n_late)])
        moments = []
        while processor.handle:
            moment = processor.handle.pop()
            moments.append(moment)
            list(processor.handleExpiredTimer((0,), TimerValues(0, moment), ExpiredTimerInfo(moment)))
            assert all(until > moment for (until,) in processor.until.values())
        assert moments == [100, 160] and not processor.until and not processor.wake.exists()


def test_flags_of_many_visitors_equal_the_batch(spark, root):
    records = []
    for i in range(600):
        mid, day = f"m{i * 7 % 90}", 1 + i // 200
        common = {"mid": mid, "is_new": "0", "sid": None if i % 11 == 0 else f"{mid}-{i % 3}"}
        records.append((i, {"common": common, "ts": day * DAY + i * 7919 % 100_000, "page": {}}))
    for number in range(3):
        put(spark, root, number, records[200 * number : 200 * number + 200])
        views = visitors.flagged_views(traffic.parse_pages(logs.parse_logs(source(spark, root))), "1 second")
        runner.finish(runner.run_file_sink(views.select("seq", "uv", "sv"), f"{root}/views", f"{root}/_checkpoints/views"))
    whole = traffic.parse_pages(logs.parse_logs(topics.read_topic(spark, path=f"{root}/in/*", streaming=False)))
    assert rows_of(spark.read.parquet(f"{root}/views")) == rows_of(traffic.flag_visits(whole).select("seq", "uv", "sv"))


def test_small_stores_take_no_disk_in_advance(spark):
    """A store of a few rows held 4 MB, for each partition of each state step of each start of a stream."""
    plain, chosen = spark.newSession(), spark.newSession()
    chosen.conf.set(session.PREALLOCATED, "true")
    for own in (plain, chosen):
        session.keyed_state(own)
    assert plain.conf.get(session.PREALLOCATED) == "false" and chosen.conf.get(session.PREALLOCATED) == "true"
