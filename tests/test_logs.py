import json

import pytest
from pyspark.sql import functions as F

from rtdw.operators import logs, traffic
from rtdw.sources.schemas import TRAFFIC_WINDOW

DAY = 24 * 60 * 60 * 1000


def topic(spark, *records):
    values = [r if isinstance(r, str) else json.dumps(r) for r in records]
    return spark.createDataFrame(list(enumerate(values)), "seq bigint, value string")


def log(mid, day, is_new, **more):
    return {"common": {"mid": mid, "is_new": is_new}, "ts": day * DAY + 1000, **more}


def flags(logs_frame):
    return [r.is_new for r in logs_frame.orderBy("seq").collect()]


VISITS = [log("a", 1, "1"), log("a", 1, "1"), log("a", 2, "1"), log("a", 2, "0"), log("b", 3, "0"), log("b", 3, "1")]


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_new_visitor_rules(spark, hot_rows):
    fixed = logs.fix_new_visitors(logs.parse_logs(topic(spark, *VISITS)), hot_rows=hot_rows)
    assert flags(fixed) == ["1", "1", "0", "0", "0", "0"]
    inside = fixed.select("seq", F.to_json("common").alias("c")).orderBy("seq").collect()
    assert json.loads(inside[2].c) == {"mid": "a", "is_new": "0"}


def test_first_visits_and_openers_are_hash_aggregates(spark, capsys):
    parsed = logs.parse_logs(topic(spark, *VISITS))
    for frame in (logs.fix_new_visitors(parsed), traffic.flag_visits(traffic.parse_pages(parsed))):
        frame.explain()
        plan = capsys.readouterr().out
        assert "HashAggregate" in plan and "SortAggregate" not in plan


def sequential_flags(records):
    """The rules as they are told: one state per visitor, records in order."""
    state, out = {}, []
    for rec in sorted(records, key=lambda r: r["ts"]):
        mid, flag, day = rec["common"]["mid"], rec["common"]["is_new"], rec["ts"] // DAY
        if flag == "1":
            if mid not in state:
                state[mid] = day
            elif state[mid] != day:
                flag = "0"
        elif mid not in state:
            state[mid] = day - 1
        out.append((rec["ts"], mid, flag))
    return out


def test_new_visitors_against_the_sequential_rules(spark):
    records = [
        {"common": {"mid": f"m{i * 7 % 5}", "is_new": str(i * 11 % 3 % 2)}, "ts": (i * 37 % 100) * DAY // 10 + i}
        for i in range(200)
    ]
    fixed = logs.fix_new_visitors(logs.parse_logs(topic(spark, *records)), hot_rows=30)
    assert sorted((r.ts, r.mid, r.is_new) for r in fixed.collect()) == sorted(sequential_flags(records))


def test_dead_letters(spark):
    rows = ["not json", "{}", "[1]", {"common": {"mid": "a"}}, {"common": {}, "ts": 5}, {"common": {"mid": "a"}, "ts": 5}]
    frame = topic(spark, *rows)
    assert [r.seq for r in logs.parse_logs(frame).collect()] == [5]
    reasons = {r.seq: r.reason for r in logs.dead_letters(frame).collect()}
    assert reasons == {
        0: "not a JSON object", 1: "no visitor", 2: "not a JSON object", 3: "no time", 4: "no visitor"
    }


RICH = {
    "common": {"mid": "a", "is_new": "1", "ch": "web"},
    "ts": 5000,
    "start": {"entry": "icon"},
    "displays": [{"item": "1", "ch": "own", "ts": 1, "mid": "x"}, {"item": "2"}],
    "actions": [{"action_id": "add", "ts": 77, "mid": "x"}],
    "err": {"code": 3},
    "page": {"page_id": "p"},
    "extra": [1, {"deep": None}],
    "nothing": None,
}


def records(branch):
    return [json.loads(r.j) for r in branch.select(F.to_json("record").alias("j")).collect()]


def test_branches(spark):
    parsed = logs.parse_logs(topic(spark, RICH))
    assert records(logs.start_records(parsed)) == [RICH]
    without = {k: v for k, v in RICH.items() if k not in ("displays", "actions")}
    assert records(logs.err_records(parsed)) == [without]
    assert records(logs.page_records(parsed)) == [{k: v for k, v in without.items() if k != "err"}]
    common = RICH["common"]
    assert records(logs.display_records(parsed)) == [{"item": "1", **common, "ts": 5000}, {"item": "2", **common, "ts": 5000}]
    assert records(logs.action_records(parsed)) == [{"action_id": "add", "ts": 77, **common}]


def test_absent_and_null_parts_give_nothing(spark):
    bare = {"common": {"mid": "a"}, "ts": 1, "start": None, "displays": [], "actions": None, "err": None}
    assert logs.fan_out(logs.parse_logs(topic(spark, bare))).count() == 0


def test_fan_out_is_all_branches(spark):
    rows = logs.fan_out(logs.parse_logs(topic(spark, RICH))).collect()
    assert sorted(r.topic for r in rows) == [
        "dwd_traffic_action", "dwd_traffic_display", "dwd_traffic_display", "dwd_traffic_err", "dwd_traffic_page",
        "dwd_traffic_start",
    ]
    start = next(json.loads(r.value) for r in rows if r.topic == "dwd_traffic_start")
    assert "nothing" not in start and start["extra"] == [1, {}]


def page(mid, sid, ms, ch="web", dur=10):
    common = {"mid": mid, "is_new": "0", "vc": "1", "ch": ch, "ar": "x", "sid": sid}
    return {"common": common, "ts": ms, "page": {"during_time": dur}}


PAGES = [page("a", "s1", 1000), page("a", "s1", 6000), page("a", "s2", 7000, ch="app"), page("a", "s2", DAY + 1, dur=None),
         page("b", None, 1000), {"common": {"mid": "c"}, "ts": 3}]


def test_visit_flags(spark):
    pages = traffic.parse_pages(logs.parse_logs(topic(spark, *PAGES)))
    rows = traffic.flag_visits(pages).orderBy("seq").collect()
    assert [(r.uv, r.sv) for r in rows] == [(1, 1), (0, 0), (0, 1), (1, 0), (1, 0)]


def test_traffic_windows(spark):
    pages = traffic.parse_pages(logs.parse_logs(topic(spark, *PAGES)))
    report = traffic.traffic_report(pages)
    assert report.columns == TRAFFIC_WINDOW
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, traffic.traffic_windows(traffic.flag_visits(pages)).collect()))
    first = report.orderBy("stt", "ch").first()
    assert tuple(first) == ("1970-01-01 00:00:00", "1970-01-01 00:00:05", "19700101", "1", "web", "x", "0", 2, 1, 2, 20)


def test_report_json(spark):
    report = spark.createDataFrame([("s", 1, 5, "x", None)], "stt string, uvCt int, ts int, sid string, ar string")
    assert traffic.report_json(report).first().value == '{"stt":"s","uv_ct":1}'


def test_elements_that_are_no_objects(spark):
    rows = topic(spark, log("a", 1, "1", displays=[{"item": "1"}, "odd", {"item": "2"}], actions=[{"id": "x"}, 3]))
    parsed = logs.parse_logs(rows)
    sent = logs.fan_out(parsed).collect()
    assert len(sent) == 3 and all(r.value for r in sent)
    assert logs.display_records(parsed).count() == 2
    assert logs.dead_letters(rows).first().reason == "a display is no object"
