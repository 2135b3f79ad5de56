"""Streams against batch, restarts and repeated micro-batches."""

import json

import pytest
from pyspark.sql import functions as F

from rtdw.operators import changes, dims, keywords, logs, traffic
from rtdw.session import run_dir, shared_dir
from rtdw.sources import routes, schemas, tables, topics
from rtdw.streaming import jobs, runner, sinks, visitors

DAY = 24 * 60 * 60 * 1000


def put(spark, root, part, records):
    """One part of a file topic; ``records`` are (seq, value) pairs."""
    rows = [(seq, v if isinstance(v, str) else json.dumps(v)) for seq, v in records]
    spark.createDataFrame(rows, topics.TOPIC_FILES).coalesce(1).write.parquet(f"{root}/in/part={part}")


def source(spark, root, streaming=True):
    return topics.read_topic(spark, path=f"{root}/in/*", streaming=streaming)


def log(i, day, mid=None, **more):
    mid = mid or f"m{i * i % 7}"
    common = {"mid": mid, "is_new": str(i % 3 % 2), "vc": "1", "ch": f"c{i % 2}", "ar": "x", "sid": f"{mid}-{day}-{i % 2}"}
    page = {"page_id": "p", "during_time": i, "last_page_id": "home", "item_type": "keyword", "item": f"w{i % 3} W1"}
    return {"common": common, "ts": day * DAY + i * 700, "page": page, **more}


PARTS = [
    [(i, log(i, 1, displays=[{"item": "a"}] * (i % 3))) for i in range(20)] + [(900, "broken")],
    [(i, log(i, 2, err={"c": i})) for i in range(20, 40)],
    [(i, log(i, 3, start={"entry": "icon"})) for i in range(40, 60)],
]


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_log_job_equals_batch(spark, root):
    for number, part in enumerate(PARTS):
        put(spark, root, number, part)
        runner.finish(jobs.split_logs(source(spark, root), root))
    # Nothing new: the job starts, finds nothing and stops.
    runner.finish(jobs.split_logs(source(spark, root), root))
    streamed = spark.read.schema(sinks.TOPIC_ROWS).parquet(f"{root}/topics").select("seq", "topic", "value")
    whole = source(spark, root, streaming=False)
    batch = logs.fan_out(logs.fix_new_visitors(logs.parse_logs(whole)))
    assert rows_of(streamed) == rows_of(batch.select("seq", "topic", "value"))
    assert [r.seq for r in spark.read.parquet(f"{root}/dead").collect()] == [900]
    one = topics.read_topic(spark, path=sinks.topic_files(f"{root}/topics", schemas.TOPIC_PAGE), streaming=False)
    assert one.count() == 60


TRAFFIC = (
    "stt string, edt string, cur_date string, vc string, ch string, ar string, is_new string, "
    "uv_ct bigint, sv_ct bigint, pv_ct bigint, dur_sum bigint"
)


def test_traffic_job_equals_batch(spark, root):
    for number, part in enumerate(PARTS):
        put(spark, root, number, part)
        if number == 2:
            whole = source(spark, root, streaming=False)
            topics.closing_row(whole).coalesce(1).write.parquet(f"{root}/in/part=closing")
        runner.finish(jobs.split_logs(source(spark, root), root))
        pages = topics.read_topic(spark, path=sinks.topic_files(f"{root}/topics", schemas.TOPIC_PAGE))
        runner.finish(jobs.sum_traffic(pages, root))
    report = sinks.read_report(spark, f"{root}/traffic_windows", TRAFFIC)
    views = traffic.parse_pages(logs.fix_new_visitors(logs.parse_logs(whole)))
    assert report.count() >= 20
    assert rows_of(report.select(*schemas.TRAFFIC_WINDOW)) == rows_of(traffic.traffic_report(views))


def test_sessions_are_forgotten(spark, root):
    """A session counts again once it had no view for the time that it is kept."""
    for number, (day, sid) in enumerate([(1, "s"), (2, "s"), (2, "s"), (9, "t"), (9, "s")]):
        common = {"mid": "m", "is_new": "0", "sid": sid}
        put(spark, root, number, [(number, {"common": common, "ts": day * DAY + number, "page": {}})])
        pages = traffic.parse_pages(logs.parse_logs(source(spark, root)))
        views = visitors.flagged_views(pages, "1 second", session_kept_ms=3 * DAY).select("seq", "uv", "sv")
        runner.finish(runner.run_file_sink(views, f"{root}/views", f"{root}/_checkpoints/views"))
    # The other session's view moves the watermark past the first one's time.
    assert rows_of(spark.read.parquet(f"{root}/views")) == [(0, 1, 1), (1, 1, 0), (2, 0, 0), (3, 1, 1), (4, 0, 1)]


def test_visitor_state_follows_the_rules(spark, root):
    """The first record of the first micro-batch settles a visitor's day, whatever earlier times come later."""
    record = lambda day, is_new: {"common": {"mid": "m", "is_new": is_new}, "ts": day * DAY}
    parts = [[(1, record(5, "1")), (0, record(6, "1"))], [(2, record(4, "1")), (3, record(5, "1"))], [(4, record(5, "0"))]]
    for number, part in enumerate(parts):
        put(spark, root, number, part)
        rows = visitors.fixed_logs(source(spark, root)).select("seq", "is_new")
        runner.finish(runner.run_file_sink(rows, f"{root}/flags", f"{root}/_checkpoints/flags"))
    assert rows_of(spark.read.parquet(f"{root}/flags")) == [(0, "0"), (1, "1"), (2, "0"), (3, "1"), (4, "0")]


def test_report_repeats_and_folds(spark, root):
    schema = "cur_date string, n bigint"
    write = sinks.write_report(root)
    frames = [spark.createDataFrame(rows, schema) for rows in ([("d1", 1), ("d2", 2)], [("d1", 3)], [("d2", 4)])]
    for number, frame in enumerate(frames):
        write(frame, number)
    write(frames[1], 1)
    everything = [("d1", 1), ("d1", 3), ("d2", 2), ("d2", 4)]
    assert rows_of(sinks.read_report(spark, root, schema)) == everything
    sinks.compact_report(spark, root, "d1", schema)
    sinks.compact_report(spark, root, "d1", schema)
    sinks.compact_report(spark, root, "none", schema)
    assert rows_of(sinks.read_report(spark, root, schema)) == everything


def test_keyword_job_equals_batch_on_closed_windows(spark, root):
    for number, part in enumerate(PARTS):
        put(spark, root, number, part)
        runner.finish(jobs.count_keywords(source(spark, root), root))
    report = sinks.read_report(
        spark, f"{root}/keyword_windows", "stt string, edt string, cur_date string, keyword string, keyword_count bigint"
    )
    pages = topics.page_table(source(spark, root, streaming=False), watermark=None)
    last = pages.agg(F.max("ts")).first()[0]
    batch = keywords.keyword_windows(pages).filter(F.unix_millis(F.to_timestamp("edt")) <= last - 5000)
    assert report.count() > 10
    assert rows_of(report.select(*schemas.KEYWORD_WINDOW)) == rows_of(batch)


def change(table, type, data, ts=5):
    return {"database": "shop", "table": table, "type": type, "data": data, "ts": ts}


def user(i):
    kind = ("insert", "update", "update", "delete")[i * i % 7 % 4]
    return change("user_info", kind, {"id": f"{i % 5}", "name": None if i % 3 else f"n{i}", "login_name": f"l{i}", "x": "y"})


def test_dimension_job_equals_batch(spark, root):
    parts = [[(i, user(i)) for i in range(n * 10, n * 10 + 10)] for n in range(3)]
    store = sinks.DimensionTables(spark, f"{root}/dims")
    assert store.rows().count() == 0 and store.compact() is None
    for number, part in enumerate(parts):
        put(spark, root, number, part)
        runner.finish(jobs.update_dimensions(source(spark, root), root, "shop", lambda: routes.dim_routes(spark)))
        if number == 1:
            assert store.compact() == 1 and store.compact() is None
    whole = changes.dim_changes(source(spark, root, streaming=False), "shop")
    routed = changes.prune_columns(changes.route_dims(whole, routes.dim_routes(spark)))
    for merge in ("column", "row"):
        expected = {r.row_key: r["data"] for r in dims.upsert(routed, merge=merge).collect()}
        assert {r.row_key: r["data"] for r in store.rows(merge).collect()} == expected


def test_dimension_columns_may_change_between_batches(spark, root):
    store = sinks.DimensionTables(spark, f"{root}/dims")

    def write(batch_id, seq, data, columns):
        row = [(seq, "t", "k", "update", data)]
        schema = "seq bigint, sink_table string, row_key string, op_type string, data map<string,string>"
        store.write(spark.createDataFrame(row, schema), batch_id, columns)

    write(0, 1, {"a": "1"}, ["a"])
    write(1, 2, {"b": "2"}, ["b"])
    assert store.rows().first()["data"] == {"a": "1", "b": "2"}
    store.compact()
    write(2, 3, {"c": "3", "a": "4"}, ["a", "c"])
    assert store.rows().first()["data"] == {"a": "4", "b": "2", "c": "3"}


def test_facts_follow_the_configuration_between_batches(spark, root):
    config = {"now": [("t", "insert", "first", "id")]}
    read = lambda: spark.createDataFrame(config["now"], schemas.FACT_ROUTE)
    put(spark, root, 0, [(0, change("t", "insert", {"id": "1", "x": "y"})), (1, change("u", "insert", {"id": "2"}))])
    runner.finish(jobs.route_facts(source(spark, root), root, "shop", read))
    config["now"] = [("t", "insert", "second", "id,x"), ("u", "insert", "third", "id")]
    put(spark, root, 1, [(2, change("t", "insert", {"id": "3", "x": None})), (3, change("u", "insert", {"id": "4"}))])
    runner.finish(jobs.route_facts(source(spark, root), root, "shop", read))
    found = spark.read.schema(sinks.TOPIC_ROWS).parquet(f"{root}/topics").select("seq", "topic", "value")
    assert rows_of(found) == [(0, "first", '{"id":"1"}'), (2, "second", '{"id":"3"}'), (3, "third", '{"id":"4"}')]


def test_facts_follow_the_captured_configuration(spark, root):
    def capture(seq, op, sink):
        row = {"source_table": "t", "source_type": "insert", "sink_table": sink, "sink_columns": "id"}
        image = {"before": row} if op == "d" else {"after": row}
        return (seq, json.dumps({"op": op, **image, "source": {"db": "config", "table": "process"}, "ts_ms": seq}))

    history = [capture(0, "r", "first")]
    config = lambda: spark.createDataFrame(history, topics.TOPIC_FILES)
    read = jobs.live_fact_routes(config, "process")
    kept = []
    sink = lambda batch, _batch_id: kept.extend(batch.collect())
    for number in range(3):
        put(spark, root, number, [(2 * number, change("t", "insert", {"id": "1"})), (2 * number + 1, "broken")])
        runner.finish(jobs.route_facts(source(spark, root), root, "shop", read, sink=sink))
        history.append(capture(number + 1, "u", "second") if number == 0 else capture(number + 1, "d", "second"))
        if number == 0:
            history.append(capture(1, "d", "first"))
    assert [(r.seq, r.topic) for r in kept] == [(0, "first"), (2, "second")]
    assert sorted(r.seq for r in spark.read.parquet(f"{root}/dead_facts").collect()) == [1, 3, 5]


def test_dimension_changes_are_published(spark, root):
    put(spark, root, 0, [(0, user(0)), (1, "broken"), (2, user(2))])
    runner.finish(jobs.update_dimensions(source(spark, root), root, "shop", lambda: routes.dim_routes(spark)))
    one = topics.read_topic(spark, path=sinks.topic_files(f"{root}/topics", schemas.TOPIC_DIM), streaming=False)
    found = {r.seq: json.loads(r.value) for r in one.collect()}
    assert sorted(found) == [0, 2]
    assert found[0]["op_type"] == "insert" and found[0]["row_key"] == "0" and "x" not in found[0]["data"]
    assert [r.seq for r in spark.read.parquet(f"{root}/dead_dims").collect()] == [1]


def test_comments_follow_the_dictionary_between_batches(spark, root):
    names = {"now": "good"}
    read = lambda: tables.dictionary(
        spark.createDataFrame([("1", names["now"])], "dic_code string, dic_name string")
    )
    for number in range(2):
        put(spark, root, number, [(number, change("comment_info", "insert", {"id": "c", "appraise": "1"}))])
        runner.finish(jobs.publish_comments(source(spark, root), root, "shop", read))
        names["now"] = "fine"
    found = spark.read.schema(sinks.TOPIC_ROWS).parquet(f"{root}/topics").orderBy("seq").collect()
    assert [json.loads(r.value)["appraise_name"] for r in found] == ["good", "fine"]
    assert {r.topic for r in found} == {schemas.TOPIC_COMMENT}


def test_captures_become_the_change_topic(spark, root):
    row = {"op": "c", "after": {"id": 1}, "source": {"db": "shop", "table": "t"}, "ts_ms": 5999}
    put(spark, root, 0, [(0, row), (1, "broken"), (2, {**row, "source": {"db": "shop", "table": "other"}})])
    runner.finish(jobs.publish_captures(source(spark, root), root, ["t"]))
    back = topics.read_topic(spark, path=f"{root}/{schemas.TOPIC_DB}", streaming=False).collect()
    assert [(r.seq, json.loads(r.value)) for r in back] == [
        (0, {"database": "shop", "table": "t", "type": "insert", "data": {"id": "1"}, "ts": 5})
    ]


def test_a_repeated_batch_changes_nothing(spark, root):
    first = spark.createDataFrame([(1, "a")], "seq bigint, value string")
    other = spark.createDataFrame([(2, "b")], "seq bigint, value string")
    runner.write_batch_once(first, root, 0)
    runner.write_batch_once(other, root, 0)
    assert [r.seq for r in spark.read.parquet(root).collect()] == [1]


def test_keyed_topic(spark, root):
    write = sinks.write_keyed_topic(f"{root}/keyed", "k")
    schema = "k string, value string, seq bigint"
    write(spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("b", "1", 3)], schema), 0)
    write(spark.createDataFrame([("b", None, 4), ("c", "5", 5)], schema), 1)
    assert rows_of(sinks.read_keyed_topic(spark, f"{root}/keyed")) == [("a", "2"), ("c", "5")]


def test_text_topic(spark, tmp_path):
    (tmp_path / "log.txt").write_text('{"a":1}\nbroken\n')
    stream = topics.read_text_topic(spark, str(tmp_path))
    assert stream.isStreaming
    rows = logs.json_logs(topics.read_text_topic(spark, str(tmp_path), streaming=False))
    assert rows.count() == 1


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        topics.read_topic(spark, "t", servers="nowhere:1")


def test_shared_dir_is_the_configured_one(spark):
    assert run_dir(spark, "x").startswith(shared_dir(spark) + "/x-")
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
