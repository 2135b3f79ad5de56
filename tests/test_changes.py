import json

import pytest
from pyspark.sql import functions as F

from rtdw.operators import changes, dims, envelope, facts
from rtdw.operators.lookup import is_small, join_scattered, lookup
from rtdw.sources import changelog, routes, tables, topics
from rtdw.sources.schemas import CHANGE, DIM_ROUTE, FACT_ROUTE


def change(table="user_info", type="insert", data=None, database="shop", **more):
    return json.dumps({"database": database, "table": table, "type": type, "data": data, "ts": 100, **more})


def topic(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "seq bigint, value string")


def seqs(df):
    return sorted(r.seq for r in df.collect())


def test_typed_topic(spark):
    values = [change(data={"id": 7}), "{broken", '{"x": 1}', change(data={"id": "8"}, old="no map"), "[1]",
              f"[{change(data={'id': '9'})}]", "null", "7"]
    rows = {r.seq: r for r in topics.typed(topic(spark, *values), CHANGE).collect()}
    assert sorted(rows) == [0, 3]
    assert rows[0]["data"] == {"id": "7"} and rows[0]["ts"] == 100
    assert rows[3]["data"] == {"id": "8"} and rows[3]["old"] is None


def test_change_filters(spark):
    values = [
        change(data={"id": 1}),
        change(data={}),
        change(data=None),
        change(data={"id": 1}, type="delete"),
        change(data={"id": 1}, type="bootstrap-insert"),
        change(data={"id": 1}, database="other"),
        json.dumps(change(data={"id": 1})),
        "",
        f"[{change(data={'id': 1})}]",
    ]
    assert seqs(changes.fact_changes(topic(spark, *values), "shop")) == [0]
    assert seqs(changes.dim_changes(topic(spark, *values), "shop")) == [0, 3, 6]
    assert seqs(changes.unreadable_changes(topic(spark, *values))) == [7, 8]


def test_column_names_are_compared_as_written(spark):
    df = spark.sql("SELECT map('id', '1', 'name', 'a', ' name', 'b') AS data, 'id, name' AS sink_columns")
    assert changes.prune_columns(df).first()["data"] == {"id": "1", " name": "b"}


CONFIG = [
    (1, "r", "A", "x", "X", "id"),
    (2, "r", "B", "x", "Y", "id"),
    (3, "u", "A", "x", "X", "id,name"),
    (4, "u", "C", "x", "X", "id,name"),
    (5, "d", "B", "x", "Y", "id"),
    (6, "c", "B", "x", "Z", "id"),
    (7, "c", "C", "x", "W", "id"),
]
CONFIG_SCHEMA = "seq bigint, op string, source_table string, source_type string, sink_table string, sink_columns string"


def test_current_config(spark):
    config = spark.createDataFrame(CONFIG, CONFIG_SCHEMA)
    one = changes.current_config(config, ["source_table", "source_type"]).collect()
    assert {(r.source_table, r.sink_table) for r in one} == {("B", "Z"), ("C", "W")}
    several = changes.current_config(config, ["source_table", "source_type"], multi_route=True).collect()
    assert {(r.source_table, r.sink_table) for r in several} == {("B", "Z"), ("C", "W"), ("C", "X")}


def test_config_from_captures(spark):
    row = {"source_table": "A", "source_type": "insert", "sink_table": "X", "sink_columns": "id"}
    values = [
        json.dumps({"op": "r", "before": None, "after": row}),
        json.dumps({"op": "c", "before": None, "after": {**row, "sink_table": "Y", "source_table": "B"}}),
        json.dumps({"op": "d", "before": {**row, "sink_table": "Y", "source_table": "B"}, "after": None}),
    ]
    config = changes.fact_config(changelog.read_captures(topic(spark, *values)))
    assert [tuple(r) for r in config.collect()] == [("A", "insert", "X", "id")]
    assert config.columns == [c.split()[0] for c in FACT_ROUTE.split(", ")]


@pytest.mark.parametrize("max_broadcast_rows", [100, 0])
def test_several_routes_of_one_source(spark, max_broadcast_rows):
    config = spark.createDataFrame([("A", "X", "f", "id", "id"), ("A", "Y", "f", "name", "id")], DIM_ROUTE)
    values = [change("A", data={"id": "1", "name": "n"}), change("B", data={"id": "2"})]
    routed = changes.route_dims(changes.dim_changes(topic(spark, *values), "shop"), config, max_broadcast_rows)
    rows = changes.prune_columns(routed).collect()
    assert sorted((r.sink_table, r.row_key, r.op_type, tuple(r["data"])) for r in rows) == [
        ("X", "1", "insert", ("id",)),
        ("Y", "1", "insert", ("name",)),
    ]


def test_first_routes(spark):
    assert routes.fact_routes(spark).count() == 4
    keys = {r.sink_table: r.sink_row_key for r in routes.dim_routes(spark).collect()}
    assert len(keys) == 16 and keys.pop("dim_base_dic") == "dic_code" and set(keys.values()) == {"id"}


def test_captures_become_change_records(spark):
    source = {"db": "shop", "table": "t"}
    values = [
        json.dumps({"op": "r", "before": None, "after": {"id": 1}, "source": source, "ts_ms": 1999}),
        json.dumps({"op": "u", "before": {"id": 1, "a": "x", "b": None}, "after": {"id": 1, "a": "y", "b": None},
                    "source": source, "ts_ms": 2000}),
        json.dumps({"op": "d", "before": {"id": 1}, "after": None, "source": source, "ts_ms": 3000}),
        json.dumps({"op": "d", "before": {"id": 1}, "after": None, "source": {"db": "shop", "table": "u"}}),
        "{}",
    ]
    captures = changelog.read_captures(topic(spark, *values), ["t"])
    rows = [tuple(r) for r in envelope.to_change_records(captures).orderBy("seq").collect()]
    assert rows == [
        (0, "shop", "t", "insert", {"id": "1"}, None, 1),
        (1, "shop", "t", "update", {"id": "1", "a": "y", "b": None}, {"a": "x"}, 2),
        (2, "shop", "t", "delete", {"id": "1"}, None, 3),
    ]


def test_snapshot_comes_before_changes(spark):
    users = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, name string")
    values = [
        json.dumps({"op": "u", "before": {"id": 1}, "after": {"id": 1, "name": "z"}, "source": {"db": "s", "table": "t"}}),
        json.dumps({"op": "d", "before": {"id": 2, "name": "b"}, "source": {"db": "s", "table": "t"}}),
    ]
    snapshot = changelog.snapshot_rows(users, "s", "t")
    history = changelog.snapshot_then_changes(snapshot, changelog.read_captures(topic(spark, *values)))
    rows = {r.key: (r.op, r.row["name"]) for r in changelog.latest_rows(history, "id").collect()}
    assert rows == {"1": ("u", "z"), "2": ("d", "b"), "3": ("r", "c")}


PUTS = [
    (1, "insert", {"a": "1", "b": "2"}),
    (2, "update", {"a": None, "b": "3"}),
    (3, "delete", {"a": "1", "b": "3"}),
    (4, "insert", {"a": "9"}),
]


def dim_changes(spark, rows, key="k", table="t"):
    rows = [(seq, table, key, op, data) for seq, op, data in rows]
    return spark.createDataFrame(
        rows, "seq bigint, sink_table string, row_key string, op_type string, data map<string,string>"
    )


def test_upsert(spark):
    def state(rows, merge):
        found = dims.upsert(dim_changes(spark, rows), ["a", "b"], merge).collect()
        return found[0]["data"] if found else None

    assert state(PUTS[:2], "column") == {"a": "1", "b": "3"}
    assert state(PUTS[:2], "row") == {"b": "3"}
    assert state(PUTS[:3], "column") is None and state(PUTS[:3], "row") is None
    assert state(PUTS, "column") == {"a": "9"} and state(PUTS, "row") == {"a": "9"}
    assert state([(1, "insert", {"a": None})], "column") is None
    with pytest.raises(ValueError):
        state(PUTS, "cell")


def test_reduced_changes_merge_to_the_same(spark):
    whole = dims.reduce_changes(dim_changes(spark, PUTS), ["a", "b"])
    parts = dims.reduce_changes(dim_changes(spark, PUTS[2:]), ["a", "b"]).unionByName(
        dims.reduce_changes(dim_changes(spark, PUTS[:2]), ["a", "b"])
    )
    for merge in ("column", "row"):
        assert dims.live_rows(dims.merge_reduced(parts), merge).collect() == dims.live_rows(whole, merge).collect()


def test_keyed_topic(spark):
    rows = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("b", "1", 3), ("b", None, 4)], "key string, value string, seq int")
    assert [tuple(r) for r in dims.upsert_latest(rows).collect()] == [("a", "2")]


def test_lifecycle(spark):
    config = spark.createDataFrame(
        [(1, "c", "T"), (3, "u", "T"), (5, "c", "T"), (1, "r", "D"), (4, "d", "D"), (2, "r", "N")],
        "seq bigint, op string, sink_table string",
    )
    rows = spark.createDataFrame([(s, t) for t in ("T", "D", "N", "X") for s in (2, 4, 6)], "seq bigint, sink_table string")
    life = dims.table_lifecycle(config)
    for max_broadcast_rows in (100, 0):
        kept = dims.apply_lifecycle(rows, life, max_broadcast_rows).collect()
        assert sorted((r.sink_table, r.seq) for r in kept) == [("N", 2), ("N", 4), ("N", 6), ("T", 4), ("T", 6)]


@pytest.mark.parametrize("max_broadcast_rows", [100, 0])
def test_comment_lookup(spark, max_broadcast_rows):
    dictionary = tables.dictionary(spark.createDataFrame([("1201", "good"), ("1202", "bad")], "dic_code string, dic_name string"))
    values = [
        change("comment_info", data={"id": "1", "user_id": "u", "appraise": "1201", "create_time": "t"}),
        change("comment_info", data={"id": "2", "appraise": "1205"}),
        change("comment_info", data={"id": "3"}),
        change("comment_info", "update", data={"id": "4", "appraise": "1201"}),
    ]
    comments = facts.extract_comments(topics.change_table(topic(spark, *values)), "shop")
    assert "comment_time" in comments.columns
    found = facts.lookup_comments(comments, dictionary, max_broadcast_rows)
    assert [tuple(r) for r in found.collect()] == [(0, "1", "u", None, "1201", "good", None, 100)]


def test_lookup_of_hot_and_missing_keys(spark):
    """Every second row has one key, a tenth has none, and some keys are not in the side."""
    rows = spark.range(2000).select(
        "id", F.when(F.col("id") % 10 == 9, None).when(F.col("id") % 2 == 0, "hot").otherwise((F.col("id") % 20).cast("string")).alias("k")
    )
    side = spark.createDataFrame([("hot", 1), ("1", 2), ("3", 3)], "k string, v int")
    expected = rows.join(side, "k", "left").select("id", "k", "v").orderBy("id").collect()
    for hot_rows in (100, 10**6):
        found = lookup(rows, side, ["k"], "f", F.col("id"), hot_rows=hot_rows)
        assert found.select("id", "k", F.col("f.v").alias("v")).orderBy("id").collect() == expected
    counted = rows.filter("k is not null").groupBy("k").count().join(side, "k", "left")
    for hot_rows in (100, 10**6):
        found = lookup(rows, counted, ["k"], "f", F.col("id"), count_column="count", hot_rows=hot_rows)
        assert found.select("id", "k", F.col("f.v").alias("v")).orderBy("id").collect() == expected


@pytest.mark.parametrize("hot_rows", [100, 10**6])
def test_scattered_join_with_several_side_rows(spark, hot_rows):
    rows = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 9).cast("string")).alias("k"))
    side = spark.createDataFrame([("hot", 1), ("hot", 2), ("1", 3), ("1", 4), ("x", 5)], "k string, v int")
    expected = sorted(map(tuple, rows.join(side, "k").select("id", "k", "v").collect()))
    found = join_scattered(rows, side, ["k"], F.col("id"), hot_rows)
    assert found.columns == ["id", "k", "v"]
    assert sorted(map(tuple, found.collect())) == expected


def test_rows_of_a_hot_key_are_spread(spark):
    """The shuffle depends on more than the key, and a hot key's rows end in all of its partitions."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(4000).select("id", F.lit("hot").alias("k"))
        side = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, v int")
        found = lookup(rows, side, ["k"], "f", F.col("id"), hot_rows=100)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 4 and max(sizes) < 2000
        assert found.filter("f.v = 1").count() == 4000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_enrich(spark):
    dim = spark.createDataFrame(
        [("t", "1", {"name": "a"}), ("other", "1", {"name": "b"})], "sink_table string, row_key string, data map<string,string>"
    )
    rows = spark.createDataFrame([(1, "1"), (2, "2"), (3, None)], "id int, user string")
    for max_rows in (100, 0):
        args = (rows, dim, F.col("user"), ["name"], F.col("id"), "t")
        left = dims.enrich(*args, max_broadcast_rows=max_rows).orderBy("id").collect()
        assert [(r.id, r.name, r.matched) for r in left] == [(1, "a", True), (2, None, False), (3, None, False)]
        assert dims.enrich(*args, how="inner", max_broadcast_rows=max_rows).count() == 1


def test_is_small(spark):
    assert is_small(spark.range(5), 5) and not is_small(spark.range(6), 5)


def test_changes_without_a_row_key_leave_no_row(spark):
    rows = [(1, "t", None, "insert", {"name": "a"}), (2, "t", "1", "insert", {"name": "b"})]
    schema = "seq long, sink_table string, row_key string, op_type string, data map<string,string>"
    assert [r.row_key for r in dims.upsert(spark.createDataFrame(rows, schema), ["name"]).collect()] == ["1"]
