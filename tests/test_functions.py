from json import loads as read_json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rtdw.functions import json, names, order, text, times
from rtdw.sources import schemas


def _one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_text_to_epoch_is_pinned_to_plus_eight(spark):
    row = _one(
        spark,
        times.date_time_to_ms(F.lit("2023-07-05 01:01:01")),
        times.date_to_ms(F.lit("2023-07-05")),
        times.date_time_to_ms(F.lit("yesterday")),
    )
    assert tuple(row) == (1688490061000, 1688486400000, None)


def test_epoch_to_text_follows_the_session_zone(spark):
    columns = [times.ms_to_date(F.lit(1688490061000)), times.ms_to_date_time(F.lit(1688490061000))]
    columns.append(times.ms_to_partition(F.lit(1688490061000)))
    assert tuple(_one(spark, *columns)) == ("2023-07-04", "2023-07-04 17:01:01", "20230704")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        assert tuple(_one(spark, *columns)) == ("2023-07-05", "2023-07-05 01:01:01", "20230705")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_names(spark):
    assert names.camel_name("sink_row_key") == "sinkRowKey"
    assert names.snake_name("sinkRowKey") == "sink_row_key"
    assert names.snake_columns(spark.createDataFrame([(1, 2)], "uvCt int, cur_date int")).columns == ["uv_ct", "cur_date"]
    row = _one(spark, names.camel_keys(F.create_map(F.lit("dic_name"), F.lit("x"), F.lit("id"), F.lit("y"))).alias("m"))
    assert row.m == {"dicName": "x", "id": "y"}


def test_words(spark):
    texts = [None, "macbook M2 15寸 M2", "ＡＢＣ１２　ｄ", "!!! ...", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(text.words("t").alias("w")).collect()
    assert [r.w for r in rows] == [None, ["macbook", "m2", "15寸"], ["abc12", "d"], [], []]


def test_only_json_objects_parse(spark):
    texts = ["not json", "", "null", "[1]", '"x"', "5", '{"a":', "{}", '{"a": 1}', None]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    kept = json.parse_once(df, json.parse_object("value"), "o").filter(F.col("o").isNotNull())
    assert [r.value for r in kept.collect()] == ["{}", '{"a": 1}']


def test_null_fields_are_left_out(spark):
    df = spark.createDataFrame([('{"a": null, "b": 1.50, "c": "x"}',)], "value string")
    assert df.select(json.object_json(json.parse_object("value")).alias("j")).first().j == '{"b":1.5,"c":"x"}'
    row = _one(spark, json.text_map_json(F.create_map(F.lit("a"), F.lit(None).cast("string"), F.lit("b"), F.lit("x"))))
    assert row[0] == '{"b":"x"}'


def test_null_fields_are_left_out_at_every_depth(spark):
    value = (
        r'''{"p": {"x": null, "y": {"z": null}, "l": [null, {"n": null, "m": 1}, "null"]}, "\":null,": ",}", '''
        r'''"t": "\"a\":null,}", "null": "null", ":null": null, "q": {"a": 1, "b": null}}'''
    )
    df = spark.createDataFrame([(value,), ("{}",), ('{"a": {"b": null}}',)], "value string")
    found = [r.j for r in df.select(json.object_json(json.parse_object("value")).alias("j")).collect()]
    assert read_json(found[0]) == {
        "p": {"y": {}, "l": [None, {"m": 1}, "null"]}, '":null,': ",}", "t": '"a":null,}', "null": "null", "q": {"a": 1}
    }
    assert found[1:] == ["{}", '{"a":{}}']
    long = "\\\\" * 50_000 + "x" * 50_000
    df = spark.createDataFrame([(f'{{"a":"{long}","b":null}}',)], "value string")
    assert df.select(json.without_nulls(F.col("value"))).first()[0] == f'{{"a":"{long}"}}'


def test_arrival_orders_by_time_then_number(spark):
    top = 2**63 - 1
    rows = [(ts, seq) for ts in (-(2**63), -5, 0, 7, top) for seq in (0, 3, top)]
    df = spark.createDataFrame(rows[::-1], "ts bigint, seq bigint")
    ordered = df.withColumn("n", order.arrival()).orderBy("n")
    assert [(r.ts, r.seq) for r in ordered.collect()] == rows
    assert [r[0] for r in ordered.select(order.seq_of(F.col("n"), F.col("ts"))).collect()] == [seq for _, seq in rows]


def test_unwrap(spark):
    texts = ['{"a":"q"}', '"{\\"a\\":\\"q\\"}"', "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "v string").select(json.unwrap("v").alias("u")).collect()
    assert [r.u for r in rows] == ['{"a":"q"}', '{"a":"q"}', "", None]


def test_database_types():
    assert schemas.spark_type("bigint(20)") == T.LongType()
    assert schemas.spark_type("decimal(16,2)") == T.DecimalType(16, 2)
    assert schemas.spark_type("decimal(10)") == T.DecimalType(10, 0)
    assert schemas.spark_type("varchar(200)") == T.StringType()
    assert schemas.spark_type("tinyint") == T.ByteType()
    schema = schemas.table_schema({"id": "bigint", "birthday": "date", "create_time": "datetime"})
    assert schema.simpleString() == "struct<id:bigint,birthday:date,create_time:timestamp>"
