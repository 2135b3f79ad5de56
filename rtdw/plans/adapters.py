"""Benchmark tables in the shape of the warehouse's inputs: log text, change records and captures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.envelope import row_json
from ..sources.changelog import image, snapshot_rows
from ..sources.tables import spread
from ..sources.topics import arrival_number

DATABASE = "shop"

# A code table for the ratings of the change records; rating 1205 is missing on purpose.
RATINGS = [("1201", "good"), ("1202", "medium"), ("1203", "bad"), ("1204", "auto")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A benchmark table with its zoneless times read as the session's zone."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    zoneless = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless})


def ratings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RATINGS, "dic_code string, dic_name string")


def log_topic(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """``events`` as log text, with the columns ``event_type`` and ``k`` kept beside it. ``dealt``: a small file's rows go to all cores."""
    k = F.col("k")
    kind = F.col("event_type")
    ms = F.unix_millis("ts")
    user = F.col("user_id")

    common = F.struct(
        user.cast("string").alias("mid"),
        F.when(k % 2 == 0, "1").otherwise("0").alias("is_new"),
        F.concat(F.lit("v"), user % 3).alias("vc"),
        F.concat(F.lit("ch"), user % 4).alias("ch"),
        (user % 5).cast("string").alias("ar"),
        F.concat_ws("-", user.cast("string"), F.date_format("ts", "yyyyMMdd")).alias("sid"),
    )
    has_page = kind.isin("view", "click", "purchase") | ((kind == "error") & (k % 2 == 0))
    page = F.struct(
        F.concat(F.lit("p"), k % 5).alias("page_id"),
        F.when(k % 3 == 0, "home").when(k % 3 == 1, "search").alias("last_page_id"),
        F.when(k % 2 == 1, "keyword").otherwise("sku_id").alias("item_type"),
        F.when(k % 11 != 0, F.concat(F.lit("w"), k % 7, F.lit(" W"), k % 5, F.lit(" w"), k % 7)).alias("item"),
        F.round(F.col("value") * 100).cast("bigint").alias("during_time"),
    )
    displays = F.transform(
        F.slice(F.array(F.lit(0), F.lit(1)), 1, (k % 3).cast("int")),
        lambda i: F.struct(k.cast("string").alias("item"), i.alias("pos"), F.lit("shadow").alias("ch")),
    )
    actions = F.transform(
        F.sequence(F.lit(0), (k % 2).cast("int")),
        lambda i: F.struct(F.lit("cart_add").alias("action_id"), k.cast("string").alias("item"), (ms + i).alias("ts")),
    )
    text = row_json(
        common.alias("common"),
        ms.alias("ts"),
        F.when(kind == "signup", F.struct(F.lit("icon").alias("entry"))).alias("start"),
        F.when(kind == "click", displays).alias("displays"),
        F.when(kind == "purchase", actions).alias("actions"),
        F.when(kind == "error", F.struct(k.alias("error_code"))).alias("err"),
        F.when(has_page, page).alias("page"),
    )
    value = F.when(F.col("event_id") % 97 == 13, F.substring(text, 1, 20)).otherwise(text)
    rows = table(spark, sf_dir, "events")
    events = (spread(rows, "event_id") if dealt else rows).withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return events.select(F.col("event_id").alias("seq"), value.alias("value"), "event_type", "k")


def _change_fields() -> dict[str, Column]:
    key = F.col("o_orderkey")
    number = key % 4
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    none = F.lit(None).cast("string")
    fields = {
        "id": F.col("o_custkey"),
        "coupon_id": key % 9,
        "user_id": F.col("o_custkey"),
        "order_id": key,
        "sku_id": key % 20,
        "get_time": day,
        "create_time": day,
        "using_time": F.when(key % 3 != 0, day),
        "used_time": none,
        "coupon_status": F.col("o_orderpriority"),
        "appraise": F.concat(F.lit("120"), 1 + key % 5),
        "comment_txt": F.concat(F.lit("c"), key),
        "login_name": F.concat(F.lit("u"), F.col("o_custkey")),
        "name": F.when(key % 3 != 0, F.concat(F.lit("n"), key)),
        "user_level": 1 + key % 3,
        "extra": F.lit("x"),
    }
    data = F.map_from_arrays(
        F.array(*[F.lit(c) for c in fields]), F.array(*[v.cast("string") for v in fields.values()])
    )
    return {
        "database": F.when(key % 50 == 7, "other").otherwise(DATABASE),
        "table": F.when(number == 0, "coupon_use")
        .when(number == 1, "favor_info")
        .when(number == 2, "user_info")
        .otherwise("comment_info"),
        "data": F.when(key % 41 == 5, F.map_filter(data, lambda _k, _v: F.lit(False))).otherwise(data),
        "seconds": F.unix_seconds("o_orderdate"),
    }


def change_topic(spark: SparkSession, sf_dir: str, *kept: str) -> DataFrame:
    """``orders`` as change records in JSON, with the columns ``kept`` beside it."""
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    fields = _change_fields()
    kind = F.when(status == "F", "insert").when(status == "O", "update").when(status == "P", "delete")
    # A map keeps its NULL values in JSON, a struct would lose them.
    text = row_json(
        fields["database"].alias("database"),
        fields["table"].alias("table"),
        kind.alias("type"),
        fields["data"].alias("data"),
        fields["seconds"].alias("ts"),
    )
    return table(spark, sf_dir, "orders").select(key.alias("seq"), text.alias("value"), *kept)


def quoted_change_topic(spark: SparkSession, sf_dir: str, *kept: str) -> DataFrame:
    """The change topic with every tenth value quoted once more."""
    escaped = F.replace(F.replace("value", F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    quoted = F.concat(F.lit('"'), escaped, F.lit('"'))
    return change_topic(spark, sf_dir, *kept).withColumn(
        "value", F.when(F.col("seq") % 10 == 3, quoted).otherwise(F.col("value"))
    )


def broken_change_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change topic with some values cut short."""
    cut = F.substring("value", 1, 20)
    return change_topic(spark, sf_dir).withColumn("value", F.when(F.col("seq") % 89 == 17, cut).otherwise(F.col("value")))


def capture_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as Debezium captures in JSON."""
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    fields = _change_fields()
    old = F.map_concat(
        F.map_filter(fields["data"], lambda k, _v: k != "name"), F.create_map(F.lit("name"), F.lit("old"))
    )
    op = F.when(status == "F", "c").when(status == "O", "u").when(status == "P", "d")
    text = row_json(
        op.alias("op"),
        F.when(op == "u", old).when(op == "d", fields["data"]).alias("before"),
        F.when(op != "d", fields["data"]).alias("after"),
        F.struct(fields["database"].alias("db"), fields["table"].alias("table")).alias("source"),
        (fields["seconds"] * 1000 + key % 1000).alias("ts_ms"),
    )
    return table(spark, sf_dir, "orders").select(key.alias("seq"), text.alias("value"))


def customer_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as the snapshot of the captured user table."""
    users = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return snapshot_rows(users, DATABASE, "user_info")


def chunk_marks(spark: SparkSession, sf_dir: str, size: int) -> DataFrame:
    """Log positions around the reading of each chunk of ``size`` users, ``chunk, low, read, high``: one chunk after the other."""
    low = F.col("chunk") * size * 5
    chunks = table(spark, sf_dir, "customer").select(F.floor(F.col("c_custkey") / size).alias("chunk")).distinct()
    return chunks.select("chunk", low.alias("low"), (low + size * 2).alias("read"), (low + size * 5).alias("high"))


def customer_chunks(spark: SparkSession, sf_dir: str, captures: DataFrame, marks: DataFrame, chunk_of: Column) -> DataFrame:
    """What a reader sees of the captured user table, chunk by chunk, each as it is at the chunk's ``read`` position."""
    start = customer_snapshot(spark, sf_dir).unionByName(captures)
    seen = image(start).withColumn("key", F.col("row")["id"]).withColumn("chunk", chunk_of)
    upto = seen.join(marks, "chunk").where("seq <= read")
    last = upto.groupBy("chunk", "key").agg(F.max_by(F.struct("op", "row"), "seq").alias("last")).where("last.op <> 'd'")
    return last.select(
        "chunk",
        F.lit(-1).cast("bigint").alias("seq"),
        F.lit("r").alias("op"),
        F.lit(None).cast("map<string,string>").alias("before"),
        F.col("last.row").alias("after"),
        F.struct(F.lit(DATABASE).alias("db"), F.lit("user_info").alias("table")).alias("source"),
        F.lit(0).cast("bigint").alias("ts_ms"),
    )


def rating_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of ratings that change with time, ``appraise, since, dic_name``: a customer stands for a change of a name."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").where("c_custkey >= 40").select(
        F.concat(F.lit("120"), 1 + key % 4).alias("appraise"),
        (F.lit(788918400).cast("bigint") + key * 100_000).alias("since"),
        F.col("c_name").alias("dic_name"),
    )


TEN_YEARS_MS = 10 * 365 * 24 * 60 * 60 * 1000


def closing_change(spark: SparkSession) -> DataFrame:
    """A change of a table that nobody routes, so late that all waiting ends."""
    data = F.create_map(F.lit("id"), F.lit("-"))
    text = row_json(F.lit(DATABASE).alias("database"), F.lit("-").alias("table"), F.lit("insert").alias("type"), data.alias("data"), F.lit(2_000_000_000).alias("ts"))
    return spark.range(1).select(F.lit(-1).cast("bigint").alias("seq"), text.alias("value"))


def config_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as captured changes of a routing table: customers stand for sink tables."""
    key, sink = F.col("o_orderkey"), F.col("o_custkey")
    status = F.col("o_orderstatus")
    op = F.when(status == "F", "c").when(status == "O", "u").when(status == "P", "d")
    row = F.create_map(
        F.lit("source_table"), F.concat(F.lit("t"), (sink + key) % 700),
        F.lit("source_type"), F.when(key % 2 == 0, "insert").otherwise("update"),
        F.lit("sink_table"), F.concat(F.lit("s"), sink),
        F.lit("sink_columns"), F.concat(F.lit("id,c"), key % 10),
    )
    text = row_json(
        op.alias("op"),
        F.when(op == "d", row).alias("before"),
        F.when(op != "d", row).alias("after"),
        F.struct(F.lit("config").alias("db"), F.lit("table_process_dwd").alias("table")).alias("source"),
        F.unix_millis("o_orderdate").alias("ts_ms"),
    )
    return table(spark, sf_dir, "orders").select(key.alias("seq"), text.alias("value"))


def partitioned_change_topic(spark: SparkSession, sf_dir: str, partitions: int = 16) -> DataFrame:
    """The quoted change topic dealt over partitions by primary key, numbered as Kafka rows are."""
    partition = F.pmod(F.xxhash64("o_custkey"), F.lit(partitions))
    return quoted_change_topic(spark, sf_dir, "o_custkey").select(
        arrival_number(partition, F.col("seq")).alias("seq"), "value"
    )


def route_captures(routes: DataFrame, table_name: str, op: str, seq: int) -> DataFrame:
    """Rows of a routing table as captures of one kind."""
    row = F.struct(*routes.columns)
    source = F.struct(F.lit("config").alias("db"), F.lit(table_name).alias("table"))
    text = row_json(
        F.lit(op).alias("op"), row.alias("before" if op == "d" else "after"), source.alias("source"), F.lit(seq).alias("ts_ms")
    )
    return routes.select(F.lit(seq).cast("bigint").alias("seq"), text.alias("value"))


# Letters as Han characters, to have Han text where the documents hold none.
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_HAN = "".join(chr(0x4E00 + 37 * i) for i in range(26))


def han_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with letters written as Han characters and blanks dropped, so that words must be found."""
    text = F.replace(F.translate(F.lower("text"), _LETTERS, _HAN), F.lit(" "), F.lit(""))
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id").select("doc_id", text.alias("text"))


def han_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of two letters or more of ``benchmark``, written as Han characters."""
    listed = F.explode(F.split(F.lower("text"), "[^a-z]+"))
    entries = table(spark, sf_dir, "benchmark").select(listed.alias("word")).filter(F.length("word") >= 2)
    return entries.distinct().select(F.translate("word", _LETTERS, _HAN).alias("word"))
