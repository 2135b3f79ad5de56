"""Topics: JSON text with an arrival number, in Kafka or as parquet files.

A topic frame has ``seq bigint`` (unique, rises with arrival) and ``value string``. File topics are the
form used where no broker exists; both forms feed the same operators.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json import is_object_text, parse_once
from ..functions.times import ms_to_timestamp, seconds_to_timestamp
from .schemas import CHANGE, PAGE_LOG

TOPIC_FILES = "seq bigint, value string"


def read_topic(
    spark: SparkSession,
    topic: str | None = None,
    *,
    path: str | None = None,
    servers: str | None = None,
    streaming: bool = True,
    starting: str = "latest",
    **options: str,
) -> DataFrame:
    """A topic from Kafka (``servers`` and ``topic``) or from parquet files (``path``).

    Kafka streams start at the latest offset unless told otherwise. The Kafka connector is not part of a
    plain Spark installation and has to be on the class path.
    """
    reader = spark.readStream if streaming else spark.read
    if servers:
        raw = (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting if streaming else "earliest")
            .options(**options)
            .load()
        )
        seq = arrival_number(F.col("partition"), F.col("offset"))
        return raw.select(seq.alias("seq"), F.col("value").cast("string").alias("value"))
    return reader.schema(TOPIC_FILES).options(**options).parquet(path)


def arrival_number(partition: Column, offset: Column) -> Column:
    """A Kafka row's ``seq``: unique, and in order of arrival within a partition and so for all rows of one key."""
    return F.shiftleft(partition.cast("bigint"), 48) + offset


def read_text_topic(spark: SparkSession, path: str, streaming: bool = True) -> DataFrame:
    """Lines of text files as a topic without arrival numbers, for jobs that need no order."""
    return (spark.readStream if streaming else spark.read).text(path)


def typed(topic: DataFrame, schema: str) -> DataFrame:
    """Read each value as ``schema``. A field of the wrong type is NULL; unreadable values are dropped."""
    row = F.when(is_object_text("value"), F.from_json("value", schema))
    parsed = parse_once(topic, row, "row").drop("value")
    fields = parsed.schema["row"].dataType.names
    read = reduce(or_, (F.col("row")[name].isNotNull() for name in fields))
    return parsed.filter(read).select(*[c for c in parsed.columns if c != "row"], "row.*")


def change_table(topic: DataFrame, watermark: str | None = "3 seconds") -> DataFrame:
    """Change records with event time ``et`` (from seconds) and processing time ``pt``."""
    table = typed(topic, CHANGE).withColumns(
        {"et": seconds_to_timestamp("ts"), "pt": F.current_timestamp()}
    )
    return table.withWatermark("et", watermark) if watermark else table


def page_table(topic: DataFrame, watermark: str | None = "5 seconds") -> DataFrame:
    """Page log with event time ``et`` (from milliseconds)."""
    table = typed(topic, PAGE_LOG).withColumn("et", ms_to_timestamp("ts"))
    return table.withWatermark("et", watermark) if watermark else table


def closing_row(topic: DataFrame, after_ms: int = 24 * 60 * 60 * 1000) -> DataFrame:
    """One log so far behind all others of a finished topic that the windows of these close.

    It is a page view of nobody, with a search, ``after_ms`` behind the latest time: published last, it moves the watermark,
    and its own window never closes. What comes after it with earlier times is late.
    """
    ts = F.coalesce(F.max(F.try_variant_get(F.try_parse_json("value"), "$.ts", "bigint")), F.lit(0)) + after_ms
    last = topic.agg((F.coalesce(F.max("seq"), F.lit(-1)) + 1).cast("bigint").alias("seq"), ts.alias("ts"))
    common = F.struct(F.lit("-").alias("mid"), F.lit("0").alias("is_new"))
    page = F.struct(F.lit("search").alias("last_page_id"), F.lit("keyword").alias("item_type"), F.lit("end").alias("item"))
    return last.select("seq", F.to_json(F.struct(common.alias("common"), page.alias("page"), "ts")).alias("value"))
