"""Sinks for micro-batches: topics, the report table and dimension tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dims
from ..operators.envelope import row_json
from ..session import shared_dir
from .runner import BatchWriter, read_batches, write_batch_once

TOPIC_ROWS = "seq bigint, value string, topic string"


def write_topics(path: str) -> BatchWriter:
    """Topic rows ``seq, topic, value`` to file topics, one folder per topic: the row names its topic."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch_once(batch.select("seq", "value", "topic"), path, batch_id, ("topic",))

    return write


def topic_files(path: str, topic: str) -> str:
    """Where :func:`write_topics` keeps one topic, for ``read_topic(path=...)``."""
    return f"{path}/batch_id=*/topic={topic}"


def write_kafka_topics(servers: str) -> BatchWriter:
    """Topic rows to Kafka. Spark writes to Kafka at least once, so readers drop repeated ``seq`` values.

    Rows with a ``key`` are published by it: all rows of one key share a partition and keep their order there.
    """

    def write(batch: DataFrame, _batch_id: int) -> None:
        key = "key" if "key" in batch.columns else "seq"
        rows = batch.select("topic", F.col(key).cast("string").alias("key"), "value")
        rows.write.format("kafka").option("kafka.bootstrap.servers", servers).save()

    return write


def as_json_rows(table: DataFrame, topic: str, key: Column | None = None) -> DataFrame:
    """Table rows as JSON rows of one topic, to be published by ``key``."""
    fields = [c for c in table.columns if c != "seq"]
    keys = [] if key is None else [key.alias("key")]
    return table.select("seq", *keys, F.lit(topic).alias("topic"), row_json(*fields).alias("value"))


def write_keyed_topic(path: str, key: str) -> BatchWriter:
    """Rows ``seq, value`` and a key column as a keyed upsert topic: the last value per key of each batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        last = batch.groupBy(key).agg(F.max_by(F.struct("value", "seq"), "seq").alias("last"))
        write_batch_once(last.select(F.col(key).alias("key"), "last.*"), path, batch_id)

    return write


def read_keyed_topic(spark: SparkSession, path: str) -> DataFrame:
    """The present content of a keyed upsert topic."""
    return dims.upsert_latest(read_batches(spark, path, "key string, value string, seq bigint"))


def write_report(path: str) -> BatchWriter:
    """Report rows to a table with one folder per ``cur_date``, and in it one per micro-batch that added to the day.

    Only the folders that a batch writes are overwritten: handed again, it puts the same rows in the same places.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        writer = numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("cur_date", "batch_id").parquet(path)

    return write


def read_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The report's rows, in the order of columns of ``schema``; a filter on ``cur_date`` lists that day's folder only."""
    table = read_batches(spark, path, schema)
    return table.select(*[c.split()[0] for c in schema.split(", ")])


def compact_report(spark: SparkSession, path: str, cur_date: str, schema: str) -> None:
    """Fold a day into one folder, once a micro-batch after the day's last one is committed.

    The folded rows are written down first, and the folders of the micro-batches are emptied after the fold is in place;
    a fold that stops half way leaves rows twice and is finished by folding again.
    """
    day = read_batches(spark, path, schema).filter(F.col("cur_date") == cur_date)
    batches = [row.batch_id for row in day.select("batch_id").distinct().toLocalIterator()]
    if not batches:
        return
    folded = f"{shared_dir(spark)}/folded-{uuid.uuid4().hex[:12]}"
    day.drop("cur_date", "batch_id").distinct().coalesce(1).write.parquet(folded)
    kept = spark.read.parquet(folded)
    kept.write.mode("overwrite").parquet(f"{path}/cur_date={cur_date}/batch_id=-1")
    for batch_id in batches:
        if batch_id >= 0:
            kept.limit(0).write.mode("overwrite").parquet(f"{path}/cur_date={cur_date}/batch_id={batch_id}")


class DimensionTables:
    """Dimension tables as reduced changes per micro-batch, one folder per table, merged when read.

    A micro-batch writes what its changes leave behind per key (:func:`rtdw.operators.dims.reduce_changes`), so
    its cost follows the batch and not the table. :meth:`compact` folds all batches so far into one folder. A filter
    on ``sink_table`` of what is read reaches the folders.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def write(self, changes: DataFrame, batch_id: int, columns: list[str] | None = None) -> None:
        """Apply dimension changes ``seq, sink_table, row_key, op_type, data``."""
        reduced = dims.reduce_changes(changes, columns)
        write_batch_once(reduced, f"{self.path}/changes", batch_id, ("sink_table",))

    def reduced(self) -> DataFrame:
        """All that is written, merged per key."""
        return dims.merge_reduced(self._parts(self._last("folded", "upto")))

    def rows(self, merge: str = "column", lifecycle: DataFrame | None = None) -> DataFrame:
        """The present rows; of tables that ``lifecycle`` (:func:`dims.table_lifecycle`) has present, if given."""
        reduced = self.reduced()
        return dims.live_rows(reduced if lifecycle is None else dims.empty_tables(reduced, lifecycle), merge)

    def compact(self) -> int | None:
        """Fold the batches written so far; returns the last folded batch, None if there was nothing new."""
        folded = self._last("folded", "upto")
        last = self._last("changes", "batch_id")
        if last is None or last == folded:
            return None
        merged = dims.merge_reduced(self._parts(folded, last))
        merged.write.mode("overwrite").partitionBy("sink_table").parquet(f"{self.path}/folded/upto={last}")
        return last

    def _last(self, folder: str, column: str) -> int | None:
        """The highest finished ``column=n`` folder below ``folder``."""
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}/{column}=*/_SUCCESS")
        file_system = hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = file_system.globStatus(hadoop_path) or []
        return max((int(f.getPath().getParent().getName().split("=")[1]) for f in found), default=None)

    def _parts(self, folded: int | None, last: int | None = None) -> DataFrame:
        """The fold ``folded``, and all batches after it (to ``last``, if given)."""
        changes = read_batches(self.spark, f"{self.path}/changes", dims.REDUCED)
        if last is not None:
            changes = changes.filter(F.col("batch_id") <= last)
        if folded is None:
            return changes.drop("batch_id")
        fold = self.spark.read.schema(dims.REDUCED).parquet(f"{self.path}/folded/upto={folded}")
        return fold.unionByName(changes.filter(F.col("batch_id") > folded).drop("batch_id"))
