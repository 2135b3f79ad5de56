"""Run streams with a checkpoint and write each micro-batch once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..session import path_exists

BatchWriter = Callable[[DataFrame, int], None]


def run_stream(
    stream: DataFrame,
    write_batch: BatchWriter,
    checkpoint: str,
    *,
    name: str | None = None,
    every: str | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Start a stream that hands its micro-batches to ``write_batch(frame, batch_id)``.

    Without ``every`` it takes what is there and stops by itself; otherwise it runs at that interval. The
    checkpoint is mandatory: a restarted job resumes from it, and hands a batch that was under way again with
    the same ``batch_id``.
    """
    writer = stream.writeStream.foreachBatch(write_batch).outputMode(output_mode)
    return _start(writer, checkpoint, name, every)


def run_file_sink(stream: DataFrame, path: str, checkpoint: str, *, every: str | None = None, **options) -> StreamingQuery:
    """Append a stream to parquet files, exactly once: readers go by the sink's own list of committed files."""
    writer = stream.writeStream.format("parquet").option("path", path).outputMode("append")
    partition_by = options.pop("partition_by", None)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _start(writer.options(**options), checkpoint, None, every)


def _start(writer, checkpoint: str, name: str | None, every: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def finish(query: StreamingQuery) -> None:
    """Wait for a stream that stops by itself."""
    query.awaitTermination()


def batch_dir(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def write_batch_once(df: DataFrame, path: str, batch_id: int, partition_by: tuple[str, ...] = ()) -> None:
    """Write a micro-batch into its own folder.

    A batch that was handed again after a restart finds its folder finished and is left alone, so readers that
    have already taken its files never see others. An unfinished folder is overwritten.
    """
    folder = batch_dir(path, batch_id)
    if not path_exists(df.sparkSession, f"{folder}/_SUCCESS"):
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(folder)


def read_batches(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    """All written micro-batches, or those before a batch. An absent folder is an empty table."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], f"{schema}, batch_id bigint")
    table = spark.read.schema(f"{schema}, batch_id bigint").parquet(path)
    return table if before is None else table.filter(table.batch_id < before)
