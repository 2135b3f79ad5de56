"""The warehouse's streaming jobs. Each reads one topic and returns a running or finished query.

``root`` is a folder on shared storage; every job keeps its checkpoint, its stores and its output below it.
Without ``every`` a job takes what has arrived and stops by itself. Topic rows go to files below ``root/topics``, or to
``sink``, such as ``write_kafka_topics``. Records that cannot be read go to a folder ``dead...`` of the job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import changes, dims, envelope, facts, keywords, logs, traffic
from ..sources.changelog import read_captures
from ..sources.schemas import DIM_ROUTE, TOPIC_COMMENT, TOPIC_DB, TOPIC_DIM
from ..sources.topics import change_table, page_table
from . import held, visitors
from .runner import BatchWriter, batch_dir, run_file_sink, run_stream, write_batch_once
from .sinks import DimensionTables, as_json_rows, write_report, write_topics

# Reads a small table anew, so that each micro-batch sees its present content.
TableReader = Callable[[], DataFrame]


def live_fact_routes(config_topic: TableReader, table: str) -> TableReader:
    """The routes of facts that are in force by the change captures of the configuration table."""
    return lambda: changes.fact_config(read_captures(config_topic(), [table]))


def live_dim_routes(config_topic: TableReader, table: str) -> TableReader:
    """The routes of dimensions that are in force by the change captures of the configuration table."""
    return lambda: changes.dim_config(read_captures(config_topic(), [table]))


def live_lifecycle(config_topic: TableReader, table: str) -> TableReader:
    """Which sink tables are present and when they were last emptied, by the captures of the configuration table.

    For ``DimensionTables.rows``: tables are emptied when read, so the answer does not depend on which micro-batch
    brought the changes.
    """
    return lambda: dims.table_lifecycle(changes.config_rows(read_captures(config_topic(), [table]), DIM_ROUTE))


def publish_captures(
    captures: DataFrame, root: str, tables: list[str] | None = None, every: str | None = None
) -> StreamingQuery:
    """Captured changes to the change topic, in the record shape that the later jobs read."""
    records = envelope.to_change_records(read_captures(captures, tables))
    return run_file_sink(envelope.change_json(records), f"{root}/{TOPIC_DB}", f"{root}/_checkpoints/ods", every=every)


def split_logs(
    topic: DataFrame,
    root: str,
    every: str | None = None,
    sink: BatchWriter | None = None,
) -> StreamingQuery:
    """Correct the new-visitor flag and fan the logs out into their topics below ``root/topics``.

    The first days are keyed state of the stream, kept for ever in its checkpoint. As with any arrival-ordered state, the
    first record is the earliest of the first micro-batch that has the visitor. Rows that cannot be read go to ``root/dead``.
    """
    write = sink or write_topics(f"{root}/topics")
    none = F.lit(None).cast("string")
    rows = logs.fan_out(visitors.fixed_logs(topic)).select("seq", "topic", "value", none.alias("reason"))
    dead = logs.dead_letters(topic).select("seq", none.alias("topic"), "value", "reason")

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # two writes of one pass over the state
        try:
            write(batch.filter("reason is null").drop("reason"), batch_id)
            write_batch_once(batch.filter("reason is not null").drop("topic"), f"{root}/dead", batch_id)
        finally:
            batch.unpersist()

    return run_stream(rows.unionByName(dead), run, f"{root}/_checkpoints/logs", every=every)


def check_logs(topic: DataFrame, root: str, every: str | None = None) -> StreamingQuery:
    """Dead letters of the logs to ``root/dead`` and, per micro-batch, how many rows and dead letters it had to ``root/counts``.

    The counts are observed while the letters are written: no second pass. Both folders are overwritten by batch.
    """
    rows = logs.with_reasons(topic)

    def run(batch: DataFrame, batch_id: int) -> None:
        counts = Observation(f"logs-{batch_id}")
        seen = batch.observe(counts, F.count(F.lit(1)).alias("n_rows"), F.count("reason").alias("n_dead"))
        seen.filter("reason is not null").write.mode("overwrite").parquet(batch_dir(f"{root}/dead", batch_id))
        found = batch.sparkSession.createDataFrame([(counts.get["n_rows"], counts.get["n_dead"])], "n_rows long, n_dead long")
        found.coalesce(1).write.mode("overwrite").parquet(batch_dir(f"{root}/counts", batch_id))

    return run_stream(rows, run, f"{root}/_checkpoints/check", every=every)


def route_late_facts(topic: DataFrame, config: DataFrame, root: str, database: str, every: str | None = None, **waiting) -> StreamingQuery:
    """Facts with their routes to ``root/routed``, also where a route is captured after its facts; rows whose wait ended have none."""
    rows = held.route_changes(changes.fact_changes(topic, database), read_captures(config), **waiting)
    return run_file_sink(rows, f"{root}/routed", f"{root}/_checkpoints/late", every=every)


def route_facts(
    topic: DataFrame,
    root: str,
    database: str,
    routes: TableReader,
    every: str | None = None,
    sink: BatchWriter | None = None,
) -> StreamingQuery:
    """Facts by configuration into the topics that it names, below ``root/topics``."""
    write = sink or write_topics(f"{root}/topics")

    def run(batch: DataFrame, batch_id: int) -> None:
        routed = changes.route_facts(changes.fact_changes(batch, database), routes())
        write(changes.fact_topic_rows(changes.prune_columns(routed)), batch_id)
        write_batch_once(changes.unreadable_changes(batch), f"{root}/dead_facts", batch_id)

    return run_stream(topic, run, f"{root}/_checkpoints/facts", every=every)


def update_dimensions(
    topic: DataFrame,
    root: str,
    database: str,
    routes: TableReader,
    every: str | None = None,
    sink: BatchWriter | None = None,
) -> StreamingQuery:
    """Dimension tables by configuration, kept in ``root/dims``; the changes are also published as one topic."""
    write = sink or write_topics(f"{root}/topics")
    tables = DimensionTables(topic.sparkSession, f"{root}/dims")

    def run(batch: DataFrame, batch_id: int) -> None:
        routed = changes.prune_columns(changes.route_dims(changes.dim_changes(batch, database), routes()))
        tables.write(routed, batch_id)
        published = routed.select("seq", "sink_table", "row_key", "op_type", "data")
        write(as_json_rows(published, TOPIC_DIM, F.concat_ws(":", "sink_table", "row_key")), batch_id)
        write_batch_once(changes.unreadable_changes(batch), f"{root}/dead_dims", batch_id)

    return run_stream(topic, run, f"{root}/_checkpoints/dims", every=every)


def publish_comments(
    topic: DataFrame,
    root: str,
    database: str,
    dictionary: TableReader,
    every: str | None = None,
    sink: BatchWriter | None = None,
) -> StreamingQuery:
    """New comments with the name of their rating, as a topic below ``root/topics``."""
    write = sink or write_topics(f"{root}/topics")

    def run(batch: DataFrame, batch_id: int) -> None:
        comments = facts.extract_comments(change_table(batch, watermark=None), database)
        write(as_json_rows(facts.lookup_comments(comments, dictionary()), TOPIC_COMMENT, F.col("id")), batch_id)
        write_batch_once(changes.unreadable_changes(batch), f"{root}/dead_comments", batch_id)

    return run_stream(topic, run, f"{root}/_checkpoints/comments", every=every)


def count_keywords(
    page_topic: DataFrame, root: str, size: str = "5 seconds", every: str | None = None
) -> StreamingQuery:
    """Keyword counts per window into the report ``root/keyword_windows``, each window once it is closed."""
    counted = keywords.keyword_windows(page_table(page_topic), size)
    return run_stream(
        counted, write_report(f"{root}/keyword_windows"), f"{root}/_checkpoints/keyword_windows", every=every
    )


def sum_traffic(
    page_topic: DataFrame, root: str, size: str = "5 seconds", delay: str = "5 seconds", every: str | None = None
) -> StreamingQuery:
    """Traffic measures per window of the page topic into the report ``root/traffic_windows``, each window once it is closed.

    One query: a state step per visitor and day, one per session, and the windows behind them, all by event time.
    """
    views = visitors.flagged_views(traffic.parse_pages(logs.parse_logs(page_topic)), delay)
    return run_stream(
        traffic.traffic_windows(views, size),
        write_report(f"{root}/traffic_windows"),
        f"{root}/_checkpoints/traffic_windows",
        every=every,
    )
