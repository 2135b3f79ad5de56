"""Change captures in the Debezium envelope: a snapshot followed by live changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json import is_object_text, parse_once
from .schemas import DEBEZIUM


def read_captures(topic: DataFrame, tables: list[str] | None = None) -> DataFrame:
    """Captured changes ``seq, op, before, after, source, ts_ms`` of the listed source tables (all by default)."""
    capture = F.when(is_object_text("value"), F.from_json("value", DEBEZIUM))
    parsed = parse_once(topic, capture, "c").filter(F.col("c.op").isNotNull())
    captures = parsed.select(*[c for c in topic.columns if c != "value"], "c.*")
    return captures.filter(F.col("source.table").isin(tables)) if tables else captures


def snapshot_rows(table: DataFrame, database: str, name: str, ts_ms: int = 0, seq: int = -1) -> DataFrame:
    """The present rows of a table as op ``r`` captures, numbered before every live change."""
    names = F.array(*[F.lit(c) for c in table.columns])
    after = F.map_from_arrays(names, F.array(*[F.col(c).cast("string") for c in table.columns]))
    return table.select(
        F.lit(seq).cast("bigint").alias("seq"),
        F.lit("r").alias("op"),
        F.lit(None).cast("map<string,string>").alias("before"),
        after.alias("after"),
        F.struct(F.lit(database).alias("db"), F.lit(name).alias("table")).alias("source"),
        F.lit(ts_ms).cast("bigint").alias("ts_ms"),
    )


def snapshot_then_changes(snapshot: DataFrame, captures: DataFrame) -> DataFrame:
    return snapshot.unionByName(captures)


def merge_chunks(chunks: DataFrame, marks: DataFrame, captures: DataFrame, key: str, chunk_of: Column) -> DataFrame:
    """One history of captures from a snapshot that was read in chunks while changes went on.

    ``chunks`` are captures with a column ``chunk``, and ``marks`` tells for each chunk the positions of the change log right before
    (``low``) and right after (``high``) it was read; ``chunk_of`` is the chunk of a change's key, of the column ``key``. A row read in
    between may show some changes of its window or none, so it yields to any change of its key inside; otherwise it holds from ``high``
    on. The last state of every key is then that of the table, however it is cut into chunks. Changes are reduced to one row per
    key of their windows before they meet the snapshot.
    """
    keyed = image(captures).select("seq", F.col("row")[key].alias("key")).where(F.col("key").isNotNull())
    inside = keyed.withColumn("chunk", chunk_of).join(marks, "chunk").where("seq > low and seq <= high")
    changed = inside.select("key").distinct()
    rows = image(chunks.drop("seq").join(marks, "chunk")).withColumn("key", F.col("row")[key])
    kept = rows.join(changed, "key", "left_anti").withColumn("seq", F.col("high"))
    return captures.unionByName(kept.select(*captures.columns))


def image(captures: DataFrame) -> DataFrame:
    """The row a capture speaks of: ``before`` for deletes, ``after`` for everything else."""
    return captures.withColumn("row", F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after")))


def latest_rows(captures: DataFrame, key: str) -> DataFrame:
    """Last capture per key, ``key, op, row``, deleted rows included with op ``d``."""
    return (
        image(captures)
        .withColumn("key", F.col("row")[key])
        .groupBy("key")
        .agg(F.max_by(F.struct("op", "row"), "seq").alias("last"))
        .select("key", "last.*")
    )
