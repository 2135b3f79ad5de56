"""Envelopes: from captured changes to the change record all later jobs read, and back to JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.changelog import image


def to_change_records(captures: DataFrame) -> DataFrame:
    """Debezium captures as change records ``seq, database, table, type, data, old, ts``.

    ``r`` and ``c`` are inserts, ``u`` updates, ``d`` deletes; ``old`` holds the values that an update changed.
    """
    kind = F.when(F.col("op").isin("r", "c"), "insert").when(F.col("op") == "u", "update").when(
        F.col("op") == "d", "delete"
    )
    changed = F.map_filter("before", lambda key, value: ~value.eqNullSafe(F.col("after")[key]))
    rest = [c for c in captures.columns if c not in ("op", "before", "after", "source", "ts_ms")]
    return image(captures).select(
        *rest,
        F.col("source.db").alias("database"),
        F.col("source.table").alias("table"),
        kind.alias("type"),
        F.col("row").alias("data"),
        F.when(F.col("op") == "u", changed).alias("old"),
        F.expr("ts_ms div 1000").alias("ts"),
    )


def change_json(records: DataFrame, keep: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Change records as topic rows."""
    fields = ["database", "table", "type", "data", "old", "ts"]
    return records.select(*[c for c in keep if c in records.columns], row_json(*fields).alias("value"))


def row_json(*columns: str | Column) -> Column:
    """Columns as one JSON object; NULL columns are left out."""
    return F.to_json(F.struct(*columns))
