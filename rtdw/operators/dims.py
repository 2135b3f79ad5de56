"""Dimension tables: keyed upsert and delete, table lifecycle, lookups.

A dimension change is ``seq, sink_table, row_key, op_type, data map<string,string>``; a dimension row is
``sink_table, row_key, data``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookup import BROADCAST_ROWS, lookup, lookup_checked

KEY = ["sink_table", "row_key"]
REDUCED = (
    "sink_table string, row_key string, deleted_at bigint, put_at bigint, "
    "cells map<string, struct<seq: bigint, value: string>>"
)


def reduce_changes(changes: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """What a set of changes leaves behind per key: :data:`REDUCED`.

    ``deleted_at`` is the last delete's ``seq``, ``put_at`` the last write's; ``cells`` has, per column (of
    ``columns``, if given), the last value that was not NULL with its ``seq``. Changes are taken apart into cells,
    so a row costs the columns it has and not those of all tables. Both aggregations combine on the map side, the
    second one gathers one row's columns; reducing reduced changes again (:func:`merge_reduced`) gives the same as
    reducing all at once. Changes without a row key belong to no row and are left out.
    """
    is_delete = F.col("op_type") == "delete"
    written = F.map_filter(
        "data", lambda key, value: value.isNotNull() & (F.lit(True) if columns is None else key.isin(columns))
    )
    row = _entry(None, None, F.when(~is_delete, F.col("seq")), F.when(is_delete, F.col("seq")))
    cells = F.transform(F.map_entries(written), lambda e: _entry(e["key"], e["value"], F.col("seq"), None))
    entries = F.when(is_delete | F.col("data").isNull(), F.array(row)).otherwise(F.concat(F.array(row), cells))
    keyed = changes.filter(F.col("row_key").isNotNull() & F.col("op_type").isNotNull())
    return _gather(keyed.select(*KEY, F.inline(entries)))


def merge_reduced(parts: DataFrame) -> DataFrame:
    """Combine reduced changes of several batches."""
    row = _entry(None, None, F.col("put_at"), F.col("deleted_at"))
    cells = F.transform(
        F.map_entries("cells"), lambda e: _entry(e["key"], e["value"]["value"], e["value"]["seq"], None)
    )
    return _gather(parts.select(*KEY, F.inline(F.concat(F.array(row), cells))))


def _entry(column: Column | None, value: Column | None, seq: Column, deleted_at: Column | None) -> Column:
    """A cell of a row, or (without a column) the row itself."""

    def typed(found: Column | None, kind: str) -> Column:
        return (F.lit(None) if found is None else found).cast(kind)

    return F.struct(
        typed(column, "string").alias("column"),
        typed(value, "string").alias("value"),
        typed(seq, "bigint").alias("seq"),
        typed(deleted_at, "bigint").alias("deleted_at"),
    )


def _gather(entries: DataFrame) -> DataFrame:
    last = entries.groupBy(*KEY, "column").agg(
        F.max_by("value", "seq").alias("value"), F.max("seq").alias("seq"), F.max("deleted_at").alias("deleted_at")
    )
    is_row = F.col("column").isNull()
    cell = F.when(~is_row, F.struct("column", F.struct("seq", "value").alias("cell")))
    return last.groupBy(*KEY).agg(
        F.max("deleted_at").alias("deleted_at"),
        F.max(F.when(is_row, F.col("seq"))).alias("put_at"),
        F.map_from_entries(F.collect_list(cell)).alias("cells"),
    )


def live_data(merge: str = "column") -> Column:
    """The columns of a reduced row that live; empty where the row is gone.

    ``merge="column"`` keeps a column's old value when a later write has none; ``merge="row"`` takes the last
    written row whole. Whatever was written before the last delete is gone.
    """
    if merge not in ("column", "row"):
        raise ValueError(f"merge must be 'column' or 'row', not {merge!r}")
    deleted_at = F.coalesce("deleted_at", F.lit(-(2**63)))

    def lives(_column: Column, cell: Column) -> Column:
        after = cell["seq"] > deleted_at
        return after if merge == "column" else after & (cell["seq"] == F.col("put_at"))

    return F.transform_values(F.map_filter("cells", lives), lambda _column, cell: cell["value"])


def live_rows(reduced: DataFrame, merge: str = "column") -> DataFrame:
    """Dimension rows from reduced changes, see :func:`live_data`."""
    return reduced.select(*KEY, live_data(merge).alias("data")).filter(F.cardinality("data") > 0)


def upsert(changes: DataFrame, columns: list[str] | None = None, merge: str = "column") -> DataFrame:
    """Dimension rows after applying the changes in order of ``seq``."""
    return live_rows(reduce_changes(changes, columns), merge)


def upsert_latest(rows: DataFrame, key: str = "key", value: str = "value", order: str = "seq") -> DataFrame:
    """A keyed topic read as a table: the last value per key; a NULL value removes the key."""
    last = rows.groupBy(key).agg(F.max_by(F.struct(value), order).alias("last"))
    return last.select(key, "last.*").filter(F.col(value).isNotNull())


def table_lifecycle(config: DataFrame) -> DataFrame:
    """State of each sink table after its configuration changes (``seq, op, sink_table``).

    ``c`` and ``r`` create a table that is absent and change nothing on a present one, ``d`` drops it, ``u``
    drops and creates it. ``emptied_at`` is the last drop.
    """
    return config.groupBy("sink_table").agg(
        (F.max_by("op", "seq") != "d").alias("is_present"),
        F.max(F.when(F.col("op").isin("d", "u"), F.col("seq"))).alias("emptied_at"),
    )


def apply_lifecycle(changes: DataFrame, lifecycle: DataFrame, max_broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Drop changes to absent tables and changes made before a table was last emptied."""
    found = lookup_checked(changes, lifecycle, ["sink_table"], "_life", F.col("seq"), max_broadcast_rows)
    life = F.col("_life")
    counts = life["is_present"] & (F.col("seq") > F.coalesce(life["emptied_at"], F.lit(-(2**63))))
    return found.filter(counts).drop("_life")


def empty_tables(reduced: DataFrame, lifecycle: DataFrame, max_broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Reduced changes of present tables, where emptying a table deletes all of its rows.

    Gives what :func:`apply_lifecycle` gives before reducing, whenever the configuration was changed.
    """
    found = lookup_checked(reduced, lifecycle, ["sink_table"], "_life", F.col("row_key"), max_broadcast_rows)
    emptied = found.filter(F.col("_life.is_present"))
    return emptied.withColumn("deleted_at", F.greatest("deleted_at", "_life.emptied_at")).drop("_life")


def enrich(
    rows: DataFrame,
    dim: DataFrame,
    key: Column,
    columns: list[str],
    scatter_by: Column,
    table: str | None,
    how: str = "left",
    max_broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int | None = None,
) -> DataFrame:
    """Add columns of one dimension's rows by row key; ``matched`` tells hits from misses.

    ``table`` names the sink table among the rows of ``dim``; None says that they are of one table only.
    """
    if table is not None:
        dim = dim.filter(F.col("sink_table") == table)
    side = dim.select("row_key", *[F.col("data")[c].alias(c) for c in columns])
    keyed = rows.withColumn("row_key", key)
    if hot_rows is None:
        found = lookup_checked(keyed, side, ["row_key"], "_dim", scatter_by, max_broadcast_rows)
    else:
        found = lookup(keyed, side, ["row_key"], "_dim", scatter_by, hot_rows=hot_rows)
    matched = F.col("_dim").isNotNull()
    if how == "inner":
        found = found.filter(matched)
    return found.select(
        *rows.columns, *[F.col("_dim")[c].alias(c) for c in columns], matched.alias("matched")
    )
