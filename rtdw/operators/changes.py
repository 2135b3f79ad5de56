"""Change records: filtering, configuration state, routing by configuration and column pruning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json import is_object_text, parse_once, text_map_json, unwrap
from ..sources.changelog import image
from ..sources.schemas import CHANGE, DIM_ROUTE, FACT_ROUTE
from ..sources.topics import typed
from .lookup import BROADCAST_ROWS, is_small, join_scattered

FACT_TYPES = ("insert", "update")
DIM_TYPES = ("insert", "update", "delete")


def _wanted(database: str, types: tuple[str, ...]) -> Column:
    return (F.col("database") == database) & F.col("type").isin(*types) & (F.cardinality("data") > 0)


def fact_changes(topic: DataFrame, database: str) -> DataFrame:
    """Inserts and updates of one database that carry data."""
    return typed(topic, CHANGE).filter(_wanted(database, FACT_TYPES))


def dim_changes(topic: DataFrame, database: str) -> DataFrame:
    """Inserts, updates and deletes of one database that carry data; doubly quoted values are read too."""
    return typed(unquoted(topic), CHANGE).filter(_wanted(database, DIM_TYPES))


def unquoted(topic: DataFrame) -> DataFrame:
    """The topic with doubly quoted values unwrapped."""
    return topic.select(*[c for c in topic.columns if c != "value"], unwrap("value").alias("value"))


def unreadable_changes(topic: DataFrame) -> DataFrame:
    """Topic rows that are not change records, for the dead-letter table."""
    plain = unwrap("value")
    record = F.when(is_object_text(plain), F.from_json(plain, CHANGE))
    parsed = parse_once(topic, record, "row")
    return parsed.filter(F.col("row.database").isNull() | F.col("row.table").isNull()).drop("row")


def config_rows(captures: DataFrame, schema: str) -> DataFrame:
    """Captured configuration changes as ``seq, op`` and the columns of ``schema``."""
    names = [field.split()[0] for field in schema.split(", ")]
    return image(captures).select("seq", "op", *[F.col("row")[n].alias(n) for n in names])


def current_config(config: DataFrame, source_keys: list[str], multi_route: bool = False) -> DataFrame:
    """The configuration in force after a history of rows with ``seq`` and ``op``.

    First the last row per ``sink_table`` decides, and deleted ones go, so a row that moves to another
    source leaves its old one. Then each source key keeps its latest row, unless ``multi_route``.
    """
    columns = [c for c in config.columns if c != "sink_table"]
    live = (
        config.groupBy("sink_table")
        .agg(F.max_by(F.struct(*columns), "seq").alias("last"))
        .select("sink_table", "last.*")
        .filter(F.col("op") != "d")
    )
    if not multi_route:
        columns = [c for c in live.columns if c not in source_keys]
        live = (
            live.groupBy(*source_keys)
            .agg(F.max_by(F.struct(*columns), "seq").alias("last"))
            .select(*source_keys, "last.*")
        )
    return live.select(*[c for c in config.columns if c not in ("seq", "op")])


def fact_config(captures: DataFrame, multi_route: bool = False) -> DataFrame:
    return current_config(config_rows(captures, FACT_ROUTE), ["source_table", "source_type"], multi_route)


def dim_config(captures: DataFrame, multi_route: bool = False) -> DataFrame:
    return current_config(config_rows(captures, DIM_ROUTE), ["source_table"], multi_route)


def route_facts(changes: DataFrame, routes: DataFrame, max_broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add the route of each change by table and type; changes without a route are dropped."""
    on = {"table": "source_table", "type": "source_type"}
    return _route(changes, routes, on, max_broadcast_rows)


def route_dims(changes: DataFrame, routes: DataFrame, max_broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add the route of each change by table, its row key and ``op_type`` (a column, never inside ``data``)."""
    routed = _route(changes, routes, {"table": "source_table"}, max_broadcast_rows)
    return routed.withColumns({"op_type": F.col("type"), "row_key": F.col("data")[F.col("sink_row_key")]})


def _route(changes: DataFrame, routes: DataFrame, on: dict[str, str], max_broadcast_rows: int) -> DataFrame:
    renamed = routes.withColumnsRenamed({source: change for change, source in on.items()})
    keys = list(on)
    values = [c for c in renamed.columns if c not in keys]
    if max_broadcast_rows > 0 and is_small(routes, max_broadcast_rows):
        return changes.join(F.broadcast(renamed), keys).select(*changes.columns, *values)
    scatter = F.col("seq") if "seq" in changes.columns else F.map_entries("data")
    return join_scattered(changes, renamed, keys, scatter)


def prune_columns(routed: DataFrame) -> DataFrame:
    """Keep only the fields of ``data`` that ``sink_columns`` names, compared as written."""
    listed = F.split("sink_columns", ",")
    return routed.withColumn("data", F.map_filter("data", lambda key, _v: F.array_contains(listed, key)))


def fact_topic_rows(routed: DataFrame) -> DataFrame:
    """Routed facts as ``seq, key, topic, value``: the sink table names the topic, null fields are left out.

    Rows are published by source table and id, so that one row's changes keep their order.
    """
    kept = [c for c in ("seq",) if c in routed.columns]
    key = F.concat_ws(":", "table", F.col("data")["id"])
    return routed.select(
        *kept, key.alias("key"), F.col("sink_table").alias("topic"), text_map_json("data").alias("value")
    )
