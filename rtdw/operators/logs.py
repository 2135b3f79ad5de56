"""Application logs: parsing, the new-visitor correction and the five branches.

A parsed log has ``log`` (all fields), ``common`` (its common part), ``mid``, ``is_new`` and ``ts`` besides the
topic's ``seq``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json import (
    long_of,
    object_json,
    object_of,
    objects_of,
    parse_object,
    parse_once,
    present,
    text_at,
    text_variant,
)
from ..functions.order import arrival
from ..functions.times import ms_to_timestamp
from ..sources.schemas import TOPIC_ACTION, TOPIC_DISPLAY, TOPIC_ERR, TOPIC_PAGE, TOPIC_START
from .lookup import HOT_ROWS, lookup

BRANCHES = {
    "start": TOPIC_START,
    "err": TOPIC_ERR,
    "display": TOPIC_DISPLAY,
    "page": TOPIC_PAGE,
    "action": TOPIC_ACTION,
}


def json_logs(topic: DataFrame) -> DataFrame:
    """Keep topic rows whose value is a JSON object, parsed once into ``log``."""
    return parse_once(topic, parse_object("value"), "log").filter(F.col("log").isNotNull()).drop("value")


def parse_logs(topic: DataFrame) -> DataFrame:
    """JSON logs that have what later steps need: a visitor and a time."""
    return _common_fields(json_logs(topic)).filter(F.col("mid").isNotNull() & F.col("ts").isNotNull())


def dead_letters(topic: DataFrame) -> DataFrame:
    """The rows that :func:`parse_logs` drops, and those of which the branches leave out an element, with the reason."""
    return with_reasons(topic).filter(F.col("reason").isNotNull())


def with_reasons(topic: DataFrame) -> DataFrame:
    """All rows, with the ``reason`` for which one is a dead letter, NULL for the others."""
    logs = _common_fields(parse_once(topic, parse_object("value"), "log"))
    reason = (
        F.when(F.col("log").isNull(), "not a JSON object")
        .when(F.col("mid").isNull(), "no visitor")
        .when(F.col("ts").isNull(), "no time")
        .when(_odd_element("displays"), "a display is no object")
        .when(_odd_element("actions"), "an action is no object")
    )
    return logs.select(*topic.columns, reason.alias("reason"))


def _odd_element(field: str) -> Column:
    """Some element of the list is no object."""
    return F.exists(objects_of(F.col("log"), field), lambda element: element.isNull())


def _common_fields(logs: DataFrame) -> DataFrame:
    log = F.col("log")
    return logs.withColumns(
        {
            "common": object_of(log, "common"),
            "mid": text_at(log, "common", "mid"),
            "is_new": text_at(log, "common", "is_new"),
            "ts": long_of(log, "ts"),
        }
    )


def day_of(ts: Column | str = "ts") -> Column:
    return F.to_date(ms_to_timestamp(ts))


def first_visits(logs: DataFrame) -> DataFrame:
    """Per visitor the remembered first day, and the number of rows.

    The day is settled by the visitor's first record: its own day if that calls the visitor new, else the day before.
    """
    # The first record calls its visitor new if it is also the first of those that do.
    first, first_new = F.min(arrival()), F.min(F.when(F.col("is_new") == "1", arrival()))
    day = day_of(F.min("ts"))
    return logs.groupBy("mid").agg(
        F.when(first == first_new, day).otherwise(F.date_sub(day, 1)).alias("first_day"),
        F.count(F.lit(1)).alias("row_count"),
    )


def fix_new_visitors(logs: DataFrame, visits: DataFrame | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Clear the new-visitor flag of records after the visitor's first day.

    The first day comes from one aggregation with map-side combine, and goes back to the rows by
    :func:`~rtdw.operators.lookup.lookup`, so no task ever holds all rows of a visitor. ``visits`` replaces the
    aggregation where the first days are already known. ``common`` is taken from the log again behind the shuffle.
    """
    visits = first_visits(logs) if visits is None else visits
    rows = logs.drop("common")
    found = lookup(rows, visits, ["mid"], "_visit", F.col("seq"), count_column="row_count", hot_rows=hot_rows)
    found = found.withColumn("common", object_of(F.col("log"), "common"))
    return clear_flags(found, (F.col("is_new") == "1") & (F.col("_visit.first_day") != day_of())).drop("_visit")


def clear_flags(logs: DataFrame, stale: Column) -> DataFrame:
    """Parsed logs with the new-visitor flag cleared where ``stale`` holds, in the record too."""
    others = F.map_filter("common", lambda key, _v: key != "is_new")
    corrected = F.map_concat(others, F.create_map(F.lit("is_new"), text_variant(F.lit("0"))))
    rest = F.map_filter("log", lambda key, _v: key != "common")
    rewritten = F.map_concat(rest, F.create_map(F.lit("common"), F.to_variant_object(corrected)))
    return logs.withColumns(
        {
            "log": F.when(stale, rewritten).otherwise(F.col("log")),
            "common": F.when(stale, corrected).otherwise(F.col("common")),
            "is_new": F.when(stale, F.lit("0")).otherwise(F.col("is_new")),
        }
    )


def _merged(element: Column, with_ts: bool) -> Column:
    """A list element with the fields of ``common`` written over its own, and the record's time if asked."""
    common = F.col("common")
    own = F.map_filter(element, lambda key, _v: ~F.map_contains_key(common, key))
    if not with_ts:
        return F.map_concat(own, common)
    own = F.map_filter(own, lambda key, _v: key != "ts")
    common = F.map_filter(common, lambda key, _v: key != "ts")
    return F.map_concat(own, common, F.create_map(F.lit("ts"), F.col("ts").cast("variant")))


# The fields that the branches of whole records leave out.
_LEFT_OUT = {"start": (), "err": ("displays", "actions"), "page": ("displays", "actions", "err")}


def start_records(logs: DataFrame) -> DataFrame:
    """Whole records that have ``start``."""
    return _branch(logs, "start")


def err_records(logs: DataFrame) -> DataFrame:
    """Records that have ``err``, without their displays and actions."""
    return _branch(logs, "err")


def page_records(logs: DataFrame) -> DataFrame:
    """Records that have ``page``, without displays, actions and error."""
    return _branch(logs, "page")


def display_records(logs: DataFrame) -> DataFrame:
    """One record per display, merged with the common part and the record's time."""
    return _elements(logs, "displays", with_ts=True)


def action_records(logs: DataFrame) -> DataFrame:
    """One record per action, merged with the common part; an action keeps its own time."""
    return _elements(logs, "actions", with_ts=False)


def _branch(logs: DataFrame, branch: str) -> DataFrame:
    rec = F.col("log")
    if _LEFT_OUT[branch]:
        rec = F.map_filter("log", lambda key, _v: ~key.isin(*_LEFT_OUT[branch]))
    return logs.filter(present(F.col("log"), branch)).select("seq", rec.alias("record"))


def _elements(logs: DataFrame, field: str, with_ts: bool) -> DataFrame:
    exploded = logs.select("seq", "common", "ts", F.explode(objects_of(F.col("log"), field)).alias("element"))
    return exploded.filter("element is not null").select("seq", _merged(F.col("element"), with_ts).alias("record"))


def fan_out(logs: DataFrame) -> DataFrame:
    """All branches in one pass over the logs, as topic rows ``seq, topic, value``. A log may give several rows."""
    log = F.col("log")

    def row(branch: str, value: Column) -> Column:
        return F.struct(F.lit(BRANCHES[branch]).alias("topic"), value.alias("value"))

    def whole(branch: str) -> Column:
        return F.when(present(log, branch), F.array(row(branch, object_json(log, _LEFT_OUT[branch]))))

    def each(branch: str, field: str, with_ts: bool) -> Column:
        # Elements that are no objects give no row: a NULL value would be a tombstone in a keyed topic.
        elements = F.array_compact(objects_of(log, field))
        return F.transform(elements, lambda element: row(branch, object_json(_merged(element, with_ts))))

    branches = [
        whole("start"),
        each("display", "displays", with_ts=True),
        each("action", "actions", with_ts=False),
        whole("err"),
        whole("page"),
    ]
    none = F.array().cast("array<struct<topic: string, value: string>>")
    rows = F.concat(*[F.coalesce(found, none) for found in branches])
    return logs.select("seq", F.inline(rows))
