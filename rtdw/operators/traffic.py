"""Traffic measures of page logs: visitors, sessions, views and time per window and dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json import long_of, object_of, present, text_of
from ..functions.names import snake_columns
from ..functions.order import arrival, seq_of
from ..functions.times import ms_to_timestamp, window_bounds
from ..sources.schemas import TRAFFIC_WINDOW
from .envelope import row_json
from .logs import day_of

DIMENSIONS = ["vc", "ch", "ar", "is_new"]


def parse_pages(logs: DataFrame) -> DataFrame:
    """Page views of parsed logs: ``seq, ts, mid, sid, vc, ch, ar, is_new, dur``."""
    common = F.col("common")
    page = object_of(F.col("log"), "page")
    return logs.filter(present(F.col("log"), "page")).select(
        "seq",
        "ts",
        "mid",
        text_of(common, "sid").alias("sid"),
        *[text_of(common, c).alias(c) for c in DIMENSIONS if c != "is_new"],
        "is_new",
        F.coalesce(long_of(page, "during_time"), F.lit(0)).alias("dur"),
    )


def first_of_day_and_session(pages: DataFrame) -> DataFrame:
    """``seq, uv, sv`` of the page views that open a visitor's day (``uv``) or a session (``sv``).

    Both are found in one aggregation over (kind, key) with map-side combine, so a visitor or session with very
    many views costs one short row per map task.
    """
    keyed = pages.select("ts", "seq", F.inline(F.array(_visitor_day(), _session()))).filter(F.col("key").isNotNull())
    openings = keyed.groupBy("kind", "key", "day").agg(seq_of(F.min(arrival()), F.min("ts")).alias("seq"))
    return openings.groupBy("seq").agg(
        F.max((F.col("kind") == "uv").cast("bigint")).alias("uv"),
        F.max((F.col("kind") == "sv").cast("bigint")).alias("sv"),
    )


def _visitor_day(*more: Column) -> Column:
    return F.struct(F.lit("uv").alias("kind"), F.col("mid").alias("key"), day_of().alias("day"), *more)


def _session(*more: Column) -> Column:
    day = F.lit(None).cast("date").alias("day")
    return F.struct(F.lit("sv").alias("kind"), F.col("sid").alias("key"), day, *more)


def flag_visits(pages: DataFrame, openers: DataFrame | None = None) -> DataFrame:
    """Add ``uv`` and ``sv`` to page views, joined on the unique ``seq``."""
    openers = first_of_day_and_session(pages) if openers is None else openers
    flagged = pages.join(openers, "seq", "left")
    return flagged.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in ("uv", "sv")})


def traffic_windows(flagged: DataFrame, size: str = "5 seconds") -> DataFrame:
    """Measures per tumbling window and dimension of flagged views, for streams.

    Takes ``et`` as event time, or ``ts`` where it is absent.
    """
    timed = flagged if "et" in flagged.columns else flagged.withColumn("et", ms_to_timestamp("ts"))
    return _sum_windows(timed.withColumn("pv", F.lit(1).cast("bigint")), size)


def traffic_report(pages: DataFrame, size: str = "5 seconds") -> DataFrame:
    """Measures per tumbling window and dimension straight from page views, reading them once.

    Gives what :func:`flag_visits` and :func:`traffic_windows` give, but no view is shuffled as such: one
    aggregation with map-side combine sums views and time per window and dimension and finds, beside them, the
    opening view of every visitor's day and session. The openings carry their time and dimensions into the sums.
    """
    no_group = F.lit(None).cast(f"struct<et: timestamp, {', '.join(f'{c}: string' for c in DIMENSIONS)}>")
    group = F.struct(F.window(ms_to_timestamp("ts"), size)["start"].alias("et"), *DIMENSIONS)
    view = F.struct(
        F.lit("pv").alias("kind"),
        F.lit(None).cast("string").alias("key"),
        F.lit(None).cast("date").alias("day"),
        group.alias("group"),
    )
    visits = [_visitor_day(no_group.alias("group")), _session(no_group.alias("group"))]
    opening = F.struct(ms_to_timestamp("ts").alias("et"), *DIMENSIONS).alias("opening")
    rows = pages.select("ts", "seq", "dur", opening, F.inline(F.array(view, *visits)))
    is_view = F.col("kind") == "pv"
    reduced = (
        rows.filter(is_view | F.col("key").isNotNull())
        .groupBy("kind", "key", "day", "group")
        .agg(
            F.min_by("opening", F.struct("ts", "seq")).alias("opening"),
            F.count(F.lit(1)).alias("rows"),
            F.sum("dur").alias("dur"),
        )
    )
    none = F.lit(0).cast("bigint")
    counted = reduced.select(
        F.coalesce("group", "opening").alias("at"),
        (F.col("kind") == "uv").cast("bigint").alias("uv"),
        (F.col("kind") == "sv").cast("bigint").alias("sv"),
        F.when(is_view, F.col("rows")).otherwise(none).alias("pv"),
        F.when(is_view, F.col("dur")).otherwise(none).alias("dur"),
    )
    return _sum_windows(counted.select("at.*", "uv", "sv", "pv", "dur"), size)


def _sum_windows(timed: DataFrame, size: str) -> DataFrame:
    summed = timed.groupBy(F.window("et", size), *DIMENSIONS).agg(
        F.sum("uv").alias("uv_ct"), F.sum("sv").alias("sv_ct"), F.sum("pv").alias("pv_ct"), F.sum("dur").alias("dur_sum")
    )
    return summed.select(
        *window_bounds(F.col("window")), *DIMENSIONS, "uv_ct", "sv_ct", "pv_ct", "dur_sum"
    ).select(*TRAFFIC_WINDOW)


def report_json(report: DataFrame, hidden: tuple[str, ...] = ("ts", "sid")) -> DataFrame:
    """Report rows as JSON lines with snake_case names, less the hidden columns."""
    named = snake_columns(report).drop(*hidden)
    return named.select(row_json(*named.columns).alias("value"))
