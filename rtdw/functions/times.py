"""Time conversions.

Text to epoch is pinned to one zone offset; epoch to text follows the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The offset and the text formats of the warehouse.
TEXT_OFFSET = "+08:00"
DATE_TIME = "yyyy-MM-dd HH:mm:ss"
DATE = "yyyy-MM-dd"
PARTITION = "yyyyMMdd"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_time_to_ms(text: Column | str, offset: str = TEXT_OFFSET) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` at ``offset`` to epoch milliseconds; unreadable text gives NULL."""
    stamped = F.concat(_column(text), F.lit(f" {offset}"))
    return F.unix_millis(F.try_to_timestamp(stamped, F.lit(f"{DATE_TIME} XXX")))


def date_to_ms(text: Column | str, offset: str = TEXT_OFFSET) -> Column:
    """``yyyy-MM-dd`` at midnight of ``offset`` to epoch milliseconds."""
    return date_time_to_ms(F.concat(_column(text), F.lit(" 00:00:00")), offset)


def ms_to_date(ms: Column | str) -> Column:
    return F.date_format(ms_to_timestamp(ms), DATE)


def ms_to_date_time(ms: Column | str) -> Column:
    return F.date_format(ms_to_timestamp(ms), DATE_TIME)


def ms_to_partition(ms: Column | str) -> Column:
    return F.date_format(ms_to_timestamp(ms), PARTITION)


def ms_to_timestamp(ms: Column | str) -> Column:
    return F.timestamp_millis(_column(ms))


def seconds_to_timestamp(seconds: Column | str) -> Column:
    return F.timestamp_seconds(_column(seconds))


def window_bounds(window: Column) -> list[Column]:
    """Window start and end as text, and the start's day as a partition value: ``stt, edt, cur_date``."""
    return [
        F.date_format(window["start"], DATE_TIME).alias("stt"),
        F.date_format(window["end"], DATE_TIME).alias("edt"),
        F.date_format(window["start"], PARTITION).alias("cur_date"),
    ]
