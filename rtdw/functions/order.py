"""One number per record that orders by time and then by arrival.

A decimal has a fixed width, so its minimum is a hash aggregate; the minimum of a struct would sort all rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPAN = Decimal(2**63)


def arrival(ts: Column | str = "ts", seq: Column | str = "seq") -> Column:
    """``ts`` and ``seq`` in one number: any two bigints fit, ``seq`` being an arrival number from 0 on."""
    return _decimal(ts) * F.lit(_SPAN) + _decimal(seq)


def seq_of(number: Column, ts: Column) -> Column:
    """The ``seq`` in a number of :func:`arrival` whose ``ts`` is known."""
    return (number - _decimal(ts) * F.lit(_SPAN)).cast("bigint")


def _decimal(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("decimal(20,0)")
