"""Key lookups that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A side is broadcast only after counting that it has no more rows than this.
BROADCAST_ROWS = 20_000

# A key with more rows than this is hot. A table of N rows has fewer than N / HOT_ROWS hot keys, which
# bounds what the hot branch broadcasts: 10^12 rows give less than a million short entries.
HOT_ROWS = 1_000_000


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a frame has at most ``rows`` rows; reads no more than needed to know."""
    return df.limit(rows + 1).count() <= rows


def hot_keys(rows: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """The keys that hold more than ``hot_rows`` rows, with their number ``_rows``, counted with map-side combine."""
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counted.filter(F.col("_rows") > hot_rows)


def lookup(
    rows: DataFrame,
    side: DataFrame,
    keys: list[str],
    found: str,
    scatter_by: Column,
    count_column: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add the column ``found``: the one ``side`` row of each row's key as a struct, NULL on a miss.

    ``side`` has at most one row per key. Rows of hot keys take their answer from a small broadcast table
    and, like rows without a key, are scattered over the shuffle instead of meeting in one task; all other
    rows are joined by key. ``scatter_by`` should differ between the rows of one key.

    ``count_column`` names a column of ``side`` that holds the number of rows per key; it is for sides made from
    ``rows`` themselves, which know every key. Without it the keys of ``rows`` are counted.
    """
    values = [c for c in side.columns if c not in (*keys, count_column)]
    packed = F.struct(*values).alias("_side")
    if count_column:
        # Both parts read both columns, so that Spark computes the aggregation behind them once.
        hot_side = side.filter(F.col(count_column) > hot_rows).select(*keys, packed)
        cold_side = side.filter(F.col(count_column) <= hot_rows).select(*keys, packed)
    else:
        cold_side = side.select(*keys, packed)
        # The side is only filtered by the few hot keys, not shuffled a second time.
        hot = hot_keys(rows, keys, hot_rows).select(*keys)
        hot_side = hot.join(cold_side.join(F.broadcast(hot), keys, "left_semi"), keys, "left")
    hot_side = hot_side.select(*keys, F.lit(True).alias("_hot"), F.col("_side").alias("_hot_side"))

    # The slot is a second join key on which the shuffle depends. A literal on one side would not do: Spark turns
    # it into a condition and goes on to shuffle by the keys alone.
    own_slot = F.xxhash64(*keys)
    no_key = reduce(or_, (F.col(key).isNull() for key in keys))
    slot = F.when(F.col("_hot") | no_key, F.xxhash64(scatter_by)).otherwise(own_slot)
    marked = rows.join(F.broadcast(hot_side), keys, "left").withColumn("_slot", slot)
    joined = marked.join(cold_side.withColumn("_slot", own_slot), [*keys, "_slot"], "left")
    return joined.select(*rows.columns, F.coalesce("_hot_side", "_side").alias(found))


def lookup_checked(
    rows: DataFrame, side: DataFrame, keys: list[str], found: str, scatter_by: Column, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """As :func:`lookup`; a side that is counted to be small is broadcast and nothing is shuffled.

    ``max_rows`` 0 says that the side is known to be large: nothing is counted.
    """
    if max_rows > 0 and is_small(side, max_rows):
        packed = side.select(*keys, F.struct(*[c for c in side.columns if c not in keys]).alias(found))
        return rows.join(F.broadcast(packed), keys, "left").select(*rows.columns, found)
    return lookup(rows, side, keys, found, scatter_by)


def join_scattered(
    rows: DataFrame, side: DataFrame, keys: list[str], scatter_by: Column, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Inner join for sides that may have several rows per key.

    The rows of a hot key are dealt out to as many slots as it holds ``hot_rows``, and its side rows are repeated
    for each slot; the rows of all other keys have one slot.
    """
    slots = F.ceil(F.col("_rows") / hot_rows)
    hot = F.broadcast(hot_keys(rows, keys, hot_rows).select(*keys, slots.alias("_slots")))
    row_slot = F.when(F.col("_slots").isNotNull(), F.pmod(F.xxhash64(scatter_by), F.col("_slots"))).otherwise(0)
    side_slots = F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("_slots") - 1, F.lit(0).cast("bigint")))
    dealt = rows.join(hot, keys, "left").withColumn("_slot", row_slot)
    repeated = side.join(hot, keys, "left").withColumn("_slot", F.explode(side_slots))
    joined = dealt.drop("_slots").join(repeated.drop("_slots"), [*keys, "_slot"])
    return joined.select(*rows.columns, *[c for c in side.columns if c not in keys])
