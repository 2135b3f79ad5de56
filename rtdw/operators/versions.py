"""Lookups in tables that have versions: each row takes the version that was in force at its own time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lookup_as_of(rows: DataFrame, versions: DataFrame, keys: list[str], at: str, since: str, found: str, width: int) -> DataFrame:
    """Add the column ``found``: of a row's key, the last version with ``since <= at`` as a struct, NULL if there is none.

    ``at`` and ``since`` are whole numbers (such as seconds). Time is cut into buckets of ``width``, and rows and versions are merged by
    time within a key's bucket, so that the rows of a hot key are dealt out over its buckets. What a bucket begins with, the
    last version before it, comes from one row per key and bucket. Rows without key or time find nothing. Of versions with
    the same key and time one counts, the greatest by its columns.
    """
    values = [c for c in versions.columns if c not in (*keys, since)]
    version = F.struct(since, *values)
    bucket = lambda time: F.floor(F.col(time) / width).alias("_bucket")
    known = versions.dropna(subset=[*keys, since]).groupBy(*keys, since).agg(F.max(F.struct(*values)).alias("_v"))
    known = known.select(*keys, since, "_v.*").select(*keys, bucket(since), F.col(since).alias("_time"), version.alias("_version"))

    # One row per key and bucket: its last version, and what it begins with.
    ends = known.groupBy(*keys, "_bucket").agg(F.max_by("_version", "_time").alias("_last"))
    used = rows.select(*keys, bucket(at)).dropna().groupBy(*keys, "_bucket").agg(F.lit(None).cast(ends.schema["_last"].dataType).alias("_last"))
    spread = ends.unionByName(used).groupBy(*keys, "_bucket").agg(F.first("_last", ignorenulls=True).alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = spread.select(*keys, "_bucket", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))

    none = F.lit(None).cast(ends.schema["_last"].dataType)
    asked = rows.select(*keys, bucket(at), F.col(at).alias("_time"), none.alias("_version"), F.struct(*rows.columns).alias("_row"))
    told = known.select(*keys, "_bucket", "_time", "_version", F.lit(None).cast(asked.schema["_row"].dataType).alias("_row"))
    begun = carried.select(*keys, "_bucket", F.lit(None).cast(asked.schema["_time"].dataType).alias("_time"), F.col("_carried").alias("_version"))
    begun = begun.withColumn("_row", F.lit(None).cast(asked.schema["_row"].dataType))
    merged = asked.dropna(subset=[*keys, "_time"]).unionByName(told).unionByName(begun)
    # What the bucket begins with first, then by time, versions before the rows of their time.
    order = [F.col("_time").asc_nulls_first(), F.col("_row").isNotNull()]
    upto = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    answered = merged.withColumn("_version", F.last("_version", ignorenulls=True).over(upto)).where("_row is not null")
    rest = asked.where(~_all_known([*keys, "_time"]))
    return answered.select("_row.*", F.col("_version").alias(found)).unionByName(rest.select("_row.*", F.col("_version").alias(found)))


def _all_known(columns: list[str]) -> Column:
    known = F.lit(True)
    for name in columns:
        known = known & F.col(name).isNotNull()
    return known
