"""Snapshot reads of configuration and lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import camel_columns


def read_table(spark: SparkSession, source: str, *, camel: bool = False, **jdbc: str) -> DataFrame:
    """A table from parquet (``source`` is a path) or, with JDBC options such as ``url``, from a database."""
    table = spark.read.format("jdbc").options(dbtable=source, **jdbc).load() if jdbc else spark.read.parquet(source)
    return camel_columns(table) if camel else table


def dictionary(table: DataFrame, code: str = "dic_code", name: str = "dic_name") -> DataFrame:
    """A code table as ``dic_code, info struct<dic_name>``."""
    return table.select(F.col(code).alias("dic_code"), F.struct(F.col(name).alias("dic_name")).alias("info"))


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Rows for much work each, dealt out by ``key`` if they come in fewer pieces than there are cores."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores, key)
