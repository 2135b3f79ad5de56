"""The comment fact: comments with the name of their rating."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import COMMENT_FACT
from .lookup import BROADCAST_ROWS, lookup_checked


def extract_comments(changes: DataFrame, database: str) -> DataFrame:
    """New comments of a change table, with their columns taken out of ``data``."""
    data = F.col("data")
    wanted = (F.col("database") == database) & (F.col("table") == "comment_info") & (F.col("type") == "insert")
    kept = [c for c in ("seq", "et", "pt") if c in changes.columns]
    return changes.filter(wanted).select(
        *[c for c in kept if c != "pt"],
        data["id"].alias("id"),
        data["user_id"].alias("user_id"),
        data["sku_id"].alias("sku_id"),
        data["appraise"].alias("appraise"),
        data["comment_txt"].alias("comment_txt"),
        data["create_time"].alias("comment_time"),
        "ts",
        *[c for c in kept if c == "pt"],
    )


def lookup_comments(comments: DataFrame, dictionary: DataFrame, max_broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Comments whose rating the dictionary knows, with its name.

    The dictionary is looked up as it is when the frame is built; streams build it anew per micro-batch.
    """
    codes = dictionary.withColumnRenamed("dic_code", "appraise")
    scatter = F.coalesce(F.col("comment_txt"), F.col("id"))
    found = lookup_checked(comments, codes, ["appraise"], "dic", scatter, max_broadcast_rows)
    return (
        found.filter(F.col("dic").isNotNull())
        .withColumn("appraise_name", F.col("dic.info.dic_name"))
        .select(*[c for c in ("seq",) if c in comments.columns], *COMMENT_FACT)
    )
