"""Search keywords: filter, split into words, count per window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..functions.text import words
from ..functions.times import window_bounds
from ..sources.schemas import KEYWORD_WINDOW


def search_phrases(pages: DataFrame) -> DataFrame:
    """Search phrases ``kw`` of a page table: keyword items reached from the search or the home page."""
    page = F.col("page")
    wanted = (
        page["last_page_id"].isin("search", "home") & (page["item_type"] == "keyword") & page["item"].isNotNull()
    )
    kept = [c for c in ("seq", "et") if c in pages.columns]
    return pages.filter(wanted).select(*kept, page["item"].alias("kw"))


def split_words(phrases: DataFrame, phrase: str = "kw") -> DataFrame:
    """One row per distinct word of each phrase; a phrase without words gives no row."""
    rest = [c for c in phrases.columns if c != phrase]
    return phrases.select(*rest, F.explode(words(phrase)).alias("keyword"))


def window_counts(keywords: DataFrame, size: str = "5 seconds") -> DataFrame:
    """Keyword counts per tumbling window over ``et``, window bounds as text."""
    counted = keywords.groupBy(F.window("et", size), "keyword").agg(F.count(F.lit(1)).alias("keyword_count"))
    return counted.select(*window_bounds(F.col("window")), "keyword", "keyword_count").select(*KEYWORD_WINDOW)


def keyword_windows(pages: DataFrame, size: str = "5 seconds") -> DataFrame:
    return window_counts(split_words(search_phrases(pages)), size)


def register_kw_split(spark: SparkSession, name: str = "kw_split") -> None:
    """Make ``kw_split`` a table function in SQL: ``SELECT keyword FROM phrases, LATERAL kw_split(kw)``.

    Written with the comma, the call becomes one ``explode`` over the phrases. ``JOIN LATERAL ... ON true`` gives
    the same rows, but Spark then joins the phrases with their distinct values.
    """
    wide, narrow = (_quoted(s) for s in (text.WIDE, text.NARROW))
    split = f"split(lower(translate(phrase, {wide}, {narrow})), {_quoted(text.WORD_BREAK)})"
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(phrase STRING) RETURNS TABLE(keyword STRING) "
        f"RETURN SELECT explode(array_distinct(array_remove({split}, '')))"
    )


def _quoted(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
