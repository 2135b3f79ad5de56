"""Search-phrase words, without Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Full-width forms U+FF01..U+FF5E sit at a constant distance from ASCII; U+3000 is the wide blank.
WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
NARROW = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " "

WORD_BREAK = r"[^\p{L}\p{N}]+"


def fold(text: Column | str) -> Column:
    """Half-width, lower-case form of a text."""
    return F.lower(F.translate(text, WIDE, NARROW))


def words(text: Column | str) -> Column:
    """The distinct words of a text: runs of letters and digits. NULL gives NULL."""
    return F.array_distinct(F.array_remove(F.split(fold(text), WORD_BREAK), ""))
