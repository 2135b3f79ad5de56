"""Vector compression: each quarter of a vector becomes the number of its nearest codebook entry.

Components are scaled to integers, so that all distances, means and codes are exact. The codebooks are trained by
rounds of assignment and averaging over all vectors; the nearest entry is found by equal-average search: entries are
sorted by the sum of their components, the search starts where a part's own sum belongs and expands outward, and a
direction ends when the squared gap between the sums, divided by the dimension, strictly exceeds the best distance (by
Cauchy's inequality no entry beyond can be nearer, or as near with a lower number).

A round is one pass over the vectors: tasks send sums and counts per entry and component, Spark adds them, and the
driver gets one codebook (``parts * ENTRIES`` entries, whatever the number of vectors), which goes to the next round.

Defined cases: rows whose vector is null, or holds a null, NaN or infinite component, are left out, and so are vectors of
another length than that of the first kept row (by vec_id, nulls last) and lengths that are no positive multiple of
the number of parts. Components are kept within a bound at which squared distances over a whole vector fit 64 bits (for
64 components 131,072). Repeated rows are rows of their own; of equal distances the lower entry wins. With fewer than
``ENTRIES`` kept rows the codebook is smaller. A table without kept rows gives no rows. Rows without a label share one
label error.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rtdw.llm.common import ready

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Parts searched at a time.
BLOCK = 4096


def limit(dim: int) -> int:
    """The largest component at which the squared distance of two vectors fits 64 bits."""
    return math.isqrt(2**62 // dim) // 2


def integers(vectors: list) -> np.ndarray:
    """Finite vectors of one length as integer rows."""
    rows = np.stack([np.asarray(v, np.float64) for v in vectors])
    bound = limit(rows.shape[1])
    return np.clip(np.floor(rows * SCALE), -bound, bound).astype(np.int64)


class Codebook:
    """One part's entries, with their order by component sum."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        sums = entries.sum(1)
        self.order = np.argsort(sums, kind="stable")
        self.sums = sums[self.order]

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row the number of its nearest entry (the lowest of equals) and the squared distance."""
        found = [self._block(rows[i : i + BLOCK]) for i in range(0, len(rows), BLOCK)]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _block(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        dim, last = rows.shape[1], len(self.sums)
        sums = rows.sum(1)
        best = np.full(len(rows), np.iinfo(np.int64).max)
        code = np.full(len(rows), last)
        start = np.searchsorted(self.sums, sums)
        up, down = start, start - 1
        rising, falling = np.arange(len(rows)), np.arange(len(rows))
        while len(rising) or len(falling):
            rising, up = self._try(rows, sums, best, code, rising, up, dim)
            up = up + 1
            falling, down = self._try(rows, sums, best, code, falling, down, dim)
            down = down - 1
        return code, best

    def _try(self, rows, sums, best, code, active, place, dim) -> tuple[np.ndarray, np.ndarray]:
        """Compare the active rows with the entries at their places; those whose direction goes on, and the places."""
        inside = (place >= 0) & (place < len(self.sums))
        active, place = active[inside], place[inside]
        gap = sums[active] - self.sums[place]
        # Compared as whole quotients: gap**2 / dim > best just if ceil(gap**2 / dim) > best.
        near = _squares_over(gap, dim) <= best[active]
        active, place = active[near], place[near]
        entry = self.order[place]
        apart = rows[active] - self.entries[entry]
        distance = (apart * apart).sum(1)
        better = (distance < best[active]) | ((distance == best[active]) & (entry < code[active]))
        best[active[better]] = distance[better]
        code[active[better]] = entry[better]
        return active, place


def _squares_over(gap: np.ndarray, dim: int) -> np.ndarray:
    """``ceil(gap**2 / dim)``, with ``gap = dim * a + b`` so that nothing leaves 64 bits."""
    a, b = np.divmod(np.abs(gap), dim)
    return dim * a * a + 2 * a * b + -(-(b * b) // dim)


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, label and embedding of the rows that take part, whatever their length."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.coalesce(finite, F.lit(False)) & (F.size(v) > 0)).select("vec_id", "label", "embedding")


def _sums(books: list[np.ndarray]):
    """A pass that sends, per part, entry and component, the sum and number of the parts assigned there."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        searchers = [Codebook(b) for b in books]
        sums, counts = [np.zeros_like(b) for b in books], [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            if not len(batch):
                continue
            for part, rows in enumerate(np.split(integers(list(batch["embedding"])), len(books), axis=1)):
                code, _ = searchers[part].nearest(rows)
                np.add.at(sums[part], code, rows)
                counts[part] += np.bincount(code, minlength=len(books[part]))
        for part, (s, n) in enumerate(zip(sums, counts, strict=True)):
            used = np.flatnonzero(n)
            if len(used):
                entry, place = np.repeat(used, s.shape[1]), np.tile(np.arange(s.shape[1]), len(used))
                yield pd.DataFrame({"part": part, "entry": entry, "place": place, "total": s[used].ravel(), "n": np.repeat(n[used], s.shape[1])})

    return run


def train(kept: DataFrame, first: list[np.ndarray], rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks after ``rounds`` passes; an entry without parts stays as it is."""
    books = first
    for _ in range(rounds):
        sent = kept.select("embedding").mapInPandas(_sums(books), "part int, entry int, place int, total long, n long")
        # A sum over any number of vectors is taken in decimals; at most one row per component of the codebooks comes back.
        means = sent.groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(20,0)")).alias("total"), F.sum("n").alias("n"))
        books = [b.copy() for b in books]
        for row in means.toLocalIterator():
            books[row.part][row.entry, row.place] = int(row.total) // row.n
    return books


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def codes(kept: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error of every kept row."""
    label = dict(kept.dtypes)["label"]
    vec_id = dict(kept.dtypes)["vec_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        searchers = [Codebook(b) for b in books]
        for batch in batches:
            if not len(batch):
                continue
            found = [s.nearest(p) for s, p in zip(searchers, np.split(integers(list(batch["embedding"])), len(books), axis=1), strict=True)]
            names = [bytes(c).hex() for c in np.stack([f[0] for f in found], 1).astype(np.uint8).tolist()]
            # Ids and labels travel as text beside the vectors: a null turns no other value into a float.
            yield pd.DataFrame({"vec_id": batch["vec_id"], "label": batch["label"], "code": names, "error": sum(f[1] for f in found)})

    plain = kept.select(F.col("vec_id").cast("string"), F.col("label").cast("string"), "embedding")
    out = plain.mapInPandas(run, "vec_id string, label string, code string, error long")
    return out.select(F.col("vec_id").cast(vec_id), F.col("label").cast(label), "code", "error")


def codes_table(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Per kept vector: vec_id, code, error, label_error and the digest of the final codebooks."""
    if entries > 256:
        raise ValueError("a code has two hex digits a part: at most 256 entries")
    ready(vectors.sparkSession)
    kept = kept_vectors(vectors)
    start = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(1).collect()
    dim = len(start[0].embedding) if start else 0
    if not start or dim % parts:
        kept, books = kept.limit(0), [np.zeros((1, 1), np.int64)] * parts
    else:
        kept = kept.where(F.size("embedding") == dim)
        seeds = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).collect()
        books = train(kept, np.split(integers([s.embedding for s in seeds]), parts, axis=1), rounds)
    coded = codes(kept, books)
    by_label = coded.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error"))
    out = coded.join(by_label, F.col("label").eqNullSafe(F.col("same")), "left")
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
