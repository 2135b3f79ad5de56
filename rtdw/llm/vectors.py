"""Embedding near-duplicates by a subspace pigeonhole join.

Vectors of one label whose cosine reaches a threshold are, as unit vectors, at most ``2 - 2 * cosine`` apart in squared
distance. A random rotation spreads this over all coordinates; cut into ``BLOCKS`` blocks of low dimension, a linked
pair must keep within the proportional share of the budget in at least one block. So each block is joined by range on
its own: its first ``GRID`` coordinates make a grid whose cells are twice the block's radius wide, a vector lives in
its cell and is also sent to the later ones of the neighbouring cells that its ball touches, and so meets every possible
partner of the block exactly once. Candidates within the block's share are verified exactly, in double precision, on
the whole vectors; a pair that several blocks find counts in the first of them.

Equal vectors are one class, joined once. Cells with many classes are cut into tiles of at most about ``TILE`` classes
a side, so no task gets an unbounded cell. Tiles send out sums and links to local roots, never pairs.

Defined cases: vectors that are null, zero, empty or hold null or non-finite components, and vectors without a label,
link with nothing and are their own component. Vectors of different length do not link. Repeated rows are a class and
link with each other. Rows without a vec_id count as links and never name a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rtdw.llm.common import components, ready, stored
from rtdw.llm.simhash import local_roots

BLOCKS = 4
GRID = 3
TILE = 2000
MARGIN = 1e-5  # for rounding to single precision in the candidate stage
CELL = ["label", "dim", "block", "cell"]


def rotation(dim: int) -> np.ndarray:
    """The same random rotation for a dimension everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(dim).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def block_bounds(dim: int) -> list[tuple[int, int]]:
    """Begin and end of each block's coordinates (fewer blocks than coordinates)."""
    n = max(1, min(BLOCKS, dim))
    cuts = [dim * i // n for i in range(n + 1)]
    return list(zip(cuts, cuts[1:], strict=False))


def budget(cosine: float, first: int, last: int, dim: int) -> float:
    """A block's share of the squared distance, in proportion to its coordinates."""
    return (2.0 - 2.0 * cosine + MARGIN) * (last - first) / dim


def rotated(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors, rotated, in single precision."""
    unit = vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))
    return (unit @ rotation(vectors.shape[1])).astype(np.float32)


def cells(rows: np.ndarray, cosine: float) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
    """For each block: (block, row numbers, cell coordinates, whether it is the rows' own cell)."""
    dim = rows.shape[1]
    for block, (first, last) in enumerate(block_bounds(dim)):
        radius = float(np.sqrt(budget(cosine, first, last, dim)))
        x = rows[:, first : min(first + GRID, last)].astype(np.float64)
        home = np.floor(x / (2 * radius)).astype(np.int64)
        everyone = np.arange(len(rows))
        yield block, everyone, home, True
        # The ball touches at most one neighbour in each coordinate: that of the nearer wall.
        step = np.where(x / (2 * radius) - home < 0.5, -1, 1)
        for choice in range(1, 1 << x.shape[1]):
            moved = home + step * [(choice >> i) & 1 for i in range(x.shape[1])]
            change = moved - home
            lead = change[everyone, (change != 0).argmax(1)]
            later = lead > 0  # of two neighbouring cells only the earlier one's vectors travel
            yield block, everyone[later], moved[later], False


def tile_links(
    plain: np.ndarray, turned: np.ndarray, home: np.ndarray, side: np.ndarray, weight: np.ndarray, block: int, cosine: float
) -> tuple[np.ndarray, np.ndarray]:
    """Links found in one tile: per row the weight of linked rows, and the least row of its local component.

    ``side`` numbers the halves of a tile: rows meet across halves, or with all others if there is one half only.
    """
    n, dim = turned.shape
    bounds = block_bounds(dim)
    limits = [budget(cosine, a, b, dim) for a, b in bounds]
    first, last = bounds[block]
    part = turned[:, first:last].astype(np.float64)
    square = (part * part).sum(1)
    norms = np.sqrt((plain * plain).sum(1))
    across = side.min() != side.max()
    count = np.zeros(n, np.int64)

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for at in range(0, n, 256):
            near = square[at : at + 256, None] + square[None, :] - 2.0 * part[at : at + 256] @ part.T <= limits[block] + 1e-9
            i, j = np.nonzero(near)
            i += at
            good = (i < j) & (home[i] | home[j])
            if across:
                good &= side[i] != side[j]
            i, j = i[good], j[good]
            for k in range(0, len(i), 50_000):
                a, b = i[k : k + 50_000], j[k : k + 50_000]
                for number, (f, l) in enumerate(bounds[: block + 1]):
                    gap = turned[a, f:l].astype(np.float64) - turned[b, f:l]
                    within = (gap * gap).sum(1) <= limits[number]
                    stay = within if number == block else ~within
                    a, b = a[stay], b[stay]
                linked = (plain[a] * plain[b]).sum(1) / (norms[a] * norms[b]) >= cosine
                a, b = a[linked], b[linked]
                np.add.at(count, a, weight[b])
                np.add.at(count, b, weight[a])
                yield a, b

    return local_roots(n, pairs()), count


def classes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows with the content address of their class (null if they link with nothing), and the classes."""
    ready(vectors.sparkSession)
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))
    address = F.when(usable, F.struct("label", F.xxhash64(v).alias("h1"), F.xxhash64(v, F.lit(1)).alias("h2")))
    rows = vectors.select("vec_id", "label", "embedding", address.alias("address"))
    # A class is numbered once, when it is written.
    found = rows.where("address is not null").groupBy("address").agg(F.first("embedding").alias("embedding"), F.min("vec_id").alias("least"), F.count("*").alias("n"))

    def turn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["turned"] = pd.Series([None] * len(batch), dtype=object, index=batch.index)
            for dim, group in batch.groupby(batch["embedding"].map(len)):
                matrix = rotated(np.stack([np.asarray(e, np.float64) for e in group["embedding"]]))
                for i, row in zip(group.index, matrix, strict=True):
                    batch.at[i, "turned"] = row
            yield batch

    numbered = found.select(F.monotonically_increasing_id().alias("cid"), "address.label", "address", "embedding", "least", "n")
    kinds = dict(numbered.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in ("cid", "label", "address", "embedding", "least", "n")) + ", turned array<float>"
    return rows.drop("embedding"), stored(numbered.mapInPandas(turn, schema), "vector-classes")


def class_links(classes: DataFrame, cosine: float, tile: int = TILE) -> DataFrame:
    """(cid, links, root): per class and tile the number of linked vectors of other classes, and its local root."""
    label_type = dict(classes.dtypes)["label"]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, group in batch.groupby(batch["turned"].map(len)):
                matrix, ids, labels = np.stack(list(group["turned"])), group["cid"].to_numpy(), group["label"].to_numpy()
                for block, rows, where, own in cells(matrix, cosine):
                    if len(rows):
                        names = [",".join(map(str, c)) for c in where.tolist()]
                        yield pd.DataFrame({"label": labels[rows], "dim": dim, "block": block, "cell": names, "cid": ids[rows], "home": own})

    placed = classes.select("cid", "label", "turned").mapInPandas(place, f"label {label_type}, dim int, block int, cell string, cid long, home boolean")
    placed = stored(placed, "vector-cells")
    sizes = placed.groupBy(*CELL).agg(F.count("*").alias("size"), F.count_if("home").alias("homes")).where("size > 1 and homes > 0")
    sized = placed.join(sizes, CELL).withColumn("sides", F.ceil(F.col("size") / tile).cast("int"))
    sized = sized.withColumn("side", F.pmod(F.xxhash64("cid"), F.col("sides")).cast("int"))
    sized = sized.select("*", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)).alias("other"))
    sized = sized.withColumns({"lo": F.least("side", "other"), "hi": F.greatest("side", "other")}).drop("size", "homes", "sides", "other")
    key = [*CELL, "lo", "hi"]
    full = sized.join(classes.select("cid", "n", "embedding", "turned"), "cid")
    full = full.repartition(*key).sortWithinPartitions(*key, "cid")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for batch in batches:
            batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
            names = batch[key]
            border = (names != names.shift()).any(axis=1).to_numpy()
            starts = np.flatnonzero(border)
            yield from _tiles(batch, starts, cosine)
            held = batch.iloc[starts[-1] :].reset_index(drop=True) if len(starts) else None
        if held is not None:
            yield from _tiles(held, np.array([0, len(held)]), cosine)

    return full.mapInPandas(run, "cid long, links long, root long")


def _tiles(batch: pd.DataFrame, starts: np.ndarray, cosine: float) -> Iterator[pd.DataFrame]:
    """The links of the tiles between successive starts (the rows after the last start wait)."""
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        if b - a < 2:
            continue
        rows = batch.iloc[a:b]
        plain = np.stack([np.asarray(e, np.float64) for e in rows["embedding"]])
        turned = np.stack([np.asarray(e, np.float32) for e in rows["turned"]])
        ids, block = rows["cid"].to_numpy(np.int64), int(rows["block"].iloc[0])
        side = rows["side"].to_numpy(np.int64)
        if rows["lo"].iloc[0] == rows["hi"].iloc[0]:
            side = np.zeros(len(rows), np.int64)
        elif side.min() == side.max():
            continue
        root, count = tile_links(plain, turned, rows["home"].to_numpy(bool), side, rows["n"].to_numpy(np.int64), block, cosine)
        found = count > 0
        if found.any():
            yield pd.DataFrame({"cid": ids[found], "links": count[found], "root": ids[root[found]]})


def vectors_table(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """Per vector: vec_id, n_links, component_id and kept."""
    rows, classes = classes_of(vectors)
    found = stored(class_links(classes, cosine), "vector-links")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("root").alias("a"), F.col("cid").alias("b"))).withColumnRenamed("node", "cid")
    placed = classes.select("cid", "address", "least", "n").join(links, "cid", "left").join(roots, "cid", "left")
    placed = placed.withColumn("root", F.coalesce("root", "cid"))
    least = placed.groupBy("root").agg(F.min("least").alias("component"))
    placed = placed.join(least, "root").select("address", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), "component")
    out = rows.join(placed, "address", "left")
    component = F.when(F.col("address").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
