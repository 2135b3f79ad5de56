"""SimHash near-duplicates by sharded BK-trees.

Two fingerprints of 64 bits within ``distance`` differing bits agree in full on at least ``BLOCKS - distance`` of the
equal blocks that the bits are cut into. So each distinct fingerprint goes to one shard for every choice of that many
blocks, named by the choice and their bits, and linked fingerprints always meet in a shard. A shard's fingerprints form
a BK-tree: children hang on an edge with their Hamming distance to the parent. A search for everything within the
radius goes down only the edges whose distance is within the radius of the searched one's distance to the node.

Shards are dealt out by a shuffle instead of a broadcast, as trees over a corpus have no size bound. A shard with more
than ``hot`` members is dealt anew by the same rule on the bits that its name leaves open: its parts hold at most
2**16 fingerprints, whatever the data. Each shard sends links to the least member of each of its local components, at
most one per member, never all pairs; the links are closed to components in Spark.

Defined cases: a null or empty text, or one of white space, has fingerprint zero and is linked like any other; fewer
words than a shingle are one shingle. Repeated rows and copies share a fingerprint and so a component. The component's
id is the least doc_id in it; rows without a doc_id are grouped but never name a component (null if all are without).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rtdw.llm.common import components, free_name, ready, stored

BITS = 64
BLOCKS = 4
SEED = 42
NO_ID = (1 << 63) - 1


def text_fingerprint(text: str | None, shingle: int = 3) -> int:
    """The SimHash of one text: a bit is set if it is set in over half of the shingles' hashes."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z are lowered, split at the six white-space characters
    if not words:
        return 0
    count = max(len(words) - shingle + 1, 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:count].tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=True)), "<u8", count)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(count, 8), axis=1, bitorder="little")
    set_in = np.add.reduce(bits, axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(set_in * 2 > count, bitorder="little").tobytes(), "little")


def fingerprint(docs: DataFrame, shingle: int = 3, text: str = "text") -> Column:
    """A long column with a text column's fingerprints (the 64 bits, as a signed number)."""
    ready(docs.sparkSession)

    def run(texts: pd.Series) -> pd.Series:
        prints = np.array([text_fingerprint(t, shingle) for t in texts], np.uint64)
        return pd.Series(prints.view(np.int64))

    return F.pandas_udf(run, "long")(F.col(text))


def block_choices(bits: int, distance: int) -> list[list[tuple[int, int]]]:
    """For each choice of blocks that must agree: the (first bit, number of bits) of its blocks."""
    cuts = [bits * i // BLOCKS for i in range(BLOCKS + 1)]
    blocks = [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [list(choice) for choice in combinations(blocks, BLOCKS - distance)]


def _name(choice: list[tuple[int, int]], number: int, places: list[int]) -> Column:
    """The bits of ``fp`` at a choice's blocks (``places`` maps them to bits of ``fp``), under the choice's number."""
    bits = [places[first + i] for first, size in choice for i in range(size)]
    mask = sum(1 << b for b in bits)
    return F.struct(F.lit(number).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("bits"))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def shards(prints: DataFrame, distance: int, hot: int) -> DataFrame:
    """``fp`` with the ``shard`` (two levels of choice and bits) it goes to, for all shards that matter."""
    choices = block_choices(BITS, distance)
    first = prints.select("fp", F.explode(F.array(*(_name(c, i, list(range(BITS))) for i, c in enumerate(choices)))).alias("one"))
    sizes = first.groupBy("one").agg(F.count("*").alias("n")).where("n > 1")
    first = first.join(sizes, "one")
    second = F.lit(None).cast("array<struct<choice:int,bits:bigint>>")
    for i, choice in enumerate(choices):
        named = {first_bit + k for first_bit, size in choice for k in range(size)}
        left = [b for b in range(BITS) if b not in named]
        inner = [_name(c, j, left) for j, c in enumerate(block_choices(len(left), distance))]
        second = F.when(F.col("one.choice") == i, F.array(*inner)).otherwise(second)
    none = F.array(F.struct(F.lit(-1).alias("choice"), F.lit(0).cast("long").alias("bits")))
    out = first.select("fp", "one", F.explode(F.when(F.col("n") > hot, second).otherwise(none)).alias("two"))
    return out.select("fp", F.struct("one.*", F.col("two.choice").alias("choice2"), F.col("two.bits").alias("bits2")).alias("shard"))


class BkForest:
    """BK-trees over the members of many shards at once, built and searched level by level."""

    def __init__(self, shard: np.ndarray, prints: np.ndarray):
        """``shard`` numbers the (sorted) members' shards; ``prints`` are distinct within a shard."""
        self.prints, n = prints, len(prints)
        self.parent_edge = np.zeros(n, np.int64)
        order, group = np.arange(n), shard.astype(np.int64)
        parents, children = [], []
        roots = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if n else order
        self.root = np.repeat(roots, np.diff(np.r_[roots, n])) if n else order
        parent = np.full(n, -1)
        while len(order):
            # The first of each group is its node; the others go on by their distance to it.
            head = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            sizes = np.diff(np.r_[head, len(order)])
            node = np.repeat(order[head], sizes)
            heads = order[head]
            known = parent[head] >= 0
            parents.append(parent[head][known])
            children.append(heads[known])
            rest = np.ones(len(order), bool)
            rest[head] = False
            order, node = order[rest], node[rest]
            edge = np.bitwise_count(prints[order] ^ prints[node]).astype(np.int64)
            self.parent_edge[order] = edge
            by = np.lexsort((order, edge, node))
            order, parent = order[by], node[by]
            group = parent * (BITS + 1) + edge[by]
        parents = np.concatenate(parents) if parents else np.zeros(0, np.int64)
        children = np.concatenate(children) if children else np.zeros(0, np.int64)
        by = np.lexsort((self.parent_edge[children], parents))
        self.children = children[by]
        self.keys = parents[by] * (BITS + 1) + self.parent_edge[self.children]

    def within(self, searched: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (searched member, other member of its tree) at most ``radius`` bits apart."""
        query, node, found = searched, self.root[searched], []
        while len(query):
            apart = np.bitwise_count(self.prints[query] ^ self.prints[node]).astype(np.int64)
            hit = (apart <= radius) & (query != node)
            found.append((query[hit], node[hit]))
            low = np.searchsorted(self.keys, node * (BITS + 1) + np.maximum(apart - radius, 0), "left")
            high = np.searchsorted(self.keys, node * (BITS + 1) + np.minimum(apart + radius, BITS), "right")
            size = high - low
            query = np.repeat(query, size)
            before = np.cumsum(size) - size
            node = self.children[np.repeat(low - before, size) + np.arange(size.sum())]
        return np.concatenate([q for q, _ in found]), np.concatenate([o for _, o in found])


def local_roots(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least member of each member's component, from symmetric links handed over in parts."""
    root = np.arange(n)
    for a, b in pairs:
        while len(a):
            a, b = root[a], root[b]
            apart = a != b
            a, b = np.maximum(a[apart], b[apart]), np.minimum(a[apart], b[apart])
            np.minimum.at(root, a, b)
            while (root[root] != root).any():
                root = root[root]
    return root


def shard_links(shard: np.ndarray, prints: np.ndarray, distance: int, part: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Each member that has a link, with the least member of its component within its shard."""
    forest = BkForest(shard, prints)
    everyone = np.arange(len(prints))
    # Searches go in parts so that the frontier stays bounded in large trees.
    size = np.bincount(shard, minlength=shard[-1] + 1)[shard] if len(shard) else shard
    cost = np.cumsum(size) // (part * 2048)
    cuts = np.flatnonzero(np.r_[True, cost[1:] != cost[:-1]]) if len(prints) else everyone
    bounds = np.r_[cuts, len(prints)]
    pairs = (forest.within(everyone[a:b], distance) for a, b in zip(bounds[:-1], bounds[1:], strict=True))
    root = local_roots(len(prints), pairs)
    linked = root != everyone
    return prints[everyone[linked]], prints[root[linked]]


def links(prints: DataFrame, distance: int, hot: int = 4096) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` whose closure is that of all links within the distance."""
    ready(prints.sparkSession)
    rows = shards(prints, distance, hot)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        count = 0

        def emit(frame: pd.DataFrame) -> pd.DataFrame:
            names = frame[["c1", "b1", "c2", "b2"]].to_numpy()
            new = np.r_[True, (names[1:] != names[:-1]).any(1)]
            a, b = shard_links(np.cumsum(new) - 1, frame["fp"].to_numpy(np.int64).view(np.uint64), distance)
            return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

        for batch in batches:
            held.append(batch)
            count += len(batch)
            if count > 200_000:  # whole shards so far; the last one may go on in the next batch
                frame = pd.concat(held, ignore_index=True)
                last = frame[["c1", "b1", "c2", "b2"]]
                open_ = (last == last.iloc[-1]).all(axis=1).to_numpy()
                if not open_.all():
                    yield emit(frame[~open_])
                    frame = frame[open_]
                held, count = [frame], len(frame)
        if count:
            yield emit(pd.concat(held, ignore_index=True))

    flat = rows.select(
        "fp", F.col("shard.choice").alias("c1"), F.col("shard.bits").alias("b1"), F.col("shard.choice2").alias("c2"), F.col("shard.bits2").alias("b2")
    )
    ordered = flat.repartition("c1", "b1", "c2", "b2").sortWithinPartitions("c1", "b1", "c2", "b2", "fp")
    return ordered.mapInPandas(run, "a long, b long")


def groups(prints: DataFrame, distance: int = 2) -> DataFrame:
    """For each distinct fingerprint: ``fp``, its component's ``root`` and ``component_id``, from a table (doc_id, fp)."""
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(distinct.select("fp"), distance))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def simhash_table(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hexadecimal digits) and component_id."""
    prints = stored(docs.select("doc_id", fingerprint(docs, shingle).alias("fp")), "simhash")
    out = prints.join(groups(prints, distance), "fp")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def simhash_filter(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """One document of each group, with its own columns: that of the least doc_id (without ids, any one text).

    Groups are told apart by their root fingerprint, as unlike documents may share a doc_id or have none.
    """
    key = [F.coalesce("doc_id", F.lit(NO_ID)).alias("_key_"), F.xxhash64("text").alias("_print_")]
    prints = stored(docs.select(*key, "doc_id", fingerprint(docs, shingle).alias("fp")), "simhash")
    group = groups(prints.select(F.col("_key_").alias("doc_id"), "fp"), distance)
    placed = prints.join(group, "fp").where("_key_ = component_id")
    id_name, print_name = free_name(docs, "_key_"), free_name(docs, "_print_")
    chosen = placed.groupBy("root", "_key_").agg(F.min("_print_").alias(print_name))
    chosen = chosen.select(F.col("_key_").alias(id_name), print_name)
    named = docs.withColumns({id_name: key[0], print_name: key[1]})
    return named.join(chosen, [id_name, print_name]).dropDuplicates([id_name, print_name]).select(*docs.columns)
