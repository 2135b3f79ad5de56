"""Removal of long strings that stand more than once in a corpus, by suffix arrays over shards of the text that can repeat.

Every string of ``size`` bytes has an anchor: the place in it with the least hash of ``GRAM`` bytes, which depends on the
string alone. Neighbouring strings share anchors, so a text falls into a few segments per kilobyte, each with all the
strings of one anchor. Equal strings have equal anchor hashes: only segments whose anchor hash stands twice in the
corpus can hold a repeat, and all segments of one anchor hash go to one shard. Equal segments travel once, with
their number, and not at all where the anchor hash has no others: copies repeat each other. A shard joins its segments, orders all suffixes by external induced sorting (:mod:`rtdw.llm.induced`) and
marks each string that shares ``size`` bytes with a neighbour in that order, or whose segment stands for several
places. The marks go back to all places of the segments, and the union of the marked strings is cut out of each text.

An anchor may be hot: a passage in a third of all documents, in front of as many different neighbours. Where an anchor has
more than ``HOT`` different segments, these are trimmed before they travel: the strings that begin up to ``BAND`` bytes
apart, counted from the anchor, all hold the same core, and where an aggregation over the cores' hashes finds one once,
none of its strings repeats. The trimmed segments that are equal are taken together again. What is left goes to the same
sorting, which decides.

Matches end at texts; a string repeats wherever it starts twice, also within one text or overlapping itself. Texts are
addressed by their MD5, so copies of a text are worked on once.

Defined cases: null text is empty; texts shorter than ``size`` bytes keep everything. Of equal texts nothing is kept (if
they reach ``size`` bytes), as each repeats the others. Repeated rows are documents of their own. Further columns are not
read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rtdw.llm import induced
from rtdw.llm.common import ready, stored

SIZE = 400
GRAM = 32
HOT = 1000
BAND = 32
SHARD = 3 << 20  # bytes of segments that a shard should have
PIECE = 1 << 20  # bytes hashed at a time
TEXT = ["t1", "t2"]
SEGMENT = ["anchor", "g1", "g2"]
STRING = "anchor long, g1 long, g2 long"
SEPARATOR = 257

_MIX = np.random.default_rng(5).integers(1, 2**63, 256, np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each ``width`` bytes, put together from hashes of powers of two."""
    out, done, base = None, 0, _BASE
    power, size = _MIX[data], 1
    while True:
        if width & size:
            if out is None:
                out = power
            else:  # the parts so far stand in front
                tail = power[done:]
                out = out[: len(tail)] * np.uint64(base) + tail
            done += size
        if done == width:
            break
        step = power[size:]
        power = power[: len(step)] * np.uint64(base) + step
        base, size = base * base % 2**64, size * 2
    out = out[: max(0, len(data) - width + 1)]
    out = out ^ (out >> np.uint64(29))
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def anchors(data: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each string of ``size`` bytes the place of its anchor, and for each place its hash."""
    hashes = rolling(data, gram)
    bits = np.uint64(max(1, int(len(hashes)).bit_length()))
    least = hashes >> bits << bits | np.arange(len(hashes), dtype=np.uint64)  # of equal hashes the first place
    width, want = 1, size - gram + 1
    while 2 * width <= want:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < want:
        least = np.minimum(least[: width - want], least[want - width :])
    return (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64), hashes.view(np.int64)


def texts(docs: DataFrame) -> DataFrame:
    """doc_id, text as bytes and the two halves of its MD5."""
    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    digest = F.md5("text")
    halves = [F.conv(F.substring(digest, at, 16), 16, -10).cast("long").alias(name) for at, name in ((1, "t1"), (17, "t2"))]
    return plain.select("doc_id", "text", *halves)


def _blocks(batch: pd.DataFrame, size: int, piece_bytes: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bytes]]:
    """Row numbers, begins in the joined bytes and begins in the text of pieces that are hashed together."""
    rows, at, within, joined, held = [], [], [], [], 0
    for row, text in enumerate(batch["text"]):
        for begin in range(0, max(0, len(text) - size + 1), piece_bytes):
            piece = bytes(text[begin : begin + piece_bytes + size - 1])
            rows.append(row)
            at.append(held)
            within.append(begin)
            joined.append(piece)
            held += len(piece)
            if held >= piece_bytes:
                yield np.array(rows), np.array(at), np.array(within), b"".join(joined)
                rows, at, within, joined, held = [], [], [], [], 0
    if rows:
        yield np.array(rows), np.array(at), np.array(within), b"".join(joined)


def segments(docs: DataFrame, size: int = SIZE, gram: int = GRAM, piece_bytes: int = PIECE) -> DataFrame:
    """t1, t2, start, n, lead, anchor, g1, g2: ``n`` strings with one anchor, how far on it is, its hash, the segment's address."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            t1, t2 = batch["t1"].to_numpy(), batch["t2"].to_numpy()
            for rows, at, within, joined in _blocks(batch, size, piece_bytes):
                place, hashes = anchors(np.frombuffer(joined, np.uint8), size, gram)
                ends = np.append(at[1:], len(joined)) - size + 1  # strings begin before these
                change = np.concatenate([[True], place[1:] != place[:-1]])
                change[at] = True
                starts = np.flatnonzero(change)
                piece = np.searchsorted(at, starts, "right") - 1
                stop = np.minimum(np.append(starts[1:], len(place)), ends[piece])
                good = stop > starts
                starts, stop, piece = starts[good], stop[good], piece[good]
                names = b"".join(xxhash.xxh3_128_digest(joined[a:b]) for a, b in zip(starts.tolist(), (stop + size - 1).tolist(), strict=True))
                g = np.frombuffer(names, np.int64).reshape(-1, 2)
                yield pd.DataFrame({
                    "t1": t1[rows[piece]], "t2": t2[rows[piece]], "start": starts - at[piece] + within[piece], "n": stop - starts,
                    "lead": place[starts] - starts, "anchor": hashes[place[starts]], "g1": g[:, 0], "g2": g[:, 1],
                })

    return docs.select(*TEXT, "text").mapInPandas(run, f"t1 long, t2 long, start long, n long, lead long, {STRING}")


def candidates(found: DataFrame) -> DataFrame:
    """The segments whose anchor hash stands more than once."""
    shared = found.groupBy("anchor").agg(F.count("*").alias("places")).where("places > 1")
    # Written first: a join of two plain shuffles is one whose hot keys adaptive execution can split.
    return found.join(stored(shared.select("anchor"), "repeat-anchors"), "anchor")


def kinds(found: DataFrame) -> DataFrame:
    """Each different segment once: its number of places, one of them, and how many segments share its anchor hash."""
    one = found.groupBy(*SEGMENT).agg(F.count("*").alias("copies"), *[F.first(c).alias(c) for c in (*TEXT, "start", "n", "lead")])
    return one.join(one.groupBy("anchor").agg(F.count("*").alias("kinds")), "anchor")


def with_segments(docs: DataFrame, found: DataFrame, one: DataFrame) -> DataFrame:
    """t1, t2, text and pieces: each text that has candidates once, with the segments that it gives to the shards."""
    piece = F.struct("start", "n", "lead", *SEGMENT, "copies", (F.col("kinds") > HOT).alias("hot"))
    given = one.where("kinds > 1").select(*TEXT, piece.alias("piece"))
    given = given.unionByName(found.select(*TEXT).distinct(), allowMissingColumns=True)
    given = given.groupBy(*TEXT).agg(F.collect_list("piece").alias("pieces"))
    return docs.select(*TEXT, "text").dropDuplicates(TEXT).join(given, TEXT)


def _bands(data: bytes, n: int, lead: int, size: int) -> list[dict]:
    """For each band of strings: its number, its strings (first, after) and the hash of the bytes that all of them hold."""
    out = []
    for band in range((lead - n + 1) // BAND, lead // BAND + 1):
        first, after = max(0, lead - band * BAND - BAND + 1), min(n, lead - band * BAND + 1)
        core = data[lead - band * BAND : max(0, lead - band * BAND - BAND + 1 + size)]
        out.append({"band": band, "first": first, "after": after, "core": xxhash.xxh3_64_intdigest(core) - 2**63})
    return out


def cut_segments(given: DataFrame, size: int = SIZE) -> DataFrame:
    """The bytes of the segments that travel; hot ones with their bands."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, pieces in zip(batch["text"], batch["pieces"], strict=True):
                for p in pieces:
                    data = bytes(text[p["start"] : p["start"] + p["n"] + size - 1])
                    bands = _bands(data, p["n"], p["lead"], size) if p["hot"] else None
                    rows.append((p["anchor"], p["g1"], p["g2"], p["copies"], p["n"], p["hot"], data, bands))
                if len(rows) > 5000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            yield pd.DataFrame(rows, columns=names)

    names = [*SEGMENT, "copies", "n", "hot", "bytes", "bands"]
    schema = f"{STRING}, copies long, n long, hot boolean, bytes binary, bands array<struct<band: long, first: long, after: long, core: long>>"
    return given.where(F.size("pieces") > 0).select("text", "pieces").mapInPandas(run, schema)


def trimmed(hot: DataFrame, size: int = SIZE) -> DataFrame:
    """Hot segments without the bands whose core stands once: (segment, skipped strings, new segment)."""
    bands = hot.select(*SEGMENT, "copies", F.inline("bands"))
    often = bands.groupBy("anchor", "band", "core").agg(F.sum("copies").alias("times")).where("times > 1").drop("times")
    kept = bands.join(often, ["anchor", "band", "core"])
    kept = kept.groupBy(*SEGMENT).agg(F.array_sort(F.collect_list(F.struct("first", "after"))).alias("kept"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for anchor, g1, g2, copies, data, bands in batch.itertuples(index=False):
                parts: list[list[int]] = []
                for band in bands:
                    if parts and parts[-1][1] == band["first"]:
                        parts[-1][1] = band["after"]
                    else:
                        parts.append([band["first"], band["after"]])
                for first, after in parts:
                    part = bytes(data[first : after + size - 1])
                    h = np.frombuffer(xxhash.xxh3_128_digest(part), np.int64)
                    rows.append((anchor, g1, g2, copies, first, after - first, int(h[0]), int(h[1]), part))
            yield pd.DataFrame(rows, columns=[*SEGMENT, "copies", "skip", "n", "s1", "s2", "bytes"])

    joined = hot.join(kept, SEGMENT).select(*SEGMENT, "copies", "bytes", "kept")
    return joined.mapInPandas(run, f"{STRING}, copies long, skip long, n long, s1 long, s2 long, bytes binary")


class _Shard:
    """The segments of one shard, joined in a scratch file once they are many, and their marks."""

    def __init__(self, size: int, budget: int):
        self.size, self.budget = size, budget
        self.bytes = induced.Queues(1, budget)
        self.keys: list[tuple[int, int, int]] = []
        self.copies: list[int] = []
        self.n: list[int] = []

    def add(self, key: tuple[int, int, int], copies: int, n: int, data: bytes) -> None:
        symbols = np.empty(len(data) + 1, np.uint16)
        symbols[:-1] = np.frombuffer(data, np.uint8)
        symbols[:-1] += 1
        symbols[-1] = SEPARATOR
        self.bytes.push(0, symbols)
        self.keys.append(key)
        self.copies.append(copies)
        self.n.append(n)

    def marks(self) -> pd.DataFrame:
        """Per run of repeated strings: the segment, its first string and the one after the last."""
        starts = np.concatenate([[0], np.cumsum(np.array(self.n) + self.size)])  # n + size - 1 bytes and the separator
        total = int(starts[-1])
        text = self.bytes.all(dtype=np.uint16)
        order, common = induced.suffix_array(lambda to: np.copyto(to, text), total, SEPARATOR + 1, self.size, self.budget)
        n, many = np.array(self.n), np.array(self.copies) > 1
        marked = induced.scratch(total + 1, np.bool_, self.budget)
        marked[:] = False
        for i in range(0, total + 1, induced.BLOCK):
            at = np.asarray(order[i : i + induced.BLOCK])
            same = np.asarray(common[i : i + induced.BLOCK + 1]) >= self.size
            both = same[: len(at)].copy()
            both[: len(same) - 1] |= same[1:]
            hit = at[both]
            segment = np.searchsorted(starts, hit, "right") - 1
            hit, segment = hit[segment < len(n)], segment[segment < len(n)]
            marked[hit[hit - starts[segment] < n[segment]]] = True
        for k in np.flatnonzero(many).tolist():
            marked[starts[k] : starts[k] + n[k]] = True
        rows = []
        for i in range(0, total + 1, induced.BLOCK):
            here = np.asarray(marked[i : i + induced.BLOCK])
            before = np.concatenate([[marked[i - 1] if i else False], here[:-1]])
            rows.append(np.flatnonzero(here != before) + i)
        edges = np.concatenate(rows).reshape(-1, 2)  # a separator follows each segment, so runs close
        segment = np.searchsorted(starts, edges[:, 0], "right") - 1
        key = np.array(self.keys, np.int64).reshape(-1, 3)[segment]
        return pd.DataFrame({
            "anchor": key[:, 0], "s1": key[:, 1], "s2": key[:, 2],
            "first": edges[:, 0] - starts[segment], "after": edges[:, 1] - starts[segment],
        })


def marks(pieces: DataFrame, size: int = SIZE, shard: int = SHARD, budget: int = induced.BUDGET) -> DataFrame:
    """anchor, s1, s2, first, after: runs of strings that repeat, by sorting the suffixes of every shard.

    ``pieces`` holds each segment once: anchor, s1, s2, copies, n and bytes.
    """
    spark = pieces.sparkSession
    total = pieces.agg(F.sum(F.length("bytes"))).first()[0] or 0
    shards = max(spark.sparkContext.defaultParallelism, -(-total // shard))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_, current = None, None
        for batch in batches:
            for number, anchor, s1, s2, copies, n, data in batch.itertuples(index=False):
                if number != current:
                    if open_ is not None:
                        yield open_.marks()
                    open_, current = _Shard(size, budget), number
                open_.add((anchor, s1, s2), copies, n, data)
        if open_ is not None:
            yield open_.marks()

    numbered = pieces.select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), "anchor", "s1", "s2", "copies", "n", "bytes")
    dealt = numbered.repartition(shards, "shard").sortWithinPartitions("shard")
    return dealt.mapInPandas(run, "anchor long, s1 long, s2 long, first long, after long")


def _removed(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for t1, t2, text, runs in batch.itertuples(index=False):
                spans: list[list[int]] = []
                for first, after in sorted((r["first"], r["after"]) for r in runs):
                    if spans and first <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], after + size - 1)
                    else:
                        spans.append([first, after + size - 1])
                cuts = [0, *(x for s in spans for x in s), len(text)]
                kept = b"".join(bytes(text[a:b]) for a, b in zip(cuts[::2], cuts[1::2], strict=True))
                rows.append((t1, t2, [{"begin": a, "end": b} for a, b in spans], kept))
            yield pd.DataFrame(rows, columns=["t1", "t2", "spans", "kept"])

    return run


def repeats(
    docs: DataFrame, size: int = SIZE, gram: int = GRAM, shard: int = SHARD, budget: int = induced.BUDGET, piece_bytes: int = PIECE
) -> DataFrame:
    """t1, t2, spans (byte ranges) and the bytes kept, for each different text that holds a repeat.

    ``docs`` comes from :func:`texts`.
    """
    ready(docs.sparkSession)
    if not 0 < gram <= size:
        raise ValueError("grams lie within the strings")
    found = stored(candidates(stored(segments(docs, size, gram, piece_bytes), "repeat-segments")), "repeat-candidates")
    one = stored(kinds(found), "repeat-kinds")
    given = stored(with_segments(docs, found, one), "repeat-texts")
    cut = stored(cut_segments(given, size), "repeat-bytes")
    trim = stored(trimmed(cut.where("hot"), size), "repeat-trimmed")
    again = trim.groupBy("anchor", "s1", "s2").agg(F.sum("copies").alias("copies"), F.first("n").alias("n"), F.first("bytes").alias("bytes"))
    cold = cut.where("not hot").select("anchor", F.col("g1").alias("s1"), F.col("g2").alias("s2"), "copies", "n", "bytes")
    marked = stored(marks(cold.unionByName(again), size, shard, budget), "repeat-marks")

    # From the marks of what was sorted to all places of the segments.
    moved = marked.join(trim.select("anchor", "s1", "s2", "g1", "g2", "skip"), ["anchor", "s1", "s2"])
    moved = moved.select(*SEGMENT, *[(F.col(c) + F.col("skip")).alias(c) for c in ("first", "after")])
    plain = marked.select("anchor", F.col("s1").alias("g1"), F.col("s2").alias("g2"), "first", "after")
    plain = plain.join(cut.where("hot").select(*SEGMENT), SEGMENT, "left_anti")
    # Where all segments of an anchor hash are equal there is nothing to sort: each place repeats the others.
    equal = one.where("kinds = 1").select(*SEGMENT, F.lit(0).cast("long").alias("first"), F.col("n").alias("after"))
    placed = found.join(plain.unionByName(moved).unionByName(equal), SEGMENT)
    run: Column = F.struct(*[(F.col("start") + F.col(c)).alias(c) for c in ("first", "after")])
    runs = placed.groupBy(*TEXT).agg(F.collect_set(run).alias("runs"))
    joined = given.select(*TEXT, "text").join(runs, TEXT)
    return joined.mapInPandas(_removed(size), "t1 long, t2 long, spans array<struct<begin: long, end: long>>, kept binary")


def repeats_table(docs: DataFrame, size: int = SIZE, **options) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans and the SHA-256 of the bytes kept."""
    plain = texts(docs)
    found = repeats(plain, size, **options)
    found = found.select(*TEXT, F.size("spans").alias("n_spans"), F.length("kept").alias("n_kept"), F.sha2("kept", 256).alias("kept_sha256"))
    rows = plain.select("doc_id", F.length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"), *TEXT)
    return rows.join(found, TEXT, "left").select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.coalesce("n_kept", "n_bytes")).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
    )
