"""Word segmentation of Chinese text with a dictionary, inside runs of Han characters.

The dictionary words of a run are the edges of a lattice over the run's places, with single characters where no word
begins. Two ways lead through it:

* ``longest``: forward longest match, the longest word at each place from the left;
* ``smart``: the path of fewest words, among these the one with the longest word first, then the longest second, and so on.
  It solves overlaps that a greedy cut gets wrong, and needs all words of the run: an Aho-Corasick automaton finds them.

The word breaks are those of the given dictionary; no particular analyzer's output is promised. Runs of other
letters and digits are words as in :func:`rtdw.functions.text.words`.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WORD_BREAK, fold
from ..session import run_dir, ship_package
from .lookup import is_small

# A dictionary of up to this many words is sent to the executors: at most about 50 MB of short words.
BROADCAST_WORDS = 500_000

MODES = ("longest", "smart")

# Leading pairs that ask in one row.
ASKED = 10_000

# Characters of texts that ask the dictionary together.
BLOCK = 4_000_000

# Characters of texts that are packed into one row.
PIECE = 65_536

# Such rows that are handed on together.
PIECES = 32

# Different characters of a task whose pairs are marked in a square of bytes; pairs of others are held one by one.
MARKED = 4_096

# One expression finds the words of a block if they begin with so few characters, and are no longer than this: it tries the
# characters in turn.
BRANCHES, DEPTH = 128, 64

# Characters of texts whose words are handed on together.
SLICE = 1_000_000

_HAN = r"\p{IsHan}"

# What lies between runs of Han characters, and between other words.
_NO_RUN = r"[\P{IsHan}[^\p{L}\p{N}]]++"
_NO_OTHER = r"[\p{IsHan}[^\p{L}\p{N}]]++"


def han_words(dictionary: DataFrame, word: str = "word") -> DataFrame:
    """The dictionary's distinct entries that consist of two or more Han characters."""
    entries = dictionary.select(fold(word).alias("word"))
    return entries.filter(F.col("word").rlike(rf"^{_HAN}{{2,}}$")).distinct()


def segment_words(
    texts: DataFrame,
    key: str,
    text: str,
    dictionary: DataFrame,
    word: str = "word",
    max_words: int = BROADCAST_WORDS,
    mode: str = "longest",
) -> DataFrame:
    """``key, keyword``: the distinct words of each text.

    A dictionary that is counted to be small goes to the executors and the texts are cut where they lie, without
    a shuffle. A larger one is joined with the pairs of characters that stand in blocks of texts; the texts are packed
    below the shared folder first.
    """
    if mode not in MODES:
        raise ValueError(f"mode {mode} is none of {MODES}")
    entries = han_words(dictionary, word)
    if not is_small(entries, max_words):
        return _cut_by_join(texts.select(key, F.col(text).alias("text")), key, entries, mode)
    tokens = F.array_distinct(F.array_remove(F.split(_split_scripts(fold(text)), WORD_BREAK), ""))
    tokenised = texts.select(key, tokens.alias("tokens"))
    runs = F.array_join(F.filter("tokens", lambda token: token.rlike(f"^{_HAN}")), " ")
    others = F.filter("tokens", lambda token: ~token.rlike(f"^{_HAN}"))
    cut = _cutter(entries, mode)(runs)
    return tokenised.select(key, F.explode(F.array_union(others, cut)).alias("keyword"))


def _split_scripts(text: Column) -> Column:
    """Put blanks around runs of Han characters."""
    return F.regexp_replace(text, f"({_HAN}+)", " $1 ")


Hits = dict[int, list[int]]


def cut_run(run: str, hits: Hits, mode: str) -> list[str]:
    """The words of a run, given the sizes of the dictionary words that begin at its places."""
    found, at = [], 0
    size_at = _fewest(run, hits) if mode == "smart" else {place: max(sizes) for place, sizes in hits.items()}
    while at < len(run):
        size = size_at.get(at, 1)
        found.append(run[at : at + size])
        at += size
    return found


def _fewest(run: str, hits: Hits) -> dict[int, int]:
    """From each place the size of the first word on the best path to the run's end.

    From the right, one step per edge: of paths with equally few words the longer first word wins, which puts the
    longest words first.
    """
    words, size_at = [0] * (len(run) + 1), {}
    for at in range(len(run) - 1, -1, -1):
        fewest, best = words[at + 1], 1
        for size in hits.get(at, ()):
            rest = words[at + size]
            if rest < fewest or (rest == fewest and size > best):
                fewest, best = rest, size
        words[at] = fewest + 1
        if best > 1:
            size_at[at] = best
    return size_at


def automaton(words: list[str]) -> ahocorasick.Automaton:
    """Finds all dictionary words in a text; the values are word lengths."""
    found = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for word in words:
        found.add_word(word)
    found.make_automaton()
    return found


def hits_in(run: str, words: ahocorasick.Automaton) -> Hits:
    hits: Hits = {}
    for end, size in words.iter(run) if len(words) else ():
        hits.setdefault(end + 1 - size, []).append(size)
    return hits


def longest_cut(run: str, known: dict[str, str], sizes: dict[str, list[int]]) -> list[str]:
    """Forward longest match: words are looked up only where one begins, the longest size first.

    The words are those of ``known``, so that all texts share them.
    """
    found, at = [], 0
    while at < len(run):
        word = run[at]
        for size in sizes.get(word, ()):
            longer = run[at : at + size]
            if longer in known:
                word = known[longer]
                break
        found.append(word)
        at += len(word)
    return found


def _cutter(entries: DataFrame, mode: str) -> Callable[[Column], Column]:
    """A vectorised function from runs, with blanks between them, to lists of words; the dictionary travels once per executor."""
    ship_package(entries.sparkSession)
    shared = entries.sparkSession.sparkContext.broadcast([row.word for row in entries.toLocalIterator()])

    @F.pandas_udf("array<string>")
    def cut_runs(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words_of = _word_lister(_run_cutter(shared.value, mode))
        for texts in batches:
            # Words of a part of the batch at a time, whatever the length of the texts.
            for part in _slices(texts):
                yield part.map(lambda text: words_of(text.split()), na_action="ignore")

    return cut_runs


def _slices(texts: pd.Series, size: int | None = None) -> Iterator[pd.Series]:
    """A batch of texts in parts of at most about ``size`` characters, in their order."""
    size = size or SLICE
    first, held = 0, 0
    for at, text in enumerate(texts):
        held += len(text) if text is not None else 0
        if held >= size:
            yield texts.iloc[first : at + 1]
            first, held = at + 1, 0
    if first < len(texts) or not len(texts):
        yield texts.iloc[first:]


def _word_lister(cut: Callable[[str], list[str]]) -> Callable[[list[str]], list[str]]:
    """From runs to their distinct words. Equal words of different texts are one object: there are only those of the
    dictionary and single characters."""
    shared: dict[str, str] = {}
    return lambda runs: list(dict.fromkeys(shared.setdefault(word, word) for run in runs for word in cut(run)))


def _run_cutter(words: list[str], mode: str) -> Callable[[str], list[str]]:
    if mode == "smart":
        found = automaton(words)
        return lambda run: cut_run(run, hits_in(run, found), mode)
    known, sizes = {word: word for word in words}, {}
    for first, size in sorted({(word[0], -len(word)) for word in words}):
        sizes.setdefault(first, []).append(-size)
    return lambda run: longest_cut(run, known, sizes)


def _text_cutter(words: list[str], mode: str) -> Callable[[str], list[str]]:
    """From runs with blanks between them to their distinct words, by the words of a block."""
    if mode == "longest" and len({word[0] for word in words}) <= BRANCHES and max(map(len, words), default=0) <= DEPTH:
        found = re.compile(_expression(words)).findall
        # Of a long text, the words of a run at a time.
        parts = lambda text: [text] if len(text) <= PIECE else text.split(" ")
        return lambda text: list(dict.fromkeys(word for part in parts(text) for word in dict.fromkeys(found(part))))
    words_of = _word_lister(_run_cutter(words, mode))
    return lambda text: words_of(text.split())


def _expression(words: list[str]) -> str:
    """Finds the longest word at each place, or a single character: the words as a tree, each branch tried as far as it goes."""
    tree: dict = {}
    for word in words:
        node = tree
        for character in word:
            node = node.setdefault(character, {})
        node[""] = {}

    def below(node: dict) -> str:
        ways = [re.escape(character) + below(node[character]) for character in sorted(node) if character]
        if not ways:
            return ""
        some = ways[0] if len(ways) == 1 and "" not in node else f"(?:{'|'.join(ways)})"
        return some + "?" * ("" in node)

    return "|".join([*filter(None, [below(tree)]), "[^ ]"])


def _packed(text: str) -> bytes:
    data = text.encode("utf-16-le")
    return len(data).to_bytes(8, "little") + pa.Codec("zstd").compress(data, asbytes=True)


def _unpacked(data: bytes) -> str:
    return pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True).decode("utf-16-le")


class _Pairs:
    """The different pairs of characters in the runs of a block."""

    def __init__(self):
        self.number = np.full(0x110000, -1, dtype=np.int32)
        self.characters: list[str] = []
        self.marked = np.zeros((MARKED, MARKED), dtype=bool)
        self.others: set[str] = set()

    def add(self, runs: str) -> None:
        """Runs with blanks between them."""
        for at in range(0, len(runs), PIECE):
            self._add(runs[at : at + PIECE + 1])

    def _add(self, runs: str) -> None:
        codes = np.frombuffer(runs.encode("utf-32-le"), dtype="<u4")
        numbers = self.number[codes]
        if (numbers < 0).any():
            new = np.unique(codes[numbers < 0])
            self.number[new] = np.arange(len(self.characters), len(self.characters) + len(new))
            self.characters += [chr(code) for code in new]
            numbers = self.number[codes]
        left, right = numbers[:-1], numbers[1:]
        if len(self.characters) > MARKED:
            rare = np.flatnonzero((left >= MARKED) | (right >= MARKED))
            self.others.update(runs[at : at + 2] for at in rare.tolist())
            common = (left < MARKED) & (right < MARKED)
            left, right = left[common], right[common]
        self.marked[left, right] = True

    def taken(self) -> list[str]:
        """The pairs so far, which are forgotten then."""
        pairs = [self.characters[i] + self.characters[j] for i, j in np.argwhere(self.marked).tolist()]
        pairs += self.others
        self.marked[:] = False
        self.others.clear()
        return [pair for pair in pairs if " " not in pair]


def _packer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``block, keys, packed, pairs`` of ``key, runs, others``: pieces of about ``PIECE`` characters with their keys, and of each block
    of about ``BLOCK`` characters the different pairs. A packed text is its different runs and, behind a tab, its other words."""
    pairs, pieces, asked = _Pairs(), [], []
    block, held, size, keys, lines = TaskContext.get().partitionId() << 32, 0, 0, [], []

    def end_piece() -> None:
        if lines:
            pieces.append((block, pa.concat_arrays(keys), _packed("\n".join(lines))))
        keys.clear()
        lines.clear()

    def end_block() -> None:
        end_piece()
        found = pairs.taken()
        asked.extend((block, found[at : at + ASKED]) for at in range(0, len(found), ASKED))

    def rows() -> pa.RecordBatch:
        n = len(asked)
        offsets = np.cumsum([0, *(len(keys) for _, keys, _ in pieces), *[0] * n])
        own = pa.concat_arrays([keys for _, keys, _ in pieces]) if pieces else pa.array([], key_type)
        columns = {
            "block": pa.array([row[0] for row in pieces + asked], pa.int64()),
            "keys": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), own),
            "packed": pa.array([row[2] for row in pieces] + [None] * n, pa.binary()),
            "pairs": pa.array([None] * len(pieces) + [row[1] for row in asked], pa.list_(pa.string())),
        }
        pieces.clear()
        asked.clear()
        return pa.RecordBatch.from_pydict(columns)

    for batch in batches:
        key_column, key_type, taken = batch.column("key"), batch.column("key").type, []
        for at, texts in enumerate(zip(batch.column("runs").to_pylist(), batch.column("others").to_pylist(), strict=True)):
            runs, others = (" ".join(dict.fromkeys(words.split())) for words in texts)
            if not runs and not others:
                continue
            if runs:
                pairs.add(runs)
            taken.append(at)
            lines.append(f"{runs}\t{others}")
            size += len(lines[-1])
            held += len(lines[-1])
            if size >= PIECE or held >= BLOCK:
                keys.append(key_column.take(pa.array(taken, pa.int32())))
                taken, size = [], 0
                end_piece()
            if held >= BLOCK:
                end_block()
                block, held = block + 1, 0
            if len(pieces) >= PIECES:
                yield rows()
        if taken:
            keys.append(key_column.take(pa.array(taken, pa.int32())))
    end_block()
    if pieces or asked:
        yield rows()


def _cut_by_join(texts: DataFrame, key: str, entries: DataFrame, mode: str) -> DataFrame:
    """``key, keyword`` of the texts, with the dictionary as a joined table.

    The texts are cut into runs and packed once, where they lie, into blocks of about ``BLOCK`` characters. A word is two characters or
    more: a block asks once for each different pair of characters that stands in it, and gets the words which that pair leads. So what
    travels is the packed texts, once, and for each block its different pairs and the words of the dictionary that may be in it.
    """
    spark, root = texts.sparkSession, run_dir(texts.sparkSession, "segment")
    ship_package(spark)
    folded = texts.select(F.col(key).alias("key"), fold("text").alias("text")).filter("text is not null")
    parts = folded.select("key", F.regexp_replace("text", _NO_RUN, " ").alias("runs"), F.regexp_replace("text", _NO_OTHER, " ").alias("others"))
    key_type = texts.schema[key].dataType.simpleString()
    packed = parts.mapInArrow(_packer, f"block long, keys array<{key_type}>, packed binary, pairs array<string>")
    # Written down: a block's pairs and its pieces must be those of one run over the texts.
    packed.write.parquet(f"{root}/blocks")
    stored = spark.read.parquet(f"{root}/blocks")
    n_blocks = stored.select("block").distinct().count()
    tasks = max(n_blocks // 4, min(n_blocks, 8 * spark.sparkContext.defaultParallelism), 1)

    leading = F.substring("word", 1, 2).alias("leading")
    words = entries.select(leading, "word").groupBy("leading").agg(F.collect_list("word").alias("words"))
    asked = stored.select("block", F.explode("pairs").alias("leading"))
    # An inner join of plain shuffles: a dictionary of few bytes is broadcast by its size, hot leading pairs are split.
    none = [F.lit(None).cast(stored.schema[c].dataType).alias(c) for c in ("keys", "packed")]
    found = asked.join(words, "leading").select("block", *none, "words")
    pieces = stored.filter("packed is not null").select("block", "keys", "packed", F.lit(None).cast("array<string>").alias("words"))
    # Of a block the words come first; a nested list in a batch is as long as the words that one pair leads.
    both = found.unionByName(pieces).repartition(tasks, "block").sortWithinPartitions("block", F.col("packed").isNotNull())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, known, words_of, held, ids, found = None, [], None, 0, [], []

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.concat_arrays(ids), pa.array(found, pa.list_(pa.string()))], names=[key, "words"])

        for batch in batches:
            blocks, keys, packed, words = (batch.column(c) for c in ("block", "keys", "packed", "words"))
            for row, block in enumerate(blocks.to_pylist()):
                if block != at:
                    at, known, words_of = block, [], None
                if words[row].is_valid:
                    known.extend(words[row].as_py())
                    continue
                words_of = words_of or _text_cutter(known, mode)
                text = _unpacked(packed[row].as_py())
                for line in text.split("\n"):
                    runs, _, others = line.partition("\t")
                    found.append(words_of(runs) + others.split())
                ids.append(keys[row].values)
                held += len(text)
                if held >= SLICE:
                    yield rows()
                    held, ids, found = 0, [], []
        if ids:
            yield rows()

    cut_texts = both.mapInArrow(cut, f"`{key}` {key_type}, words array<string>")
    keywords = cut_texts.select(key, F.explode("words").alias("keyword"))
    # Texts of one key are one text.
    repeated = stored.select(F.explode("keys").alias("key")).groupBy("key").count().filter("count > 1")
    return keywords if repeated.isEmpty() else keywords.distinct()
