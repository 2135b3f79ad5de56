"""Byte-pair encoding by backtracking over longest matches, and decoding by an offset table.

An Aho-Corasick automaton over the reversed tokens reads a word from its end once and so knows the longest token that
starts at each place. Beginning with that token, a token is taken when it is compatible with the token before it, that is when merging the two tokens' bytes
would give back just these two; else the next shorter one is tried, and a place from which nothing fits is never
visited again. Since the merged form of every beginning of a word is unique, this gives the merges' exact result in
time linear in the word, without replaying merges. Compatibility of two tokens is looked up in a table that is filled
from the merge ranks along the inner edges of both tokens as pairs turn up.

Defined cases: a null text is empty; an empty text, or one of white space, has no ids and decodes to the empty string.
Very long texts and words are encoded whole. Repeated rows get equal results; extra columns do not matter.
"""

from __future__ import annotations

import codecs
import json
import re
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rtdw.llm.common import ready

LAST = 256  # added to the symbol of a word's last byte: it is a symbol of its own in the vocabulary
NEVER = 1 << 40
# Bounds of what a worker remembers: words and runs, pairs, and steps of the automaton.
CACHED = 400_000
MOST_PAIRS = 400_000
MOST_STEPS = 400_000
#: Rows whose ids or texts go back to Spark at once.
ROWS = 1000
#: One of these at a word's end is a piece of its own.
MARKS = frozenset(".,;:!?")
#: Marks behind a plain letter or digit at a run's end. A blank before them changes no ids, and the run is two that are known.
LAST_MARKS = re.compile(r"[!-/:-@\[-`{-~](?<=[a-zA-Z0-9À-ÖØ-öø-ÿ].)[!-/:-@\[-`{-~]*(?=[ \n]|\Z)")
# What the normaliser takes for white space, in as far as str.split() differs from it.
NOT_SPACE = re.compile("[\x1c-\x1f]")
SPACE = regex.compile(r"\s+")
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file, by letter."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Decoder:
    """The offset table of a tokenizer file: each token's text and the blank after it, one after the other."""

    def __init__(self, content: bytes):
        file = json.loads(content)
        names = {i: t for t, i in file["model"]["vocab"].items()} | {t["id"]: t["content"] for t in file["added_tokens"]}
        texts = [(names.get(i, "") + " ").encode() for i in range(max(names) + 1)]
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        self.letters = np.frombuffer(b"".join(texts), np.uint8)

    def decode(self, ids: bytes) -> str:
        """The ids' token texts with a blank between them: a gather by the offset table."""
        numbers = np.frombuffer(ids, "<u4")
        if not len(numbers):
            return ""
        starts = self.offsets[numbers]
        lengths = self.offsets[numbers + 1] - starts
        before = np.cumsum(lengths) - lengths
        places = np.repeat(starts - before, lengths) + np.arange(before[-1] + lengths[-1])
        return self.letters[places][:-1].tobytes().decode()


class WordBpe:
    """Encoder of a tokenizer file with word-end marks."""

    cached = CACHED

    def __init__(self, content: bytes):
        file = json.loads(content)
        self._begin({t["content"]: t["id"] for t in file["added_tokens"]})
        model, letters = file["model"], byte_letters()
        end = model["end_of_word_suffix"]
        # Merges: rank and result of a pair; the halves and the rank of a token that a merge makes.
        ids = model["vocab"]
        self.ranks: dict[int, dict[int, int]] = {}
        self.halves: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b, made = ids[left], ids[right], ids[left + right]
            self.ranks.setdefault(a, {})[b] = rank
            self.halves[made] = (a, b, rank)
        self.right_edges = {i: tuple(self._edge(i, 1)) for i in ids.values()}
        self.left_edges = {i: tuple(self._edge(i, 0)) for i in ids.values()}
        self._fits: dict[int, bool] = {}
        spelled: dict[int, tuple[int, ...]] = {}
        for token, i in ids.items():
            if self._whole(i):
                body, last = (token[: -len(end)], LAST) if token.endswith(end) and token != end else (token, 0)
                symbols = [letters[c] for c in body]
                symbols[-1] += last
                spelled[i] = tuple(symbols)
        self.length = {i: len(symbols) for i, symbols in spelled.items()}
        # The longest shorter token that a token begins with, or -1.
        by_symbols = {symbols: i for i, symbols in spelled.items()}
        self.shorter = {
            i: next((by_symbols[symbols[:n]] for n in range(len(symbols) - 1, 0, -1) if symbols[:n] in by_symbols), -1)
            for i, symbols in spelled.items()
        }
        self._build(spelled)

    def _begin(self, added: dict[str, int]) -> None:
        """What the handling of text needs: the added tokens, and what is remembered."""
        self.added = {t: np.uint32(i).tobytes() for t, i in added.items()}
        self.split_added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def _build(self, spelled: dict[int, tuple[int, ...]]) -> None:
        """The automaton over reversed tokens: steps by (state, symbol), fallback and longest token of each state."""
        steps: dict[int, int] = {}
        fallback, longest, links = [0], [-1], [(0, 0)]
        for token, symbols in spelled.items():
            state = 0
            for symbol in reversed(symbols):
                key = state << 9 | symbol
                if key not in steps:
                    steps[key] = len(longest)
                    links.append((state, symbol))
                    fallback.append(0)
                    longest.append(-1)
                state = steps[key]
            longest[state] = token
        depth = [0] * len(links)
        for state in range(1, len(links)):
            depth[state] = depth[links[state][0]] + 1
        for state in sorted(range(1, len(links)), key=depth.__getitem__):
            parent, symbol = links[state]
            back = parent
            while back:
                back = fallback[back]
                if (back << 9 | symbol) in steps:
                    fallback[state] = steps[back << 9 | symbol]
                    break
            if longest[state] < 0:
                longest[state] = longest[fallback[state]]
        self.steps, self.fallback, self.longest = steps, fallback, longest

    def _starting(self, symbols: list[int]) -> list[int]:
        """The longest token that starts at each place."""
        steps, fallback, longest, out, state = self.steps, self.fallback, self.longest, [], 0
        for symbol in reversed(symbols):
            key = state << 9 | symbol
            step = steps.get(key)
            if step is None:
                while step is None and state:
                    state = fallback[state]
                    step = steps.get(state << 9 | symbol)
                step = step or 0
                if len(steps) < MOST_STEPS:  # the step with its fallbacks is known from now on
                    steps[key] = step
            state = step
            out.append(longest[state])
        out.reverse()
        return out

    def _edge(self, token: int, side: int) -> Iterator[tuple[int, int]]:
        """The token's parts along its right (1) or left (0) edge, each with the rank at which it is merged on."""
        until = NEVER
        while True:
            yield token, until
            if token not in self.halves:
                return
            *parts, until = self.halves[token]
            token = parts[side]

    def _crosses(self, left: int, right: int, but: int = -1) -> bool:
        """Whether some merge, other than that of rank ``but``, would join the two tokens' bytes across the border.

        Parts x and y meet there until one of them is merged on. The lower rank goes first, and of equal ones the
        leftmost, so x must be merged on later than y joins it, and y not earlier.
        """
        ends = self.left_edges[right]
        for x, x_until in self.right_edges[left]:
            ranks = self.ranks.get(x)
            if ranks:
                for y, y_until in ends:
                    rank = ranks.get(y)
                    if rank is not None and rank != but and rank < x_until and rank <= y_until:
                        return True
        return False

    def _whole(self, token: int) -> bool:
        """Whether merging the token's own bytes gives the token (else it never occurs)."""
        if token not in self.halves:
            return True
        left, right, rank = self.halves[token]
        return self._whole(left) and self._whole(right) and not self._crosses(left, right, rank)

    def fits(self, left: int, right: int) -> bool:
        """The pair-compatibility table."""
        key = left << 20 | right
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) > MOST_PAIRS:
                self._fits.clear()
            known = self._fits[key] = not self._crosses(left, right)
        return known

    def encode_word(self, word: str) -> list[int]:
        """The ids of one word (no white space inside)."""
        symbols = list(word.encode())
        symbols[-1] += LAST
        size, best = len(symbols), self._starting(symbols)
        lengths, shorter, fits, known = self.length, self.shorter, self.fits, self._fits
        path: list[int] = []
        starts: list[int] = []
        dead = bytearray(size + 1)
        at, before, token = 0, -1, best[0]
        while at < size:
            if token < 0:  # nothing fits here: the place is no border
                if not path:
                    raise ValueError(f"no encoding of {word!r}")
                dead[at] = 1
                at, token = starts.pop(), shorter[path.pop()]
                before = path[-1] if path else -1
                continue
            end = at + lengths[token]
            good = not dead[end]
            if good and before >= 0:
                good = known.get(before << 20 | token)
                if good is None:
                    good = fits(before, token)
            if good:
                path.append(token)
                starts.append(at)
                at, before = end, token
                token = best[at] if at < size else -1
            else:
                token = shorter[token]
        return path

    def _word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            if len(self.words) > self.cached:
                self.words.clear()
            ids = pack_ids(self.encode_word(word))
            if len(word) < 64:
                self.words[word] = ids
        return ids

    def _chunk(self, chunk: str) -> bytes:
        """The ids of a normalised run without white space and added tokens."""
        if chunk.isalpha():
            return self._word(chunk)
        if chunk[-1:] in MARKS and chunk[:-1].isalpha():
            return self._word(chunk[:-1]) + self._word(chunk[-1])
        return b"".join(map(self._word, PIECE.findall(chunk)))

    def _runs(self, text: str) -> list[str]:
        """The normalised runs of a text between white space."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
        return SPACE.split(text) if NOT_SPACE.search(text) else text.split()

    def _segment(self, text: str) -> bytes:
        chunks = self._runs(text)
        found = list(map(self.chunks.get, chunks))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    found[i] = self._new(chunks[i])
        return b"".join(found)

    def _new(self, chunk: str) -> bytes:
        ids = self.chunks.get(chunk)
        if ids is None:
            if len(self.chunks) > self.cached:
                self.chunks.clear()
            ids = self._chunk(chunk)
            if len(chunk) < 64:
                self.chunks[chunk] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if "<|" not in text:
            return self._segment(text)
        parts = self.split_added.split(text)
        return b"".join(self.added[p] if i % 2 else self._segment(p) for i, p in enumerate(parts))


class _Known(dict):
    """Ids by run or word. One that is not known is asked of the library; all are forgotten when they are too many."""

    def __init__(self, model):
        super().__init__()
        self.model, self.letters = model, "".join(sorted(letters := byte_letters(), key=letters.get))

    def __missing__(self, run: str) -> bytes:
        pieces = [run] if run.isalpha() else PIECE.findall(run)
        ids = b"".join(map(self.__getitem__, pieces)) if len(pieces) > 1 else pack_ids(self.ask(run))
        if len(run) < 64:
            if len(self) > LibraryBpe.cached:
                self.clear()
            self[run] = ids
        return ids

    def ask(self, word: str) -> list[int]:
        # Printable ASCII stands for itself.
        if not (word.isascii() and word.isprintable()):
            word = codecs.charmap_decode(word.encode(), "strict", self.letters)[0]
        return [t.id for t in self.model.tokenize(word)]


class LibraryBpe(WordBpe):
    """The same text handling with each new word's ids taken from the tokenizers library; no automaton, no tables of merges."""

    def __init__(self, content: bytes):
        tokenizer = Tokenizer.from_str(content.decode())
        self._begin({t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()})
        # A run that is one word has the word's ids, so one memory serves both.
        self.chunks = self.words = _Known(tokenizer.model)

    def _runs(self, text: str) -> list[str]:
        return super()._runs(LAST_MARKS.sub(r" \g<0>", text))

    def _segment(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self._runs(text)))

    def encode_word(self, word: str) -> list[int]:
        return self.words.ask(word)


_LOADED: dict[tuple[type, int], WordBpe | Decoder] = {}


class Vocabulary:
    """A tokenizer file's content, broadcast to the tasks (its size is the file's); each worker builds it once."""

    def __init__(self, spark: SparkSession, path: str):
        ready(spark)
        with open(path, "rb") as file:
            self.content = spark.sparkContext.broadcast(file.read())

    def load(self, kind: type = WordBpe) -> WordBpe | Decoder:
        content = self.content.value
        key = (kind, hash(content))
        if key not in _LOADED:
            _LOADED[key] = kind(content)
        return _LOADED[key]


def encode(vocabulary: Vocabulary, text: Column) -> Column:
    """A binary column with a text column's ids, each as little-endian unsigned 32-bit integer."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = vocabulary.load()
        for texts in batches:
            for at in range(0, len(texts), ROWS):
                yield pd.Series([bpe.encode(t) for t in texts.iloc[at : at + ROWS]], dtype=object)

    return F.pandas_udf(run, "binary")(text)


def decode(vocabulary: Vocabulary, ids: Column) -> Column:
    """A string column with the decoded text of a column that :func:`encode` made; null for null."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = vocabulary.load(Decoder)
        for rows in batches:
            for at in range(0, len(rows), ROWS):
                part = rows.iloc[at : at + ROWS]
                yield pd.Series([None if r is None else decoder.decode(bytes(r)) for r in part], dtype=object)

    return F.pandas_udf(run, "string")(ids)
