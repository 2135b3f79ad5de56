"""Packing documents into token windows by Karmarkar-Karp multiway differencing.

Documents are cut into pieces that fit a window: full windows straight away, the rest joins a group of about
``group_tokens``. Within a group every piece starts as a partition of its own with one filled window and the others
empty. The two partitions of the widest imbalance are merged again and again, the fullest window of one with the
emptiest of the other, until one partition into near-equal windows remains. If its fullest window exceeds the
capacity, the window count rises by one and the group is partitioned anew.

Each task packs what it reads, group after group: no shuffle, memory bounded by a group and a document, and a lost task
is simply repeated. Sequence ids carry the task's number.

Defined cases: a null or empty text is a document of the closing id alone; repeated rows are packed each for itself;
documents of any length are cut, and nothing is dropped. An empty table gives no pieces.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rtdw.llm.bpe import LibraryBpe, Vocabulary
from rtdw.llm.common import ready

WINDOW = 4096
END_ID = 2
#: Rows, and bytes of their ids, that go back to Spark at once: no fewer than a document's, or those of a group.
ROWS = 5000
ROW_BYTES = 2 << 20
PIECES_TYPE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)


def difference(sizes: list[int], windows: int, capacity: int) -> np.ndarray | None:
    """Karmarkar-Karp: the window of each piece, or none if a window exceeds the capacity."""
    # A partition: its windows' sums in falling order, and where they came from.
    heap: list[tuple[int, int]] = []
    parts: list[tuple] = []
    for i, size in enumerate(sizes):
        sums = np.zeros(windows, np.int64)
        sums[0] = size
        parts.append((sums, None, None, None))
        heap.append((-size if windows > 1 else 0, i))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        sums = parts[a][0] + parts[b][0][::-1]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        if sums[0] > capacity:  # the fullest window never gets emptier
            return None
        parts.append((sums, a, b, order))
        heapq.heappush(heap, (int(sums[-1] - sums[0]), len(parts) - 1))
    owner = np.zeros(len(sizes), np.int64)
    todo = [(len(parts) - 1, np.arange(windows))]
    while todo:
        node, final = todo.pop()
        _, a, b, order = parts[node]
        if a is None:
            owner[node] = final[0]
            continue
        own = np.empty(windows, np.int64)
        own[order] = final
        todo.append((a, own))
        todo.append((b, own[::-1]))
    return owner


def partition(sizes: list[int], capacity: int = WINDOW) -> np.ndarray:
    """The window of each piece, with as few windows as differencing fills without exceeding the capacity."""
    if not sizes:
        return np.zeros(0, np.int64)
    windows = -(-sum(sizes) // capacity)
    while True:
        owner = difference(sizes, windows, capacity)
        if owner is not None:
            return owner
        windows += 1


class _Packer:
    """Cuts documents into pieces and gives them places; rows go out as groups fill."""

    def __init__(self, first: int, group_tokens: int):
        self.next_sequence, self.group_tokens = first, group_tokens
        self.rows: list[tuple] = []
        self.waiting: list[tuple] = []
        self.tokens = self.held = 0

    def add(self, doc_id, ids: bytes) -> None:
        total, start = len(ids) // 4, 0
        while total - start >= WINDOW:
            self._place(doc_id, start, ids[4 * start : 4 * (start + WINDOW)], total, self.next_sequence, 0)
            self.next_sequence += 1
            start += WINDOW
        if start < total:
            self.waiting.append((doc_id, start, ids[4 * start :], total))
            self.tokens += total - start
        if self.tokens >= self.group_tokens:
            self.flush()

    def flush(self) -> None:
        owner = partition([len(piece[2]) // 4 for piece in self.waiting])
        used: dict[int, tuple[int, int]] = {}
        for window, (doc_id, start, ids, total) in zip(owner.tolist(), self.waiting, strict=True):
            sequence, offset = used.get(window, (-1, 0))
            if sequence < 0:
                sequence = self.next_sequence
                self.next_sequence += 1
            self._place(doc_id, start, ids, total, sequence, offset)
            used[window] = (sequence, offset + len(ids) // 4)
        self.waiting, self.tokens = [], 0

    def _place(self, doc_id, start: int, ids: bytes, total: int, sequence: int, offset: int) -> None:
        self.rows.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), total, sequence, offset, ids))
        self.held += len(ids)

    def full(self) -> bool:
        return len(self.rows) > ROWS or self.held > ROW_BYTES

    def take(self, with_ids: bool) -> pd.DataFrame:
        rows, self.rows, self.held = self.rows, [], 0
        frame = pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES_TYPE.split(", ")])
        return frame if with_ids else frame.drop(columns="ids")


def pack(docs: DataFrame, vocabulary: Vocabulary, group_tokens: int = 1 << 20, with_ids: bool = True) -> DataFrame:
    """The pieces of all documents (columns ``doc_id`` and ``text``) with their places, and their ids on request."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Built for each task, in a tenth of a second: idle workers hold neither model nor words.
        bpe = LibraryBpe(vocabulary.content.value)
        packer = _Packer(TaskContext.get().partitionId() << 36, group_tokens)
        end = np.uint32(END_ID).tobytes()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                packer.add(None if pd.isna(doc_id) else doc_id, bpe.encode(text) + end)
                if packer.full():
                    yield packer.take(with_ids)
        packer.flush()
        yield packer.take(with_ids)

    ready(docs.sparkSession)
    schema = PIECES_TYPE if with_ids else PIECES_TYPE.removesuffix(", ids binary")
    schema = schema.replace("doc_id long", "doc_id string")
    # As text, so that no id becomes a float beside a null.
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(run, schema).withColumn("doc_id", F.col("doc_id").cast("long"))
