"""Online packing of token sequences by the sum of squares.

Documents come one after the other. Each one's ids (with an end id) go whole
to the place that makes the sum over all fill levels h of N(h)^2 smallest, where
N(h) counts the windows that are filled up to h, 0 < h < capacity (the
sum-of-squares rule of Csirik, Johnson, Kenyon, Orlin, Shor and Weber). N is
kept in an array, so a decision reads no window: from level h to h + n it adds
2 (N(h + n) - N(h)) + 2, a window that becomes full 1 - 2 N(h), a new one
2 N(n) + 1. Ties go to the fullest window. A document longer than a window first
fills windows of its own; its rest is placed by the rule.

Documents may be cut, so nothing needs padding. When a task holds more than
``most_open`` windows, and at its end, the emptiest windows' pieces are poured
into the fullest ones, one cut a window at most; at the end windows whose level
is a power of two stay as they are, and the last rest becomes sequences of
powers of two. Each task packs the rows it reads: no shuffle, nothing on the
driver, and a task holds at most ``most_open`` windows of ids.

Defined results: a null or empty text is the end id alone; null and repeated ids
stay as they are, each row is packed; texts of any length are taken whole; the
sequences depend on how the rows are dealt to tasks, the ids of a document never
do; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypulse.llm.storage import share_code
from daypulse.llm.tokens import default_tokenizer, encoder, with_end


class Levels:
    """How many windows are filled up to each level."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, np.int64)

    def choose(self, size: int) -> int:
        """The level of the window that takes ``size`` ids (0: a new one)."""
        n, full = self.count, self.capacity
        if size >= full:
            return 0
        level = np.flatnonzero(n[:full - size + 1])
        if not len(level):
            return 0
        cost = 2 * (n[level + size] - n[level]) + 2
        if level[-1] + size == full:
            cost[-1] = 1 - 2 * n[level[-1]]
        at = len(level) - 1 - int(cost[::-1].argmin())
        return int(level[at]) if cost[at] <= 2 * n[size] + 1 else 0

    def move(self, before: int, after: int) -> None:
        """A window goes from one level to another; 0 and capacity count nothing."""
        if 0 < before < self.capacity:
            self.count[before] -= 1
        if 0 < after < self.capacity:
            self.count[after] += 1


#: A run of ids of one document: (its id, first id's place in it, ids, ids of the document).
Piece = tuple[object, int, np.ndarray, int]


class Packer:
    """Open windows of one task, by level; full ones are handed out."""

    def __init__(self, capacity: int, most_open: int) -> None:
        self.levels, self.capacity, self.most_open = Levels(capacity), capacity, most_open
        self.open: dict[int, list[list[Piece]]] = {}
        self.n_open = 0

    def add(self, key: object, ids: np.ndarray) -> Iterator[list[Piece]]:
        """Takes a document; yields the sequences that are full by it."""
        n, full = len(ids), self.capacity
        for at in range(0, n - n % full, full):
            yield [(key, at, ids[at:at + full], n)]
        rest = n % full
        if not rest:
            return
        piece = (key, n - rest, ids[n - rest:].copy(), n)
        level = self.levels.choose(rest)
        window = self._take(level) if level else []
        window.append(piece)
        self.levels.move(level, level + rest)
        if level + rest == full:
            yield window
        else:
            self._put(level + rest, window)
            if self.n_open > self.most_open:
                yield from self._pour([w for _, w in self._all()])

    def end(self) -> Iterator[list[Piece]]:
        """Yields what is left, so that nothing needs padding."""
        uneven = []
        for level, window in self._all():
            if level & (level - 1):
                uneven.append(window)
            else:
                yield window
        yield from self._pour(uneven)
        for level, window in self._all():
            at = level
            while window:
                size = 1 << (at.bit_length() - 1)
                part, window = split(window, size)
                at -= size
                yield part

    def _take(self, level: int) -> list[Piece]:
        self.n_open -= 1
        return self.open[level].pop()

    def _put(self, level: int, window: list[Piece]) -> None:
        self.n_open += 1
        self.open.setdefault(level, []).append(window)

    def _all(self) -> list[tuple[int, list[Piece]]]:
        """All open windows, the fullest first; none is open afterwards."""
        found = [(level, w) for level in sorted(self.open, reverse=True) for w in self.open[level]]
        self.open, self.n_open = {}, 0
        self.levels.count[:] = 0
        return found

    def _pour(self, windows: list[list[Piece]]) -> Iterator[list[Piece]]:
        """Fills the fullest windows from the emptiest; at most one stays open."""
        first, last = 0, len(windows) - 1
        while first < last:
            window = windows[first]
            gap = self.capacity - weight(window)
            while gap and first < last:
                given, kept = split(windows[last], gap)
                window += given
                gap -= weight(given)
                windows[last] = kept
                if not kept:
                    last -= 1
            if gap:
                break
            yield window
            first += 1
        if first <= last:
            level = weight(windows[first])
            if level == self.capacity:
                yield windows[first]
            else:
                self._put(level, windows[first])
                self.levels.move(0, level)


def weight(window: list[Piece]) -> int:
    return sum(len(p[2]) for p in window)


def split(window: list[Piece], size: int) -> tuple[list[Piece], list[Piece]]:
    """The first ``size`` ids of a window, and the others."""
    taken, at = [], 0
    while at < len(window) and size >= len(window[at][2]):
        taken.append(window[at])
        size -= len(window[at][2])
        at += 1
    others = window[at:]
    if size and others:
        key, start, ids, n = others[0]
        taken.append((key, start, ids[:size], n))
        others[0] = (key, start + size, ids[size:], n)
    return taken, others


def pack_windows(docs: DataFrame, capacity: int = 4096, tokenizer: str | None = None, end_id: int = 2, id_col: str = "doc_id",
                 text: str = "text", most_open: int = 1024) -> DataFrame:
    """One row for each piece: the id, start, length, ids_crc32, doc_tokens
    (with the end id), sequence_id and offset (its place in the sequence)."""
    share_code(docs.sparkSession)
    path = tokenizer or default_tokenizer("word_bpe_49k.json")
    rows = docs.select(F.col(f"`{id_col}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, packer, sequence = encoder(path), Packer(capacity, most_open), TaskContext.get().partitionId() << 40
        found: list[tuple] = []
        key_type = None

        def close(window: list[Piece]) -> None:
            nonlocal sequence
            at = 0
            for key, start, ids, n in window:
                found.append((key, start, len(ids), zlib.crc32(np.ascontiguousarray(ids, "<u4")), n, sequence, at))
                at += len(ids)
            sequence += 1

        def rows_out() -> pa.RecordBatch:
            columns = list(zip(*found)) or [()] * len(names)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, key_type if i == 0 else pa.int64()) for i, c in enumerate(columns)],
                                              names=names)

        for batch in batches:
            keys, key_type = batch.column(0).to_pylist(), batch.column(0).type
            for at, ids, ends in coder.batches(batch.column(1)):
                ids, ends = with_end(ids, ends, end_id)
                cut = ends.tolist()
                for i in range(len(cut) - 1):
                    for window in packer.add(keys[at + i], ids[cut[i]:cut[i + 1]]):
                        close(window)
                yield rows_out()
        if key_type is not None:
            for window in packer.end():
                close(window)
            yield rows_out()

    packed = rows.mapInArrow(run, f"key {kind}, " + ", ".join(f"`{n}` long" for n in names[1:]))
    return packed.withColumnRenamed("key", id_col)
