"""Best-two-fit packing of token sequences.

Each document's ids (with an end id) are cut into pieces of ``capacity``
tokens, the first piece taking the remainder, and the pieces are packed into
sequences. A sequence is filled greedily, always with the longest piece that
fits; then its shortest piece gives way to the two unpacked pieces that fill
the widened gap most tightly, if they fill more than it did.

Only lengths matter to that rule, and there are at most ``capacity`` of them.
So the rule runs on the table of counts by length: a filling is repeated as
often as the stock of each of its lengths allows, which is what packing one
sequence after the other would do. The work and the list of fillings depend on
``capacity`` alone, not on the corpus. The pieces then take their places by
their rank among the pieces of the same length, which needs one count for each
task and length, no global sort and no large group.

Defined results: a null or empty text is the end id alone; repeated rows are
packed each; null ids stay null; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from daypulse.llm.storage import materialise, share_code
from daypulse.llm.tokens import default_tokenizer, document_crc, encoder, with_end


def cuts(size: np.ndarray, capacity: int) -> tuple[np.ndarray, ...]:
    """(row, piece, start, length) of all pieces of documents of these sizes,
    in order; a document's first piece takes the remainder."""
    pieces = -(-size // capacity)
    row = np.repeat(np.arange(len(size)), pieces)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    end = ((size - 1) % capacity + 1)[row] + piece * capacity
    start = np.where(piece > 0, end - capacity, 0)
    return row, piece, start, end - start


def cut_into_pieces(docs: DataFrame, capacity: int, tokenizer: str, end_id: int, id_col: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row for each piece: the id, piece, start, length, ids_crc32, and
    (task, ord): the how-manieth piece of its length in its task it is."""
    share_code(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text}`").cast("string").alias("__text"))
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, seen, task = encoder(tokenizer), np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            for at, ids, ends in coder.batches(batch.column(1)):
                ids, ends = with_end(ids, ends, end_id)
                row, piece, start, length = cuts(np.diff(ends), capacity)
                order = np.argsort(length, kind="stable")
                group = np.searchsorted(length[order], length[order])  # where a length's pieces begin
                nth = np.empty(len(order), np.int64)
                nth[order] = np.arange(len(order)) - group + seen[length[order]]
                seen += np.bincount(length, minlength=capacity + 1)
                crc = document_crc(ids, np.append(ends[row] + start, ends[-1]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at + row)), pa.array(piece.astype(np.int32)), pa.array(start),
                     pa.array(length), pa.array(crc, pa.int64()), pa.array(np.full(len(row), task, np.int32)), pa.array(nth)],
                    names=[id_col, "piece", "start", "length", "ids_crc32", "task", "ord"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, task int, ord long")


def fillings(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Best-two-fit on counts by length: (lengths of a sequence, how many such
    sequences), in the order in which they are filled."""
    stock = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        stock[length] = n
    out = []
    while stock.any():
        left, used, gap = stock.copy(), [], capacity
        while (fits := np.flatnonzero(left[:gap + 1])).size:
            used.append(int(fits[-1]))
            left[fits[-1]] -= 1
            gap -= used[-1]
        small = used[-1]
        left[small] += 1
        room, there = gap + small, np.flatnonzero(left[:gap + small + 1])
        best, pair = small, None
        j = len(there) - 1
        for i, a in enumerate(there.tolist()):  # a <= b, a + b <= room: the longest b for each a
            while j >= i and a + there[j] > room:
                j -= 1
            k = j
            if k == i and left[a] < 2:
                k -= 1
            if k < i:
                break
            if a + int(there[k]) > best:
                best, pair = a + int(there[k]), (int(there[k]), a)
        if pair:
            used[-1:] = pair
        lengths, uses = np.unique(used, return_counts=True)
        times = int((stock[lengths] // uses).min())
        stock[lengths] -= times * uses
        out.append((used, times))
    return out


def places(runs: list[tuple[list[int], int]], capacity: int) -> tuple[np.ndarray, ...]:
    """For a binary search by length and rank: (sorted key, first sequence,
    offset); rank r of a length has its place in the last run that begins at
    or before r, in the run's sequence number r - begin."""
    taken, base, found = np.zeros(capacity + 1, np.int64), 0, []
    for lengths, times in runs:
        offset = 0
        for n in lengths:
            found.append((n, int(taken[n]), base, offset))
            taken[n] += times
            offset += n
        base += times
    found.sort()
    n, begin, first, offset = (np.array(c, np.int64) for c in zip(*found)) if found else [np.zeros(0, np.int64)] * 4
    return n, begin, first, offset


def pack(docs: DataFrame, capacity: int = 1024, tokenizer: str | None = None, end_id: int = 2, id_col: str = "doc_id",
         text: str = "text") -> DataFrame:
    """One row for each piece: the id, piece (from 0), start, length,
    ids_crc32, sequence_id and offset (its place in the sequence)."""
    pieces = materialise(cut_into_pieces(docs, capacity, tokenizer or default_tokenizer(), end_id, id_col, text), "pieces")
    per_task = materialise(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    size, begin, first, offset = places(fillings(counts, capacity), capacity)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["task", "length"]).select(
        id_col, "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("ord")).alias("sequence_id"))
    schema = StructType([*ranked.schema.fields, StructField("offset", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = size * (1 << 48) + begin
        for b in batches:
            length, rank = np.asarray(b.column(3)), np.asarray(b.column(5))
            at = np.searchsorted(key, length * (1 << 48) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(first[at] + rank - begin[at]), pa.array(offset[at])],
                                             names=schema.names)

    return ranked.mapInArrow(run, schema)
