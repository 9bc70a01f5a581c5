"""Best-fit decreasing packing of a whole corpus into token windows, planned on counts of lengths.

Every document is encoded once, followed by an end id; a document longer than a window is first cut
into full windows. What is left is packed by best fit, longest first: a segment tree indexed by
remaining capacity finds the tightest open window. Best fit sees nothing of a piece but its length,
so the plan needs only how many pieces there are of each length, at most ``capacity`` numbers for a
corpus of any size, and treats equal windows together: a run says that the pieces of one length from
one rank on go to windows from one number on. Each piece then finds its window from its rank among
the pieces of its length. The packing is that of one best fit over all pieces, without a task, a
group or a driver that holds them.

The rank is the place among the pieces of that length in the scan task plus those of earlier tasks,
which come from counts by task and length in a join that hashes narrow rows by task and length. Every
length leaves at most four more ranges of windows, so there are at most ``4 * capacity`` of them at
any time however many pieces there are, and so is the table of runs that goes to the tasks.

Defined results: a null text is empty and has the end id alone; a null doc_id is kept as null; each
row is packed, also one that repeats; ties go to any window with as much room; an empty table gives
no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import cut
from marketlake.llm.word_ids import encoder

CAPACITY = 2048
BATCH_TEXTS = 500
ROWS_OUT = 20_000

PIECES = (
    "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, task int, nth long"
)
PLACED = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


class RoomTree:
    """How many ranges of windows are open at each remaining capacity, summed up a binary tree."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.sums = [0] * (2 * self.leaves)

    def add(self, room: int, number: int) -> None:
        node = room + self.leaves
        while node:
            self.sums[node] += number
            node >>= 1

    def tightest(self, length: int) -> int:
        """The least room of an open window that holds the length; 0 if none does."""
        node = length + self.leaves
        if self.sums[node]:
            return length
        while node > 1 and (node & 1 or not self.sums[node + 1]):
            node >>= 1
        if node <= 1:
            return 0
        node += 1
        while node < self.leaves:
            node *= 2
            node += not self.sums[node]
        return node - self.leaves


class Run(NamedTuple):
    """Pieces of a length from a rank on lie in windows from a number on, ``each`` to a window."""

    length: int
    rank: int
    window: int
    each: int
    offset: int


def best_fit_runs(counts: np.ndarray, capacity: int) -> list[Run]:
    """The plan of best fit, longest first, for so many pieces of each length."""
    tree = RoomTree(capacity)
    ranges: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    runs: list[Run] = []
    windows = 0

    def keep_open(room: int, first: int, number: int) -> None:
        if room and number:
            ranges[room].append((first, number))
            tree.add(room, 1)

    for length in range(capacity, 0, -1):
        rank, left = 0, int(counts[length])
        while left:
            if room := tree.tightest(length):
                first, number = ranges[room].pop()
                tree.add(room, -1)
            else:
                room, first, number = capacity, windows, -(-left // (capacity // length))
                windows += number
            # A window that has taken a piece is tighter than all others, so it takes the next one.
            each = room // length
            filled = min(number, left // each)
            if filled:
                runs.append(Run(length, rank, first, each, capacity - room))
                keep_open(room - each * length, first, filled)
                rank += filled * each
                left -= filled * each
            if filled < number and left:
                runs.append(Run(length, rank, first + filled, left, capacity - room))
                keep_open(room - left * length, first + filled, 1)
                filled += 1
                left = 0
            keep_open(room, first + filled, number - filled)
    return runs


def place(runs: list[Run], lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The window and offset of pieces, given their rank among the pieces of their length."""
    table = np.array(sorted(runs), dtype=np.int64).reshape(-1, len(Run._fields))
    size = 1 << 48
    own = table[np.searchsorted(table[:, 0] * size + table[:, 1], lengths * size + ranks, "right") - 1]
    later = ranks - own[:, 1]
    return own[:, 2] + later // own[:, 3], own[:, 4] + later % own[:, 3] * lengths


def pieces_of(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int) -> DataFrame:
    """Full windows and rests of the documents, each with its place in its task and length."""
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    names = [c.split()[0] for c in PIECES.split(", ")]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(tokenizer_path)
        end = end_id.to_bytes(4, "little")
        task = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_TEXTS):
                part = batch.slice(at, BATCH_TEXTS)
                texts = [t or "" for t in part.column("text").to_pylist()]
                rows = []
                encoded = ids_of.encode(texts)
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoded, strict=True):
                    ids += end
                    tokens, view = len(ids) // 4, memoryview(ids)
                    for start in range(0, tokens, capacity):
                        own = view[4 * start : 4 * (start + capacity)]
                        length = len(own) // 4
                        rows.append((doc_id, start, length, zlib.crc32(own), tokens, task, seen[length]))
                        seen[length] += 1
                columns = zip(*rows, strict=True)
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
                )

    return source.mapInArrow(encode, PIECES)


def pack_windows(
    docs: DataFrame, tokenizer_path: str, *, capacity: int = CAPACITY, end_id: int = 1
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    # Ranks refer to tasks, so the pieces are kept: a task that runs again would number them anew.
    pieces = cut(pieces_of(docs, tokenizer_path, capacity, end_id))
    by_task = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for row in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row["length"]] = row["n"]
    runs = docs.sparkSession.sparkContext.broadcast(best_fit_runs(counts, capacity))

    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.select(
        "task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    ranked = pieces.join(before, ["task", "length"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("nth")).alias("rank")
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(at, ROWS_OUT)
                lengths = part.column("length").to_numpy().astype(np.int64)
                windows, offsets = place(runs.value, lengths, part.column("rank").to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("start"),
                        pa.array(lengths),
                        part.column("ids_crc32"),
                        part.column("doc_tokens"),
                        pa.array(windows),
                        pa.array(offsets),
                    ],
                    names=[c.split()[0] for c in PLACED.split(", ")],
                )

    return ranked.mapInArrow(find, PLACED)
