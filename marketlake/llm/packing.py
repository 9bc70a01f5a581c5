"""Best-fit packing of documents into token sequences, merged over a tree of tasks.

Every document is encoded once, followed by an end id; only documents longer than a sequence are
cut. Each scan task packs the pieces it has by best fit, longest first. Bins that are nearly full
are final; the others go on as items: groups of ``fan_in`` tasks pack their underfull bins by best
fit again, until one group is left. What goes on from a group is at most ``max_open`` bins, the
emptiest ones; fuller ones are final as they are, so no task holds more than
``fan_in * max_open`` numbers and nothing is left out. A merged bin keeps the id of its first part.

The cap costs no sequence of the method. Best fit leaves at most one bin of a group that is half full
or less, for of two such bins the second one would have gone into the first. So a merge of ``fan_in``
groups has at most ``fan_in`` bins that fit together with any other; two bins over half full never do.
Each of these few can go into one of the ``max_open`` emptiest bins if it fits into a bin at all, and
all of those stay open.

Pieces move through a shuffle only if their first bin stayed underfull.

Defined results: a null text is empty and has the end id alone; a null doc_id is kept as null; each
row is packed, also one that repeats; ties go by order of length, id and position; an empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import cut
from marketlake.llm.word_ids import encoder

CAPACITY = 4096
NEARLY_FULL = 0.99
FAN_IN = 8
MAX_OPEN = 16_384
BATCH_TEXTS = 1000

PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, "
    "bin long, offset long, fill long, closed boolean"
)
MERGES = "bin long, parent long, offset long, fill long, closed boolean"


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each item in the given order, and the fill of each bin.

    Open bins are stacked by free space; one integer has a bit for each free space that occurs, so
    the tightest bin that fits is its lowest bit at or above the length.
    """
    bins, offsets, fills = [], [], []
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    free_bits = 0
    for length in lengths:
        above = free_bits >> length
        if above:
            free = length + (above & -above).bit_length() - 1
            stack = by_free[free]
            k = stack.pop()
            if not stack:
                free_bits &= ~(1 << free)
        else:
            k, free = len(fills), capacity
            fills.append(0)
        bins.append(k)
        offsets.append(fills[k])
        fills[k] += length
        if rest := free - length:
            by_free[rest].append(k)
            free_bits |= 1 << rest
    return bins, offsets, fills


def pack(
    keys: np.ndarray, lengths: np.ndarray, capacity: int, nearly_full: float, max_open: int
) -> tuple[np.ndarray, ...]:
    """Order of packing, and in that order bin, offset, fill of the bin and whether it is final.

    ``keys`` has the tie breaks, most important first.
    """
    order = np.lexsort((*keys[::-1], -lengths))
    bins, offsets, fills = (
        np.array(x, dtype=np.int64) for x in best_fit(lengths[order].tolist(), capacity)
    )
    closed = fills >= nearly_full * capacity
    still_open = np.flatnonzero(~closed)
    if len(still_open) > max_open:
        by_fill = still_open[np.argsort(fills[still_open], kind="stable")]
        closed[by_fill[max_open:]] = True
    return order, bins, offsets, fills[bins] if len(bins) else bins, closed[bins]


def text_groups(
    batches: Iterator[pa.RecordBatch], size: int
) -> Iterator[tuple[list[int | None], list[str]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            texts = part.column("text").to_pylist()
            yield part.column("doc_id").to_pylist(), [t or "" for t in texts]


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    capacity: int = CAPACITY,
    end_id: int = 1,
    nearly_full: float = NEARLY_FULL,
    fan_in: int = FAN_IN,
    max_open: int = MAX_OPEN,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )

    def encode_and_pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer_path)
        end = np.array([end_id], dtype="<u4").tobytes()
        rows: list[tuple] = []
        for ids, texts in text_groups(batches, BATCH_TEXTS):
            for doc_id, data in zip(ids, words.encode(texts), strict=True):
                data += end
                view = memoryview(data)
                for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                    own = view[at : at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own)))
        if not rows:
            return
        doc_ids, piece_nos, starts, lengths, crcs = zip(*rows, strict=True)
        rows.clear()
        lengths = np.array(lengths, dtype=np.int64)
        known = np.array([-1 if d is None else d for d in doc_ids], dtype=np.int64)
        keys = np.array([known, np.array(piece_nos), np.array(crcs)], dtype=np.int64)
        order, bins, offsets, fills, closed = pack(keys, lengths, capacity, nearly_full, max_open)
        base = TaskContext.get().partitionId() << 40
        for at in range(0, len(order), 20_000):
            o, here = order[at : at + 20_000], slice(at, at + 20_000)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([doc_ids[k] for k in o], pa.int64()),
                    pa.array([piece_nos[k] for k in o], pa.int32()),
                    pa.array([starts[k] for k in o], pa.int64()),
                    pa.array(lengths[o]),
                    pa.array([crcs[k] for k in o], pa.int64()),
                    pa.array(bins[here] + base),
                    pa.array(offsets[here]),
                    pa.array(fills[here]),
                    pa.array(closed[here]),
                ],
                names=[c.split()[0] for c in PIECES.split(", ")],
            )

    placed = cut(source.mapInArrow(encode_and_pack, PIECES))

    def merge(table: pa.Table) -> pa.Table:
        ids = table.column("bin").to_numpy()
        lengths = table.column("fill").to_numpy()
        order, bins, offsets, fills, closed = pack(
            np.array([ids]), lengths, capacity, nearly_full, max_open
        )
        first = np.zeros(bins.max() + 1, dtype=np.int64)
        first[bins[offsets == 0]] = ids[order][offsets == 0]
        return pa.table(
            {
                "bin": ids[order],
                "parent": first[bins],
                "offset": offsets,
                "fill": fills,
                "closed": closed,
            }
        )

    tasks = placed.rdd.getNumPartitions()
    # Bin ids carry the number of the task that made them, and so does the group of a round.
    bins = placed.where(~F.col("closed") & (F.col("offset") == 0)).select("bin", "fill")
    moves, width = None, 1
    while True:
        width *= fan_in
        group = F.floor(F.shiftright("bin", 40) / F.lit(width)).alias("group")
        merged = cut(bins.groupBy(group).applyInArrow(merge, MERGES))
        step = merged.select(
            F.col("bin").alias("mid"), F.col("parent").alias("root"), F.col("offset").alias("more")
        )
        if moves is None:
            moves = step.select(F.col("mid").alias("from"), "root", "more")
        else:
            before = moves.select("from", F.col("root").alias("mid"), F.col("more").alias("so_far"))
            moves = before.join(step, "mid", "left").select(
                "from",
                F.coalesce("root", "mid").alias("root"),
                (F.col("so_far") + F.coalesce("more", F.lit(0))).alias("more"),
            )
        if width >= tasks:
            break
        bins = merged.where(~F.col("closed") & (F.col("offset") == 0)).select(
            F.col("parent").alias("bin"), "fill"
        )
    facts = ["doc_id", "piece", "start", "length", "ids_crc32"]
    final = placed.where("closed").select(*facts, F.col("bin").alias("sequence_id"), "offset")
    moved = (
        placed.where(~F.col("closed"))
        .join(moves, F.col("bin") == F.col("from"))
        .select(
            *facts,
            F.col("root").alias("sequence_id"),
            (F.col("offset") + F.col("more")).alias("offset"),
        )
    )
    return final.unionByName(moved)
