"""One large JSON array, read by many tasks.

An answer that is a single array of records can be far larger than what one task should hold. The
file is cut into ranges of bytes, and each range gives the records that begin in it. Where a record begins
depends on whether the range starts within a text and how deep it is nested, which no look at the range
alone can tell. So the ranges are first summed up, each in a task of its own, for both cases of standing within
a text and both of standing behind a backslash; going through these sums, a few numbers per range, gives
every range its true state. Then the ranges are read: a record belongs to the range that has the bracket or
comma before it, and its reader goes on beyond the range to the record's end. Nothing is lost or read twice.
Both passes take a range in blocks, so a task holds a block and the records of one answer, however large the
range; only text behind the end of the array, which is malformed, is held as a whole.

The records come as landed answers, arrays of at most ``per_body`` records each, so that everything that
works on answers works on these. A file that is no array is one answer as it is. What is not well formed
(a missing end, text behind the end, nothing between two commas) is an answer that is malformed. An
empty array gives no answer. Files are opened as footers are, and must not be compressed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RANGE_BYTES = 8 << 20
PER_BODY = 256
#: How much of a range is read at once.
BLOCK_BYTES = 1 << 20
#: How much is read at once beyond the end of a range.
MORE_BYTES = 256 << 10

RANGES = "path string, size long, fetched_at timestamp, start long, stop long"
STATES = f"{RANGES}, array boolean, within boolean, escaped boolean, depth long, begun boolean"
SUMS = f"{RANGES}, first string, odd array<boolean>, escapes array<boolean>, even_depth array<long>, odd_depth array<long>"

QUOTE, BACKSLASH, COMMA = ord('"'), ord("\\"), ord(",")
_DEPTH = np.zeros(256, np.int8)
_DEPTH[[ord(c) for c in "[{"]] = 1
_DEPTH[[ord(c) for c in "]}"]] = -1
_SIGN = _DEPTH != 0
_SIGN[[QUOTE, BACKSLASH, COMMA]] = True
BLANKS = b" \t\r\n"
BEGINS = (b"[", b",")


@dataclass
class State:
    """Where a reader stands: in a text, behind a backslash, how deep, and whether anything came yet."""

    within: bool = False
    escaped: bool = False
    depth: int = 0
    begun: bool = False

    def behind(self, first: str, odd: list, escapes: list, even_depth: list, odd_depth: list) -> State:
        """Where a reader stands behind a range, by the range's sums."""
        e = int(self.escaped)
        depth = self.depth + int((odd_depth if self.within else even_depth)[e])
        return State(self.within != bool(odd[e]), bool(escapes[e]), depth, self.begun or first != "")


def _signs(data: bytes, escaped: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """Places and values of quotes, brackets and commas, without escaped quotes, and whether the next
    byte is escaped."""
    raw = np.frombuffer(data, np.uint8)
    places = np.flatnonzero(_SIGN[raw])
    values = raw[places]
    slashes = places[values == BACKSLASH]
    open_end = False
    if len(slashes) or escaped:
        # A run of backslashes escapes what follows if their number is odd.
        first = np.append(True, np.diff(slashes) > 1)[: len(slashes)]
        starts = slashes[first]
        lengths = np.diff(np.append(np.flatnonzero(first), len(slashes)))
        behind = starts + lengths
        odd = lengths % 2 == 1
        if escaped:
            if len(starts) and starts[0] == 0:
                odd[0] = not odd[0]
            else:
                behind, odd = np.append(0, behind), np.append(True, odd)
        taken = behind[odd]
        open_end = bool(len(taken) and taken[-1] == len(raw))
        hit = np.zeros(len(raw) + 1, bool)
        hit[taken] = True
        keep = (values != BACKSLASH) & ~((values == QUOTE) & hit[places])
    else:
        keep = values != BACKSLASH
    return places[keep], values[keep], open_end


def _summed(data: bytes) -> dict:
    """What a block does to a reader, for each case of being escaped and of standing in a text."""
    out: dict = {"odd": [], "escapes": [], "even_depth": [], "odd_depth": []}
    out["first"] = data.lstrip(BLANKS)[:1].decode("latin-1")
    for escaped in (False, True):
        if escaped and data and data[:1] not in (b'"', b"\\"):
            # Any other first byte means the same behind a backslash.
            for case in ("odd", "escapes", "even_depth", "odd_depth"):
                out[case] *= 2
            break
        _, values, open_end = _signs(data, escaped)
        inside = np.cumsum(values == QUOTE) % 2 == 1
        steps = _DEPTH[values].astype(np.int64)
        out["odd"].append(bool((values == QUOTE).sum() % 2))
        out["escapes"].append(open_end)
        out["even_depth"].append(int(steps[~inside].sum()))
        out["odd_depth"].append(int(steps[inside].sum()))
    return out


def _joined(sums: dict, more: dict) -> dict:
    """The sums of a block and of the one behind it as the sums of both."""
    out: dict = {"first": sums["first"] or more["first"], "odd": [], "escapes": [], "even_depth": [], "odd_depth": []}
    for e in (0, 1):
        odd, then = sums["odd"][e], int(sums["escapes"][e])
        same, other = ("odd_depth", "even_depth") if odd else ("even_depth", "odd_depth")
        out["odd"].append(odd != more["odd"][then])
        out["escapes"].append(more["escapes"][then])
        out["even_depth"].append(sums["even_depth"][e] + more[same][then])
        out["odd_depth"].append(sums["odd_depth"][e] + more[other][then])
    return out


def _boundaries(data: bytes, state: State) -> tuple[list[int], list[int], State]:
    """Places that begin a record, places that end the array, and where the reader stands behind."""
    places, values, open_end = _signs(data, state.escaped)
    quotes = values == QUOTE
    inside = (np.cumsum(quotes) + state.within) % 2 == 1
    outside = ~inside & ~quotes
    steps = np.where(outside, _DEPTH[values], 0).astype(np.int64)
    depth = state.depth + np.cumsum(steps)
    begins = outside & (((values == COMMA) & (depth == 1)) | ((values == ord("[")) & (depth == 1)))
    ends = outside & (_DEPTH[values] < 0) & (depth == 0)
    after = State(bool((quotes.sum() + state.within) % 2), open_end, int(depth[-1]) if len(depth) else state.depth)
    return places[begins].tolist(), places[ends].tolist(), after


def _open(path: str):
    from pyarrow import fs

    try:
        system, inner = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    except (pa.ArrowInvalid, OSError) as error:
        raise ValueError(f"ranges cannot be read at {path}: {error}") from error
    return system.open_input_file(inner)


def _blocks(handle, start: int, stop: int, at_once: int) -> Iterator[bytes]:
    handle.seek(start)
    while start < stop and (data := handle.read(min(at_once, stop - start))):
        yield data
        start += len(data)


def _summed_range(handle, start: int, stop: int) -> dict:
    return reduce(_joined, map(_summed, _blocks(handle, start, stop, BLOCK_BYTES)), _summed(b""))


def _record(mark: bytes, pieces: list[bytes], end: bytes) -> Iterator[bytes]:
    """The text between a bracket or comma and what ends it."""
    record = b"".join(pieces).strip(BLANKS)
    if not end or not record and mark + end != b"[]":
        # Without an end, or with nothing between two commas, the array is not well formed.
        yield b"," + record
    elif record:
        yield record


def _records(handle, size: int, start: int, stop: int, state: State) -> Iterator[bytes]:
    """Texts of the records whose bracket or comma is in the range, and of what is malformed there."""
    closed_before = state.begun and state.depth == 0
    whole: list[bytes] = []
    # The last bracket or comma, and what came behind it.
    mark, pieces = b"", []
    for data in _blocks(handle, start, stop, BLOCK_BYTES):
        begins, ends, state = _boundaries(data, state)
        at = 0
        for place in sorted([*begins, *ends]):
            if mark in BEGINS:
                yield from _record(mark, [*pieces, data[at:place]], data[place : place + 1])
            mark, pieces, at = data[place : place + 1], [], place + 1
        if mark:
            pieces.append(data[at:])
        if closed_before:
            whole.append(data)
    if mark in BEGINS:
        # The last record ends further on.
        for data in _blocks(handle, stop, size, MORE_BYTES):
            begins, ends, state = _boundaries(data, state)
            nearest = min([*begins[:1], *ends[:1]], default=None)
            pieces.append(data[:nearest])
            if nearest is not None:
                yield from _record(mark, pieces, data[nearest : nearest + 1])
                break
        else:
            yield from _record(mark, pieces, b"")
        pieces = []
    # Behind the end of the array nothing but white space may come.
    rest = b"".join(whole if closed_before else pieces).strip(BLANKS)
    if rest:
        yield b"," + rest


def _bodies(path: str, size: int, start: int, stop: int, array: bool, state: State, per_body: int) -> Iterator[tuple[int, str]]:
    with _open(path) as handle:
        if not array:
            if start == 0:
                yield 0, handle.read(size).decode("utf-8", "replace")
            return
        held: list[bytes] = []
        number = 0
        for record in _records(handle, size, start, stop, state):
            held.append(record)
            if len(held) == per_body:
                yield number, "[" + b",".join(held).decode("utf-8", "replace") + "]"
                held, number = [], number + 1
        if held:
            yield number, "[" + b",".join(held).decode("utf-8", "replace") + "]"


def read_large_arrays(
    spark: SparkSession,
    path: str,
    source: str,
    *,
    range_bytes: int = RANGE_BYTES,
    per_body: int = PER_BODY,
    suffix: str = ".json",
) -> DataFrame:
    """Landed answers of a source from large JSON documents below a path.

    The request key is the file's name, the place of the range and a number.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{suffix}")
        .load(path)
        .select("path", F.col("length").alias("size"), F.col("modificationTime").alias("fetched_at"))
    )
    ranges = listed.select(
        "path",
        "size",
        "fetched_at",
        F.explode(F.sequence(F.lit(0), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(range_bytes))).alias("start"),
    ).select("path", "size", "fetched_at", "start", F.least(F.col("start") + range_bytes, F.col("size")).alias("stop"))

    moment, flags, steps = pa.timestamp("us", "UTC"), pa.list_(pa.bool_()), pa.list_(pa.int64())
    sums = pa.schema(
        [("path", pa.string()), ("size", pa.int64()), ("fetched_at", moment), ("start", pa.int64()), ("stop", pa.int64()),
         ("first", pa.string()), ("odd", flags), ("escapes", flags), ("even_depth", steps), ("odd_depth", steps)]
    )

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with _open(row["path"]) as handle:
                    found = _summed_range(handle, row["start"], row["stop"])
                yield pa.RecordBatch.from_pylist([row | found], schema=sums)

    facts = [c.split()[0] for c in RANGES.split(", ")]

    def go_through(sums: pd.DataFrame) -> pd.DataFrame:
        sums = sums.sort_values("start")
        first = next((c for c in sums["first"] if c), "")
        state, rows = State(), []
        for r in sums.to_dict("records"):
            place = (state.within, state.escaped, state.depth, state.begun)
            rows.append((*(r[c] for c in facts), first == "[", *place))
            state = state.behind(*(r[c] for c in ("first", "odd", "escapes", "even_depth", "odd_depth")))
        return pd.DataFrame(rows, columns=[*facts, "array", "within", "escaped", "depth", "begun"])

    # A range is a row, and each row is worth a task.
    tasks = max(1, ranges.count())
    dealt = ranges.repartitionByRange(tasks, "path", "start")
    states = dealt.mapInArrow(sum_up, SUMS).groupBy("path").applyInPandas(go_through, STATES)

    answer = pa.schema([("request_key", pa.string()), ("fetched_at", moment), ("body", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                state = State(r["within"], r["escaped"], r["depth"], r["begun"])
                name = r["path"].rpartition("/")[2].removesuffix(suffix)
                for number, body in _bodies(r["path"], r["size"], r["start"], r["stop"], r["array"], state, per_body):
                    key = f"{name}-{r['start']:015d}-{number}"
                    row = {"request_key": key, "fetched_at": r["fetched_at"], "body": body}
                    yield pa.RecordBatch.from_pylist([row], schema=answer)

    placed = states.repartitionByRange(tasks, "path", "start")
    bodies = placed.mapInArrow(read, "request_key string, fetched_at timestamp, body string")
    return bodies.select(
        F.lit(source).alias("source"), "request_key", "fetched_at", F.lit(200).alias("status"), "body"
    )
