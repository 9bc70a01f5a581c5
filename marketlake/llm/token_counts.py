"""Tokens of each section of a document, by the characters that tokens span.

A whole text is encoded once. Its tokens cover its bytes without gaps, so their lengths give their
character spans (a token that holds part of a character spans that character). Sections are
character intervals that cover the text: lines with their line ends, or paragraphs with the blank
lines after them. Spans and sections are both in order, so joining them is one merge per document.
A token that touches several sections goes by an explicit rule:

* ``majority``: to the section with most of its characters, the earlier one of equals;
* ``start``: to the section with its first character.

Tokens of each run between spaces are looked up after the first time in a Python worker. Splitting
there gives the tokens of the whole text unless a space stands inside or at the end of a run of
white space; texts that have such a run are encoded whole. All work is in the scan's own stage.

Defined results: a null or empty text has one empty section without tokens; rows that repeat count
each; a null id stays null; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHED_RUNS = 500_000

#: The splitting pattern of the vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: A space inside a run of white space, or at the end of one that ends the text.
UNSAFE = re.compile(r"\s \s|\s \Z")
PARAGRAPH = re.compile(r"\n[^\S\n]*\n\s*")

SCHEMA = "doc_id long, section int, start long, end long, n_tokens long, n_crossing long"


class Lengths:
    """Byte lengths of the tokens of texts."""

    def __init__(self, ranks_path: str, pattern: str = PATTERN):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            "own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.length_of = np.zeros(max(ranks.values()) + 1, "<u2")
        for token, rank in ranks.items():
            self.length_of[rank] = len(token)
        self.known: dict[str, bytes] = {}

    def whole(self, text: str) -> np.ndarray:
        return self.length_of[self.encoding.encode_ordinary(text)]

    def of(self, text: str) -> np.ndarray:
        if UNSAFE.search(text):
            return self.whole(text)
        known = self.known
        first, *rest = text.split(" ")
        try:
            joined = b"".join([known[run] for run in rest])
        except KeyError:
            new = {run for run in set(rest) if run not in known}
            if len(known) + len(new) > CACHED_RUNS:
                known.clear()
                new = set(rest)
            for run in new:
                known[run] = self.whole(" " + run).tobytes()
            joined = b"".join([known[run] for run in rest])
        return np.concatenate([self.whole(first), np.frombuffer(joined, "<u2")])


def spans(text: str, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character of each token, and the one after its last."""
    ends = np.cumsum(lengths, dtype=np.int64)
    starts = ends - lengths
    if text.isascii() or not len(ends):
        return starts, ends
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    character = np.cumsum((data & 0xC0) != 0x80) - 1
    return character[starts], character[ends - 1] + 1


def line_starts(text: str) -> list[int]:
    """A line end belongs to the line before it; an empty last line is none."""
    found = [0, *(m.end() for m in re.finditer("\n", text))]
    return found[:-1] if len(found) > 1 and found[-1] == len(text) else found


def paragraph_starts(text: str) -> list[int]:
    return [0, *(m.end() for m in PARAGRAPH.finditer(text) if 0 < m.end() < len(text))]


SECTIONS = {"line": line_starts, "paragraph": paragraph_starts}


def attribute(
    starts: np.ndarray, ends: np.ndarray, section_starts: np.ndarray, length: int, rule: str
) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and those among them that touch another section."""
    first = np.searchsorted(section_starts, starts, "right") - 1
    last = np.searchsorted(section_starts, ends - 1, "right") - 1
    crossing = np.flatnonzero(first != last)
    if rule == "majority" and len(crossing):
        bounds = np.append(section_starts, length)
        first = first.copy()
        for k in crossing:
            held = range(first[k], last[k] + 1)
            first[k] = max(
                held,
                key=lambda s: (min(ends[k], bounds[s + 1]) - max(starts[k], bounds[s]), -s),
            )
    elif rule not in ("majority", "start"):
        raise ValueError(f"no such rule: {rule}")
    n = len(section_starts)
    return np.bincount(first, minlength=n), np.bincount(first[crossing], minlength=n)


_LENGTHS: dict[tuple[str, str], Lengths] = {}


def count_tokens(
    docs: DataFrame,
    ranks_path: str,
    *,
    sections: str = "line",
    rule: str = "majority",
    pattern: str = PATTERN,
) -> DataFrame:
    """doc_id, section (from 0), start and end in characters, n_tokens, n_crossing."""
    if rule not in ("majority", "start"):
        raise ValueError(f"no such rule: {rule}")
    starts_of = SECTIONS[sections]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (ranks_path, pattern) not in _LENGTHS:
            _LENGTHS[ranks_path, pattern] = Lengths(ranks_path, pattern)
        lengths = _LENGTHS[ranks_path, pattern]
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                own: list[int] = []
                columns: list[list[np.ndarray]] = [[] for _ in range(5)]
                for k, text in enumerate(part.column("text").to_pylist()):
                    text = text or ""
                    begins = np.array(starts_of(text), np.int64)
                    counts, crossing = attribute(
                        *spans(text, lengths.of(text)), begins, len(text), rule
                    )
                    own.append(k)
                    for column, values in zip(
                        columns,
                        (
                            np.arange(len(begins)),
                            begins,
                            np.append(begins[1:], len(text)),
                            counts,
                            crossing,
                        ),
                        strict=True,
                    ):
                        column.append(values)
                if not own:
                    continue
                repeat = np.repeat(own, [len(x) for x in columns[0]])
                flat = [np.concatenate(c) for c in columns]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(repeat)),
                        pa.array(flat[0].astype(np.int32)),
                        *[pa.array(x.astype(np.int64)) for x in flat[1:]],
                    ],
                    names=[c.split()[0] for c in SCHEMA.split(", ")],
                )

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return source.mapInArrow(scan, SCHEMA)
