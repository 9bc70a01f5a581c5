"""Benchmark passages in documents, found within an edit budget by the pigeonhole rule.

Texts are compared as lower-case words (runs of letters, digits and underscores). A test item of
``n`` words may differ by ``e = floor(n * edit_rate)`` word edits. Cut into ``e + 1`` pieces, at
least one piece of any such occurrence is intact. An automaton finds all intact pieces in one pass
over a document; around every hit Myers' bit-parallel distance, on words, decides. Nothing is
sampled: an occurrence within the budget anywhere in a whole text is found.

The test set is handed to the tasks in shards of about ``shard_chars`` characters of items, whose size
is known before they are sent; they lie on the executors' disks until they are asked for. A task
holds the automata of ``HELD_MATCHERS`` shards. Beyond that it takes the shards in turn over
``CHUNK_CHARS`` characters of documents at a time, so that an automaton is built once a chunk and not
once a batch. Documents are scanned once, in one narrow stage without a shuffle.

Defined results: a null or empty text has no hits, a null or wordless item is never found; rows
that repeat count one by one; a hit of a row without id has a null doc_id; equal items are found
each under its own id; empty tables give no hits. Other columns are left alone.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EDIT_RATE = 0.2
SHARD_CHARS = 1_000_000
HELD_MATCHERS = 4
CHUNK_CHARS = 32_000_000

WORD = re.compile(r"\w+")

HITS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("edits", T.IntegerType()),
        T.StructField("item_words", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
    ]
)


def lowered(text: str) -> str:
    """Lower case that keeps every position: the one letter that grows is replaced first."""
    return text.replace("İ", "I").lower()


def pieces(n_words: int, edits: int) -> list[tuple[int, int]]:
    """The word ranges of ``edits + 1`` pieces of nearly equal length."""
    bounds = [n_words * k // (edits + 1) for k in range(edits + 2)]
    return list(zip(bounds, bounds[1:], strict=False))


def myers_ends(pattern: list[str], words: list[str], budget: int) -> list[tuple[int, int]]:
    """(end, distance) of each prefix end where the pattern ends within the budget.

    Bit-parallel approximate search: an occurrence may start anywhere in ``words``.
    """
    m = len(pattern)
    masks: dict[str, int] = {}
    for k, word in enumerate(pattern):
        masks[word] = masks.get(word, 0) | 1 << k
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    found = []
    for end, word in enumerate(words, 1):
        eq = masks.get(word, 0)
        diagonal = ((((eq & plus) + plus) ^ plus) | eq | minus) & full
        right, left = minus | (full & ~(diagonal | plus)), plus & diagonal
        score += (right & top != 0) - (left & top != 0)
        right, left = (right << 1) & full, (left << 1) & full
        plus, minus = left | (full & ~(diagonal | right)), right & diagonal
        if score <= budget:
            found.append((end, score))
    return found


def occurrences(pattern: list[str], words: list[str], budget: int) -> list[tuple[int, int, int]]:
    """(start, end, distance) of separate occurrences, the best of each run of ends."""
    found: list[tuple[int, int, int]] = []
    ends = myers_ends(pattern, words, budget)
    run: list[tuple[int, int]] = []
    for k, (end, score) in enumerate(ends):
        run.append((end, score))
        if k + 1 < len(ends) and ends[k + 1][0] == end + 1:
            continue
        best_end, best = min(run, key=lambda x: (x[1], x[0]))
        run = []
        low = max(0, best_end - len(pattern) - budget)
        back = [
            e for e, s in myers_ends(pattern[::-1], words[low:best_end][::-1], best) if s == best
        ]
        start = best_end - (back[0] if back else len(pattern))
        if not found or start >= found[-1][1]:
            found.append((start, best_end, best))
        elif best < found[-1][2]:
            found[-1] = (start, best_end, best)
    return found


class Matcher:
    """Finds the items of one shard in texts."""

    def __init__(self, items: list[tuple[int | None, str]], edit_rate: float):
        import ahocorasick

        self.items = []
        keys: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            words = WORD.findall(lowered(text or ""))
            if not words:
                continue
            budget = int(len(words) * edit_rate + 1e-9)
            for low, high in pieces(len(words), budget):
                key = f" {' '.join(words[low:high])} "
                keys.setdefault(key, []).append((len(self.items), low))
            self.items.append((item_id, words, budget))
        self.automaton = ahocorasick.Automaton()
        for key, owners in keys.items():
            self.automaton.add_word(key, (len(key), owners))
        if keys:
            self.automaton.make_automaton()

    def _regions(self, joined: str) -> dict[int, list[list[int]]]:
        """By item, the word ranges that can hold an occurrence, merged where they overlap."""
        hits = list(self.automaton.iter(joined))
        if not hits:
            return {}
        spaces = np.flatnonzero(np.array(memoryview(joined.encode("utf-32-le")).cast("I")) == 32)
        starts = np.searchsorted(spaces, [end + 1 - value[0] for end, value in hits])
        found: dict[int, set[int]] = {}
        for start, (_, (_, owners)) in zip(starts.tolist(), hits, strict=True):
            for item, low in owners:
                found.setdefault(item, set()).add(start - low)
        regions = {}
        for item, diagonals in found.items():
            _, words, budget = self.items[item]
            merged: list[list[int]] = []
            for at in sorted(diagonals):
                low, high = max(0, at - budget), at + len(words) + budget
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = high
                else:
                    merged.append([low, high])
            regions[item] = merged
        return regions

    def contains(self, text: str | None) -> bool:
        return bool(text) and next(self.find(text, spans=False), None) is not None

    def find(self, text: str | None, spans: bool = True) -> Iterator[tuple]:
        """(item_id, edits, item_words, start, end) in characters of the text."""
        if not text or not self.items:
            return
        low_text = lowered(text)
        words = WORD.findall(low_text)
        regions = self._regions(f" {' '.join(words)} ")
        places = None
        for item, ranges in sorted(regions.items()):
            item_id, pattern, budget = self.items[item]
            for low, high in ranges:
                for start, end, edits in occurrences(pattern, words[low:high], budget):
                    if places is None and spans:
                        places = [m.span() for m in WORD.finditer(low_text)]
                    begin, stop = (
                        (places[low + start][0], places[low + end - 1][1])
                        if spans and end > start
                        else (0, 0)
                    )
                    yield item_id, edits, len(pattern), begin, stop


def _shards(items: DataFrame, shard_chars: int) -> Iterator[list[tuple[int | None, str]]]:
    """The items in shards of about ``shard_chars``, dealt out in one pass, one on the driver at a time."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = rows.where(F.col("text").isNotNull())
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-total // shard_chars))
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(count)).alias("shard")
    dealt = rows.select(shard, "item_id", "text").repartition(count, "shard").sortWithinPartitions("shard")
    for _, own in groupby(dealt.toLocalIterator(), key=lambda r: r["shard"]):
        yield sorted(((r["item_id"], r["text"]) for r in own), key=repr)


class _Held:
    """A broadcast shard that is known by its number in every worker."""

    def __init__(self, broadcast, number: int):
        self.broadcast, self.number = broadcast, number


_BUILT: dict[int, Matcher] = {}


def _matcher(held: _Held) -> Matcher:
    """The matcher of a shard; a worker keeps those it used last."""
    matcher = _BUILT.pop(held.number, None)
    if matcher is None:
        while len(_BUILT) >= HELD_MATCHERS:
            _BUILT.pop(next(iter(_BUILT)))
        matcher = Matcher(*held.broadcast.value)
    _BUILT[held.number] = matcher
    return matcher


def _held_shards(docs: DataFrame, items: DataFrame, edit_rate: float, shard_chars: int) -> list[_Held]:
    context = docs.sparkSession.sparkContext
    shards = (context.broadcast((shard, edit_rate)) for shard in _shards(items, shard_chars) if shard)
    return [_Held(b, b._jbroadcast.id()) for b in shards]


def _chunks(parts: Iterator, size: Callable) -> Iterator[list]:
    """Consecutive parts of about CHUNK_CHARS characters together."""
    held, chars = [], 0
    for part in parts:
        held.append(part)
        chars += size(part)
        if chars >= CHUNK_CHARS:
            yield held
            held, chars = [], 0
    if held:
        yield held


def _characters(texts: pd.Series) -> int:
    return int(texts.map(lambda t: len(t) if t else 0).sum())


def find_benchmark(
    docs: DataFrame,
    items: DataFrame,
    *,
    edit_rate: float = EDIT_RATE,
    shard_chars: int = SHARD_CHARS,
) -> DataFrame:
    """One row per occurrence: doc_id, item_id, edits, item_words, start and end in characters."""
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    shards = _held_shards(docs, items, edit_rate, shard_chars)
    if not shards:
        return docs.sparkSession.createDataFrame([], HITS)

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in _chunks(frames, lambda frame: _characters(frame["text"])):
            for held in shards:
                matcher = _matcher(held)
                for frame in chunk:
                    rows = [
                        (None if pd.isna(doc_id) else int(doc_id), *hit)
                        for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True)
                        for hit in matcher.find(text)
                    ]
                    out = pd.DataFrame(rows, columns=HITS.fieldNames())
                    yield out.astype({"doc_id": "Int64", "item_id": "Int64"})

    return source.mapInPandas(scan, HITS)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    *,
    edit_rate: float = EDIT_RATE,
    shard_chars: int = SHARD_CHARS,
) -> DataFrame:
    """The documents that hold no test item, with all their columns."""
    shards = _held_shards(docs, items, edit_rate, shard_chars)
    if not shards:
        return docs

    @F.pandas_udf(T.BooleanType())
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for chunk in _chunks(batches, _characters):
            kept = [np.ones(len(texts), bool) for texts in chunk]
            for held in shards:
                matcher = _matcher(held)
                for texts, flags in zip(chunk, kept, strict=True):
                    for k, text in enumerate(texts):
                        if flags[k] and matcher.contains(text):
                            flags[k] = False
            yield from map(pd.Series, kept)

    return docs.where(clean(F.col("text").cast("string")))
