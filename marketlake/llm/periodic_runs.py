"""Periodic runs in the words of each text, found in an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q that is at least ``min_length`` and
``min_exponent * q`` words long and that no neighbouring word extends. It ends in a square whose
two halves, as suffixes, agree in exactly q words; these are the branching squares. They are found
without a suffix tree: each LCP interval of depth d is a range of the suffix array, cut into children
where the LCP is d. Two suffixes at a distance of d that lie in different children of the interval
agree in exactly d words, so for each suffix i of all children but the largest one it is enough
to look whether the place of i + d or i - d in the array lies in the interval and in another child.
Each branching square is rotated to the left as far as it goes, and squares of the same stretch are
merged into the run of their smallest period.

Texts go through numpy in groups of about ``GROUP_WORDS`` words. Suffixes are ranked by their first
1, 2, 4, ... words, and only those that share their rank are ranked on. The ranks of all steps are
kept, since they also compare stretches from any place to the left and right: the LCP of neighbours
and the rotations take a step per power of two. A run needs two suffixes that agree in
``min_length * (min_exponent - 1) / min_exponent`` words, so texts without such a pair leave early.
Scans are narrow, and a text is always whole in one task.

Defined results: a null, empty or blank text has no words, no runs and an empty collapsed text; a
null doc_id is kept as null; rows that repeat give a row each; among runs of equal exponent the best
is the one that starts first, then the one with the smaller period; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH, MIN_EXPONENT = 24, 3
GROUP_WORDS = 200_000
CHUNK = 2_000_000

RUN = "struct<start: long, length: long, period: long>"
FOUND = f"doc_id long, n_words long, runs array<{RUN}>, best {RUN}, collapsed string"

Words = list[bytes]
Rewrite = Callable[[int | None, Words], Words]


def _groups(change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index of the group of each element, and whether the group has more than one."""
    first = np.maximum.accumulate(np.where(change, np.arange(len(change)), 0))
    last = np.append(change[1:], True)
    return first, ~(change & last)


def _ranked_on(rank: np.ndarray, ends: np.ndarray, open_at: np.ndarray, step: int) -> np.ndarray:
    """Sort the suffixes ``open_at`` by what stands ``step`` words on; returns those still open.

    A rank is the number of smaller suffixes, so a group of equals has room for its members.
    """
    own, there = rank[open_at], open_at + step
    inside = there < ends[open_at]
    after = np.where(inside, rank[np.where(inside, there, 0)] + 1, 0)
    key = own * np.int64(rank.max() + 2) + after
    order = np.argsort(key)
    key, own, at = key[order], own[order], open_at[order]
    first, shared = _groups(np.append(True, key[1:] != key[:-1]))
    first_own, _ = _groups(np.append(True, own[1:] != own[:-1]))
    rank[at] = own + first - first_own
    return np.sort(at[shared])


def _nearest_smaller(lcp: np.ndarray, step: int, or_equal: bool) -> np.ndarray:
    """Index of the nearest smaller (or equal) value before (step -1) or after (step 1) each.

    Each index points on until its pointer is right; what a pointer skips is larger, so the pointer
    of that pointer skips nothing that matters either. The ends of ``lcp`` hold -1.
    """
    to = np.clip(np.arange(len(lcp)) + step, 0, len(lcp) - 1)
    active = np.arange(1, len(lcp) - 1)
    while len(active):
        there = lcp[to[active]]
        wrong = there > lcp[active] if or_equal else there >= lcp[active]
        active = active[wrong]
        to[active] = to[to[active]]
    return to


class _Ranks:
    """Ranks by the first 1, 2, 4, ... words of all suffixes of some texts, until all differ."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray, needed: int):
        """``ids`` are below their number and differ between texts; ``ends`` are the texts'."""
        counts = np.bincount(ids, minlength=len(ids))
        rank = (np.cumsum(counts) - counts)[ids]
        open_at = np.flatnonzero(counts[ids] > 1)
        self.levels = [rank.copy()]
        self.place = np.arange(len(ids))
        step, whole = 1, True
        while len(open_at):
            if whole and 2 * step > needed:
                # Two suffixes that agree in ``step`` words are in a text that goes on.
                keep = np.isin(ends, np.unique(ends[open_at]))
                moved = np.cumsum(keep) - 1
                self.place = self.place[keep]
                self.levels = [level[keep] for level in self.levels]
                rank, open_at = rank[keep], moved[open_at]
                ends = moved[ends[keep] - 1] + 1
                whole = False
            open_at = _ranked_on(rank, ends, open_at, step)
            self.levels.append(rank.copy())
            step *= 2
        # Without a pair of suffixes that agree in so many words there is no run.
        self.empty = whole
        # The last level tells all suffixes apart; the others compare stretches.
        self.order = np.argsort(rank)
        self.levels = [np.append(level, -1) for level in self.levels[:-1]]

    def lcp(self) -> np.ndarray:
        """Words that neighbours in the suffix array share, between -1 and -1."""
        a, b = self.order[:-1], self.order[1:]
        shared = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            shared += (level[a + shared] == level[b + shared]) * np.int64(1 << k)
        return np.concatenate([[-1], shared, [-1]])

    def shared_before(self, at: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """How many words just before ``at`` equal those ``distance`` later."""
        shared = np.zeros(len(at), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level, start = self.levels[k], at - shared - (1 << k)
            there = np.maximum(start, 0)
            shared += ((start >= 0) & (level[there] == level[there + distance])) * np.int64(1 << k)
        return shared


def _children(lcp: np.ndarray) -> tuple[np.ndarray, ...]:
    """Depth, interval and own range of all children but the largest of every LCP interval."""
    before, before_equal = (_nearest_smaller(lcp, -1, equal) for equal in (False, True))
    after, after_equal = (_nearest_smaller(lcp, 1, equal) for equal in (False, True))
    cuts = np.flatnonzero(lcp > 0)
    first = np.where(before_equal == before, np.arange(len(lcp)), before_equal)
    while len(wrong := np.flatnonzero(first[first] != first)):
        first[wrong] = first[first[wrong]]
    heads = cuts[first[cuts] == cuts]
    interval = np.concatenate([first[cuts], heads])
    start = np.concatenate([cuts, before[heads]])
    stop = np.concatenate([after_equal[cuts], heads])
    order = np.lexsort((stop - start, interval))
    interval, start, stop = interval[order], start[order], stop[order]
    keep = np.append(interval[1:] == interval[:-1], False)
    interval, start, stop = interval[keep], start[keep], stop[keep]
    return lcp[interval], before[interval], after[interval], start, stop


def _branching_squares(ranks: _Ranks) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of squares whose halves agree in exactly a period, some more than once."""
    depth, low, high, start, stop = _children(ranks.lcp())
    order = ranks.order
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    sizes = stop - start
    starts, periods = [], []
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        # A child is at most half of its interval, so one alone is within reason too.
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK)))
        own = np.repeat(np.arange(at, to), sizes[at:to])
        within = np.arange(len(own)) - np.repeat(ends[at:to] - sizes[at:to] - (ends[at] - sizes[at]), sizes[at:to])
        suffix, d = order[start[own] + within], depth[own]
        for other, first in ((suffix + d, suffix), (suffix - d, suffix - d)):
            there = np.flatnonzero((other >= 0) & (other < len(order)))
            p, c = place[other[there]], own[there]
            hit = there[(p >= low[c]) & (p < high[c]) & ((p < start[c]) | (p >= stop[c]))]
            starts.append(first[hit])
            periods.append(d[hit])
        at = to
    nothing = np.empty(0, np.int64)
    return np.concatenate([nothing, *starts]), np.concatenate([nothing, *periods])


def runs_of(
    ids: np.ndarray, ends: np.ndarray, min_length: int, min_exponent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs by start, then period, in texts laid end to end.

    ``ids`` are word numbers below their number, which no two texts share; ``ends`` holds the end
    of its text for each word.
    """
    nothing = np.empty(0, np.int64)
    ranks = _Ranks(ids, ends, max(1, -(-min_length * (min_exponent - 1) // min_exponent)))
    if ranks.empty:
        return nothing, nothing, nothing
    at, period = _branching_squares(ranks)
    wanted = np.maximum(min_length, min_exponent * period)
    # A stretch of more than two periods begins before its last square.
    one_more = (at > 0) & (ranks.levels[0][at - 1] == ranks.levels[0][at - 1 + period])
    likely = one_more | (wanted <= 2 * period)
    at, period, wanted = at[likely], period[likely], wanted[likely]
    more = ranks.shared_before(at, period)
    long = more + 2 * period >= wanted
    start, length, period = (at - more)[long], (more + 2 * period)[long], period[long]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.append(True, (start[1:] != start[:-1]) | (length[1:] != length[:-1]))[: len(start)]
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return ranks.place[start[order]], length[order], period[order]


def _best(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length / period; ``runs`` are by start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _collapsed(words: Words, runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run repeats."""
    if not runs:
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()])


def _group_rows(
    doc_ids: list[int | None], texts: list[Words], min_length: int, min_exponent: int
) -> pa.RecordBatch:
    sizes = np.array([len(w) for w in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    ids = np.empty(int(ends[-1]), np.int64)
    for words, end in zip(texts, ends.tolist(), strict=True):
        # A word's number is its first place.
        index: dict[bytes, int] = {}
        first = end - len(words)
        ids[first:end] = np.fromiter(map(index.setdefault, words, count(first)), np.int64, len(words))
    found = runs_of(ids, np.repeat(ends, sizes), min_length, min_exponent) if len(ids) else ((), (), ())
    by_text: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    owners = np.searchsorted(ends, found[0], "right")
    firsts = ends - sizes
    for owner, start, length, period in zip(owners.tolist(), *map(list, map(np.asarray, found)), strict=True):
        by_text[owner].append((int(start - firsts[owner]), int(length), int(period)))
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def named(r: tuple[int, int, int] | None) -> dict[str, int] | None:
        return r and dict(zip(("start", "length", "period"), r, strict=True))

    collapsed = [_collapsed(w, r) for w, r in zip(texts, by_text, strict=True)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc_ids, pa.int64()),
            pa.array(sizes),
            pa.array([[named(r) for r in rs] for rs in by_text], pa.list_(run)),
            pa.array([named(_best(rs)) for rs in by_text], run),
            pa.array(collapsed, pa.binary()).cast(pa.string()),
        ],
        names=["doc_id", "n_words", "runs", "best", "collapsed"],
    )


def find_runs(
    docs: DataFrame,
    *,
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
    rewrite: Rewrite | None = None,
) -> DataFrame:
    """doc_id, n_words, all runs, the best one and the text without repeats, for every row.

    ``rewrite`` may change the words of a row, given its doc_id, before runs are looked for. A word
    goes if a run holds it after the run's first period.
    """
    if min_exponent < 2:
        raise ValueError("a run repeats its period at least twice")
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids: list[int | None] = []
        texts: list[Words] = []
        held = 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                words = (text.as_py() or "").encode("utf-8", "replace").split()
                if rewrite:
                    words = rewrite(doc_id, words)
                doc_ids.append(doc_id)
                texts.append(words)
                held += len(words)
                if held >= GROUP_WORDS or len(texts) >= GROUP_WORDS:
                    yield _group_rows(doc_ids, texts, min_length, min_exponent)
                    doc_ids, texts, held = [], [], 0
        if texts:
            yield _group_rows(doc_ids, texts, min_length, min_exponent)

    return source.mapInArrow(scan, FOUND)
