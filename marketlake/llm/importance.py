"""Documents drawn like a target set, by hashed word features and Gumbel noise.

A feature is a word, or also a pair of neighbouring words, of a lower-cased text; its bucket is its
CRC-32 modulo ``buckets``. A bucket's gain compares its share of the target with that of the
documents, a document's weight is the mean gain of its features, and the highest weights with noise
that depends on the seed and the doc_id alone are drawn.

Features are counted exactly: each task adds up what it sees, and the counts meet in a shuffle on
the feature. The head of the vocabulary, at most ``head`` words (and as many pairs) of at most
``HEAD_BYTES`` bytes, is broadcast with the state of the CRC after each word, and pairs with their
bucket; whatever is not in it, the tail, is hashed as it comes. A pair of the tail goes on from the
state of its first word. Counts of the head and of the tail both feed the bucket totals, which
cover all documents. Texts are then read a second time and scored in one narrow stage.

Ranks need no global sort in one task: scores are whole numbers, so the counts by score, a table
that does not grow with the corpus, give the lowest score drawn. Only rows from there up are sorted,
by range, and a row's rank is its place in its range after the sizes of the ranges before. Rows of
one doc_id and score are told apart by their place in the scored table, so they do not share a range.

Defined results: a null or empty text has no features and weight 0; a null doc_id counts as empty
text for the noise and comes last among ties; rows that repeat are drawn each; without target or
documents all gains follow from the same formula; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import LOWER, UPPER, cut, stored

BUCKETS = 10_000
HEAD = 65_536
HEAD_BYTES = 64
FLUSH = 200_000
#: Place of a row within its partition in a number from monotonically_increasing_id.
PLACE_BITS = 33

#: Letters, digits and all signs beyond ASCII make words; the other ASCII signs part them.
_TABLE = bytes(
    b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256)
).translate(bytes.maketrans(UPPER.encode(), LOWER.encode()))

COUNTS = "feature binary, words int, n long"
SCORED = "doc_id long, n_words long, n_features long, weight long"


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_TABLE).split()


def features_of(words: list[bytes], max_words: int) -> Iterable[bytes]:
    yield from words
    if max_words > 1:
        yield from (a + b" " + b for a, b in pairwise(words))


def feature_counts(texts: DataFrame, max_words: int) -> DataFrame:
    """Exact counts of all features of the column ``text``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            sizes = [f.count(b" ") + 1 for f in held]
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array(list(held), pa.binary()),
                    pa.array(sizes, pa.int32()),
                    pa.array(list(held.values()), pa.int64()),
                ],
                names=["feature", "words", "n"],
            )
            held.clear()
            return batch

        for batch in batches:
            for text in batch.column("text"):
                words = words_of(text.as_py() or "")
                held.update(words if max_words == 1 else features_of(words, max_words))
                if len(held) >= FLUSH:
                    yield rows()
        if held:
            yield rows()

    partial = texts.select("text").mapInArrow(count, COUNTS)
    return partial.groupBy("feature", "words").agg(F.sum("n").alias("n"))


def _step() -> Column:
    """Counts in steps of a 16th power of two, by which the head is chosen without a sort."""
    return F.floor(F.log2("n") * 16).cast("int")


def _in_head(lowest: dict[int, int | None]) -> Column:
    chosen = F.lit(False)
    for words, step in lowest.items():
        if step is not None:
            chosen = chosen | ((F.col("words") == words) & (_step() >= step))
    return chosen & (F.length("feature") <= HEAD_BYTES)


def _lowest_steps(counts: DataFrame, head: int, max_words: int) -> dict[int, int | None]:
    """For words and for pairs, the step from which on at most ``head`` are as frequent."""
    sizes = (
        counts.where(F.length("feature") <= HEAD_BYTES)
        .groupBy("words", _step().alias("step"))
        .count()
        .orderBy(F.desc("step"))
        .collect()
    )
    lowest: dict[int, int | None] = {}
    for words in range(1, max_words + 1):
        taken, lowest[words] = 0, None
        for row in sizes:
            if row["words"] == words:
                taken += row["count"]
                if taken > head:
                    break
                lowest[words] = row["step"]
    return lowest


def _bucket_sums(counts: DataFrame, buckets: int) -> np.ndarray:
    """The sum of the counts of each bucket, hashing every feature."""
    sums = np.zeros(buckets, np.int64)
    bucket = (F.crc32("feature") % buckets).alias("bucket")
    for row in counts.groupBy(bucket).agg(F.sum("n").alias("n")).collect():
        sums[row["bucket"]] = row["n"]
    return sums


def gains_of(target: np.ndarray, source: np.ndarray) -> list[int]:
    """floor(1000 ln) of the smoothed share in the target over that in the source, per bucket."""
    buckets = len(source)
    targets, sources = float(target.sum() + buckets), float(source.sum() + buckets)
    return [
        math.floor(1000 * math.log((t + 1.0) * sources / ((s + 1.0) * targets)))
        for t, s in zip(target.tolist(), source.tolist(), strict=True)
    ]


class _WordGains(dict):
    """Gains of words; those that are not in the head are hashed as they come and not held."""

    def __init__(self, states: dict[bytes, int], gains: list[int]):
        super().__init__((word, gains[state % len(gains)]) for word, state in states.items())
        self.gains = gains

    def __missing__(self, word: bytes) -> int:
        return self.gains[zlib.crc32(word) % len(self.gains)]


def _weigh(source: DataFrame, head: dict, gains: list[int], max_words: int) -> DataFrame:
    held = source.sparkSession.sparkContext.broadcast((head, gains))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (states, pairs), gain_of = held.value
        by_word = _WordGains(states, gain_of)
        buckets = len(gain_of)

        def of_pair(a: bytes, b: bytes) -> int:
            bucket = pairs.get((a, b))
            if bucket is None:
                state = states.get(a)
                before = zlib.crc32(a) if state is None else state
                bucket = zlib.crc32(b" " + b, before) % buckets
            return gain_of[bucket]

        for batch in batches:
            columns: list[list] = [[], [], []]
            for text in batch.column("text"):
                words = words_of(text.as_py() or "")
                total, n = sum(map(by_word.__getitem__, words)), len(words)
                if max_words > 1:
                    total += sum(of_pair(a, b) for a, b in pairwise(words))
                    n += max(0, len(words) - 1)
                for column, value in zip(columns, (len(words), n, total // n if n else 0), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)],
                names=[c.split()[0] for c in SCORED.split(", ")],
            )

    return source.mapInArrow(scan, SCORED)


def _with_ranks(scored: DataFrame, eligible: Column, percent: int) -> DataFrame:
    """``scored`` with rank 1, 2, ... of the highest scores, that part of the eligible rows."""
    sizes = scored.where(eligible).groupBy("score").count().orderBy(F.desc("score")).collect()
    draw = percent * sum(row["count"] for row in sizes) // 100
    lowest, above = None, 0
    for row in sizes:
        if above >= draw:
            break
        lowest, above = row["score"], above + row["count"]
    unranked = scored.withColumn("rank", F.lit(None).cast("long"))
    if lowest is None:
        return unranked.drop("row_id")
    candidate = F.coalesce(eligible & (F.col("score") >= lowest), F.lit(False))
    in_order = cut(
        scored.where(candidate)
        .orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row_id")
        .withColumn("place", F.monotonically_increasing_id())
    )
    part = F.shiftright("place", PLACE_BITS).alias("part")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        in_order.groupBy(part)
        .count()
        .select("part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    )
    # One row per range of the sort, so the table is small by the number of tasks.
    rank = F.col("before") + F.col("place").bitwiseAND((1 << PLACE_BITS) - 1) + 1
    drawn = (
        in_order.withColumn("part", part)
        .join(F.broadcast(before), "part")
        .withColumn("rank", F.when(rank <= draw, rank))
    )
    return unranked.where(~candidate).drop("row_id").unionByName(drawn.select(*scored.drop("row_id").columns, "rank"))


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    max_words: int = 1,
    buckets: int = BUCKETS,
    seed: str = "2024",
    min_words: int = 20,
    percent: int = 10,
    head: int = HEAD,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row of ``docs``.

    Of the rows with at least ``min_words`` words, ``percent`` in a hundred have a rank.
    """
    if max_words not in (1, 2):
        raise ValueError("features are words, or words and pairs")
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    counts = cut(feature_counts(source, max_words))
    lowest = _lowest_steps(counts, head, max_words)
    in_head = _in_head(lowest)
    states: dict[bytes, int] = {}
    pairs: dict[tuple[bytes, bytes], int] = {}
    sums = _bucket_sums(counts.where(~in_head), buckets)
    for row in counts.where(in_head).collect():
        feature = bytes(row["feature"])
        state = zlib.crc32(feature)
        sums[state % buckets] += row["n"]
        if row["words"] == 1:
            states[feature] = state
        else:
            first, _, second = feature.partition(b" ")
            pairs[first, second] = state % buckets
    wanted = feature_counts(target.select(F.col("text").cast("string").alias("text")), max_words)
    gains = gains_of(_bucket_sums(wanted, buckets), sums)

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = stored(
        _weigh(source, (states, pairs), gains, max_words).select(
            "doc_id",
            "n_words",
            "n_features",
            "weight",
            (F.col("weight") + noise).cast("long").alias("score"),
            F.monotonically_increasing_id().alias("row_id"),
        )
    )
    return _with_ranks(scored, F.col("n_words") >= min_words, percent)
