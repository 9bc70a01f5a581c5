"""Document fingerprints from Lempel-Ziv phrases.

A text is lower-cased (A-Z), split at ASCII white space (words of over 32 bytes, as in scripts
without spaces, into characters) and parsed from left to right into dictionary phrases: each phrase
is the shortest run of words not parsed before in this text. Texts that compress each other well
share phrases. The phrase set is hashed, and the fingerprint has the smallest value of each of 128
hash functions, 16 bits of it. The share of equal places estimates the share of common phrases.

For comparing every document with the next one and with an edit of the two, documents are dealt
into ranges of doc_id by one shuffle, a task each, and sorted there, so that neighbours meet in a task; the first
document of the next range is sent along. Range bounds and first ids are the only rows that the
driver sees, one per range.

Defined results: a null text is empty; an empty text has no phrases and is like an empty text (1)
and unlike others (0); a null doc_id is below all numbers; rows that repeat an id follow one
another by a hash of the text; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLACES = 128
SEED = 1234567
LONGEST_WORD = 32
RANGE_ROWS = 10_000

_rng = np.random.default_rng(SEED)
MULTIPLY = _rng.integers(0, 2**63, PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _rng.integers(0, 2**64, PLACES, dtype=np.uint64)
NOTHING = np.full(PLACES, 0xFFFF, np.uint16)

SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def words_of(text: str) -> list[bytes]:
    words = text.encode("utf-8", "replace").lower().split()
    if words and max(map(len, words)) > LONGEST_WORD:
        split: list[bytes] = []
        for word in words:
            if len(word) > LONGEST_WORD:
                split += [c.encode() for c in word.decode("utf-8")]
            else:
                split.append(word)
        return split
    return words


def phrases(words: list[bytes]) -> set[bytes]:
    """The dictionary of the parse; the last phrase may be one parsed before."""
    seen: set[bytes] = set()
    add = seen.add
    phrase = b""
    for word in words:
        phrase = phrase + b" " + word if phrase else word
        if phrase not in seen:
            add(phrase)
            phrase = b""
    return seen


def signature(text: str) -> np.ndarray:
    """The smallest hashes of the phrase set, as 128 numbers of 16 bits."""
    from xxhash import xxh64_intdigest

    found = phrases(words_of(text))
    if not found:
        return NOTHING
    hashes = np.fromiter(map(xxh64_intdigest, found), np.uint64, len(found))
    least = np.full(PLACES, 2**64 - 1, np.uint64)
    for at in range(0, len(hashes), 2048):
        mixed = hashes[at : at + 2048, None] * MULTIPLY + ADD
        np.minimum(least, mixed.min(axis=0), out=least)
    # The low bits of the product are poor, and the highest are near 0 in a minimum.
    return ((least >> np.uint64(20)) & np.uint64(0xFFFF)).astype(np.uint16)


def as_text(places: np.ndarray) -> str:
    return places.astype(">u2").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u2").astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row, in the scan's own stage."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [as_text(signature(t or "")) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(prints, pa.string())],
                names=["doc_id", "fingerprint"],
            )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(scan, "doc_id long, fingerprint string")


def edited_text(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of range and place; rows marked as tail only follow the last of a range."""
    waiting, where, ended = None, None, False
    for batch in batches:
        out: list[tuple] = []
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            for number, tail, doc_id, text in zip(
                *(part.column(c).to_pylist() for c in ("part", "tail", "doc_id", "text")),
                strict=True,
            ):
                if number != where:
                    waiting, where, ended = None, number, False
                if ended:
                    continue
                places = signature(text)
                if waiting is not None:
                    own_id, own_text, own = waiting
                    edited = edited_text(own_text, text)
                    changed = signature(edited)
                    out.append(
                        (
                            own_id,
                            len(own_text),
                            hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(),
                            as_text(own),
                            as_text(changed),
                            likeness(own, changed),
                            likeness(own, places),
                        )
                    )
                waiting, ended = (doc_id, text, places), bool(tail)
        if out:
            types = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                names=[c.split()[0] for c in SCHEMA.split(", ")],
            )


def compare_with_next(docs: DataFrame, *, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Each document against the next in descending doc_id (after the last: the first) and
    against its edit with that one."""
    spark = docs.sparkSession
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        key.alias("key"),
    )
    keys = docs.select(key.alias("key"))
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), keys.count() // range_rows)
    cuts = keys.stat.approxQuantile("key", [k / ranges for k in range(1, ranges)], 0.1 / ranges)
    bounds = sorted({int(c) for c in cuts})
    edges = np.array(bounds, np.int64)

    @F.pandas_udf(T.IntegerType())
    def number_of(key: pd.Series) -> pd.Series:
        """The number of bounds at or below the key."""
        return pd.Series(np.searchsorted(edges, key.to_numpy(np.int64), "right"))

    rows = keys.groupBy(number_of("key").alias("part")).agg(F.max("key").alias("first")).collect()
    order = sorted((r["part"] for r in rows), reverse=True)
    first = np.full(len(bounds) + 1, -(2**63), np.int64)
    first[[r["part"] for r in rows]] = [r["first"] for r in rows]
    # The first document of a range also follows the last one of the range before.
    before = np.full(len(bounds) + 1, -1, np.int64)
    before[order] = [order[k - 1] for k in range(len(order))]

    @F.pandas_udf("part int, sent int")
    def place_of(key: pd.Series) -> pd.DataFrame:
        values = key.to_numpy(np.int64)
        part = np.searchsorted(edges, values, "right")
        return pd.DataFrame(
            {"part": part, "sent": np.where(values == first[part], before[part], -1)}
        ).astype("int32")

    own = F.struct(F.col("place.part").alias("part"), F.lit(0).alias("tail"))
    sent = F.struct(F.col("place.sent").alias("part"), F.lit(1).alias("tail"))
    copies = F.when(F.col("place.sent") >= 0, F.array(own, sent)).otherwise(F.array(own))
    dealt = (
        source.withColumn("place", place_of("key"))
        .withColumn("copy", F.explode(copies))
        .select("copy.part", "copy.tail", "key", "doc_id", "text")
        .repartitionById(len(bounds) + 1, "part")
        .sortWithinPartitions("part", "tail", F.desc("key"), F.xxhash64("text"))
        .select("part", "tail", "doc_id", "text")
    )
    return dealt.mapInArrow(_compare, SCHEMA)
