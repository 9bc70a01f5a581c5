"""Passages that a later document shares with an earlier one, found by alignment and deleted.

A line ends at a line break or after a sentence mark with white space behind it, so that a passage
set into another paragraph shares lines too. Lines are compared without surrounding white space, by
an 80-bit hash and their number of words; scripts without spaces are counted by characters. From
each line on, and up to each line, the shortest run of lines with ``min_block_words`` words is a key,
however short its lines are. It depends on nothing outside the run, so it is the same in all
documents that hold the run. A later holder of a key is paired with the first one, which holds the
whole run: runs inside a shared passage cover it, so whatever is to go is in some pair. A key that
very many documents hold costs one pair for each of them, never their square, so no frequency is cut
off and nothing is missed for being common.
Each pair is aligned by patience diff: lines that are unique in both documents, in the longest
increasing order, then the gaps between them in the same way; where a gap has no unique line, its
rarest common one is taken. Runs of aligned neighbouring lines with ``min_block_words`` words or
more are deleted from the later document. Alignment goes on with what is left until it finds
nothing more, so that moved and repeated blocks go as well, and runs that stay out of order beside
longer chains of single lines are looked up in the end. Every deleted block stays in an earlier
document: the first holder of a line never loses it to another.

Earlier is the smaller doc_id. Defined results: rows without doc_id have no place in the order and
stay as they are; rows that repeat an id are one document and are not compared with each other;
null texts stay null, and a document that loses all its lines keeps its row with an empty text;
other columns are kept; an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.common import cut

MIN_BLOCK_WORDS = 30
SALTS = 32
FIRST_SALTS = 16

Pair = tuple[int, int]


def _increasing(pairs: list[Pair]) -> list[Pair]:
    """The longest run of pairs, sorted by their first number, whose second number increases."""
    tails: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for k, (_, b) in enumerate(pairs):
        place = bisect_left(tails, b)
        before.append(at[place - 1] if place else -1)
        if place == len(tails):
            tails.append(b)
            at.append(k)
        else:
            tails[place], at[place] = b, k
    chain = []
    k = at[-1] if at else -1
    while k >= 0:
        chain.append(pairs[k])
        k = before[k]
    return chain[::-1]


def _anchors(a: list, b: list, a0: int, a1: int, b0: int, b1: int) -> list[Pair]:
    """Matches inside two ranges: lines unique in both in increasing order, else the rarest line."""
    count_a, count_b = Counter(a[a0:a1]), Counter(b[b0:b1])
    common = count_a.keys() & count_b.keys()
    if not common:
        return []
    unique = {x for x in common if count_a[x] == 1 == count_b[x]}
    if unique:
        place = {b[j]: j for j in range(b0, b1) if b[j] in unique}
        return _increasing([(i, place[a[i]]) for i in range(a0, a1) if a[i] in unique])
    first_a, first_b = {}, {}
    for i in range(a0, a1):
        first_a.setdefault(a[i], i)
    for j in range(b0, b1):
        first_b.setdefault(b[j], j)
    rarest = min(common, key=lambda x: (count_a[x] * count_b[x], first_a[x]))
    return [(first_a[rarest], first_b[rarest])]


def patience(a: list, b: list) -> list[Pair]:
    """Positions (i, j) of aligned equal lines, increasing in both."""
    matched: list[Pair] = []
    ranges = [(0, len(a), 0, len(b))]
    while ranges:
        a0, a1, b0, b1 = ranges.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            matched.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            matched.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        i0, j0 = a0, b0
        anchors = _anchors(a, b, a0, a1, b0, b1)
        for i, j in anchors:
            matched.append((i, j))
            ranges.append((i0, i, j0, j))
            i0, j0 = i + 1, j + 1
        if anchors:
            ranges.append((i0, a1, j0, b1))
    return sorted(matched)


def shared_blocks(later: list, words: list[int], earlier: list, min_words: int) -> list[int]:
    """Line numbers of ``later`` in aligned blocks of at least ``min_words`` words."""
    held = set(earlier)
    if sum(n for x, n in zip(later, words, strict=True) if x in held) < min_words:
        return []
    left = [k for k, x in enumerate(later) if x in held]
    gone: list[int] = []
    while left:
        found: list[int] = []
        block: list[int] = []
        previous = (-2, -2)
        aligned = [(left[i], j) for i, j in patience([later[k] for k in left], earlier)]
        for pair in [*aligned, (-9, -9)]:
            if pair != (previous[0] + 1, previous[1] + 1):
                if sum(words[k] for k in block) >= min_words:
                    found += block
                block = []
            block.append(pair[0])
            previous = pair
        if not found:
            break
        gone += found
        out = set(found)
        left = [k for k in left if k not in out]
    return sorted({*gone, *_crossing(later, words, left, earlier, min_words)})


def _crossing(
    later: list, words: list[int], left: list[int], earlier: list, min_words: int
) -> list[int]:
    """Lines of the shortest runs of ``min_words`` words with a line that is left, held anywhere."""
    if not any(words[k] for k in left):
        return []
    still, held = set(left), {}
    gone: list[int] = []
    for i, j in zip(*(x.tolist() for x in run_bounds(np.array(words), min_words)), strict=True):
        if still.isdisjoint(range(i, j)):
            continue
        n = j - i
        if n not in held:
            held[n] = {tuple(earlier[p : p + n]) for p in range(len(earlier) - n + 1)}
        if tuple(later[i:j]) in held[n]:
            gone += range(i, j)
    return gone


SENTENCE_END = re.compile(r"[.!?…。！？]+[^\S\n]+")


def segments(text: str) -> list[list[str]]:
    """The lines of each row of a text, with the white space behind them."""
    rows = []
    for row in text.split("\n"):
        at, lines = 0, []
        for end in SENTENCE_END.finditer(row):
            lines.append(row[at : end.end()])
            at = end.end()
        if at < len(row) or not lines:
            lines.append(row[at:])
        rows.append(lines)
    return rows


def without(text: str, gone: list[int]) -> str:
    """The text without some of its lines; a row that loses all its lines goes as a whole."""
    lost, number, kept = set(gone), 0, []
    for lines in segments(text):
        left = [x for k, x in enumerate(lines, number) if k not in lost]
        number += len(lines)
        if len(left) == len(lines):
            kept.append("".join(left))
        elif left:
            kept.append("".join(left).rstrip() if number - 1 in lost else "".join(left))
    return "\n".join(kept)


#: Signs of scripts without spaces: Han and kana, a word each, and Thai, Lao, Burmese and Khmer,
#: whose words have about four.
SPACELESS = re.compile(
    r"([\u3040-\u30ff\u31f0-\u31ff\u3400-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff])"
    r"|[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff]{1,4}"
)


def count_words(line: str) -> int:
    """The number of words; signs of scripts without spaces part the words around them."""
    if line.isascii():
        return len(line.split())
    rest, signs = SPACELESS.subn(" ", line)
    return len(rest.split()) + signs


def run_bounds(
    counts: np.ndarray, least: int, sizes: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """First and behind-last lines of the shortest runs of ``least`` words from and up to each line.

    ``sizes`` are the numbers of lines of texts laid end to end; a run lies within one text. Every run
    of so many words is the union of those inside it, but for empty lines around it.
    """
    sizes = np.array([len(counts)]) if sizes is None else sizes
    last = np.repeat(np.cumsum(sizes), sizes)
    first = last - np.repeat(sizes, sizes)
    total = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    own = np.flatnonzero(counts)
    start = own[total[own] + least <= total[last[own]]]
    end = own[total[own + 1] - least >= total[first[own]]] + 1
    starts = np.concatenate([start, np.searchsorted(total, total[end] - least, "right") - 1])
    ends = np.concatenate([np.searchsorted(total, total[start] + least), end])
    size = len(counts) + 1
    both = np.unique(starts * size + ends)
    return both // size, both % size


#: An odd number has an inverse modulo 2**64, so the hash of a run follows from those of two prefixes.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)


def _powers(base: int, number: int) -> np.ndarray:
    out = np.full(number, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def run_keys(keys: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Signed 64-bit hashes of the shortest runs of lines with ``least`` words, each once a text.

    Returns the hashes and the number of the text of each. A run hashes to the sum of its lines'
    hashes times powers of BASE, in the arithmetic of 64 bits, mixed in the end; runs of other lines
    that meet cost an alignment that finds nothing.
    """
    lines = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, 12)
    counts = lines[:, 10:].copy().view("<u2").reshape(-1).astype(np.int64)
    sizes = np.array([len(k) // 12 for k in keys], dtype=np.int64)
    starts, ends = run_bounds(counts, least, sizes)
    hashes = lines[:, :8].copy().view("<u8").reshape(-1)
    prefix = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * _powers(BASE, len(hashes)), dtype=np.uint64, out=prefix[1:])
    found = (prefix[ends] - prefix[starts]) * _powers(INVERSE, len(hashes) + 1)[starts]
    found ^= (ends - starts).astype(np.uint64) << np.uint64(48)
    found ^= found >> np.uint64(31)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    found ^= found >> np.uint64(29)
    owners = np.repeat(np.arange(len(keys)), sizes)[starts] if len(starts) else starts
    order = np.lexsort((found, owners))
    found, owners = found[order], owners[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owners[1:] != owners[:-1])
    return found[new].view(np.int64), owners[new]


NUMBERS = [k.to_bytes(2, "little") for k in range(65_536)]


def line_keys(text: str) -> bytes:
    """Ten bytes of hash and two of the number of words (65535 for more) of each line."""
    from xxhash import xxh3_128_digest

    out = []
    for lines in segments(text):
        for line in lines:
            out.append(xxh3_128_digest(line.strip().encode("utf-8", "replace"))[:10])
            out.append(NUMBERS[min(count_words(line), 65_535)])
    return b"".join(out)


def _unpacked(keys: bytes) -> tuple[list[bytes], list[int]]:
    counts = np.frombuffer(keys, np.uint8).reshape(-1, 12)[:, 10:].copy().view("<u2").reshape(-1)
    return [keys[k : k + 12] for k in range(0, len(keys), 12)], counts.tolist()


def _free_name(taken: list[str], stem: str) -> str:
    name, k = stem, 0
    while name.lower() in {c.lower() for c in taken}:
        name, k = f"{stem}{k}", k + 1
    return name


def removed_lines(docs: DataFrame, *, min_block_words: int = MIN_BLOCK_WORDS) -> DataFrame:
    """(doc_id, version, gone) of documents that lose lines: a hash of the text, line numbers."""
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).where("doc_id is not null and text is not null")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                keys = [line_keys(t.as_py()) for t in part.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("version"), pa.array(keys, pa.binary())],
                    names=["doc_id", "version", "keys"],
                )

    documents = cut(
        source.select("doc_id", F.xxhash64("text").alias("version"), "text").mapInArrow(
            hashed, "doc_id long, version long, keys binary"
        )
    )

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found, owners = run_keys(part.column("keys").to_pylist(), min_block_words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), part.column("doc_id").take(pa.array(owners))],
                    names=["key", "doc_id"],
                )

    distinctive = documents.select("doc_id", "keys").mapInArrow(runs, "key long, doc_id long")
    holders = (
        distinctive.groupBy("key")
        .agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
        .where("first_id < last_id")
        .select("key", "first_id")
    )
    # Only shared runs have holders, so copying these rows for each salt is cheap, and it deals
    # the holders of one very common run out to many tasks.
    salted = holders.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    pairs = cut(
        distinctive.withColumn("salt", salt)
        .join(salted, ["key", "salt"])
        .where(F.col("doc_id") > F.col("first_id"))
        .select("doc_id", "first_id")
        .distinct()
    )
    involved = pairs.select("doc_id").union(pairs.select("first_id")).distinct()
    sequences = (
        documents.join(involved, "doc_id", "left_semi")
        .groupBy("doc_id", "version")
        .agg(F.first("keys").alias("keys"))
    )
    # The later holders of one very popular document are dealt out to many tasks in the same way;
    # a first document has as many copies as its pairs have salts, one for most.
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(FIRST_SALTS)).cast("int")
    dealt = pairs.withColumn("salt", salt)
    first = dealt.select("first_id", "salt").distinct().join(
        sequences.select(F.col("doc_id").alias("first_id"), F.col("keys").alias("first_keys")), "first_id"
    )
    both = dealt.join(sequences, "doc_id").join(first, ["first_id", "salt"])

    def align(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            gone = []
            for own, earlier in zip(frame["keys"], frame["first_keys"], strict=True):
                lines, words = _unpacked(bytes(own))
                gone.append(shared_blocks(lines, words, _unpacked(bytes(earlier))[0], min_block_words))
            out = frame[["doc_id", "version"]].assign(gone=gone)
            yield out[out["gone"].map(len) > 0]

    found = both.select("doc_id", "version", "keys", "first_keys").mapInPandas(
        align, "doc_id long, version long, gone array<int>"
    )
    return found.groupBy("doc_id", "version").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone")
    )


def drop_shared_passages(
    docs: DataFrame,
    *,
    min_block_words: int = MIN_BLOCK_WORDS,
    removed: str | None = None,
) -> DataFrame:
    """The documents without the passages they share with earlier ones, with all their columns.

    ``removed`` names a column for the numbers of the deleted lines, from 0.
    """
    gone = removed_lines(docs, min_block_words=min_block_words)
    key, version, lost = (_free_name(docs.columns, s) for s in ("_key", "_version", "_lost"))
    joined = docs.withColumns(
        {key: F.col("doc_id").cast("long"), version: F.xxhash64(F.col("text").cast("string"))}
    ).join(
        gone.select(
            F.col("doc_id").alias(key), F.col("version").alias(version), F.col("gone").alias(lost)
        ),
        [key, version],
        "left",
    )

    @F.pandas_udf(T.StringType())
    def shortened(texts: pd.Series, gone: pd.Series) -> pd.Series:
        return pd.Series(
            [None if t is None else without(t, g) for t, g in zip(texts, gone, strict=True)],
            dtype=object,
        )

    # Texts that lose nothing are not sent to Python.
    changed = F.when(F.col(lost).isNotNull(), F.col("text").cast("string"))
    columns = {
        "text": F.when(F.col(lost).isNull(), F.col("text")).otherwise(
            shortened(changed, F.col(lost))
        )
    }
    if removed:
        columns[removed] = F.coalesce(F.col(lost), F.array().cast("array<int>"))
    return joined.withColumns(columns).drop(key, version, lost)
