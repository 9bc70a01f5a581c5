"""Near-duplicate documents by SimHash, with neighbours found in BK-trees.

A text is lower-cased (A-Z), split at ASCII white space and cut into word shingles. A bit of its
fingerprint is set if it is set in over half of the shingles' XXH64. Texts link if their
fingerprints differ in at most ``radius`` bits, and the class of a text is everything reachable.

Search works on distinct fingerprints. Their 64 bits are split into blocks, two or more beyond the
radius only when there are very many fingerprints: two within the radius agree on all but
``radius`` blocks, so a shard per choice of agreeing blocks and their value brings every such pair
together at least once. Each shard gets a BK-tree, in which a child hangs from its parent by their
integer Hamming distance; a query at distance d from a node follows only the edges from d - radius
to d + radius. The shard's tree is shared by all queries of the shard. A shard beyond
``shard_limit`` fingerprints is dealt in parts, and the tree of each part is sent to the queries
of each other part, so that no task holds more than two parts and no pair is lost. A task reduces
what it finds to one link per fingerprint and shard, so a ball of near copies never becomes all
its pairs. Links meet in a star contraction (``components.roots``).

Defined results: no words, as in null or empty texts, is fingerprint zero, linked like any other;
fewer words than a shingle are one shingle; rows that repeat share a class; the class is
the smallest non-null doc_id, null if there is none; other columns are kept (``keep_one``) or
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.common import cut
from marketlake.llm.components import roots

SHINGLE = 4
SEED = 42
RADIUS = 4
SHARD_LIMIT = 32_768
CHUNK = 2_000_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text as a signed 64-bit number."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1]).tolist()
        ends = ends.tolist()
        hashes = [
            xxh64_intdigest(joined[s:e], SEED)
            for s, e in zip(starts, ends[shingle - 1 :], strict=False)
        ]
    # Bit n of the number is bit n % 8 of byte n // 8 in this order.
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(bits), 255):
        counts += bits[at : at + 255].sum(axis=0, dtype=np.uint8)
    set_bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, name: str, shingle: int = SHINGLE) -> DataFrame:
    """The rows with their fingerprint in the new column ``name``, in the scan's own stage."""

    @F.pandas_udf(T.LongType())
    def of_text(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.withColumn(name, of_text(F.col("text").cast("string")))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --- BK-trees -------------------------------------------------------------------------


def build_trees(fps: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """BK-trees of all shards at once, one level after another.

    ``shard`` numbers the tree of each fingerprint; fingerprints are distinct within a shard.
    Gives the root of each shard, and edges sorted by parent and distance: their keys
    (parent * 128 + distance) and children.
    """
    place = np.arange(len(fps))
    group = shard.astype(np.int64)
    parent_of_group = None
    keys, children, tree_roots = [], [], None
    while len(place):
        order = np.argsort(group, kind="stable")
        place, group = place[order], group[order]
        first = np.concatenate([[True], group[1:] != group[:-1]])
        leaders, index = place[first], np.cumsum(first) - 1
        if parent_of_group is None:
            tree_roots = leaders
        else:
            keys.append(group[first])
            children.append(leaders)
        rest = ~first
        place, above = place[rest], leaders[index[rest]]
        distance = np.bitwise_count(fps[place] ^ fps[above]).astype(np.int64)
        group = above * 128 + distance
        parent_of_group = above
    if not keys:
        return tree_roots, np.empty(0, np.int64), np.empty(0, np.int64)
    keys, children = np.concatenate(keys), np.concatenate(children)
    order = np.argsort(keys)
    return tree_roots, keys[order], children[order]


def search_trees(
    fps: np.ndarray,
    trees: tuple[np.ndarray, np.ndarray, np.ndarray],
    queries: np.ndarray,
    at: np.ndarray,
    radius: int,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, found) arrays: nodes within the radius of each query, searched from node ``at``.

    All queries go down together; a frontier beyond CHUNK visits is worked off in halves.
    """
    _, keys, children = trees
    stack = [(queries, at)]
    while stack:
        query, node = stack.pop()
        if len(query) > CHUNK:
            half = len(query) // 2
            stack += [(query[:half], node[:half]), (query[half:], node[half:])]
            continue
        distance = np.bitwise_count(fps[query] ^ fps[node]).astype(np.int64)
        near = distance <= radius
        if near.any():
            yield query[near], node[near]
        low = np.searchsorted(keys, node * 128 + np.maximum(distance - radius, 0))
        high = np.searchsorted(keys, node * 128 + distance + radius, "right")
        count = high - low
        if total := int(count.sum()):
            edge = np.arange(total) - np.repeat(np.cumsum(count) - count - low, count)
            stack.append((np.repeat(query, count), children[edge]))


def contract(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest number linked with each of ``n`` numbers."""
    label = np.arange(n)
    for a, b in pairs:
        while True:
            x, y = label[a], label[b]
            differ = x != y
            if not differ.any():
                break
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while (label[label] != label).any():
                label = label[label]
    return label


def shard_links(fps: np.ndarray, shard: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join, within each shard, all fingerprints joined by steps within the radius.

    ``shard`` is sorted. A fingerprint is linked with the first of its part, in place of all pairs.
    """
    _, number, sizes = np.unique(shard, return_inverse=True, return_counts=True)
    many = sizes[number] > 1
    fps, number = fps[many], number[many]
    if not len(fps):
        return fps, fps
    _, number = np.unique(number, return_inverse=True)
    trees = build_trees(fps, number)
    everyone = np.arange(len(fps))
    label = contract(
        len(fps), search_trees(fps, trees, everyone, trees[0][number], radius)
    )
    moved = label != everyone
    return fps[moved], fps[label[moved]]


# --- distributed search ---------------------------------------------------------------


def _blocks(distinct: int, radius: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of the blocks; more of them, and longer keys, for more fingerprints."""
    count = radius + (1 if distinct <= 2**20 else 2 if distinct <= 2**26 else 3)
    count = min(count, 64)
    bounds = [64 * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(bounds, bounds[1:], strict=False)]


def _block(fp: Column, block: tuple[int, int]) -> Column:
    low, width = block
    mask = (1 << width) - 1
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit(mask if mask < 2**63 else -1))


def neighbours(fps: DataFrame, radius: int = RADIUS, shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints of column fp as all pairs within the
    radius would."""
    blocks = _blocks(fps.count(), radius)
    choices = list(combinations(blocks, len(blocks) - radius))
    fp = F.col("fp")
    shards = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(k).alias("choice"),
                    F.xxhash64(F.lit(k), *[_block(fp, b) for b in choice]).alias("key"),
                )
                for k, choice in enumerate(choices)
            ]
        )
    )
    rows = fps.select("fp", shards.alias("s")).select("fp", "s.key")
    # Only a block value that many share can make a shard large; values are few, so counting them
    # is one small combined aggregate.
    heavy = (
        fps.select(
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(k).alias("n"), _block(fp, b).alias("v"))
                        for k, b in enumerate(blocks)
                    ]
                )
            ).alias("s")
        )
        .groupBy("s")
        .count()
        .agg(F.max("count"))
        .first()[0]
        or 0
    )
    if heavy > shard_limit:
        parts = (
            rows.groupBy("key")
            .count()
            .where(F.col("count") > shard_limit)
            .select("key", F.ceil(F.col("count") / (shard_limit // 2)).cast("int").alias("parts"))
        )
        own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("parts")).cast("int")
        rows = (
            rows.join(parts, "key", "left")
            .withColumn("parts", F.coalesce("parts", F.lit(1)))
            .withColumn("own", own)
            # With one part, one copy; else one for each other part it is searched with.
            .withColumn(
                "other",
                F.explode(
                    F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(
                        F.filter(
                            F.sequence(F.lit(0), F.col("parts") - 1), lambda k: k != F.col("own")
                        )
                    )
                ),
            )
            .select(
                "fp",
                F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"),
            )
        )

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for frame in frames:
            if kept is not None:
                frame = pd.concat([kept, frame], ignore_index=True)
            shard = frame["key"].to_numpy()
            # The last shard of a batch may go on in the next one.
            done = int(np.searchsorted(shard, shard[-1])) if len(shard) else 0
            kept = frame.iloc[done:]
            yield from _linked(frame.iloc[:done], radius)
        if kept is not None:
            yield from _linked(kept, radius)

    dealt = rows.repartition("key").sortWithinPartitions("key", "fp")
    return dealt.mapInPandas(search, "a long, b long")


def _linked(frame: pd.DataFrame, radius: int) -> Iterator[pd.DataFrame]:
    if len(frame):
        # Unsigned, because numpy counts the bits of a signed number's magnitude.
        fps = frame["fp"].to_numpy().astype("int64").view("uint64")
        a, b = shard_links(fps, frame["key"].to_numpy(), radius)
        yield pd.DataFrame({"a": a.view("int64"), "b": b.view("int64")})


def near_duplicates(
    docs: DataFrame,
    *,
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    shard_limit: int = SHARD_LIMIT,
) -> DataFrame:
    """One row per document: doc_id, fp (signed) and component_id."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    prints = cut(with_fingerprint(source, "fp", shingle).select("doc_id", "fp"))
    return prints.join(classes(prints, radius, shard_limit), "fp", "left").select(
        "doc_id", "fp", "component_id"
    )


def classes(prints: DataFrame, radius: int, shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """(fp, component_id) of the distinct fingerprints in (doc_id, fp)."""
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    root_of = roots(neighbours(distinct.select("fp"), radius, shard_limit))
    rooted = distinct.join(root_of, distinct["fp"] == root_of["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.select("fp", "root").join(ids, "root").select("fp", "component_id")


def keep_one(
    docs: DataFrame,
    *,
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    shard_limit: int = SHARD_LIMIT,
) -> DataFrame:
    """The documents that name their class, with all their columns.

    Of rows that repeat an id all stay, as do rows of classes without any id.
    """
    classified = near_duplicates(docs, shingle=shingle, radius=radius, shard_limit=shard_limit)
    names = iter(f"_id{k}" for k in range(len(docs.columns) + 1))
    name = next(n for n in names if n not in docs.columns)
    gone = (
        classified.where(~F.col("doc_id").eqNullSafe(F.col("component_id")))
        .where(F.col("component_id").isNotNull())
        .select(F.coalesce("doc_id", F.lit(None)).alias(name))
        .where(F.col(name).isNotNull())
        .distinct()
    )
    return docs.join(gone, docs["doc_id"] == gone[name], "left_anti")
