"""Scores of documents under a causal self-attention model over subword ids.

The model (``attention``) is trained here, on all training documents, by Spark: ids, their frequent
neighbours (which give the classes of ids), pairs of frequent ids, and classes of ids after an id are
counted over all of them. The attention itself is fitted by gradient descent to all their windows, in
rounds: each task starts from the weights of the round, fits them to the windows of its part, and says
how far each row of weights moved and at how many places it was met; the moves' mean by these numbers
is the next round's start. Each window is met in one round; those of a small corpus in each of two or three.
Texts are encoded once; their ids are kept in the shared folder and read again for counting, fitting
and scoring. Every task scores whole texts in overlapping windows.

The base score adds up smoothed word counts. A text is split into words once, when it is encoded: its
words of the head, at most ``common_words`` that are frequent in a sixteenth of the training texts, are
kept as numbers, whose counts go to the tasks as a table of that bounded size; its other words are kept
as they are and meet their counts in one shuffle by word. All counts cover all training texts, so which
words are in the head changes the cost and no result.

Defined results: a null or empty text is its end alone; a null id counts as empty text for the
held-out rule; rows that repeat are scored each; without training documents ids are equally likely
and the base score is 0; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from hashlib import sha1
from math import log10

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm import attention
from marketlake.llm.attention import CLASSES, COMMON, GROUP_IDS, PAIRED, STRIDE, TABLE_ROWS
from marketlake.llm.common import bucket_of, cut, stored
from marketlake.llm.packing import text_groups
from marketlake.llm.word_ids import drop_numbers, encoder, numbers

COMMON_WORDS = 100_000
#: Windows are met in so many rounds; fewer windows than SMALL are met two or three times, as more would be
#: learned by heart. A task has at least TASK_WINDOWS in a round, as means of shorter ways lead less far.
ROUNDS, SMALL, TASK_WINDOWS = 4, 150_000, 65_536
#: Sums travel in blocks of so many numbers.
BLOCK = 4096
FLUSH_WORDS = 200_000
BATCH_TEXTS = 500
BEGIN, END, IDS = 49_406, 49_407, 49_408

#: The head is chosen from so much of the training texts.
HEAD_SHARE = 1 / 16

ENCODED = (
    "row_id long, doc_id long, held_out boolean, n_tokens long, head binary, "
    "rare array<struct<word: binary, n: int>>, ids binary"
)
FACTS = "row_id", "doc_id", "held_out", "n_tokens"
RARE = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32())]))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").lower().split()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) of all words of the texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())],
                names=["word", "c"],
            )
            held.clear()
            return batch

        for batch in batches:
            for text in batch.column("text"):
                held.update(words_of(text.as_py() or ""))
                if len(held) >= FLUSH_WORDS:
                    yield rows()
        if held:
            yield rows()

    partial = texts.select("text").mapInArrow(count, "word binary, c long")
    return partial.groupBy("word").agg(F.sum("c").alias("c"))


def _head(texts: DataFrame, most: int) -> list[bytes]:
    """The most frequent words, ``most`` of them or fewer, of a share of the texts.

    Words are counted by the size of their count, in steps of a 16th power of two; as many of
    the highest steps as fit are taken. A sort with a limit would send that many words of every
    task to the driver.
    """
    counts = cut(word_counts(texts.where(F.rand(11) < HEAD_SHARE)))
    step = F.floor(F.log2("c") * 16).cast("int")
    taken, lowest = 0, None
    for r in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        taken += r["count"]
        if taken > most:
            break
        lowest = r["step"]
    if lowest is None:
        return []
    rows = counts.where(step >= lowest).toPandas().sort_values(["c", "word"], ascending=[False, True])
    return [bytes(w) for w in rows["word"]]


def _number_type(head: Sequence[bytes]) -> str:
    return "<u2" if len(head) <= 2**16 else "<u4"


def _encode(source: DataFrame, tokenizer_path: str, head: list[bytes]) -> DataFrame:
    """Each text's ids, the numbers of its words of the head, and its other words with their counts."""
    key, number_type = sha1(b" ".join(head)).hexdigest(), _number_type(head)
    held = source.sparkSession.sparkContext.broadcast(head)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = numbers(tokenizer_path, key, held.value)
        row_id = TaskContext.get().partitionId() << 40
        for batch in batches:
            flags, done = batch.column("held_out"), 0
            for doc_ids, texts in text_groups([batch], BATCH_TEXTS):
                lists = [words_of(text) for text in texts]
                sizes = np.array([len(words) for words in lists])
                own = known.of([word for words in lists for word in words])
                pieces = list(map(known.ids.__getitem__, own.tolist()))
                ends = np.cumsum(sizes)
                ids = [b"".join(pieces[end - n : end]) for end, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                for k, text in enumerate(texts):
                    if known.encoder.holds_special(text):
                        ids[k] = np.frombuffer(known.encoder.whole(text), "<u4").astype("<u2").tobytes()
                text_of = np.repeat(np.arange(len(texts)), sizes)
                common = own < len(head)
                heads = np.split(
                    own[common].astype(number_type),
                    np.cumsum(np.bincount(text_of[common], minlength=len(texts)))[:-1],
                )
                pairs, times = np.unique(text_of[~common] << 32 | own[~common], return_counts=True)
                rare = pa.StructArray.from_arrays(
                    [
                        pa.array([known.words[k] for k in (pairs & 2**32 - 1).tolist()], pa.binary()),
                        pa.array(times, pa.int32()),
                    ],
                    fields=list(RARE.value_type),
                )
                places = np.searchsorted(pairs, np.arange(len(texts) + 1) << 32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row_id, row_id + len(texts))),
                        pa.array(doc_ids, pa.int64()),
                        pa.array(flags.slice(done, len(texts)).to_pylist(), pa.bool_()),
                        pa.array(sizes + 1, pa.int64()),
                        pa.array([x.tobytes() for x in heads], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(places, pa.int32()), rare).cast(RARE),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["row_id", "doc_id", "held_out", "n_tokens", "head", "rare", "ids"],
                )
                row_id += len(texts)
                done += len(texts)
                known.forget()

    return source.mapInArrow(scan, ENCODED)


def _head_counts(training: DataFrame, head: list[bytes]) -> np.ndarray:
    number_type = _number_type(head)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_numbers()
        counts = np.zeros(len(head), np.int64)
        for batch in batches:
            for part in batch.column("head"):
                counts += np.bincount(np.frombuffer(part.as_buffer(), number_type), minlength=len(head))
        yield from _in_blocks(counts, EXACT)

    size = len(head)
    return _summed(training.select("head").mapInArrow(count, BLOCKS), size, EXACT)


def _rare_sums(encoded: DataFrame) -> DataFrame:
    """By text: n_rare and rare_sum, the number of its words beyond the head that training knows and the sum of
    log10(c + 1) over them; and ``kinds``, whose sum is the number of such words in training."""
    rows = encoded.select("row_id", "held_out", F.inline("rare"))
    same = Window.partitionBy("word")
    learnt = F.sum(F.when(F.col("held_out"), 0).otherwise(F.col("n"))).over(same)
    first = F.row_number().over(same.orderBy("row_id")) == 1
    counted = rows.select("row_id", "n", learnt.alias("c"), first.alias("first")).where("c > 0")
    return counted.groupBy("row_id").agg(
        F.sum("n").alias("n_rare"),
        F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("rare_sum"),
        F.sum(F.col("first").cast("long")).alias("kinds"),
    )


def _texts(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), "<u2").astype(np.int64) for x in batch.column("ids")]


#: 24 bits are more than the model can tell apart. Counts of words are exact.
SHORT, EXACT = "<f4", "<i8"


def _in_blocks(values: np.ndarray, kind: str = SHORT) -> Iterator[pa.RecordBatch]:
    """Blocks of a flat array with the places and values of their numbers other than 0."""
    for at in range(0, len(values), 256 * BLOCK):
        part = values[at : at + 256 * BLOCK]
        there = np.flatnonzero(part)
        blocks, starts, sizes = np.unique(there // BLOCK, return_index=True, return_counts=True)
        own = [slice(a, a + n) for a, n in zip(starts, sizes, strict=True)]
        places = (there % BLOCK).astype("<u2")
        numbers = part[there].astype(kind)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(blocks + at // BLOCK, pa.int32()),
                pa.array([places[x].tobytes() for x in own], pa.binary()),
                pa.array([numbers[x].tobytes() for x in own], pa.binary()),
            ],
            names=["block", "places", "numbers"],
        )


BLOCKS = "block int, places binary, numbers binary"


def _summed(frame: DataFrame, size: int, kind: str = SHORT) -> np.ndarray:
    """The sum of flat arrays of that size, from their blocks."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in range(3))
            for block, places, numbers in zip(*columns, strict=True):
                if block not in sums:
                    sums[block] = np.zeros(BLOCK, np.float64 if kind == SHORT else kind)
                sums[block][np.frombuffer(places, "<u2")] += np.frombuffer(numbers, kind)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(sums), pa.int32()),
                pa.array([x.astype(kind).tobytes() for x in sums.values()], pa.binary()),
            ],
            names=["block", "numbers"],
        )

    out = np.zeros((-(-size // BLOCK), BLOCK), kind)
    sums = frame.repartition("block").mapInArrow(add, "block int, numbers binary")
    for batch in sums.toArrow().to_batches():
        for block, numbers in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            out[block] = np.frombuffer(numbers.as_buffer(), kind)
    return out.reshape(-1)[:size]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The ids of texts, about GROUP_IDS at a time."""
    drop_numbers()
    group, held = [], 0
    for batch in batches:
        for ids in batch.column("ids"):
            group.append(np.frombuffer(ids.as_buffer(), "<u2").astype(np.int64))
            held += len(group[-1])
            if held >= GROUP_IDS:
                yield group
                group, held = [], 0
    if group:
        yield group


def _id_counts(training: DataFrame) -> np.ndarray:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(IDS, np.int64)
        for batch in batches:
            texts = _texts(batch)
            if texts:
                counts += np.bincount(np.concatenate(texts), minlength=IDS)
                counts[END] += len(texts)
        yield from _in_blocks(counts)

    return _summed(training.select("ids").mapInArrow(count, BLOCKS), IDS).astype(float)


def _neighbours(training: DataFrame, counts: np.ndarray) -> np.ndarray:
    """The features of each id: its common neighbours, over all texts."""
    slot = attention.common_slots(counts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = np.zeros((3, IDS + 1, COMMON), np.uint32)
        for texts in _groups(batches):
            attention.neighbours([np.concatenate([[BEGIN], t, [END]]) for t in texts], slot, near)
        yield from _in_blocks(near.reshape(-1))

    sums = _summed(training.select("ids").mapInArrow(count, BLOCKS), 3 * (IDS + 1) * COMMON)
    return attention.features(sums.reshape(3, IDS + 1, COMMON))


def _pair_counts(training: DataFrame, row_of: np.ndarray, class_of: np.ndarray, slot: np.ndarray):
    """Counts of classes after table rows, of frequent ids and of classes after frequent ids."""
    rows_end, pairs_end = TABLE_ROWS * CLASSES, TABLE_ROWS * CLASSES + PAIRED * PAIRED

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(pairs_end + PAIRED * CLASSES, np.int64)
        for texts in _groups(batches):
            before = np.concatenate([x for t in texts for x in ([BEGIN], t)])
            after = np.concatenate([x for t in texts for x in (t, [END])])
            classes = class_of[after]
            a, b = slot[before].astype(np.int64), slot[after]
            there = a >= 0
            both = there & (b >= 0)
            for keys in (
                row_of[before] * np.int64(CLASSES) + classes,
                rows_end + a[both] * PAIRED + b[both],
                pairs_end + a[there] * CLASSES + classes[there],
            ):
                np.add.at(counts, keys, np.int64(1))
        yield from _in_blocks(counts)

    counts = _summed(
        training.select("ids").mapInArrow(count, BLOCKS),
        pairs_end + PAIRED * CLASSES,
    )
    return (
        counts[:rows_end].reshape(-1, CLASSES).astype(float),
        counts[rows_end:pairs_end].reshape(-1, PAIRED),
        counts[pairs_end:].reshape(-1, CLASSES).astype(float),
    )


def _round(
    training: DataFrame, model: Broadcast, weights: np.ndarray, number: int, rounds: int, expected: float
) -> np.ndarray:
    """The weights after a pass of all tasks over their windows of ``training``."""
    start = training.sparkSession.sparkContext.broadcast(weights)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = attention.Fit(model.value, start.value)
        rng = np.random.default_rng([number, TaskContext.get().partitionId()])
        for texts in _groups(batches):
            own.see(texts, rng, number / rounds, 1 / rounds, expected)
        moved = (own.weights - start.value) * own.seen[:, None]
        yield from _in_blocks(np.column_stack([own.seen, moved]).reshape(-1))

    rows, width = weights.shape
    sums = _summed(training.select("ids").mapInArrow(fit, BLOCKS), rows * (width + 1))
    start.destroy()
    sums = sums.reshape(rows, width + 1)
    return weights + sums[:, 1:] / np.maximum(sums[:, :1], 1)


def _fitted(training: DataFrame, model: attention.Model, total: float) -> attention.Model:
    """The model with its attention fitted to all windows of ``training``, which has so many ids."""
    spark = training.sparkSession
    windows = total / STRIDE
    passes = int(min(3, max(1, -(-SMALL // max(1, windows)))))
    rounds, parts = (passes, 1) if passes > 1 else (ROUNDS, ROUNDS)
    split = training.rdd.getNumPartitions()
    tasks = int(max(1, min(split, windows / parts // TASK_WINDOWS)))
    part = F.pmod(F.xxhash64("row_id"), F.lit(parts))
    held = spark.sparkContext.broadcast(model)
    weights = attention.weights_of(model)
    for number in range(rounds):
        own = training.where(part == number % parts)
        own = own if tasks == split else own.coalesce(tasks)
        weights = _round(own, held, weights, number, rounds, windows / parts / tasks)
    held.destroy()
    return attention.with_weights(model, weights)


def learn(encoded: DataFrame, tokenizer_path: str, sample_windows: int | None = None) -> attention.Model:
    """The model of the rows of ``encoded`` that are not held out."""
    training = encoded.where("not held_out")
    counts = _id_counts(training)
    ends_word = encoder(tokenizer_path).ends_word[:IDS]
    class_of = attention.classes_of(_neighbours(training, counts), counts, ends_word)
    row_of = attention.rows_of(counts, class_of)
    by_row, by_pair, by_class = _pair_counts(training, row_of, class_of, attention.frequent(counts))
    shares = attention.shares_from(counts, class_of, by_pair, by_class)
    model = attention.initial(row_of, class_of, shares, by_row, BEGIN, END)
    total = counts.sum()
    if sample_windows is not None and sample_windows * STRIDE < total:
        share = sample_windows * STRIDE / total
        training = training.where(F.pmod(F.xxhash64("row_id", F.lit(1)), F.lit(2**20)) < share * 2**20)
        total *= share
    return _fitted(training, model, total)


def score_documents(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    modulus: int = 7,
    held_out: int = 2,
    common_words: int = COMMON_WORDS,
    sample_windows: int | None = None,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    The attention is fitted to all training documents; ``sample_windows``, for trials, leaves it
    documents of about so many windows. All counts cover everything either way.
    """
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).withColumn("held_out", bucket_of(F.col("doc_id"), modulus) == held_out)
    head = _head(source.where("not held_out"), common_words)
    encoded = stored(_encode(source, tokenizer_path, head))
    training = encoded.where("not held_out")
    counts = _head_counts(training, head)
    rare = cut(_rare_sums(encoded))
    # Every text has an end, which is a token.
    tokens, ends = training.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.count(F.lit(1))).first()
    kinds = (rare.agg(F.sum("kinds")).first()[0] or 0) + int((counts > 0).sum()) + (ends > 0)
    model = learn(encoded, tokenizer_path, sample_windows)
    held = docs.sparkSession.sparkContext.broadcast((model, np.log10(counts + 1.0), counts > 0))
    number_type = _number_type(head)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_numbers()
        model, value, known = held.value
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_TEXTS):
                part = batch.slice(at, BATCH_TEXTS)
                words = [np.frombuffer(x.as_buffer(), number_type) for x in part.column("head")]
                text_of = np.repeat(np.arange(len(words)), [len(x) for x in words])
                words = np.concatenate(words)
                sums = np.bincount(text_of, value[words], len(part)) + log10(ends + 1)
                n_known = np.bincount(text_of[known[words]], minlength=len(part)) + (ends > 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in FACTS),
                        pa.array(n_known, pa.int64()),
                        pa.array(sums, pa.float64()),
                        pa.array(model.score(_texts(part)), pa.float64()),
                    ],
                    names=[*FACTS, "n_common", "common_sum", "score"],
                )

    scored = encoded.select(*FACTS, "head", "ids").mapInArrow(
        score,
        "row_id long, doc_id long, held_out boolean, n_tokens long, n_common long, "
        "common_sum double, score double",
    )
    base = (
        F.col("common_sum")
        + F.coalesce("rare_sum", F.lit(0.0))
        - F.col("n_tokens") * F.lit(log10(tokens + kinds + 1))
    )
    return scored.join(rare, "row_id", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_common") + F.coalesce("n_rare", F.lit(0))).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
    )
