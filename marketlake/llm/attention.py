"""A small causal self-attention model over subword ids, trained and run in numpy.

The input id gives a query, a key and a value; the last 17 to 32 inputs are attended with a learned
bias by distance. The probability of the next id is that of its class, from the logits
``B[input] + context @ U``, times its share of the class after this input. ``B`` is the class bigram
of all training documents and the shares come from their counts of id pairs (smoothed towards the
ids' own counts); queries, keys, values, ``U`` and the distance bias are trained by gradient descent
on windows (``Fit``), of which any number of workers take their own and send how far each weight
moved. Positive weights come from
phi(x) = max(1 + x / 8, 0.05) ** 8, close to the exponential and a few multiplications in numpy.

Windows overlap: the inputs of a text stand in blocks of 16; each block is the queries of one
window whose keys are the block before and itself, so every id is scored exactly once. A batch of
windows goes through masked matrix products at once.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

import numpy as np
from numpy.lib.stride_tricks import as_strided

STRIDE, WINDOW = 16, 32
WIDTH = 16
CLASSES = 64
ROWS = 8192
LEAST = 0.05
#: Pairs of the most frequent ids have shares of their own, with so much weight on the ids' counts.
PAIRED = 2048
PAIR_PRIOR = 5.0
CHUNK = 256

#: A step of training takes BATCH windows, in runs of RUN neighbours that share their blocks; PIECE of them
#: at a time stay in the processor's cache. Texts of about GROUP_IDS ids are mixed.
BATCH, RUN, PIECE = 512, 16, 64
GROUP_IDS = 500_000
RATE, LEAST_PACE, WARM_STEPS = 0.05, 0.05, 30

#: Classes look at the COMMON most frequent ids up to NEAR places away.
COMMON, NEAR = 64, 8

#: Key k of query q is visible if it is not later; both count within the window.
CAUSAL = (np.arange(WINDOW)[None, :] <= STRIDE + np.arange(STRIDE)[:, None]).astype(np.float32)
ONES, SEEN = np.ones(CLASSES, np.float32), np.ones(WINDOW, np.float32)
DISTANCE = np.clip(STRIDE + np.arange(STRIDE)[:, None] - np.arange(WINDOW)[None, :], 0, WINDOW - 1)


def eighth(y: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    out = np.multiply(y, y, out=out)
    np.multiply(out, out, out=out)
    return np.multiply(out, out, out=out)


def in_windows(a: np.ndarray) -> np.ndarray:
    """Windows of runs of blocks. The next block lies behind a block, so a window is a longer look at the
    same memory."""
    runs, blocks = a.shape[:2]
    return as_strided(a, (runs, blocks - 1, WINDOW, *a.shape[3:]), a.strides)


def hide(weight: np.ndarray, blocks: np.ndarray, nothing: int) -> None:
    """Sets weights of keys without an input to 0. Only blocks at the ends of a text, or between texts, have
    such places, and then the last one is such a place."""
    gaps = blocks[:, :, -1] == nothing
    run, block = np.nonzero(gaps[:, :-1] | gaps[:, 1:])
    if len(run):
        seen = np.concatenate([blocks[run, block], blocks[run, block + 1]], axis=1) != nothing
        weight[run, block] *= seen[:, None, :]


@dataclass
class Shares:
    """log10 of the share that an id has of its class, after an input id.

    ``slot`` numbers the PAIRED most frequent ids. ``pair`` is the share after a frequent input of a
    frequent id, ``rest`` that of the less frequent ids of a class together, of which each has
    ``log_part``; after other inputs it is ``log_share``.
    """

    slot: np.ndarray
    log_share: np.ndarray
    pair: np.ndarray
    rest: np.ndarray
    log_part: np.ndarray

    def of(self, inputs: np.ndarray, targets: np.ndarray, classes: np.ndarray) -> np.ndarray:
        a, b = self.slot[inputs], self.slot[targets]
        out = self.pair[np.maximum(a, 0), np.maximum(b, 0)]
        odd = np.flatnonzero((a < 0) | (b < 0))
        if len(odd):
            x, t = a[odd], targets[odd]
            out[odd] = np.where(
                x < 0, self.log_share[t], self.rest[np.maximum(x, 0), classes[odd]] + self.log_part[t]
            )
        return out


def frequent(counts: np.ndarray) -> np.ndarray:
    slot = np.full(len(counts), -1, np.int32)
    top = np.argsort(-counts, kind="stable")[:PAIRED]
    slot[top] = np.arange(len(top), dtype=np.int32)
    return slot


def shares_from(counts: np.ndarray, classes: np.ndarray, pairs: np.ndarray, by_class: np.ndarray) -> Shares:
    """``pairs`` counts frequent ids after frequent ids, ``by_class`` classes after frequent ids."""
    slot = frequent(counts)
    top = np.argsort(-counts, kind="stable")[:PAIRED]
    smooth = counts + 0.05
    share = smooth / np.bincount(classes, smooth, CLASSES)[classes]
    others = np.where(slot < 0, share, 0.0)
    left = np.bincount(classes, others, CLASSES)
    part = np.where(slot < 0, others / np.maximum(left, 1e-300)[classes], 1.0)
    own = np.zeros_like(by_class)
    for c in range(CLASSES):
        own[:, c] = pairs[:, classes[top] == c].sum(axis=1)
    room = by_class + PAIR_PRIOR
    pair = (pairs + PAIR_PRIOR * share[top]) / room[:, classes[top]]
    # Counts of less frequent ids, which none has if all ids are frequent.
    rest = (np.maximum(by_class - own, 0) + PAIR_PRIOR * left) / room
    return Shares(
        slot,
        np.log10(share).astype(np.float32),
        np.log10(pair).astype(np.float32),
        np.log10(np.maximum(rest, 1e-300)).astype(np.float32),
        np.log10(np.maximum(part, 1e-300)).astype(np.float32),
    )


@dataclass
class Model:
    """``row_of`` and ``class_of`` map ids; the last row of the tables stands for no input."""

    row_of: np.ndarray
    class_of: np.ndarray
    shares: Shares
    qkv: np.ndarray
    bigram: np.ndarray
    readout: np.ndarray
    bias: np.ndarray
    begin: int
    end: int

    def laid_out(self, texts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """Where each text starts, its number of blocks, and the blocks of all of them: table rows and
        ids of the inputs, and the targets. An empty block stands before each text and after the last."""
        counts = np.array([-(-(len(t) + 1) // STRIDE) for t in texts])
        first = np.concatenate([[0], np.cumsum(counts + 1)])
        inputs = np.full((first[-1] + 1, STRIDE), len(self.qkv) - 1, np.uint16)
        ids = np.full(inputs.shape, self.begin, np.int32)
        targets = np.full(inputs.shape, -1, np.int32)
        flat_in, flat_out, flat_ids = inputs.reshape(-1), targets.reshape(-1), ids.reshape(-1)
        for text, at in zip(texts, (first[:-1] + 1) * STRIDE, strict=True):
            n = len(text)
            flat_in[at] = self.row_of[self.begin]
            flat_in[at + 1 : at + 1 + n] = self.row_of[text]
            flat_ids[at + 1 : at + 1 + n] = text
            flat_out[at : at + n] = text
            flat_out[at + n] = self.end
        return first, counts, inputs, ids, targets

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """log10 of the probability of each text's ids and the end after them."""
        if not texts:
            return np.empty(0)
        first, counts, inputs, ids, targets = self.laid_out(texts)
        blocks = np.concatenate([np.arange(a + 1, a + 1 + n) for a, n in zip(first, counts, strict=False)])
        out = np.empty(len(blocks))
        scaled = self._scaled()
        for at in range(0, len(blocks), CHUNK):
            own = blocks[at : at + CHUNK]
            log_p = self._forward(inputs[own - 1], inputs[own], ids[own], targets[own], scaled)
            out[at : at + CHUNK] = log_p.sum(axis=1, dtype=np.float64)
        return np.add.reduceat(out, np.concatenate([[0], np.cumsum(counts)[:-1]]))

    def _scaled(self) -> tuple[np.ndarray, ...]:
        """The tables with 1 + x / 8 of phi worked in: queries, distance bias, readout, bigram."""
        qkv = self.qkv.copy()
        qkv[:, :WIDTH] *= 0.125
        one = np.float32(1.0)
        return qkv, self.bias * 0.125 + one, self.readout * 0.125, self.bigram * 0.125 + one

    def _forward(
        self,
        before: np.ndarray,
        own: np.ndarray,
        ids: np.ndarray,
        targets: np.ndarray,
        scaled: tuple[np.ndarray, ...] | None = None,
    ) -> np.ndarray:
        """log10 probabilities of the targets of a batch of windows; 0 where there is none."""
        qkv, bias, readout, bigram = scaled or self._scaled()
        keys = np.concatenate([before, own], axis=1)
        table = qkv.take(keys, axis=0)
        q, k, v = table[:, STRIDE:, :WIDTH], table[:, :, WIDTH : 2 * WIDTH], table[:, :, 2 * WIDTH :]
        y = np.matmul(q, k.transpose(0, 2, 1))
        y += bias
        weight = eighth(np.maximum(y, LEAST, out=y), y)
        weight *= CAUSAL
        # Only windows at the ends of a text have places without an input.
        unseen = keys == len(qkv) - 1
        partial = np.flatnonzero(unseen.any(axis=1))
        if len(partial):
            weight[partial] *= ~unseen[partial][:, None, :]
        context = np.matmul(weight, v)
        total = (weight @ SEEN)[:, :, None]
        # An input sees itself; only rows without input see nothing.
        context /= np.maximum(total, 1e-9)
        z = context.reshape(-1, WIDTH) @ readout
        z += bigram.take(own.reshape(-1), axis=0)
        p = eighth(np.maximum(z, LEAST, out=z), z)
        target = targets.reshape(-1)
        there = target >= 0
        target = np.where(there, target, 0)
        classes = self.class_of[target]
        chosen = p[np.arange(len(p)), classes]
        log_p = np.log10(chosen / (p @ ONES)) + self.shares.of(ids.reshape(-1), target, classes)
        return np.where(there, log_p, 0.0).reshape(targets.shape)


def windows(text: np.ndarray, begin: int, end: int) -> np.ndarray:
    """Rows of WINDOW inputs and STRIDE targets; -1 where there is none."""
    n = len(text)
    blocks = -(-(n + 1) // STRIDE)
    inputs = np.full((blocks + 1) * STRIDE, -1, np.int32)
    targets = np.full(blocks * STRIDE, -1, np.int32)
    inputs[STRIDE] = begin
    inputs[STRIDE + 1 : STRIDE + 1 + n] = text
    targets[:n] = text
    targets[n] = end
    by_block = inputs.reshape(-1, STRIDE)
    return np.concatenate([by_block[:-1], by_block[1:], targets.reshape(-1, STRIDE)], axis=1)


def common_slots(counts: np.ndarray) -> np.ndarray:
    """A number for each of the COMMON most frequent ids; -1 for others and for the gap after all ids."""
    slot = np.full(len(counts) + 1, -1, np.int64)
    top = np.argsort(-counts, kind="stable")[:COMMON]
    slot[top] = np.arange(len(top))
    return slot


def neighbours(texts: list[np.ndarray], slot: np.ndarray, out: np.ndarray) -> None:
    """Adds to ``out`` how often each id, and at the end the gap, has each common id just before it,
    just after it, and 2 to NEAR places away."""
    size = len(slot) - 1
    gap = np.full(NEAR, size, np.int64)
    line = np.concatenate([gap, *(x for t in texts for x in (t, gap))])
    place = np.flatnonzero(slot[line] >= 0)
    common = slot[line[place]]
    line *= COMMON
    for offset in range(-NEAR, NEAR + 1):
        if offset:
            kind = {1: 0, -1: 1}.get(offset, 2)
            np.add.at(out[kind].reshape(-1), line[place + offset] + common, out.dtype.type(1))


def features(near: np.ndarray) -> np.ndarray:
    """A row for each id of what ``neighbours`` counted; near are also those just before and after."""
    rows = np.concatenate(near[:, :-1], axis=1).astype(np.float32)
    rows[:, 2 * COMMON :] += rows[:, :COMMON]
    rows[:, 2 * COMMON :] += rows[:, COMMON : 2 * COMMON]
    return rows


def classify(sample: np.ndarray, counts: np.ndarray, ends_word: np.ndarray) -> np.ndarray:
    """Classes from the neighbours within the inputs of a set of windows."""
    inputs = sample[:, :WINDOW].astype(np.int64)
    near = np.zeros((3, len(counts) + 1, COMMON), np.uint32)
    neighbours([row[row >= 0] for row in inputs], common_slots(counts), near)
    return classes_of(features(near), counts, ends_word)


def classes_of(x: np.ndarray, counts: np.ndarray, ends_word: np.ndarray) -> np.ndarray:
    """A class for each id, by k-means on its ``features``."""
    size, common = len(counts), COMMON
    # Only ids that occur have a row of features.
    rows = np.flatnonzero((counts > 0) | x.any(axis=1))
    unseen = np.ones(size, bool)
    unseen[rows] = False
    x = x[rows]
    for kind in range(3):
        part = x[:, kind * common : (kind + 1) * common]
        part += 0.5 * part.sum(axis=0) / max(1.0, part.sum())
        part /= np.maximum(part.sum(axis=1, keepdims=True), 1e-12)
    np.sqrt(x, out=x)
    # Whether an id ends its word tells most about the next one.
    x = np.column_stack([x, 0.7 * ends_word[rows].astype(np.float32)])
    weight = np.sqrt(counts[rows] + 1e-9)
    label = (ends_word[:size] > 0).astype(np.int64)
    if len(rows) <= CLASSES:
        label[rows] = np.arange(len(rows)) % CLASSES
        return label
    start = np.argsort(-counts[rows], kind="stable")[: 8 * CLASSES]
    centres = [x[start[0]]]
    gap = ((x[start] - centres[0]) ** 2).sum(axis=1)
    for _ in range(CLASSES - 1):
        centres.append(x[start[int(np.argmax(gap * weight[start]))]])
        gap = np.minimum(gap, ((x[start] - centres[-1]) ** 2).sum(axis=1))
    centres = np.array(centres)
    for _ in range(12):
        d = (centres**2).sum(axis=1) - 2 * x @ centres.T
        own = d.argmin(axis=1)
        total = np.bincount(own, weight, CLASSES)
        for c in range(x.shape[1]):
            s = np.bincount(own, weight * x[:, c], CLASSES)
            centres[:, c] = np.where(total > 0, s / np.maximum(total, 1e-12), centres[:, c])
    label[rows] = own
    # An unseen id goes with most ids that end a word, or do not, as it does.
    for kind in (False, True):
        alike = rows[ends_word[rows] == kind]
        if len(alike):
            label[unseen & (ends_word[:size] == kind)] = np.bincount(label[alike]).argmax()
    return label


def rows_of(counts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The table row of each id: frequent ones have their own, the others share by class."""
    top = np.argsort(-counts, kind="stable")[:ROWS]
    row = ROWS + classes.astype(np.int32)
    row[top] = np.arange(len(top), dtype=np.int32)
    return row


TABLE_ROWS = ROWS + CLASSES


def bigram_logits(pairs: np.ndarray) -> np.ndarray:
    """Logits whose phi is the smoothed share of each class after each row, from counts."""
    overall = pairs.sum(axis=0) + 1.0
    overall /= overall.sum()
    share = (pairs + 4.0 * overall) / (pairs.sum(axis=1, keepdims=True) + 4.0)
    logits = 8.0 * (share**0.125 - 1.0)
    return np.vstack([logits, 8.0 * (overall**0.125 - 1.0)]).astype(np.float32)


class Fit:
    """Adam over the attention's weights; the bigram and the shares stay.

    All weights are rows of one table: those of the inputs, then the readout and the distance bias.
    ``seen`` counts the places where each row was trained. Rows that a step does not meet stay.
    """

    def __init__(self, model: Model, weights: np.ndarray | None = None):
        self.model = model
        self.weights = weights_of(model) if weights is None else weights.copy()
        self.first = np.zeros_like(self.weights)
        self.second = np.zeros_like(self.weights)
        self.seen = np.zeros(len(self.weights))
        self.moves, self.room = np.zeros(0, np.float32), {}
        self.steps = self.windows = 0
        self.bigram = model.bigram * np.float32(0.125) + np.float32(1.0)

    def see(self, texts: list[np.ndarray], rng: np.random.Generator, done: float, share: float, expected: float) -> None:
        """One pass over all windows of the texts.

        ``expected`` windows, as far as known beforehand, are the ``share`` of all training that
        follows ``done``; the pace falls with it.
        """
        *_, inputs, _, targets = self.model.laid_out(texts)
        classes = np.where(targets >= 0, self.model.class_of[targets], -1)
        short = -(len(inputs) - 1) % RUN
        inputs = np.pad(inputs, ((0, short), (0, 0)), constant_values=len(self.model.qkv) - 1)
        classes = np.pad(classes, ((0, short), (0, 0)), constant_values=-1)
        starts = rng.permutation(np.arange(0, len(inputs) - 1, RUN))
        for at in range(0, len(starts), BATCH // RUN):
            part = starts[at : at + BATCH // RUN, None]
            left = 1 - done - share * min(1.0, self.windows / max(1.0, expected))
            pace = RATE * min(1.0, (self.steps + 1) / WARM_STEPS) * max(LEAST_PACE, left)
            # A step of few windows is as small.
            pace *= len(part) * RUN / BATCH
            self.step(inputs[part + np.arange(RUN + 1)], classes[part + np.arange(1, RUN + 1)], pace)
            self.windows += len(part) * RUN

    def step(self, blocks: np.ndarray, classes: np.ndarray, pace: float) -> None:
        """One step on runs of neighbouring blocks of table rows; a run's first block has no targets.

        Places without an input are the last ones of their block."""
        split = len(self.model.qkv)
        if self.moves.shape[:-1] != blocks.shape:
            self.moves = np.zeros((*blocks.shape, 3 * WIDTH), np.float32)
        d_last = np.zeros((len(self.weights) - split, 3 * WIDTH), np.float32)
        targets = max(1, int((classes >= 0).sum()))
        piece = max(1, PIECE // classes.shape[1])
        for at in range(0, len(blocks), piece):
            own = slice(at, at + piece)
            self._gradients(blocks[own], classes[own], targets, self.moves[own], d_last.reshape(-1))
        keys = blocks.reshape(-1)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        # Two numbers are added at a time, as one complex number.
        moves = self.moves.reshape(-1, 3 * WIDTH).view(np.complex64).take(order, axis=0)
        sums = np.add.reduceat(moves, starts, axis=0).view(np.float32)
        rows, times = keys[starts].astype(np.int64), np.diff(np.append(starts, len(keys)))
        known = rows != split - 1
        rows = np.concatenate([rows[known], np.arange(split, len(self.weights))])
        self.seen[rows[: known.sum()]] += times[known]
        self.seen[split:] += targets
        g = np.concatenate([sums[known], d_last])
        self.steps += 1
        first, second = self.first[rows], self.second[rows]
        first += np.float32(0.1) * (g - first)
        second += np.float32(0.01) * (g * g - second)
        self.first[rows], self.second[rows] = first, second
        first *= np.float32(pace / (1 - 0.9**self.steps))
        second *= np.float32(1 / (1 - 0.99**self.steps))
        first /= np.sqrt(second, out=second) + np.float32(1e-8)
        self.weights[rows] -= first

    def _gradients(
        self, blocks: np.ndarray, classes: np.ndarray, targets: int, d_table: np.ndarray, d_last: np.ndarray
    ) -> None:
        """Sets the gradients of the inputs' rows and adds those of the readout and the bias."""
        qkv, readout, bias = parts_of(self.weights)
        runs, length = classes.shape[:2]
        eighth_of, one, least = np.float32(0.125), np.float32(1.0), np.float32(LEAST)
        table = qkv.take(blocks.reshape(-1), axis=0).reshape(*blocks.shape, 3 * WIDTH)
        q = table[:, 1:, :, :WIDTH]
        k, v = in_windows(table[..., WIDTH : 2 * WIDTH]), in_windows(table[..., 2 * WIDTH :])
        scores, s, weight, z, p = self._room(runs, length)
        s = np.matmul(q, k.swapaxes(2, 3), out=s)
        s *= eighth_of
        s += bias[DISTANCE] * eighth_of + one
        np.maximum(s, least, out=s)
        eighth(s, weight)
        weight *= CAUSAL
        hide(weight, blocks, len(qkv) - 1)
        # Weights are of any sum; what is made of them is divided by it.
        part = (one / np.maximum(weight @ SEEN, np.float32(1e-9)))[..., None]
        context = np.matmul(weight, v)
        context *= part
        flat = context.reshape(-1, WIDTH)
        self.bigram.take(blocks[:, 1:].reshape(-1), axis=0, out=z, mode="clip")
        z += np.matmul(flat, readout * eighth_of, out=p)
        np.maximum(z, least, out=z)
        eighth(z, p)
        total = p @ ONES
        # d log phi(x) / dx is 1 / (1 + x / 8), so that of a class's share has the seventh power. Where phi
        # is held at its least, that is as good as 0.
        d = np.divide(p, z, out=p)
        wanted = classes.reshape(-1)
        use = wanted >= 0
        each = use.astype(np.float32)
        each /= np.float32(targets) * total
        places = np.maximum(wanted, 0)
        places += np.arange(0, d.size, CLASSES)
        chosen = z.reshape(-1).take(places)
        total[chosen <= least] = 0
        total /= chosen
        d.reshape(-1)[places] -= total
        each = each[:, None]
        d_last[: readout.size] += ((flat * each).T @ d).reshape(-1)
        d_flat = d @ readout.T
        d_flat *= each
        inner = np.einsum("ij,ij->i", d_flat, flat).reshape(part.shape)
        d_context = d_flat.reshape(context.shape)
        d_context *= part
        inner *= part
        d_s = np.matmul(d_context, v.swapaxes(2, 3), out=scores)
        d_s -= inner
        d_s *= weight
        d_s /= s
        by_place = d_s.reshape(runs * length, -1).sum(axis=0)
        d_last[readout.size :] += np.bincount(DISTANCE.reshape(-1), by_place, WINDOW)
        np.matmul(d_s, k, out=d_table[:, 1:, :, :WIDTH])
        for at, weights, by in ((WIDTH, d_s, q), (2 * WIDTH, weight, d_context)):
            own = slice(at, at + WIDTH)
            np.matmul(weights[..., :STRIDE].swapaxes(2, 3), by, out=d_table[:, :-1, :, own])
            last = d_table[:, -1, :, own]
            last[...] = 0
            d_table[:, 1:, :, own] += np.matmul(weights[..., STRIDE:].swapaxes(2, 3), by)

    def _room(self, runs: int, length: int) -> list[np.ndarray]:
        """Arrays that are used again in each piece of the same size."""
        if (runs, length) not in self.room:
            shape, flat = (runs, length, STRIDE, WINDOW), (runs * length * STRIDE, CLASSES)
            self.room = {(runs, length): [np.empty(x, np.float32) for x in (shape, shape, shape, flat, flat)]}
        return self.room[runs, length]

    def fitted(self) -> Model:
        return with_weights(self.model, self.weights)


def weights_of(model: Model) -> np.ndarray:
    # The last query's distances to its keys are all there are, in falling order.
    last = np.concatenate([model.readout.reshape(-1), model.bias[-1, ::-1]])
    return np.concatenate([model.qkv, last.reshape(-1, 3 * WIDTH)]).astype(np.float32)


def parts_of(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the inputs, readout and bias by distance, as views."""
    rows = TABLE_ROWS + 1
    last = weights[rows:].reshape(-1)
    return weights[:rows], last[: WIDTH * CLASSES].reshape(WIDTH, CLASSES), last[WIDTH * CLASSES :]


def with_weights(model: Model, weights: np.ndarray) -> Model:
    qkv, readout, bias = parts_of(weights)
    return replace(model, qkv=qkv, readout=readout, bias=bias[DISTANCE])


def train(
    sample: np.ndarray,
    model: Model,
    *,
    most_steps: int = 700,
    epochs: float = 3.0,
    batch: int = 192,
    seed: int = 7,
) -> Model:
    """Fit to a set of windows in memory."""
    if not len(sample):
        return model
    steps = int(min(most_steps, max(50, epochs * len(sample) / batch)))
    rng = np.random.default_rng(seed)
    row_of = np.append(model.row_of, len(model.qkv) - 1).astype(np.uint16)
    blocks = row_of[sample[:, :WINDOW]].reshape(-1, 2, STRIDE)
    targets = sample[:, None, WINDOW:]
    classes = np.where(targets >= 0, model.class_of[targets], -1)
    fit = Fit(model)
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(sample), min(batch, len(sample)))
        fit.step(blocks[pick], classes[pick], RATE * min(1.0, step / WARM_STEPS) * (1 - step / (steps + 1)))
    return fit.fitted()


def initial(row_of: np.ndarray, class_of: np.ndarray, shares: Shares, pairs: np.ndarray, begin: int, end: int) -> Model:
    """The model before training; ``pairs`` counts classes after table rows."""
    rng = np.random.default_rng(11)
    qkv = rng.normal(0, 0.3, (TABLE_ROWS + 1, 3 * WIDTH)).astype(np.float32)
    qkv[-1] = 0
    bigram = bigram_logits(pairs)
    # A class without ids must not take probability.
    bigram[:, np.bincount(class_of, minlength=CLASSES) == 0] = -1000.0
    return Model(
        row_of=row_of,
        class_of=class_of.astype(np.int32),
        shares=shares,
        qkv=qkv,
        bigram=bigram,
        readout=rng.normal(0, 0.1, (WIDTH, CLASSES)).astype(np.float32),
        bias=np.zeros((STRIDE, WINDOW), np.float32),
        begin=begin,
        end=end,
    )
