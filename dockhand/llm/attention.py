"""A small causal self-attention model over subword ids, in numpy.

The next subword is predicted in two steps: its class from the context, then the subword within
its class by counts of the whole training corpus.  Class scores are the log of the smoothed
class bigram (also counted over the whole corpus) plus what one attention head adds from up to 31
earlier subwords.  The head (queries, keys, values by subword, output, relative positions) is
trained with Adam from gradients summed over all parts of the corpus (scoring.py).

Positions go in blocks of BLOCK; a block's keys are its own and those of the block before, so
windows overlap by half and each position is scored once, under a mask that keeps out later
positions and other texts.  Blocks begin with their text, so a score does not depend on what else
is in a batch.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np

from dockhand.llm.words import ranges

BLOCK = 16
DIM = 16
CLASSES = 64
OWN_CLASSES = 56  # of the most frequent subwords; the others share the rest in bands of equal mass
ROWS, SHARED_ROWS = 2048, 64  # input rows; rarer subwords share some
_CHUNK = 128  # blocks at once, so that what is made of them stays in the processor's cache
_GROUP = 512  # blocks whose gradients are added up by row at once
_FAR = np.float32(-1e9)
_ONES = np.ones((max(CLASSES, 2 * BLOCK), 1), np.float32)  # products with it are the faster sums
_LARGEST = 40.0  # of the head's scores; exp(2 * 40) is a single-precision number
HEAD = ("q", "k", "v", "out", "near")  # what is trained; all else are counts


@dataclass
class Layout:
    """How subwords map to input rows and classes."""

    row: np.ndarray
    cls: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Layout:
        """From the counts of all training texts."""
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(counts), np.int64)
        rank[order] = np.arange(len(counts))
        own = ROWS - SHARED_ROWS
        row = np.where(rank < own, rank, own + np.arange(len(counts)) % SHARED_ROWS)
        rest = counts[order][OWN_CLASSES:] + 1e-3
        band = np.minimum(np.cumsum(rest) / rest.sum() * (CLASSES - OWN_CLASSES), CLASSES - OWN_CLASSES - 1)
        klass = np.empty(len(counts), np.int64)
        klass[order[:OWN_CLASSES]] = np.arange(min(OWN_CLASSES, len(counts)))
        klass[order[OWN_CLASSES:]] = OWN_CLASSES + band.astype(np.int64)
        return cls(row.astype(np.int32), klass.astype(np.int32))


@dataclass
class Model:
    layout: Layout
    within: np.ndarray  # log probability of each subword in its class
    bigram: np.ndarray  # rows x classes, log probabilities
    q: np.ndarray
    k: np.ndarray
    v: np.ndarray
    out: np.ndarray
    near: np.ndarray  # by distance, 0 to 2 * BLOCK - 1

    @classmethod
    def start(cls, layout: Layout, tokens: np.ndarray, pairs: np.ndarray, seed: int) -> Model:
        """From counts of subwords and of (row, class) pairs; the head adds nothing yet."""
        smooth = tokens + 0.1
        within = np.log(smooth) - np.log(np.bincount(layout.cls, smooth, CLASSES))[layout.cls]
        share = (pairs.sum(0) + 0.5) / (pairs.sum() + 0.5 * CLASSES)
        bigram = np.log(pairs + 5 * share) - np.log(pairs.sum(1, keepdims=True) + 5)
        rng = np.random.default_rng(seed)
        table = lambda scale: rng.normal(0, scale, (ROWS, DIM)).astype(np.float32)
        return cls(layout, within, bigram.astype(np.float32), table(0.3), table(0.3), table(0.3), np.zeros((DIM, CLASSES), np.float32), np.zeros(2 * BLOCK, np.float32))

    def _bias(self) -> np.ndarray:
        distance = np.arange(BLOCK)[:, None] + BLOCK - np.arange(2 * BLOCK)[None, :]
        bias = np.where(distance >= 0, self.near[np.maximum(distance, 0)], _FAR).astype(np.float32)
        return np.append(bias.reshape(-1), np.full(BLOCK, _FAR))

    def _tables(self) -> np.ndarray:
        """Queries (scaled), keys and values side by side."""
        return np.concatenate([self.q * np.float32(DIM**-0.5), self.k, self.v], 1)

    @staticmethod
    def _attend(tables: np.ndarray, bias: np.ndarray, rows: np.ndarray, first: np.ndarray, weights: _Wide):
        """Queries, keys and values side by side, weights that don't add up to 1 yet, their sums, and
        the output of all blocks but the first, which is there for the next one to look at.

        Scores are bounded (see settle), so their exponentials need no shift by the maximum."""
        found = np.take(tables, rows, axis=0)
        n = len(found) - 1
        a, flat = weights.blocks[:n], weights.flat[:n]
        np.matmul(found[1:, :, :DIM], _across(found, DIM), out=a)
        flat += bias
        np.exp(flat, out=flat)
        a[first, :, :BLOCK] = 0  # no look at another text
        total = a @ _ONES[: 2 * BLOCK]
        o = a @ _pairs(found, 2 * DIM)
        o /= total
        return found, a, total, o

    def log_probabilities(self, x: np.ndarray, y: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Natural logarithm of each target's probability, 0 where the target is -1.

        x, y: blocks x BLOCK subwords and their successors; first: whether a block begins a text."""
        out = np.zeros(x.shape, np.float64)
        rows = self.layout.row[np.concatenate([x[:1], x])]
        tables, bias, share, room = self._tables(), self._bias(), np.exp(self.bigram), _Room()
        for low in range(0, len(x), _CHUNK):
            part = slice(low, low + _CHUNK)
            n = len(y[part])
            o = self._attend(tables, bias, rows[low : low + n + 1], first[part], room.weights)[-1]
            h = np.matmul(o, self.out, out=room.classes[:n]).reshape(-1, CLASSES)
            row, target = rows[low + 1 : low + n + 1].reshape(-1), np.maximum(y[part], 0).reshape(-1)
            klass = self.layout.cls[target]
            picked = np.take(h, room.places[: len(h)] + klass) + np.take(self.bigram, row * CLASSES + klass)
            np.exp(h, out=h)
            sums = np.einsum("nc,nc->n", h, np.take(share, row, axis=0, out=room.shares[: len(h)], mode="clip"))
            found = picked - np.log(sums) + np.take(self.within, target)
            out[part] = found.reshape(-1, BLOCK)
        out[y < 0] = 0
        return out

    def head(self) -> np.ndarray:
        """The trained parameters as one vector."""
        return np.concatenate([getattr(self, n).reshape(-1) for n in HEAD])

    def with_head(self, values: np.ndarray) -> Model:
        """The same model with other trained parameters."""
        new, at = {}, 0
        for n in HEAD:
            old = getattr(self, n)
            new[n] = values[at : at + old.size].reshape(old.shape).astype(np.float32)
            at += old.size
        return replace(self, **new).settle()

    def settle(self) -> Model:
        """Bounds the head so that exponentials of its scores fit into single precision."""
        longest = lambda table: float(np.sqrt((table**2).sum(1)).max())
        scores = longest(self.q) * longest(self.k) * DIM**-0.5 + float(np.abs(self.near).max())
        classes = float((np.abs(self.v) @ np.abs(self.out)).max())
        for bound, names in ((scores, ("q", "near")), (classes, ("out",))):
            for n in names if bound > _LARGEST else ():
                setattr(self, n, getattr(self, n) * np.float32(_LARGEST / bound))
        return self

    def gradient(self, x: np.ndarray, before: np.ndarray | None, y: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, int]:
        """Of the cross entropy of the classes, summed over all targets, as a vector like head();
        and the number of targets.  before: the block before each one; None: the one in front of it in x."""
        if before is not None:
            x, y = np.stack([before, x], 1).reshape(-1, BLOCK), np.stack([np.full_like(y, -1), y], 1).reshape(-1, BLOCK)
            first = np.stack([np.ones_like(first), first], 1).reshape(-1)
        rows = self.layout.row[np.concatenate([x[:1], x])]
        made = self._tables(), self._bias(), np.exp(self.bigram), _Room()
        d_tables, d_out, d_bias = np.zeros((ROWS, 3 * DIM)), np.zeros((DIM, CLASSES)), np.zeros((BLOCK, 2 * BLOCK))
        d_found = np.empty((_GROUP + -(-_GROUP // _CHUNK), BLOCK, 3 * DIM), np.float32)
        for low in range(0, len(x), _GROUP):
            at, places = 0, []
            for begin in range(low, min(low + _GROUP, len(x)), _CHUNK):
                end = min(begin + _CHUNK, low + _GROUP, len(x))
                places.append(rows[begin : end + 1])  # the block in front takes part in each chunk
                found = self._gradients(*made, places[-1], y[begin:end], first[begin:end], d_found[at : at + end - begin + 1])
                at += end - begin + 1
                d_out += found[0]
                d_bias += found[1]
            _add_rows(d_tables, np.concatenate(places).reshape(-1), d_found[:at].reshape(-1, 3 * DIM))
        distance = np.arange(BLOCK)[:, None] + BLOCK - np.arange(2 * BLOCK)[None, :]
        seen = distance >= 0
        d_near = np.bincount(distance[seen], d_bias[seen], 2 * BLOCK)
        d_q, d_k, d_v = d_tables[:, :DIM] * DIM**-0.5, d_tables[:, DIM : 2 * DIM], d_tables[:, 2 * DIM :]
        found = {"q": d_q, "k": d_k, "v": d_v, "out": d_out, "near": d_near}
        return np.concatenate([found[n].reshape(-1) for n in HEAD]), int((y >= 0).sum())

    def _gradients(self, tables, bias, share, room: _Room, rows: np.ndarray, y: np.ndarray, first: np.ndarray, d_found: np.ndarray):
        """Of out and of the scores by place; those of queries, keys and values go to d_found.

        With z the exponentials, Z their sum and t the target, the gradient of a position's class
        scores is z / Z - t; Z goes to the narrow side of the products, and so do the sums of weights."""
        n = len(y)
        made, a, total, o = self._attend(tables, bias, rows, first, room.weights)
        by_block = np.matmul(o, self.out, out=room.classes[:n])
        z = by_block.reshape(-1, CLASSES)
        np.exp(z, out=z)
        z *= np.take(share, rows[1:].reshape(-1), axis=0, out=room.shares[: len(z)], mode="clip")
        sums, target = z @ _ONES[:CLASSES], self.layout.cls[np.maximum(y, 0).reshape(-1)]
        z.reshape(-1)[room.places[: len(z)] + target] -= sums[:, 0]
        weight = (y >= 0)[:, :, None] / sums.reshape(n, BLOCK, 1)
        d_out = ((o * weight).transpose(0, 2, 1) @ by_block).sum(0)
        d_o = room.outputs[1 : n + 1]
        np.matmul(z, self.out.T, out=d_o.reshape(-1, DIM))
        d_o *= weight / total
        own = np.einsum("nd,nd->n", d_o.reshape(-1, DIM), o.reshape(-1, DIM)).reshape(n, BLOCK, 1)
        room.outputs[n + 1] = 0
        np.matmul(room.weights.by_key(n), _pairs(room.outputs[: n + 2]), out=d_found[:, :, 2 * DIM :])
        d_s = d_o @ _across(made, 2 * DIM)
        d_s -= own
        d_a = np.multiply(a, d_s, out=room.slopes.blocks[:n])
        room.queries[1 : n + 1], room.queries[n + 1] = made[1:, :, :DIM], 0
        np.matmul(room.slopes.by_key(n), _pairs(room.queries[: n + 2]), out=d_found[:, :, DIM : 2 * DIM])
        d_found[0, :, :DIM] = 0
        np.matmul(d_a, _pairs(made, DIM), out=d_found[1:, :, :DIM])
        return d_out, room.slopes.flat[:n].sum(0)[: 2 * BLOCK * BLOCK].reshape(BLOCK, -1)


def _pairs(blocks: np.ndarray, column: int = 0) -> np.ndarray:
    """A view of each block but the first together with the one before it, in DIM columns."""
    return np.ndarray((len(blocks) - 1, 2 * BLOCK, DIM), np.float32, blocks, 4 * column, blocks.strides)


def _across(blocks: np.ndarray, column: int) -> np.ndarray:
    """The same with rows and columns exchanged; products with it are much faster than with a transposed view."""
    copy = np.ascontiguousarray(blocks[:, :, column : column + DIM].transpose(2, 0, 1))
    return np.ndarray((len(blocks) - 1, DIM, 2 * BLOCK), np.float32, copy, 0, (4 * BLOCK, copy.strides[0], 4))


class _Wide:
    """Values of queries x keys for each block of a chunk.

    A block is BLOCK values longer than it need be, so that by_key sees those of each key, in its
    own block and in the next one, at one distance.  flat has these, too: numpy is slower with gaps."""

    def __init__(self) -> None:
        size = 2 * BLOCK * BLOCK + BLOCK
        self._room = np.zeros((_CHUNK + 2, size), np.float32)  # a block of zeros in front, and one behind
        self.flat = self._room[1:]
        self.blocks = self.flat[:, :-BLOCK].reshape(-1, BLOCK, 2 * BLOCK)  # a view
        self._by_key = np.ndarray((_CHUNK + 1, BLOCK, 2 * BLOCK), np.float32, self._room, 4 * BLOCK, (4 * size, 4, 8 * BLOCK))

    def by_key(self, n: int) -> np.ndarray:
        """For the block in front and n blocks: its keys x queries of the block and the next one."""
        self.flat[n] = 0
        return self._by_key[: n + 1]


class _Room:
    """Memory for what a chunk needs, used over and over."""

    def __init__(self) -> None:
        self.places = np.arange(_CHUNK * BLOCK) * CLASSES
        self.classes, self.shares = np.empty((_CHUNK, BLOCK, CLASSES), np.float32), np.empty((_CHUNK * BLOCK, CLASSES), np.float32)
        self.outputs, self.queries = (np.zeros((_CHUNK + 2, BLOCK, DIM), np.float32) for _ in range(2))
        self.weights, self.slopes = _Wide(), _Wide()


class Adam:
    """Few large steps: short memories, and a rate that falls to nothing."""

    def __init__(self, steps: int, rate: float = 0.2) -> None:
        self.steps, self.rate, self.done = steps, rate, 0
        self.mean = self.square = 0.0

    def step(self, model: Model, gradient: np.ndarray) -> Model:
        rate = self.rate * min(1, 2 * (1 - self.done / self.steps))
        self.done += 1
        self.mean = 0.7 * self.mean + 0.3 * gradient
        self.square = 0.9 * self.square + 0.1 * gradient**2
        change = self.mean / (1 - 0.7**self.done) / (np.sqrt(self.square / (1 - 0.9**self.done)) + 1e-8)
        return model.with_head(model.head() - rate * change)


def _add_rows(total: np.ndarray, place: np.ndarray, found: np.ndarray) -> None:
    """Adds gradients of table rows to the totals."""
    order = np.argsort(place.astype(np.uint16), kind="stable")  # ROWS is less, and short numbers sort faster
    rows = place[order]
    heads = np.flatnonzero(np.diff(rows, prepend=-1))
    pairs = np.take(found, order, axis=0).view(np.complex64)  # two columns are added up as one
    total[rows[heads]] += np.add.reduceat(pairs, heads).view(np.float32)


def blocked(tokens: np.ndarray, counts: np.ndarray, boundary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts of counts[i] subwords as blocks: inputs (a boundary first), targets (a boundary last,
    -1 beyond), which blocks begin a text, and the first block of each text (one more for the end)."""
    n = -(-(counts + 1) // BLOCK)
    starts = np.concatenate([[0], np.cumsum(n)])
    begin, end = starts[:-1] * BLOCK, starts[:-1] * BLOCK + counts + 1
    beyond = ranges(end, starts[1:] * BLOCK - end)
    filled = np.ones(starts[-1] * BLOCK, bool)
    filled[begin] = filled[beyond] = False
    x = np.full(len(filled), boundary, np.int32)
    x[filled] = tokens
    y = np.full(len(filled), boundary, np.int32)
    y[:-1] = x[1:]
    y[beyond] = -1
    first = np.zeros(starts[-1], bool)
    first[starts[:-1]] = True
    return x.reshape(-1, BLOCK), y.reshape(-1, BLOCK), first, starts
