"""A small causal self-attention language model over subword ids, in numpy.

One attention layer with a bias per distance, a residual embedding and a
rectifier predict the class of the next subword; a class holds its subwords
with fixed shares. Classes keep word starts and continuations apart. A text is
cut into blocks; a block's tokens attend to their own block, up to
themselves, and to the block before, so windows overlap and every token is
scored once. Blocks of many texts are attended to in batches under one mask.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

BLOCK, KEY, HIDDEN = 16, 16, 32
#: Rows of the embedding tables and classes; rarer subwords share their class's row.
ROWS, SINGLE, GROUPS = 3072, 40, 20
#: Hashed buckets of the ids near an id.
NEAR = 64
_BIG = np.float32(-1e9)
_BLOCKS_AT_ONCE = 64
#: Blocks a step of :meth:`Learner.learn` takes together; steps until its rate is reached.
_BLOCKS_A_STEP, _WARM = 512, 20


@dataclass(frozen=True)
class Vocabulary:
    """Subword ids by class and embedding row. Classes below ``starts`` begin words; class 0 ends a text."""

    cls: np.ndarray  # id -> class; the last id is the end of a text
    share: np.ndarray  # id -> natural log of its share of the class
    row: np.ndarray  # id -> embedding row
    starts: int
    classes: int

    @property
    def end(self) -> int:
        return len(self.cls) - 1


class Company:
    """How often every id occurs, and how often near ids of every hashed bucket; sums of parts are the whole's."""

    def __init__(self, size: int):
        self.count = np.zeros(size, np.int64)
        self.near = np.zeros(size * NEAR, np.int32)
        self.bucket = (np.arange(size) * 2654435761 % (1 << 32)) // ((1 << 32) // NEAR)

    def add(self, ids: np.ndarray, size: np.ndarray) -> None:
        """Texts of ``size`` ids laid end to end."""
        self.count += np.bincount(ids, minlength=len(self.count))
        row, bucket, text = ids * NEAR, self.bucket[ids], np.repeat(np.arange(len(size)), size)
        for step in (1, 2, 3, 4):
            same = text[:-step] == text[step:]
            for place in ((row[:-step] + bucket[step:])[same], (row[step:] + bucket[:-step])[same]):
                np.add.at(self.near, place, np.int32(1))


def build_vocabulary(streams: list[np.ndarray], is_start: np.ndarray) -> Vocabulary:
    """The vocabulary of texts given as id arrays."""
    met = Company(len(is_start))
    met.add(np.concatenate([*streams, np.empty(0, np.int64)]).astype(np.int64), np.array([len(s) for s in streams], np.int64))
    return vocabulary(met.count, met.near.reshape(-1, NEAR), len(streams), is_start)


def vocabulary(count: np.ndarray, near: np.ndarray, texts: int, is_start: np.ndarray) -> Vocabulary:
    """Classes from the counts of :class:`Company`: common subwords alone, others by their company.

    ``is_start`` tells for every id whether it begins a word. Ids are grouped
    by the ids that occur near them, by k-means, within either kind. Every id
    has a share, also those that do not occur.
    """
    size = len(is_start)
    count = count.astype(float)
    order = np.argsort(-count, kind="stable")
    place = np.full(size, -1)
    seen_ids = np.flatnonzero(count)
    place[seen_ids] = np.arange(len(seen_ids))
    company = near[seen_ids].astype(np.float32)
    company /= np.maximum(company.sum(axis=1, keepdims=True), 1.0)
    np.sqrt(company, out=company)
    cls = np.full(size + 1, -1)
    cls[size] = 0
    at = 1
    starts = 0
    rng = np.random.default_rng(7)
    for kind in (True, False):
        own = order[is_start[order] == kind]
        single = own[:SINGLE][count[own[:SINGLE]] > 0]
        cls[single] = at + np.arange(len(single))
        at += len(single)
        rest = own[len(single):]
        met = rest[count[rest] > 0]
        if len(met):
            centre = company[place[met[rng.permutation(min(len(met), 4 * GROUPS))[:GROUPS]]]]
            own_company, weight = company[place[met]], np.sqrt(count[met])[:, None]
            for _ in range(12):
                nearest = (own_company @ centre.T - 0.5 * (centre ** 2).sum(axis=1)).argmax(axis=1)
                total = np.zeros_like(centre)
                np.add.at(total, nearest, own_company * weight)
                mass = np.bincount(nearest, weights=weight[:, 0], minlength=len(centre))
                centre = np.where(mass[:, None] > 0, total / np.maximum(mass, 1e-9)[:, None], centre).astype(np.float32)
            cls[met] = at + nearest
            at += len(centre)
        cls[rest[count[rest] == 0]] = at  # ids that do not occur are a class of their own
        at += 1
        if kind:
            starts = at
    full = np.r_[count, max(1, texts)] + 0.05
    mass = np.bincount(cls, weights=full, minlength=at)
    rank = np.empty(size, np.int64)
    rank[order] = np.arange(size)
    row = np.where(rank < ROWS - at - 1, rank, 0)
    row = np.where((rank < ROWS - at - 1) & (count > 0), row, ROWS - at + cls[:size])
    return Vocabulary(cls, np.log(full / mass[cls]).astype(np.float32), np.r_[row, ROWS - at - 1], starts, at)


def blocks(ids: np.ndarray, size: np.ndarray, v: Vocabulary, block: int = BLOCK) -> tuple[np.ndarray, ...]:
    """(input rows, target ids, is target, first of a text) by block, for texts of ``size`` ids laid end to end.

    Inputs are targets shifted by one; the end of a text is its last target
    and also what stands before its first.
    """
    full = size + 1
    n = -(-full // block)
    base = (np.cumsum(n) - n) * block
    target = np.full(int(n.sum()) * block, v.end)
    inside = np.zeros(len(target), bool)
    target[np.repeat(base - (np.cumsum(size) - size), size) + np.arange(len(ids))] = ids
    inside[np.repeat(base - (np.cumsum(full) - full), full) + np.arange(int(full.sum()))] = True
    given = np.r_[np.int64(v.end), target[:-1]][: len(target)]
    given[base] = v.end
    first = np.zeros(len(target) // block, bool)
    first[base // block] = True
    return v.row[given].reshape(-1, block), target.reshape(-1, block), inside.reshape(-1, block), first


def _after_starts(given: np.ndarray, first: np.ndarray, start_row: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks with a block of starts before every text, in which nothing is foretold, and where the others are."""
    at = np.arange(len(given)) + np.cumsum(first)
    rows = np.full((len(given) + int(first.sum()), BLOCK), start_row)
    rows[at] = given
    return rows, at


def _windows(x: np.ndarray, apart: int = 1) -> np.ndarray:
    """The blocks at 1, 1 + ``apart`` and so on, each after the one before it; a view."""
    n, s, d = x.shape
    by_block, by_place, by_value = x.strides
    return np.lib.stride_tricks.as_strided(x, (n // 2 if apart == 2 else n - 1, 2 * s, d), (apart * by_block, by_place, by_value))


@dataclass
class Weights:
    query: np.ndarray
    key: np.ndarray
    value: np.ndarray
    residual: np.ndarray
    distance: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    def all(self) -> list[np.ndarray]:
        return [self.query, self.key, self.value, self.residual, self.distance, self.out, self.bias]


def _mask(distance: np.ndarray, block: int) -> np.ndarray:
    """(block, 2 block): bias of every earlier place, a large negative number for later ones."""
    gap = block + np.arange(block)[:, None] - np.arange(2 * block)[None, :]
    return np.where(gap >= 0, distance[np.maximum(gap, 0)], _BIG).astype(np.float32)


class Space:
    """Arrays used again and again, by name, so that no memory is taken and given back for every batch."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, *shape: int) -> np.ndarray:
        size = math.prod(shape)
        if name not in self.held or len(self.held[name]) < size:
            self.held[name] = np.empty(size, np.float32)
        return self.held[name][:size].reshape(shape)

    def __getstate__(self):
        return {"held": {}}


def _exponentials(make: Callable[[], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials of what ``make`` gives, by row of one scale, and their sums by row.

    It is made again where values are too large or too small as they are; each
    row's maximum is then taken out.
    """
    x = make()
    one = np.ones(x.shape[1], np.float32)
    if x.max() < 60:
        total = np.exp(x, out=x) @ one
        if total.min() > 1e-20:
            return x, total
        x = make()
    x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    return x, x @ one


#: How far back every place of two blocks is from every place of the second.
_GAP = BLOCK + np.arange(BLOCK)[:, None] - np.arange(2 * BLOCK)[None, :]
#: Rows of a table that a step changes together; they stay in the processor's cache.
_ROWS_AT_ONCE = 256
_MANY = 24


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of rows from each place of ``first`` to the next; many rows are faster added up one place after another."""
    n = np.diff(first, append=len(values))
    many = n > _MANY
    out = np.add.reduceat(values, first, axis=0) if not many.any() else np.empty((len(first), values.shape[1]), np.float32)
    if many.any():
        for i, lo, size in zip(np.flatnonzero(many).tolist(), first[many].tolist(), n[many].tolist()):
            np.sum(values[lo:lo + size], axis=0, out=out[i])
        few = values[np.repeat(~many, n)]
        if len(few):
            out[~many] = np.add.reduceat(few, np.cumsum(n[~many]) - n[~many], axis=0)
    return out


class Learner:
    """Weights fitted by Adam; gradients are summed over blocks until a step takes them."""

    def __init__(self, w: Weights, v: Vocabulary):
        self.v, self.start_row = v, v.row[v.end]
        #: query, key, value and residual side by side; bias by distance; output with its bias as the last row
        self.table = np.concatenate([w.query, w.key, w.value, w.residual], axis=1)
        self.distance, self.out = w.distance.copy(), np.r_[w.out, w.bias[None, :]]
        self.m1, self.m2 = ([np.zeros_like(p) for p in (self.table, self.distance, self.out)] for _ in range(2))
        self.room, self.values = Space(), np.empty((0, self.table.shape[1]), np.float32)
        self.steps = 0
        self._begin()

    def _begin(self) -> None:
        self.held: list[np.ndarray] = []  # the table's rows that ``values`` are gradients of
        self.rows = 0
        self.by_gap, self.by_class = np.zeros((BLOCK, 2 * BLOCK), np.float32), np.zeros_like(self.out)
        self.mask = _mask(self.distance, BLOCK)
        self.targets = self.blocks = 0

    def weights(self) -> Weights:
        parts = np.split(self.table, [KEY, 2 * KEY, 2 * KEY + HIDDEN], axis=1)
        return Weights(*(np.ascontiguousarray(p) for p in parts), self.distance.copy(), self.out[:HIDDEN].copy(), self.out[HIDDEN].copy())

    def add(self, rows: np.ndarray, cls: np.ndarray, inside: np.ndarray, apart: int = 1) -> None:
        """Gradients of the blocks at 1, 1 + ``apart`` and so on of ``rows``, each behind the one before it.

        ``cls`` and ``inside`` tell the classes of these blocks' targets and which of them count.
        """
        s, n, room = BLOCK, len(cls), self.room
        x = self.table.take(rows, axis=0, out=room("x", *rows.shape, self.table.shape[1]), mode="clip")
        own, before = slice(1, None, apart), slice(0, len(rows) - 1, apart)
        both = _windows(x, apart)
        q, k, val = x[own, :, :KEY], both[:, :, KEY:2 * KEY], both[:, :, 2 * KEY:2 * KEY + HIDDEN]

        def weight() -> np.ndarray:
            p = np.matmul(q, k.transpose(0, 2, 1), out=room("p", n, s, 2 * s))
            p += self.mask
            return p.reshape(-1, 2 * s)

        p, total = _exponentials(weight)
        p *= (1 / total)[:, None]
        p = p.reshape(n, s, 2 * s)
        h = np.matmul(p, val, out=room("h", n, s, HIDDEN))
        h += x[own, :, 2 * KEY + HIDDEN:]
        g = room("g", n * s, HIDDEN + 1)  # ends with a one, which brings the bias
        g[:, HIDDEN] = 1
        np.maximum(h.reshape(-1, HIDDEN), 0, out=g[:, :HIDDEN])
        d, mass = _exponentials(lambda: np.matmul(g, self.out, out=room("d", n * s, self.out.shape[1])))
        d[np.arange(len(d)), cls.ravel()] -= mass
        scale = np.where(inside.ravel(), 1 / mass, np.float32(0))[:, None]
        live = h > 0
        dh = np.matmul(d, self.out[:HIDDEN].T, out=h.reshape(-1, HIDDEN))
        dh *= scale
        dh = dh.reshape(h.shape)
        dh *= live
        g *= scale
        self.by_class += np.matmul(g.T, d, out=room("by_class", *self.out.shape))
        da = np.matmul(dh, val.transpose(0, 2, 1), out=room("da", *p.shape))
        da -= np.einsum("bij,bij->bi", da, p)[:, :, None]
        da *= p
        lo, hi = self.rows, self.rows + rows.size
        if hi > len(self.values):
            self.values = np.r_[self.values, np.empty((hi, x.shape[2]), np.float32)]
        grad = self.values[lo:hi].reshape(x.shape)
        grad[slice(0, None, apart) if apart > 1 else slice(0, 1)] = 0
        np.matmul(da, k, out=grad[own, :, :KEY])
        grad[own, :, 2 * KEY + HIDDEN:] = dh
        for at, left, right in ((KEY, da, q), (2 * KEY, p, dh)):  # keys and values: by the blocks themselves, then by those after them
            columns, back = slice(at, at + right.shape[2]), left.transpose(0, 2, 1)
            np.matmul(back[:, s:], right, out=grad[own, :, columns])
            grad[before, :, columns] += np.matmul(back[:, :s], right, out=room("part", n, s, right.shape[2]))
        self.held.append(rows.ravel())
        self.rows = hi
        self.by_gap += da.sum(axis=0)
        self.targets += int(inside.sum())
        self.blocks += n

    def step(self, rate: float) -> None:
        """One step of Adam with the mean gradient of what was added since the last one."""
        row = np.concatenate(self.held)
        order = np.argsort(row.astype(np.uint16), kind="stable")
        first = np.flatnonzero(np.diff(row[order], prepend=-1))
        ordered = self.values.take(order, axis=0, out=self.room("ordered", len(row), self.table.shape[1]), mode="clip")
        by_distance = np.bincount(np.maximum(_GAP, 0).ravel(), np.where(_GAP >= 0, self.by_gap, 0).ravel(), 2 * BLOCK).astype(np.float32)
        self.steps += 1
        all_rows = slice(None)
        for k, rows, grad in ((0, row[order[first]], _sums(ordered, first)), (1, all_rows, by_distance), (2, all_rows, self.by_class)):
            grad /= max(1, self.targets)
            self._change((self.table, self.distance, self.out)[k], self.m1[k], self.m2[k], rows, grad, rate)
        self._begin()

    def _change(self, x: np.ndarray, a1: np.ndarray, a2: np.ndarray, rows: np.ndarray | slice, grad: np.ndarray, rate: float) -> None:
        """Adam on all of ``x``, whose gradient is nought outside ``rows``; ``a1`` and ``a2`` are sums, not means, of what faded."""
        t, f = self.steps, np.float32
        a1 *= f(0.9)
        a1[rows] += grad
        grad *= grad
        a2 *= f(0.99)
        a2[rows] += grad
        far = math.sqrt(0.01 / (1 - 0.99 ** t))
        scale, least = f(rate * 0.1 / (1 - 0.9 ** t) / far), f(1e-8 / far)
        for lo in range(0, len(x), _ROWS_AT_ONCE):
            own = slice(lo, lo + _ROWS_AT_ONCE)
            change = np.sqrt(a2[own], out=self.room("change", *a2[own].shape))
            change += least
            np.divide(a1[own], change, out=change)
            change *= scale
            x[own] -= change

    def learn(self, ids: np.ndarray, size: np.ndarray, rate: float) -> None:
        """Steps over all blocks of texts of ``size`` ids laid end to end, in their order."""
        given, target, inside, first = blocks(ids, size, self.v)
        rows, at = _after_starts(given, first, self.start_row)
        cls, counted = np.zeros(rows.shape, np.int64), np.zeros(rows.shape, bool)
        cls[at], counted[at] = self.v.cls[target], inside
        lo = 1
        while lo < len(rows):
            hi = min(len(rows), lo + min(_BLOCKS_A_STEP - self.blocks, _BLOCKS_AT_ONCE))
            self.add(rows[lo - 1:hi], cls[lo:hi], counted[lo:hi])
            lo = hi
            if self.blocks >= _BLOCKS_A_STEP:
                self.step(rate * min(1.0, (self.steps + 1) / _WARM))

    def end(self, rate: float) -> None:
        """What is left, in a step as much shorter as there are fewer blocks than usual."""
        if self.blocks:
            self.step(rate * min(1.0, (self.steps + 1) / _WARM) * self.blocks / _BLOCKS_A_STEP)


def initial(v: Vocabulary, seed: int = 3) -> Weights:
    rng = np.random.default_rng(seed)
    f = np.float32
    return Weights(*(rng.normal(0, 0.3, (ROWS, d)).astype(f) for d in (KEY, KEY, HIDDEN, HIDDEN)),
                   np.zeros(2 * BLOCK, f), rng.normal(0, 0.2, (HIDDEN, v.classes)).astype(f), np.zeros(v.classes, f))


def train(streams: list[np.ndarray], v: Vocabulary, steps: int = 1500, batch: int = 128, rate: float = 0.01,
          seed: int = 3) -> Weights:
    """Weights fitted from the start on blocks of texts, drawn with a fixed seed."""
    w = initial(v, seed)
    if not streams:
        return w
    learner, rng = Learner(w, v), np.random.default_rng(seed + 1)
    given, target, inside, first = blocks(np.concatenate(streams), np.array([len(x) for x in streams]), v)
    cls = v.cls[target]
    for step in range(steps):
        pick = rng.integers(0, len(given), batch)
        before = np.where(first[pick, None], learner.start_row, given[pick - 1])
        learner.add(np.stack([before, given[pick]], axis=1).reshape(-1, BLOCK), cls[pick], inside[pick], apart=2)
        learner.step(rate * min(1.0, (step + 1) / 50) * max(0.05, 1 - step / steps))
    return learner.weights()


class Model:
    """Scores texts of subword ids; built from a vocabulary and weights."""

    def __init__(self, v: Vocabulary, w: Weights):
        self.v = v
        f = np.float32
        # similarities stay small enough for exponentials without a maximum taken out
        most = float(np.linalg.norm(w.query, axis=1).max() * np.linalg.norm(w.key, axis=1).max() + np.abs(w.distance).max())
        self.query = (w.query * min(1.0, 60.0 / max(most, 1e-9))).astype(f)
        self.key = w.key
        self.value = np.c_[w.value, np.ones(len(w.value), f)].astype(f)  # the last column adds up the weights
        self.residual, self.out, self.bias = w.residual, w.out, w.bias
        # hidden states end with a one, which brings the bias
        self.residual_one, self.out_bias = np.c_[w.residual, np.zeros(len(w.residual), f)].astype(f), np.r_[w.out, w.bias[None, :]].astype(f)
        self.mask = _mask(w.distance, BLOCK)
        self.one, self.room = np.ones(v.classes, f), Space()

    def _attend(self, rows: np.ndarray) -> np.ndarray:
        """Hidden states of all blocks but the first."""
        given, n, room = rows[1:], len(rows) - 1, self.room

        def of(x: np.ndarray, name: str, at: np.ndarray) -> np.ndarray:
            return x.take(at, axis=0, out=room(name, *at.shape, x.shape[1]), mode="clip")

        weight = np.matmul(of(self.query, "query", given), _windows(of(self.key, "key", rows)).transpose(0, 2, 1), out=room("weight", n, BLOCK, 2 * BLOCK))
        weight += self.mask
        np.exp(weight, out=weight)
        h = np.matmul(weight, _windows(of(self.value, "value", rows)), out=room("h", n, BLOCK, HIDDEN + 1))
        h /= h[:, :, HIDDEN:].copy()
        h += of(self.residual_one, "residual", given)
        return np.maximum(h, 0, out=h)

    def _class_logs(self, h: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(chosen class's value, sum over word starts, sum over all), as exponentials of one scale by row."""
        starts = self.v.starts
        logit = np.matmul(h, self.out_bias, out=self.room("logit", len(h), self.v.classes))
        chosen = logit[np.arange(len(cls)), cls]
        with np.errstate(over="ignore", invalid="ignore"):
            e = np.exp(logit, out=logit)
            starting, both = e[:, :starts] @ self.one[:starts], e @ self.one
        if not np.isfinite(both).all():  # values far from any met in training: take the maximum out first
            logit = h @ self.out_bias
            top = logit.max(axis=1, keepdims=True)
            chosen = logit[np.arange(len(cls)), cls] - top[:, 0]
            e = np.exp(logit - top)
            starting, both = e[:, :starts].sum(axis=1), e.sum(axis=1)
        return chosen, starting, both

    def token_logs(self, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Natural logs for all tokens of all texts (of ``size`` ids, end to end), each followed by its end.

        (token given that it begins a word or not, a word beginning at this place).
        """
        given, target, inside, first = blocks(ids, size, self.v)
        token = np.empty(target.shape, np.float32)
        begin = np.empty(target.shape, np.float32)
        rows, at = _after_starts(given, first, self.v.row[self.v.end])
        cls, foretold = np.zeros(rows.shape, np.int64), np.zeros(len(rows), bool)
        cls[at], foretold[at] = self.v.cls[target], True
        hi = 0
        for begun in range(1, len(rows), _BLOCKS_AT_ONCE):
            told, t = foretold[begun:begun + _BLOCKS_AT_ONCE], cls[begun:begun + _BLOCKS_AT_ONCE].ravel()
            lo, hi = hi, hi + int(told.sum())
            h = self._attend(rows[begun - 1:begun + _BLOCKS_AT_ONCE])
            chosen, starting, both = self._class_logs(h.reshape(-1, HIDDEN + 1), t)
            kind = np.log(np.maximum(np.where(t < self.v.starts, starting, both - starting), 1e-30))
            token[lo:hi] = (chosen - kind).reshape(-1, BLOCK)[told]
            begin[lo:hi] = (kind - np.log(both)).reshape(-1, BLOCK)[told]
        token += self.v.share[target]
        return token[inside], begin[inside]
