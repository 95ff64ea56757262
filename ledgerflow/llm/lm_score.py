"""Language-model scores: a log-bilinear model trained by noise-contrastive estimation.

Words are white-space separated, A-Z in lower case; a text ends with one end
token. The model is normalised over the known words, one unknown word and the
end token. Every known word has a vector, as context and as target, that of its
cell: frequent words, the end and the unknown word have cells of their own, the
other words share hashed cells. The numbers of both kinds of cells grow with the
square root of the vocabulary. A word's probability has three steps:

* a log-bilinear network gives the group of the cell from the two cells before,
  ``score = (c1 * r[h1] + c2 * r[h2]) . g[group] + bias``, normalised over all groups
  by batched products of each cell's exponentials; the most frequent cells are groups of their
  own, the others lie in groups of like frequency, about as many as cells in each;
* in a group of several cells a second product gives the cell, normalised over
  the cells of the group;
* within a hashed cell, absolute discounting gives a word with count c the share
  of c - d. What it frees is the unknown word's: a token of a hashed cell is
  trained as the unknown word with the cell's freed share as chance.

Training is data-parallel: in each round every task takes the broadcast
parameters, runs minibatch noise-contrastive steps for both networks over its
training rows in numpy and returns the rows of the parameter tables that it
changed; Spark averages them by row, weighted by the tokens and noise that met
it. ``task_tokens`` bounds the number of tasks, so what they return stays small
beside the input. Token counts cover all training rows and are a distributed
table; only the ``hot_words`` most frequent (fixed bound) are sent to the tasks,
where most tokens find their counts. The rest meet the count table in a shuffle
join on a hash, which therefore holds no frequent key.

Words are keyed by a 64-bit hash; at n distinct words the chance that any two
share one is about n^2 / 2^65 (3e-8 at a million, 3 % at a billion), and then
two words share a count.

Defined cases: null and empty texts hold the end token alone; with no training
rows N is 0 and every word is unknown (``score`` then is that of a uniform
choice between unknown word and end). Repeated rows are scored row by row; extra
columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import (
    LOWER, id_remainder, materialize, mix64, signed, span_hashes, text_slices, unsigned, word_spans,
)

TILE_BITS = 9  # so many neighbouring cells' exponentials stay in the processor's cache
END = np.uint64(1)  # the end token's key; words with this hash do not occur in practice


@dataclass(frozen=True)
class LmParams:
    dim: int = 16
    noise: int = 32           # noise groups shared by a minibatch
    batch: int = 8192
    block: int = 16           # tokens of a group that share as many noise cells
    rate: float = 0.1
    rounds: int = 1           # passes over the training rows, parameters averaged after each
    heads: int = 256          # most frequent cells, groups of their own
    growth: float = 8.0       # hashed cells: the power of two from growth * sqrt(V) on
    own: int = 4              # cells of frequent words, for each hashed cell
    hot_words: int = 1 << 18  # most frequent words whose counts go to every task (16 bytes each)
    task_tokens: int = 1 << 27  # tokens of one training task, where there are more than tasks at a time


def word_keys(batch, column):
    """Runs of rows with their words' keys: first row, row count, keys, row of each word."""
    for first, n, data, offsets in text_slices(batch, column):
        data = LOWER[data]
        starts, ends, row = word_spans(data, offsets)
        yield first, n, span_hashes(data, starts, ends), row


def word_blocks(batch, column, size: int = 1 << 21):
    """``word_keys`` with neighbouring runs joined up to some ``size`` words."""
    held, words = [], 0

    def joined():
        first, rows = held[0][0], sum(n for _, n, _, _ in held)
        out = first, rows, np.concatenate([k for _, _, k, _ in held]), np.concatenate([r + np.int32(at - first) for at, _, _, r in held])
        held.clear()  # not kept while the block is in use
        return out

    for first, n, keys, row in word_keys(batch, column):
        if held and words + len(keys) + n > size:
            yield joined()
            words = 0
        held.append((first, n, keys, row.astype(np.int32)))
        words += len(keys) + n
    if held:
        yield joined()


def with_ends(n: int, keys: np.ndarray, row: np.ndarray):
    """The token stream with an end after each row: keys, row, position of each row's end."""
    lengths = np.bincount(row, minlength=n)
    ends = np.cumsum(lengths + 1) - 1
    out = np.empty(len(keys) + n, np.uint64)
    mask = np.ones(len(out), bool)
    mask[ends] = False
    out[mask] = keys
    out[ends] = END
    return out, np.repeat(np.arange(n, dtype=np.int32), lengths + 1), ends


def token_counts(train: DataFrame) -> DataFrame:
    """``key``, ``n`` of every token of the given texts (end tokens included)."""
    def count(batches):
        held, size = [], 0

        def flush():
            keys = np.concatenate([k for k, _ in held])
            n = np.concatenate([c for _, c in held])
            order = np.argsort(keys)
            keys, n = keys[order], n[order]
            at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            return keys[at], np.add.reduceat(n, at)

        def rows(keys, n):
            for i in range(0, len(keys), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(signed(keys[i:i + (1 << 16)])), pa.array(n[i:i + (1 << 16)])], names=["key", "n"])

        for batch in batches:
            for _, n, keys, _ in word_keys(batch, 0):
                held.append(np.unique(keys, return_counts=True))
                held.append((np.array([END]), np.array([n])))
                size += len(held[-2][0])
                if size > 1 << 21:  # merge what is held; a table that stays large is passed on
                    k, c = flush()
                    if len(k) > 1 << 20:
                        yield from rows(k, c)
                        held, size = [], 0
                    else:
                        held, size = [(k, c)], len(k)
        if held:
            yield from rows(*flush())

    return train.select("text").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


class KeyTable:
    """Sorted distinct hashes, found by their leading bits and a few steps from there."""

    def __init__(self, keys: np.ndarray):
        self.n = len(keys)
        self.keys = np.append(keys, np.uint64(2**64 - 1))
        bits = self.n.bit_length() + 1
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Where the table holds each key; -1 where it does not."""
        at = self.first[keys >> self.shift]
        behind = np.flatnonzero(self.keys[at] < keys)
        for _ in range(16):
            at[behind] += 1
            behind = behind[self.keys[at[behind]] < keys[behind]]
            if not len(behind):
                break
        at[behind] = np.searchsorted(self.keys, keys[behind])
        at[(self.keys[at] != keys) | (at == self.n)] = -1
        return at


@dataclass
class Cells:
    """Cells in order of frequency after the end (0) and the unknown word (1), so that
    the cells of a group are neighbours."""
    keys: np.ndarray     # sorted keys of the words with a cell of their own, and the end
    ids: np.ndarray      # their cells
    hashed: np.ndarray   # cell of each hash bucket (a power of two)
    share: np.ndarray    # of the training tokens, by cell
    free: np.ndarray     # chance that a token of the cell stands for the unknown word
    left: np.ndarray     # discounted tokens of a hashed cell
    starts: np.ndarray   # first cell of each group, and the number of cells

    def __post_init__(self):
        self.table = KeyTable(self.keys)
        self.ids, self.hashed = self.ids.astype(np.int32), self.hashed.astype(np.int32)
        self.size = np.diff(self.starts)
        self.group = np.repeat(np.arange(len(self.size), dtype=np.int32), self.size)
        mass = np.add.reduceat(self.share, self.starts[:-1])
        with np.errstate(divide="ignore", invalid="ignore"):
            self.log_group = np.log(np.maximum(mass, 1e-12)).astype(np.float32)
            inner = self.share / mass[self.group]
            self.log_inner = np.log(np.where(inner > 0, inner, 1e-12)).astype(np.float32)
        self.up_to = np.cumsum(self.share)
        self.groups_up_to = np.cumsum(mass)

    def of(self, keys: np.ndarray) -> np.ndarray:
        place = self.table.places(keys)
        return np.where(place >= 0, self.ids[place], self.hashed[keys & np.uint64(len(self.hashed) - 1)])

    def draw_groups(self, rng, n: int) -> np.ndarray:
        u = rng.random(n) * self.groups_up_to[-1]
        return np.minimum(np.searchsorted(self.groups_up_to, u, "right"), len(self.size) - 1)

    def draw_cells(self, rng, groups: np.ndarray, n: int) -> np.ndarray:
        """``n`` cells of each of the given groups, by their shares."""
        first, last = self.starts[groups], self.starts[groups + 1] - 1
        low = self.up_to[first] - self.share[first]
        u = low[:, None] + rng.random((len(groups), n)) * (self.up_to[last] - low)[:, None]
        return np.clip(np.searchsorted(self.up_to, u, "right"), first[:, None], last[:, None])


def _contexts(cls: np.ndarray, ends: np.ndarray, start: int):
    """Cells one and two places before each token; ``start`` before a row's first."""
    h1 = np.empty_like(cls)
    h1[1:] = cls[:-1]
    h2 = np.empty_like(cls)
    h2[2:] = cls[:-2]
    first = np.concatenate([[0], ends[:-1] + 1])
    h1[first] = start
    h2[first] = start
    second = first + 1
    second = second[second <= ends]
    h2[second] = start
    return h1, h2


def initial_parameters(p: LmParams, cells: Cells, trained: bool = True) -> dict[str, np.ndarray]:
    """Vectors of contexts (the last row is the start), groups and cells; the last
    column of the latter two is a bias."""
    rng = np.random.default_rng(11)
    n = len(cells.share)
    r = rng.normal(0, 0.1, (n + 1, p.dim)).astype(np.float32)
    r[np.append(cells.share == 0, not trained)] = 0
    g = rng.normal(0, 0.1, (len(cells.size), p.dim + 1)).astype(np.float32)
    q = rng.normal(0, 0.1, (n, p.dim + 1)).astype(np.float32)
    g[:, -1] = cells.log_group
    q[:, -1] = cells.log_inner
    return {"r": r, "g": g, "q": q, "c": np.ones((2, p.dim), np.float32)}


def _chance(x: np.ndarray) -> np.ndarray:
    out = np.clip(x, -30, 30)
    np.exp(np.negative(out, out=out), out=out)
    out += 1
    return np.reciprocal(out, out=out)


def _order(rows: np.ndarray) -> np.ndarray:
    """Stable order of numbers below 2**32, by 16 bits at a time (numpy sorts these by radix)."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    high = rows >> 16
    return order[np.argsort(high[order].astype(np.uint16), kind="stable")] if high.any() else order


def _rows(a: np.ndarray, wide: int) -> tuple[int, int]:
    """Rows of a block whose product with ``wide`` columns is so small that the algebra
    library starts no threads (a task has one core), and the rows in whole blocks."""
    rows = max(1, (1 << 18) // (a.shape[1] * wide))
    return rows, len(a) // rows * rows


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` by blocks of rows."""
    rows, whole = _rows(a, b.shape[1])
    out = np.empty((len(a), b.shape[1]), np.float32)
    np.matmul(a[:whole].reshape(-1, rows, a.shape[1]), b, out=out[:whole].reshape(-1, rows, b.shape[1]))
    np.matmul(a[whole:], b, out=out[whole:])
    return out


def _sum_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b`` by blocks of rows."""
    rows, whole = _rows(a, b.shape[1])
    blocks = a[:whole].reshape(-1, rows, a.shape[1]).transpose(0, 2, 1) @ b[:whole].reshape(-1, rows, b.shape[1])
    return blocks.sum(0) + a[whole:].T @ b[whole:]


def _context(w: dict, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    ctx = np.ones((len(h1), w["g"].shape[1]), np.float32)
    ctx[:, :-1] = w["r"].take(h1, 0) * w["c"][0] + w["r"].take(h2, 0) * w["c"][1]
    return ctx


def _climb(w: np.ndarray, state: np.ndarray, met: np.ndarray, rows: np.ndarray, delta: np.ndarray, times, rate: float) -> None:
    """One adaptive step on the given rows of a table, where rows repeat; ``times`` is how often each was met."""
    order = _order(rows)
    rows = rows[order]
    at = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    hit = rows[at]
    grad = np.add.reduceat(delta.take(order, 0), at, axis=0)
    total = state.take(hit, 0)
    total += grad * grad
    state[hit] = total
    total += np.float32(1e-8)
    grad *= np.float32(rate)
    grad /= np.sqrt(total, out=total)
    grad += w.take(hit, 0)
    w[hit] = grad
    met[hit] += np.diff(np.append(at, len(rows))) if np.isscalar(times) else np.add.reduceat(times[order], at)


def nce_step(w: dict, h1, h2, target, cells: Cells, state: dict, met: dict, rng, p: LmParams) -> None:
    """One minibatch: logistic discrimination of the true group from noise groups, and
    of the true cell from noise cells of its group."""
    r1, r2 = w["r"].take(h1, 0), w["r"].take(h2, 0)
    ctx = np.ones((len(h1), w["g"].shape[1]), np.float32)
    ctx[:, :-1] = r1 * w["c"][0] + r2 * w["c"][1]
    group = cells.group[target]
    noise = cells.draw_groups(rng, p.noise)
    log_noise = cells.log_group + np.float32(math.log(p.noise))
    gt, gn = w["g"].take(group, 0), w["g"][noise]
    up = _chance(log_noise[group] - np.einsum("ij,ij->i", ctx, gt))[:, None]  # 1 - P(data | true group)
    down = -_chance(_product(ctx, gn.T) - log_noise[noise])                   # -P(data | noise group)
    d_ctx = _product(down, gn)
    d_ctx += up * gt
    steps = [("g", np.concatenate([group, noise]), np.concatenate([up * ctx, _sum_product(down, ctx)]), 1)]
    inner = np.flatnonzero(cells.size[group] > 1)
    if len(inner):
        # Tokens of a group are cut into blocks that share their noise cells.
        inner = inner[_order(group[inner])]
        of = group[inner]
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        place = np.arange(len(of)) - np.repeat(first, np.diff(np.append(first, len(of))))
        begins = place % p.block == 0
        slot = (np.cumsum(begins) - 1) * p.block + place % p.block
        drawn = cells.draw_cells(rng, of[begins], p.block)
        log_noise = cells.log_inner + np.float32(math.log(p.block))
        x, t = ctx.take(inner, 0), target[inner]
        qt, qn = w["q"].take(t, 0), w["q"].take(drawn, 0)
        blocks = np.zeros((drawn.size, x.shape[1]), np.float32)
        blocks[slot] = x
        blocks = blocks.reshape(qn.shape)
        real = np.zeros(drawn.size, np.float32)
        real[slot] = -1
        up = _chance(log_noise[t] - np.einsum("ij,ij->i", x, qt))[:, None]
        down = _chance(blocks @ qn.transpose(0, 2, 1) - log_noise[drawn][:, None, :]) * real.reshape(*drawn.shape, 1)
        d_ctx[inner] += up * qt + (down @ qn).reshape(-1, x.shape[1]).take(slot, 0)
        steps.append(("q", np.concatenate([t, drawn.ravel()]),
                      np.concatenate([up * x, (down.transpose(0, 2, 1) @ blocks).reshape(-1, x.shape[1])]), 1))
    d_ctx = d_ctx[:, :-1]
    steps.append(("c", np.array([0, 1]), np.stack([np.einsum("ij,ij->j", d_ctx, r1), np.einsum("ij,ij->j", d_ctx, r2)]), 1))
    # A word is the first context of one token and mostly the second of the next: one row for both.
    near, far = d_ctx * w["c"][0], d_ctx * w["c"][1]
    both = np.append(h1[:-1] == h2[1:], False)
    near[:-1] += far[1:] * both[:-1, None]
    alone = np.append(0, np.flatnonzero(~both[:-1]) + 1)
    steps.append(("r", np.concatenate([h1, h2[alone]]), np.concatenate([near, far[alone]]), np.append(1 + both, np.ones(len(alone)))))
    for name, rows, delta, times in steps:
        _climb(w[name], state[name], met[name], rows, delta, times, p.rate)


def _train_round(train: DataFrame, w: dict, cells: Cells, total: int, p: LmParams) -> dict:
    start = len(cells.share)
    names = list(w)
    width = p.dim + 1

    def run(batches):
        mine = {k: v.copy() for k, v in w.items()}
        state = {k: np.zeros_like(v) for k, v in w.items()}
        met = {k: np.zeros(len(v)) for k, v in w.items()}
        rng = np.random.default_rng(5)
        for batch in batches:
            for _, n, keys, row in word_keys(batch, 0):
                stream, _, ends = with_ends(n, keys, row)
                cell = cells.of(stream)
                h1, h2 = _contexts(cell, ends, start)
                for at in range(0, len(cell), p.batch):
                    part = slice(at, at + p.batch)
                    target = np.where(rng.random(len(cell[part])) < cells.free[cell[part]], 1, cell[part])
                    nce_step(mine, h1[part], h2[part], target, cells, state, met, rng, p)
        for t, name in enumerate(names):
            changed = np.flatnonzero(met[name])
            for at in range(0, len(changed), 1 << 14):
                i = changed[at:at + (1 << 14)]
                v = np.zeros((len(i), width), np.float32)
                v[:, :mine[name].shape[1]] = mine[name][i]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, v.size + 1, width, dtype=np.int32)), pa.array(v.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(i), t, np.int32)), pa.array(i.astype(np.int32)), lists, pa.array(met[name][i])],
                    names=["t", "i", "v", "met"])

    tasks = max(train.sparkSession.sparkContext.defaultParallelism, -(-total // p.task_tokens))
    parts = train.select("text").coalesce(tasks).mapInArrow(run, "t int, i int, v array<float>, met double")
    mean = parts.groupBy("t", "i").agg(*[(F.sum(F.col("v")[j] * F.col("met")) / F.sum("met")).cast("float").alias(f"x{j}") for j in range(width)])
    out = {k: v.copy() for k, v in w.items()}
    got = mean.toPandas()  # at most one row for each row of the parameter tables
    for t, name in enumerate(names):
        mine = got[got["t"] == t]
        out[name][mine["i"]] = mine[[f"x{j}" for j in range(out[name].shape[1])]].to_numpy(np.float32)
    return out


def _reach(ctx: np.ndarray, table: np.ndarray) -> float:
    """No score of these contexts is above this, nor below its negative, rows without a chance apart."""
    real = table[table[:, -1] > -1e8]
    if not len(real):
        return math.inf
    return np.sqrt((ctx ** 2).sum(1).max(initial=0) * (real[:, :-1] ** 2).sum(1).max()) + abs(real[:, -1]).max()


def _log_sums(ctx: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Log of the sum of exponentials over all rows of the table, by matrix products
    that stay in the processor's cache."""
    out = np.empty(len(ctx), np.float32)
    rows = max(16, (1 << 17) // len(table))
    # Only where sums could overflow or vanish each row's largest is taken off.
    small = _reach(ctx[:, :-1], table) < 60
    columns, ones = np.ascontiguousarray(table.T), np.ones(len(table), np.float32)
    for at in range(0, len(ctx), rows):
        s = _product(ctx[at:at + rows], columns)
        if small:
            out[at:at + rows] = np.log(np.einsum("ij,j->i", np.exp(s, out=s), ones))
        else:
            top = s.max(1, keepdims=True)
            s -= top
            out[at:at + rows] = top[:, 0] + np.log(np.exp(s, out=s).sum(1))
    return out


def _compact(cells: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct cells, and the place of each cell among them."""
    seen = np.zeros(width, bool)
    seen[cells] = True
    return np.flatnonzero(seen), (np.cumsum(seen, dtype=np.int32) - 1)[cells]


def _log_pair_sums(w: dict, h1: np.ndarray, h2: np.ndarray, held: int = 3 << 22, rows: int = 1024) -> np.ndarray:
    """Log of the sum of exponentials over all groups, for pairs of cells before in order of
    the first cells' tiles. A score is the sum of a part of each cell, so its exponential is a product:
    exponentials are taken once for a cell, and a pair is a dot product of two rows. At
    most ``held`` exponentials of second cells are kept at a time."""
    (u1, i1), (u2, i2) = (_compact(h, len(w["r"])) for h in (h1, h2))
    a, b = w["r"].take(u1, 0) * w["c"][0], w["r"].take(u2, 0) * w["c"][1]
    if not _reach(a, w["g"]) + _reach(b, w["g"]) < 60:  # products could overflow or vanish
        return np.concatenate([_log_sums(_context(w, h1[i:i + (1 << 16)], h2[i:i + (1 << 16)]), w["g"]) for i in range(0, len(h1), 1 << 16)])
    sums = np.zeros(len(h1), np.float32)
    tiles = np.arange((len(w["r"]) >> TILE_BITS) + 2)
    edges, cells = np.searchsorted(h1 >> TILE_BITS, tiles), np.searchsorted(u1 >> TILE_BITS, tiles)
    columns = min(144, max(8, held // max(1, len(u2))))
    for table in np.array_split(w["g"], -(-len(w["g"]) // columns)):
        vectors = np.ascontiguousarray(table.T)
        left, right = np.empty((2, rows, len(table)), np.float32)
        second = _product(b, vectors[:-1])
        second += vectors[-1]
        np.exp(second, out=second)
        for start, end, low, high in zip(edges, edges[1:], cells, cells[1:]):
            first = _product(a[low:high], vectors[:-1])
            np.exp(first, out=first)
            for i in range(start, end, rows):
                n = min(rows, end - i)
                first.take(i1[i:i + n] - low, 0, left[:n], "clip")
                second.take(i2[i:i + n], 0, right[:n], "clip")
                sums[i:i + n] += np.einsum("ij,ij->i", left[:n], right[:n])
    return np.log(sums)


@dataclass
class LanguageModel:
    params: LmParams
    weights: dict
    cells: Cells
    hot: tuple             # sorted keys and counts
    total: int             # N
    distinct: int          # V
    discount: float
    counts: DataFrame | None

    def log_probability(self, cell, h1, h2) -> tuple[np.ndarray, np.ndarray]:
        """log P(cell | two cells before) and log P(unknown word | two cells before)."""
        w, cells = self.weights, self.cells
        # In order of the first cell's tile, the second cell and the first, each distinct pair once.
        order = _order(h1 & ((1 << TILE_BITS) - 1))
        order = order[_order(h2[order])]
        order = order[_order(h1[order] >> TILE_BITS)]
        a, b = h1[order], h2[order]
        new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[:len(a)]
        of = np.empty(len(cell), np.int32)
        of[order] = np.cumsum(new, dtype=np.int32) - 1
        a, b = a[new], b[new]
        log_z = _log_pair_sums(w, a, b)
        group = cells.group[cell]
        logp, unknown = np.empty(len(cell)), np.empty(len(cell))
        for at in range(0, len(cell), 1 << 16):
            part = slice(at, at + (1 << 16))
            ctx = _context(w, h1[part], h2[part])
            logp[part] = np.einsum("ij,ij->i", ctx, w["g"].take(group[part], 0)) - log_z[of[part]]
            unknown[part] = ctx @ w["g"][1] - log_z[of[part]]
        # The tokens of a group are neighbours, those with the same pair too.
        inner = order[cells.size[group[order]] > 1]
        inner = inner[_order(group[inner])]
        edges = np.flatnonzero(np.diff(group[inner], prepend=-1, append=-1))
        for at, to in zip(edges, edges[1:]):
            tokens = inner[at:to]
            first, last = cells.starts[group[tokens[0]]], cells.starts[group[tokens[0]] + 1]
            pairs = of[tokens]
            new = np.append(True, pairs[1:] != pairs[:-1])
            ctx = _context(w, a[pairs[new]], b[pairs[new]])
            again = np.cumsum(new) - 1
            logp[tokens] += np.einsum("ij,ij->i", ctx.take(again, 0), w["q"].take(cell[tokens], 0)) - _log_sums(ctx, w["q"][first:last])[again]
        return logp, unknown

    def log_rest(self, cell: np.ndarray) -> np.ndarray:
        """Log of the discounted tokens of a hashed cell, 0 elsewhere."""
        left = self.cells.left[cell]
        return np.log(np.where(left > 0, left, 1.0))


def _most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows of the largest counts, found in a histogram of log counts (a
    few hundred cells). Of the last cell, whose counts differ by a tenth, those in the
    first of 4,096 ranges of the key."""
    cell = F.floor(F.log2(F.col("n").cast("double")) * 8)
    span = F.shiftrightunsigned(F.col("key"), 52)
    held = 0
    for c, rows in sorted(((r["cell"], r["count"]) for r in counts.groupBy(cell.alias("cell")).count().collect()), reverse=True):
        if held + rows > most:
            spans = sorted((r["span"], r["count"]) for r in counts.where(cell == c).groupBy(span.alias("span")).count().collect())
            up_to = np.cumsum([held] + [x for _, x in spans])
            fits = int(np.searchsorted(up_to, most, "right")) - 1
            return counts.where((cell > c) | ((cell == c) & (span < (spans[fits][0] if fits < len(spans) else 1 << 12))))
        held += rows
    return counts


def make_cells(keys: np.ndarray, n: np.ndarray, ends: int, tokens: np.ndarray, types: np.ndarray, discount: float, p: LmParams) -> Cells:
    """Cells from the words with one of their own (keys, counts) and the tokens and
    distinct words of each hash bucket."""
    buckets = len(tokens)
    freed = discount * types
    unknown = freed.sum()
    mass = np.concatenate([[max(ends, 1), unknown if ends else 1], n, tokens - freed])
    order = np.concatenate([[0, 1], 2 + np.argsort(-mass[2:], kind="stable")])
    place = np.empty(len(mass), np.int64)
    place[order] = np.arange(len(mass))
    none = np.zeros(2 + len(keys))
    with np.errstate(divide="ignore", invalid="ignore"):
        free = np.concatenate([none, np.where(tokens > 0, freed / tokens, 0.0)])
    heads = min(p.heads, len(mass))
    size = max(1, math.ceil(math.sqrt(len(mass) - heads)))
    known = np.concatenate([[END], keys]).astype(np.uint64)
    by_key = np.argsort(known)
    return Cells(known[by_key], np.concatenate([place[:1], place[2:2 + len(keys)]])[by_key], place[-buckets:],
                 mass[order] / mass.sum(), free[order], np.concatenate([none, tokens - freed])[order],
                 np.unique(np.concatenate([np.arange(heads), np.arange(heads, len(mass), size), [len(mass)]])))


def fit(train: DataFrame, params: LmParams = LmParams()) -> LanguageModel:
    p = params
    counts = materialize(token_counts(train), "lm-counts")
    end = int(signed(np.array([END]))[0])
    stats = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("distinct"),
                       F.count(F.when(F.col("n") == 1, 1)).alias("n1"), F.count(F.when(F.col("n") == 2, 1)).alias("n2"),
                       F.coalesce(F.sum(F.when(F.col("key") == end, F.col("n"))), F.lit(0)).alias("ends")).first()
    hot = _most_frequent(counts, p.hot_words).toPandas()  # hot_words rows at most
    keys, n = unsigned(hot["key"].to_numpy(np.int64)), hot["n"].to_numpy(np.int64)
    discount = min(0.95, max(0.05, stats["n1"] / max(1, stats["n1"] + 2 * stats["n2"])))
    buckets = 1 << max(4, math.ceil(math.log2(max(1.0, p.growth * math.sqrt(stats["distinct"])))))
    own = np.flatnonzero((keys != END) & (n > 1))  # words seen once share hashed cells
    own = own[np.lexsort((keys[own], -n[own]))][:p.own * buckets]
    tokens, types = np.zeros(buckets), np.zeros(buckets)
    bucket = F.col("key").bitwiseAND(F.lit(buckets - 1))
    for r in counts.where(F.col("key") != end).groupBy(bucket.alias("b")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).collect():
        tokens[r["b"]], types[r["b"]] = r["n"], r["k"]
    of = (keys[own] & np.uint64(buckets - 1)).astype(np.int64)
    tokens -= np.bincount(of, n[own], buckets)
    types -= np.bincount(of, minlength=buckets)
    cells = make_cells(keys[own], n[own], stats["ends"], tokens, types, discount, p)
    w = initial_parameters(p, cells, stats["total"] > 0)
    if stats["total"]:
        for _ in range(p.rounds):
            w = _train_round(train, w, cells, stats["total"], p)
    w["g"][np.add.reduceat(cells.share, cells.starts[:-1]) == 0, -1] = -1e9
    w["q"][cells.share == 0, -1] = -1e9
    if cells.share[1] == 0:  # no word shares a cell: the unknown word is as rare as one token more
        w["g"][1] = 0
        w["g"][1, -1] = -math.log(stats["total"] + 1)
    if stats["ends"] and not (keys == END).any():  # the end's count is always at hand
        keys, n = np.append(keys, END), np.append(n, stats["ends"])
    by_key = np.argsort(keys)
    return LanguageModel(p, w, cells, (keys[by_key], n[by_key]), int(stats["total"]), int(stats["distinct"]), discount, counts)


def score(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` of every row."""
    counts = model.counts
    lean = LanguageModel(**{**model.__dict__, "counts": None})  # what the tasks need
    denominator = math.log10(model.total + model.distinct + 1)
    hot_keys, hot_n = model.hot
    hot_words, hot_cells = KeyTable(hot_keys), model.cells.of(hot_keys)
    id_type = docs.schema["doc_id"].dataType

    def run(batches):
        for number, batch in enumerate(batches):
            id_column = batch.column(0)
            for first, n, keys, row in word_blocks(batch, 1):
                stream, row, ends = with_ends(n, keys, row)
                del keys
                place = hot_words.places(stream)
                hot = place >= 0
                cell = np.empty(len(stream), np.int32)
                cell[hot], cell[~hot] = hot_cells[place[hot]], lean.cells.of(stream[~hot])
                c = hot_n[place[hot]]
                logp, unknown = lean.log_probability(cell, *_contexts(cell, ends, len(lean.cells.share)))
                logp -= lean.log_rest(cell)
                logp[hot] += np.where(lean.cells.left[cell[hot]] > 0, np.log(c - lean.discount), 0.0)
                logp /= math.log(10)
                unknown /= math.log(10)
                sums = {"lm": np.bincount(row[hot], logp[hot], n), "n_tokens": np.bincount(row, minlength=n),
                        "n_known": np.bincount(row[hot], minlength=n),
                        "base": np.bincount(row[hot], np.log10(c + 1.0), n)}
                # One head row a document, then one row for each of its distinct words without a count so far.
                r_open, k_open = row[~hot], stream[~hot]
                order = np.lexsort((k_open, r_open))
                r_open, k_open = r_open[order], k_open[order]
                new = np.flatnonzero(np.append(True, (r_open[1:] != r_open[:-1]) | (k_open[1:] != k_open[:-1]))[:len(r_open)])
                times = np.diff(np.append(new, len(r_open)))
                lm, lm_unknown = (np.add.reduceat(x[~hot][order], new) if len(new) else np.zeros(0) for x in (logp, unknown))
                r_open, k_open = r_open[new], k_open[new]
                yield pa.RecordBatch.from_arrays(
                    [id_column.slice(first, n), pa.array(np.full(n, number)), pa.array(np.arange(first, first + n)),
                     pa.array(signed(mix64(np.arange(first, first + n, dtype=np.uint64)))), pa.array(np.ones(n, bool)),
                     pa.array(np.zeros(n, np.int64)), *(pa.array(sums[k]) for k in ("n_tokens", "n_known", "base", "lm")), pa.array(np.zeros(n))], schema=schema(id_column.type))
                for at in range(0, len(new), 1 << 16):
                    r, k, t, x, y = (v[at:at + (1 << 16)] for v in (r_open, k_open, times, lm, lm_unknown))
                    zero = np.zeros(len(r), np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(len(r), id_column.type), pa.array(np.full(len(r), number)), pa.array((r + first).astype(np.int64)), pa.array(signed(k)),
                         pa.array(np.zeros(len(r), bool)), pa.array(t), pa.array(zero), pa.array(zero), pa.array(zero.astype(float)), pa.array(x), pa.array(y)], schema=schema(id_column.type))

    def schema(id_arrow):
        return pa.schema([("doc_id", id_arrow), ("batch", pa.int64()), ("row", pa.int64()), ("key", pa.int64()), ("head", pa.bool_()), ("times", pa.int64()),
                          ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("lm", pa.float64()), ("lm_unknown", pa.float64())])

    rows = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type.simpleString()}, batch long, row long, key long, head boolean, times long, n_tokens long, n_known long, base double, lm double, lm_unknown double")
    rows = rows.withColumn("part", F.spark_partition_id())
    # Head rows look for a count too (under a spread key) and ignore what they find.
    found = rows.join(counts.select("key", F.col("n").alias("c")), "key", "left")
    c = F.when(~F.col("head"), F.coalesce("c", F.lit(0)))
    # A word that has a count here has no cell of its own, or would be among the hot words.
    inside = F.when(c > 0, F.col("lm") + F.col("times") * F.log10(c - model.discount)).otherwise(F.col("lm_unknown"))
    per = found.groupBy("part", "batch", "row").agg(
        F.max("doc_id").alias("doc_id"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(c > 0, F.col("times")).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + F.when(~F.col("head"), F.col("times") * F.log10(c + 1.0)).otherwise(0.0)).alias("base"),
        F.sum(F.when(F.col("head"), F.col("lm")).otherwise(inside)).alias("score"))
    return per.select("doc_id", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"),
                      (F.col("base") - F.col("n_tokens") * denominator).alias("base_score"), "score")


def score_folds(docs: DataFrame, folds: int = 7, held_out_fold: int = 2, params: LmParams = LmParams()) -> DataFrame:
    """Learn from the rows outside the held-out fold and score all."""
    held = id_remainder(F.col("doc_id"), folds) == held_out_fold
    return score(docs, fit(docs.where(~held), params)).withColumn("held_out", held)
