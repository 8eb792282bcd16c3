"""Prediction by partial matching over bytes: counting, frozen models as automata, and batch scoring.

Training counts every (context, next byte) of order 0 to ``depth`` in one pass: only the longest grams are
counted from text, shorter ones are sums of these. The contexts that occur most in a group become the states of its
automaton, whose state is the longest known context of the history. For each state the probability of
every byte is worked out once, with escapes (method C) down the chain of shorter contexts and exclusion
of the bytes that a longer context already offered, so scoring is one table lookup for each byte.

Where every context counts, no automaton is built: ``levels`` has the sums that the same escapes need for any part
of the gram table that holds whole contexts, and ``gram_logs`` works out single grams from them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm import textvec as tv
from strandlake.runtime import cut, drop

#: Bytes that UTF-8 never has: before a text starts, and after it ends.
BEFORE, END = 0xFE, 0xFF
#: Bytes of text handled at once, and symbols that one lane of the scoring loop takes.
BLOCK, LANE = 1 << 21, 256


def grams(data: np.ndarray, offsets: np.ndarray, depth: int) -> np.ndarray:
    """Keys of the ``depth`` bytes before each byte and that byte, for every byte of every row and its end."""
    rows, lens = len(offsets) - 1, np.diff(offsets)
    padded = np.full(len(data) + rows * (depth + 1), BEFORE, np.uint8)
    padded[np.arange(len(data)) + np.repeat(np.arange(rows) * (depth + 1) + depth, lens)] = tv.LOWER[data]
    padded[offsets[1:] + np.arange(1, rows + 1) * (depth + 1) - 1] = END
    key = np.zeros(len(padded) - depth, np.uint64)
    for j in range(depth + 1):
        key = (key << np.uint64(8)) | padded[j : j + len(key)]
    return key[padded[depth:] != BEFORE]


def count_contexts(keyed: DataFrame, depth: int, group: str, most: int) -> pa.Table:
    """``group, k, ctx, sym, n``: of summed gram counts ``(group, key, n)`` the contexts seen most in each group, at most ``most``, and their next bytes.

    Which these are is read from a histogram of their totals, so nothing is sorted or gathered; what comes to the
    driver is bounded by the groups and ``most``.
    """
    orders = F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.shiftrightunsigned("key", 8).bitwiseAND(F.lit((1 << (8 * k)) - 1).cast("bigint")).alias("ctx"))
        for k in range(depth + 1)
    ]))
    every = (
        keyed.select(group, F.col("key").bitwiseAND(F.lit(255).cast("bigint")).cast("int").alias("sym"), "n", orders.alias("o"))
        .groupBy(group, F.col("o.k").alias("k"), F.col("o.ctx").alias("ctx"), "sym").agg(F.sum("n").alias("n"))
    )
    trees = cut(every.groupBy(group, "k", "ctx").agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("sym", "n"))).alias("next")))
    bucket = F.floor(F.log2("total") * 16).cast("int")
    room: dict[str, int] = {}
    least: dict[str, int] = {}
    for name, b, size in sorted(map(tuple, trees.groupBy(group, bucket.alias("b")).count().collect()), key=lambda r: (r[0], -r[1])):
        if room.setdefault(name, most) >= size:
            least[name] = b
            room[name] -= size
        else:
            room[name] = -1
    if not least:
        return pa.table({group: pa.array([], pa.string()), **{c: pa.array([], pa.int64()) for c in ("k", "ctx", "sym", "n")}})
    floor = F.element_at(F.create_map(*[F.lit(x) for kv in least.items() for x in kv]), F.col(group))
    kept = trees.where(bucket >= floor).select(group, "k", "ctx", F.explode("next").alias("sym", "n")).toArrow()
    drop(trees)
    return kept


@dataclass
class Level:
    """Grams of one order and their counts, sorted; of each of their contexts the sum, the kinds, and the sum of its symbols in the next shorter context."""

    order: int
    gram: np.ndarray
    n: np.ndarray
    ctx: np.ndarray
    total: np.ndarray
    kinds: np.ndarray
    shorter: np.ndarray

    def count(self, keys: np.ndarray) -> np.ndarray:
        return _at(self.gram, self.n, keys)


def _at(known: np.ndarray, values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(keys))
    i = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[i] == keys, values[i], 0)


def levels(key: np.ndarray, n: np.ndarray, orders: range, below: Level | None = None) -> list[Level]:
    """Levels of ascending ``orders`` from gram counts; ``below`` is the level before the first, if it is not of order 0."""
    out = []
    for k in orders:
        gram, own = np.unique(key & ((1 << 8 * (k + 1)) - 1), return_inverse=True)
        count = np.bincount(own, n, len(gram))
        first = np.flatnonzero(np.diff(gram >> 8, prepend=-1))
        less = below.count(gram & ((1 << 8 * k) - 1)) if below is not None else np.zeros(len(gram))
        sums = [np.add.reduceat(x, first) if len(first) else x for x in (count, np.ones(len(gram)), less)]
        below = Level(k, gram, count, gram[first] >> 8, *sums)
        out.append(below)
    return out


def gram_logs(known: list[Level], key: np.ndarray) -> np.ndarray:
    """log10 probability of the last byte of each gram after the bytes before it; ``known`` has all orders from 0."""
    p, mass, done = np.zeros(len(key)), np.ones(len(key)), np.zeros(len(key), bool)
    gone, gone_kinds = np.zeros(len(key)), np.zeros(len(key))
    for level in reversed(known):
        ctx = (key >> 8) & ((1 << 8 * level.order) - 1)
        total, kinds = _at(level.ctx, level.total, ctx), _at(level.ctx, level.kinds, ctx)
        live, live_kinds = total - gone, kinds - gone_kinds
        whole = np.maximum(live + live_kinds, 1)
        n = level.count(key & ((1 << 8 * (level.order + 1)) - 1))
        hit = ~done & (n > 0)
        p[hit] = (mass * n / whole)[hit]
        done |= hit
        mass = np.where(live > 0, mass * live_kinds / whole, mass)
        gone, gone_kinds = _at(level.ctx, level.shorter, ctx), kinds
    return np.log10(np.where(done, p, mass / max(256 - len(known[0].gram), 1)))


@dataclass
class Automaton:
    """``sym``: class of each byte; ``move``: next state, flat; ``logp``: log10 probability, flat by (state, class), a column for each model."""

    sym: np.ndarray
    width: int
    move: np.ndarray
    logp: np.ndarray
    start: int
    depth: int


def _code(k: np.ndarray | int, ctx: np.ndarray) -> np.ndarray:
    return (np.asarray(k, np.int64) << 56) | np.asarray(ctx, np.int64)


def build(contexts: tuple[np.ndarray, np.ndarray], counts: tuple[np.ndarray, ...], models: int, depth: int) -> Automaton:
    """``contexts``: orders and keys; ``counts``: models, orders, keys, symbols and numbers. Contexts lacking a prefix or suffix are left out."""
    order, key = (np.asarray(x, np.int64) for x in contexts)
    kept = [np.zeros(1, np.int64)]
    for k in range(1, depth + 1):
        c = np.unique(key[order == k])
        inner = np.isin(c & ((1 << 8 * (k - 1)) - 1), kept[-1]) & np.isin(c >> 8, kept[-1])
        kept.append(c[inner])
    ctx = np.concatenate(kept)
    order = np.repeat(np.arange(depth + 1), [len(x) for x in kept])
    code = _code(order, ctx)
    place = lambda k, c: np.searchsorted(code, _code(k, c))
    model, k_of, ctx_of, symbol, number = (np.asarray(x, np.int64) for x in counts)
    seen = np.unique(symbol)
    sym = np.zeros(256, np.int32)
    sym[seen] = np.arange(1, len(seen) + 1)
    width, unseen = len(seen) + 1, 256 - len(seen)
    suffix = np.zeros(len(code), np.int64)
    move = np.zeros((len(code), width), np.int32)
    for k in range(depth + 1):
        own = np.flatnonzero(order == k)
        if k and len(own):
            suffix[own] = place(k - 1, ctx[own] & ((1 << 8 * (k - 1)) - 1))
            move[own] = move[suffix[own]]
        longer = np.flatnonzero((order == k + 1) & (sym[ctx & 255] > 0))
        if len(longer):
            move[place(k, ctx[longer] >> 8), sym[ctx[longer] & 255]] = longer
    logp = np.empty((len(code), width, models), np.float32)
    spot = np.minimum(place(k_of, ctx_of), len(code) - 1)
    inside = code[spot] == _code(k_of, ctx_of)
    for m in range(models):
        c = np.zeros((len(code), width))
        own = inside & (model == m)
        np.add.at(c, (spot[own], sym[symbol[own]]), number[own])
        for lo in range(0, len(code), 2048):
            chain = np.arange(lo, min(lo + 2048, len(code)))
            p, mass = np.zeros((len(chain), width)), np.ones(len(chain))
            gone = np.zeros((len(chain), width), bool)
            gone[:, 0] = True
            for _ in range(depth + 1):
                live = np.where(gone, 0, c[chain])
                total, kinds = live.sum(1), (live > 0).sum(1)
                whole = np.maximum(total + kinds, 1)
                p += (mass / whole)[:, None] * live
                mass = np.where(total > 0, mass * kinds / whole, mass)
                gone |= live > 0
                chain = suffix[chain]
            rest = (~gone).sum(1) + max(unseen, 0)
            each = mass / np.maximum(rest, 1)
            p = np.where(gone, p, p + each[:, None])
            p[:, 0] = each
            logp[lo : lo + len(chain), :, m] = np.log10(np.maximum(p, 1e-300))
    begin = [(k, int.from_bytes(bytes([BEFORE]) * k, "big")) for k in range(depth + 1)]
    start = max(int(i) for k, c in begin if (i := place(k, c)) < len(code) and code[i] == _code(k, c))
    return Automaton(sym, width, move.ravel(), np.ascontiguousarray(logp.reshape(-1, models)), start, depth)


def score_rows(a: Automaton, data: np.ndarray, offsets: np.ndarray, with_end: bool) -> np.ndarray:
    """Sums of log10 probabilities of each row (rows x models): all rows run through the automaton side by side, in lanes."""
    out = np.zeros((len(offsets) - 1, a.logp.shape[1]))
    for i, j in tv.blocks(offsets, BLOCK):
        off = offsets[i : j + 1] - offsets[i]
        raw = tv.LOWER[data[offsets[i] : offsets[j]]]
        if with_end:
            lens = np.diff(off)
            ended = np.full(len(raw) + len(lens), END, np.uint8)
            ended[np.arange(len(raw)) + np.repeat(np.arange(len(lens)), lens)] = raw
            raw, off = ended, off + np.arange(len(off))
        out[i:j] = _score_block(a, a.sym[raw], off)
    return out


def _score_block(a: Automaton, s: np.ndarray, off: np.ndarray) -> np.ndarray:
    lens = np.diff(off)
    pieces = -(-lens // LANE)
    row = np.repeat(np.arange(len(lens)), pieces)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    at = off[row] + nth * LANE
    size = np.minimum(LANE, off[row + 1] - at)
    order = np.argsort(-size, kind="stable")
    row, nth, at, size = row[order], nth[order], at[order], size[order]
    state = np.where(nth == 0, a.start, 0).astype(np.int32)
    later = np.flatnonzero(nth > 0)
    for j in range(a.depth):
        state[later] = a.move[state[later] * a.width + s[at[later] - a.depth + j]]
    total = np.zeros((len(row), a.logp.shape[1]))
    live = len(row) - np.searchsorted(size[::-1], np.arange(int(size.max(initial=0))), "right")
    for j, n in enumerate(live):
        cell = state[:n] * a.width + s[at[:n] + j]
        total[:n] += a.logp[cell]
        state[:n] = a.move[cell]
    out = np.zeros((len(lens), a.logp.shape[1]))
    np.add.at(out, row, total)
    return out
