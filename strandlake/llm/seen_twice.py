"""A fixed-size filter of the 64-bit keys that occur more than once, made without gathering keys.

Joins on signatures first count keys alone (narrow rows). Keys counted twice or more set
bits of one bitmap of fixed size, which is small enough to broadcast whatever the corpus; the second pass then
emits only keys that may recur. When the corpus outgrows the bitmap it lets more keys through, never fewer.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of 64 bits in the bitmap (a power of two): 16 MB.
WORDS = 1 << 21
_SHIFTS = (0, 29)
#: Packed keys that meet in one group, about.
PACKED = 500_000


def recurring(keys: DataFrame, key: str) -> Broadcast:
    """The bitmap of the keys that ``keys`` holds in two or more rows.

    Almost all keys are distinct, so they are dealt as they are, not combined before; callers send a key
    that recurs within a batch no more than twice, which keeps even the commonest key short.
    """
    twice = keys.repartition(key).groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    bits = (1 << 27) - 1
    spots = F.explode(F.array(*[F.shiftrightunsigned(key, s).bitwiseAND(F.lit(bits)).cast("int") for s in _SHIFTS]))
    words = twice.select(spots.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, bit & 63)")).alias("set"))
    found = words.toArrow()
    bitmap = np.zeros(WORDS, np.uint64)
    bitmap[found.column("word").to_numpy()] = found.column("set").to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(bitmap)


def may_recur(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For each key (as 64-bit integers) whether it may occur more than once; never false for one that does."""
    k, ok = keys.view(np.uint64), np.ones(len(keys), bool)
    for s in _SHIFTS:
        bit = (k >> np.uint64(s)) & np.uint64((1 << 27) - 1)
        ok &= ((bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1)).astype(bool)
    return ok


def _spots(keys: np.ndarray) -> np.ndarray:
    return (keys.view(np.uint64) >> np.uint64(37)).astype(np.int64)


def packed(key: np.ndarray, doc: np.ndarray, asks: np.ndarray, parts: int) -> pa.RecordBatch:
    """``part, key, doc, asks``: keys, who holds them and whether they ask for others, packed by the part of the bitmap (a power of two of them) they fall in."""
    part = _spots(key) // (64 * WORDS // parts)
    order = np.argsort(part, kind="stable")
    edge = np.concatenate(([0], np.cumsum(np.bincount(part, minlength=parts))))
    full = np.flatnonzero(np.diff(edge))
    cols = [pa.array([c[edge[p] : edge[p + 1]].tobytes() for p in full], pa.binary()) for c in (key[order], doc[order], asks[order])]
    return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), *cols], names=["part", "key", "doc", "asks"])


def parts_of(keys: int) -> int:
    """Parts of the bitmap such that about ``PACKED`` of so many keys fall in each."""
    parts = 8
    while parts < 4096 and parts * PACKED < keys:
        parts *= 2
    return parts


def packs(found: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]], parts: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``packed`` of about ``PACKED`` keys each."""
    held, n = [], 0
    for one in found:
        held.append(one)
        n += len(one[0])
        if n >= PACKED:
            yield packed(*(np.concatenate(c) for c in zip(*held, strict=True)), parts)
            held, n = [], 0
    if n:
        yield packed(*(np.concatenate(c) for c in zip(*held, strict=True)), parts)


def bits_of(t: pa.Table, each: int) -> pa.Table:
    """``part, bits``: a part of the bitmap of ``asked``, of ``each`` words, from all its rows of ``packed``."""
    key, doc, asks = (np.frombuffer(b"".join(t.column(c).to_pylist()), kind) for c, kind in (("key", np.int64), ("doc", np.int64), ("asks", bool)))
    order = np.argsort(key, kind="stable")
    key, doc, asks = key[order], doc[order], asks[order]
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    least, last = np.minimum.reduceat(doc, new), np.maximum.reduceat(np.where(asks, doc, np.iinfo(np.int64).min), new)
    spots = _spots(key[new[last > least]])
    bits = np.zeros(each, np.uint64)
    part = t.column("part")[0].as_py()
    np.bitwise_or.at(bits, (spots >> 6) - part * each, np.uint64(1) << (spots & 63).astype(np.uint64))
    return pa.table({"part": pa.array([part], pa.int32()), "bits": pa.array([bits.tobytes()], pa.binary())})


def asked(packs: DataFrame, parts: int) -> Broadcast:
    """The bitmap of the keys that someone asks for and someone earlier (of a smaller id) holds, made of rows of ``packed``."""
    each = WORDS // parts
    found = packs.groupBy("part").applyInArrow(lambda t: bits_of(t, each), "part int, bits binary").toArrow()
    bitmap = np.zeros(WORDS, np.uint64)
    for part, bits in zip(found.column("part").to_pylist(), found.column("bits").to_pylist(), strict=True):
        bitmap[part * each : (part + 1) * each] = np.frombuffer(bits, np.uint64)
    return packs.sparkSession.sparkContext.broadcast(bitmap)


def may_be_asked(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For each key whether it may be in a bitmap of ``asked``; never false for one that is."""
    at = _spots(keys)
    return ((bitmap[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
