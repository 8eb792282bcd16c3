"""Repeated passages across documents: exact runs by hashed windows, fuzzy ones by collinear chaining of shared seeds.

Winnowed word k-mers are the seeds. Each seed that several documents hold is first matched with its first holder only
(smallest id), so a seed of any number of holders gives as many matches as holders. The matches of a pair of
documents are chained in order with linear gap costs by a Fenwick tree of prefix maxima; the words of the chained spans,
cut from both documents in small blocks, are then aligned: along the diagonal of each anchor, through an edit
script between diagonals, and outwards while matches outweigh mismatches. Passages of at least ``MIN_WORDS``
words and an identity of at least ``IDENTITY`` are reported, each with the earlier document that has it.

The first holders of the seeds of a passage may each hold a piece of it only. So every run of ``MIN_WORDS`` words that
several documents hold is also matched with the first holder of the run itself, whatever else holds its seeds: no word of an
exact repeat of ``MIN_WORDS`` is left out, and every document with the run is linked with the run's first holder, unless a passage of
the same two documents has it already.

Repeats with edits in every such run are found by links: two shared seeds that can follow each other in a chain. Documents with a common
chain have a common link. Where a shared seed of a document is in no passage yet, the links around it are matched with their first holder, and
those still open then with all earlier holders, by all seeds that the two documents share. So no seed is left out because the first document
with it has only a piece of the passage. Links of more than ``OFTEN`` holders (lines of fewer than ``MIN_WORDS`` words that very many documents hold) are
asked for together with the end of the passage or a third seed. Copies of a passage are linked with an earlier holder each, not all with all.

Defined cases: null, empty and short texts have no passages; very long texts are read whole; rows with equal ids are one document (callers
whose rows are documents of their own number them first); exact copies repeat their first document as a whole; of several places of a run in
its first holder the first counts; repeats within one document are left; extra columns are ignored; an empty table gives an empty
result; rows with a null id take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandlake.llm import seen_twice
from strandlake.llm import textvec as tv
from strandlake.runtime import bounded_batches, cut, drop, giving_back, hinted, hot_keys, release, rows_with, together

#: Words of a seed, seeds in a winnowing window, least words and identity of a passage, widest gap in a chain, words of a block.
K, WINDOW, MIN_WORDS, IDENTITY, MAX_GAP, PIECE = 5, 16, 50, 0.8, 40, 128
#: Holders of a link up to which all are compared because of the link alone.
OFTEN = 100
#: Links of a seed, about: the seeds after it within ``MAX_GAP``.
LINKS = 5
#: Words within which an equal seed counts as a periodic stretch going on.
REPEAT = 64
#: Gap cost of a word, score of a match and a mismatch in extensions, and the drop at which they end.
GAP_COST, MATCH, MISMATCH, DROP = 0.05, 1, -2, 10
MARGIN = WINDOW + K + DROP
#: Words of the marks of runs: of any run of ``MIN_WORDS`` words the least of its ``WINDOW`` hashes of so many words is its mark.
MARK = MIN_WORDS - WINDOW + 1
#: Base of the rolling hash (odd) and its inverse modulo 2 ** 64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def winnow(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the seeds: the least k-mer of every window.

    A k-mer that recurs within ``REPEAT`` words belongs to a periodic stretch: it is told apart by its distance from the
    stretch's first occurrence, and kept once for each window, so stretches of the same period are matched in order.
    """
    h = tv.shingle_hashes(words, K)
    w = min(WINDOW, len(h))
    at = np.unique(np.lib.stride_tricks.sliding_window_view(h, w).argmin(1) + np.arange(len(h) - w + 1))
    h = h[at]
    order = np.lexsort((at, h))
    h, at = h[order], at[order]
    again = np.concatenate(([False], (h[1:] == h[:-1]) & (at[1:] - at[:-1] <= REPEAT)))
    if again.any():
        first = np.maximum.accumulate(np.where(again, 0, np.arange(len(at))))
        far = at - at[first]
        keep = ~again | (far // WINDOW != np.concatenate(([0], far[:-1])) // WINDOW)
        h = np.where(again, tv.mix(h + far.astype(np.uint64)), h)[keep]
        at = at[keep]
    order = np.argsort(at, kind="stable")
    return h[order], at[order]


def _words(b: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For blocks of rows: the first row, the hashes of all words, and where the words of each row begin."""
    data, off = tv.string_bytes(b.column("text"))
    for i, j in tv.blocks(off, 1 << 21):
        low, o = tv.LOWER[data[off[i] : off[j]]], off[i : j + 1] - off[i]
        starts, ends, first = tv.word_spans(low, o, tv.SPACE)
        yield i, tv.word_hashes(low, starts, ends), first


def _recurring_keys(docs: DataFrame) -> DataFrame:
    """``key``: the seeds of every document and the marks of its runs; one that recurs in a block has two rows of it, for no more is asked than whether it recurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, words, first in _words(b):
                own = [np.unique(winnow(words[first[r] : first[r + 1]])[0]) for r in np.flatnonzero(np.diff(first) >= MIN_WORDS)]
                if not own:
                    continue
                row, at, mark = _marked(words, first)
                mark = mark[np.concatenate(([True], (mark[1:] != mark[:-1]) | (row[1:] != row[:-1])))]
                for keys in (np.concatenate(own), mark):
                    u, n = np.unique(keys, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(u, np.minimum(n, 2)).view(np.int64))], names=["key"])

    return docs.mapInArrow(giving_back(run), "key bigint")


def _seed_rows(docs: DataFrame, bitmap: Broadcast) -> DataFrame:
    """``seed, doc, at, fresh``: the seeds of every document that may be held by another one too; the first place of a seed in a document is fresh."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id").to_numpy()
            for i, words, first in _words(b):
                seeds, at, who, new = [], [], [], []
                for r in np.flatnonzero(np.diff(first) >= MIN_WORDS):
                    h, p = winnow(words[first[r] : first[r + 1]])
                    may = seen_twice.may_recur(bitmap.value, h)
                    h, p = h[may], p[may]
                    fresh = np.zeros(len(h), bool)
                    fresh[np.unique(h, return_index=True)[1]] = True
                    seeds.append(h)
                    at.append(p)
                    new.append(fresh)
                    who.append(np.full(len(h), ids[i + r]))
                if seeds:
                    cols = [pa.array(np.concatenate(seeds).view(np.int64)), pa.array(np.concatenate(who)), pa.array(np.concatenate(at).astype(np.int32)), pa.array(np.concatenate(new))]
                    yield pa.RecordBatch.from_arrays(cols, names=["seed", "doc", "at", "fresh"])

    return docs.mapInArrow(giving_back(run), "seed bigint, doc bigint, at int, fresh boolean")


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of whole groups: rows with equal values of the first ``keys`` columns, which come sorted."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(i).to_numpy() for i in range(keys)]
        change = np.zeros(b.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        if held:
            last = held[-1]
            change[0] = any(last.column(i)[last.num_rows - 1].as_py() != c[0].item() for i, c in enumerate(cols))
        starts = np.flatnonzero(change)
        if not len(starts):
            held.append(b)
            continue
        if held or starts[-1]:
            yield pa.Table.from_batches([*held, b.slice(0, int(starts[-1]))])
        held = [b.slice(int(starts[-1]))]
    if held:
        yield pa.Table.from_batches(held)


class PrefixMax:
    """A Fenwick tree of prefix maxima, each with the item that has it."""

    def __init__(self, n: int):
        self.best, self.item = [-1e18] * (n + 1), [-1] * (n + 1)

    def put(self, i: int, value: float, item: int) -> None:
        i += 1
        while i < len(self.best):
            if value > self.best[i]:
                self.best[i], self.item[i] = value, item
            i += i & -i

    def get(self, n: int) -> tuple[float, int]:
        """The greatest of the first ``n`` places."""
        value, item = -1e18, -1
        while n > 0:
            if self.best[n] > value:
                value, item = self.best[n], self.item[n]
            n -= n & -n
        return value, item


def chain(a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
    """Collinear chains of the matches, sorted by ``b``, then ``a``; each as the places of its matches in order."""
    n = len(a)
    if n > 1 and (np.diff(a) > 0).all() and (np.diff(b) > 0).all():
        before = np.arange(-1, n - 1)  # with linear costs the best predecessor in one increasing run is the one before
    else:
        rank = np.unique(a, return_inverse=True)[1]
        tree, score, before = PrefixMax(int(rank.max()) + 1), [0.0] * n, np.full(n, -1)
        i = 0
        while i < n:
            j = i
            while j < n and b[j] == b[i]:
                j += 1
            for x in range(i, j):
                value, prior = tree.get(int(rank[x]))
                gain = value - GAP_COST * float(a[x] + b[x])
                score[x] = K + max(0.0, gain)
                before[x] = prior if gain > 0 else -1
            for x in range(i, j):
                tree.put(int(rank[x]), score[x] + GAP_COST * float(a[x] + b[x]), x)
            i = j
        order = sorted(range(n), key=lambda x: -score[x])
        used = np.zeros(n, bool)
        taken = np.full(n, -2)
        for x in order:  # strongest chains first; a match belongs to one chain
            while x >= 0 and not used[x]:
                used[x] = True
                nxt = before[x]
                taken[x] = nxt if nxt >= 0 and not used[nxt] else -1
                x = nxt
        before = taken
    far = (before >= 0) & (np.maximum(a - a[before], b - b[before]) > MAX_GAP)
    before = np.where(far, -1, before)
    chains: list[list[int]] = []
    where: dict[int, int] = {}
    for x in range(n):
        p = int(before[x])
        if p >= 0 and p in where and chains[where[p]][-1] == p:
            where[x] = where[p]
            chains[where[x]].append(x)
        else:
            where[x] = len(chains)
            chains.append([x])
    return [np.array(c) for c in chains]


def _chain_rows(matches: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 2):
            doc, src, b, a = (t.column(c).to_numpy() for c in ("doc", "src", "b", "a"))
            edge = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (src[1:] != src[:-1]), [True])))
            out: list[list] = [[], [], [], [], []]
            for i, j in zip(edge[:-1], edge[1:], strict=True):
                if j - i < 2:
                    continue
                for k, c in enumerate(chain(a[i:j], b[i:j])):
                    ca, cb = a[i:j][c], b[i:j][c]
                    if len(c) >= 2 and cb[-1] - cb[0] + K + 2 * MARGIN >= MIN_WORDS:
                        for o, v in zip(out, (doc[i], src[i], k, ca, cb), strict=True):
                            o.append(v)
            if out[0]:
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(o, k) for o, k in zip(out, kinds, strict=True)], names=["doc", "src", "no", "a", "b"])

    return matches.mapInArrow(giving_back(run), "doc bigint, src bigint, no int, a array<int>, b array<int>")


def _piece_rows(docs: DataFrame) -> DataFrame:
    """Word hashes (32 bits) of each document in blocks of ``PIECE`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = tv.string_bytes(b.column("text"))
            ids = b.column("doc_id").to_numpy()
            for i, j in tv.blocks(off, 1 << 21):
                low, o = tv.LOWER[data[off[i] : off[j]]], off[i : j + 1] - off[i]
                starts, ends, first = tv.word_spans(low, o, tv.SPACE)
                words = (tv.word_hashes(low, starts, ends) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                who, no, raw = [], [], []
                for r in range(j - i):
                    own = words[first[r] : first[r + 1]]
                    for p in range(0, len(own), PIECE):
                        who.append(ids[i + r])
                        no.append(p // PIECE)
                        raw.append(own[p : p + PIECE].tobytes())
                if who:
                    yield pa.RecordBatch.from_arrays([pa.array(who, pa.int64()), pa.array(no, pa.int32()), pa.array(raw, pa.binary())], names=["id", "piece", "words"])

    return docs.mapInArrow(giving_back(run), "id bigint, piece int, words binary")


def _script(x: np.ndarray, y: np.ndarray) -> int:
    """Most words that two short runs have in common, in order."""
    if not len(x) or not len(y):
        return 0
    last = np.zeros(len(y) + 1, int)
    for w in x:
        now = np.concatenate(([0], np.where(y == w, last[:-1] + 1, last[1:])))
        last = np.maximum.accumulate(now)
    return int(last[-1])


def _grow(x: np.ndarray, y: np.ndarray) -> tuple[int, int]:
    """Words taken, and equal ones among them, from the start of two runs while the score is within DROP of its best."""
    n = min(len(x), len(y))
    if not n:
        return 0, 0
    same = x[:n] == y[:n]
    score = np.cumsum(np.where(same, MATCH, MISMATCH))
    ended = np.flatnonzero(np.maximum.accumulate(np.maximum(score, 0)) - score > DROP)
    score = score[: ended[0]] if len(ended) else score
    if not len(score) or score.max() <= 0:
        return 0, 0
    best = int(score.argmax()) + 1
    return best, int(same[:best].sum())


def align(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[int, int, int, int, float]:
    """``a0, a1, b0, b1, identity`` of the passage around the anchors ``x[a[i]] = y[b[i]]``."""
    same, i = 0, 0
    while i < len(a):
        j = i
        while j + 1 < len(a) and a[j + 1] - b[j + 1] == a[i] - b[i]:
            j += 1
        stop = a[j] + K
        same += int((x[a[i] : stop] == y[b[i] : stop - a[i] + b[i]]).sum())
        if j + 1 < len(a):
            end_a, end_b = a[j] + K, b[j] + K
            na, nb = a[j + 1], b[j + 1]
            over = max(0, end_a - na, end_b - nb)  # anchors of two diagonals may overlap
            same += _script(x[end_a:na], y[end_b:nb]) - over
        i = j + 1
    left, left_same = _grow(x[: a[0]][::-1], y[: b[0]][::-1])
    right, right_same = _grow(x[a[-1] + K :], y[b[-1] + K :])
    a0, a1, b0, b1 = int(a[0] - left), int(a[-1] + K + right), int(b[0] - left), int(b[-1] + K + right)
    return a0, a1, b0, b1, (same + left_same + right_same) / max(a1 - a0, b1 - b0)


def _aligned(parts: DataFrame) -> DataFrame:
    schema = "doc_id bigint, source_id bigint, start_word int, end_word int, source_start int, source_end int, identity double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 3):
            doc, src, no, side, piece = (t.column(c).to_numpy() for c in ("doc", "src", "no", "side", "piece"))
            change = (doc[1:] != doc[:-1]) | (src[1:] != src[:-1]) | (no[1:] != no[:-1])
            edge = np.flatnonzero(np.concatenate(([True], change, [True])))
            words, out = t.column("words"), []
            for i, j in zip(edge[:-1], edge[1:], strict=True):
                runs = []
                for s in (0, 1):
                    own = [q for q in range(i, j) if side[q] == s]
                    base = int(piece[own[0]]) * PIECE if own else 0
                    runs.append((np.frombuffer(b"".join(words[q].as_py() for q in own), np.uint32), base))
                (x, xo), (y, yo) = runs
                a = np.array(t.column("a")[i].as_py()) - xo
                b = np.array(t.column("b")[i].as_py()) - yo
                if not len(x) or not len(y) or a[-1] + K > len(x) or b[-1] + K > len(y):
                    continue
                a0, a1, b0, b1, identity = align(x, y, a, b)
                if b1 - b0 >= MIN_WORDS and a1 - a0 >= MIN_WORDS * IDENTITY and identity >= IDENTITY:
                    out.append((doc[i], src[i], b0 + yo, b1 + yo, a0 + xo, a1 + xo, identity))
            if out:
                kinds = (pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.float64())
                names = ["doc_id", "source_id", "start_word", "end_word", "source_start", "source_end", "identity"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return parts.mapInArrow(giving_back(run), schema)


def _rolled(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words by differences of one running sum."""
    n = len(words)
    if n < k:
        return np.zeros(0, np.uint64)
    power, back = np.full(n, np.uint64(BASE)), np.full(n, np.uint64(INVERSE))
    power[0] = back[0] = 1
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * np.cumprod(power))))
    return tv.mix((sums[k:] - sums[:-k]) * np.cumprod(back)[: n - k + 1] + np.uint64(k))


def _marked(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, place among all words and mark of every run of ``MIN_WORDS`` words inside a row."""
    at = np.arange(max(0, len(words) - MIN_WORDS + 1))
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))[: len(at)]
    inside = at + MIN_WORDS <= first[row + 1]
    if not inside.any():
        return row[:0], at[:0], np.zeros(0, np.uint64)
    marks = _rolled(words, MARK)
    mark = marks[np.lib.stride_tricks.sliding_window_view(marks, WINDOW).argmin(1) + at]
    return row[inside], at[inside], mark[inside]


def exact_runs(docs: DataFrame, bitmap: Broadcast) -> DataFrame:
    """``doc_id, source_id, start_word, end_word, source_start, source_end``: the longest runs whose every ``MIN_WORDS`` words have the source as first holder."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id").to_numpy()
            for i, words, first in _words(b):
                row, at, mark = _marked(words, first)
                may = seen_twice.may_recur(bitmap.value, mark)
                if may.any():
                    row, at = row[may], at[may]
                    cols = [pa.array(_rolled(words, MIN_WORDS)[at].view(np.int64)), pa.array(ids[row + i]), pa.array((at - first[row]).astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(cols, names=["run", "doc", "at"])

    def with_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_src, last_a = None, 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            h, doc, at = (b.column(c).to_numpy() for c in ("run", "doc", "at"))
            new = np.concatenate(([h[0] != last], h[1:] != h[:-1]))
            head = np.maximum.accumulate(np.where(new, np.arange(len(h)), -1))
            src, a = np.where(head < 0, last_src, doc[head]), np.where(head < 0, last_a, at[head]).astype(np.int32)
            last, last_src, last_a = h[-1], src[-1], a[-1]
            other = doc != src
            if other.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[other]) for x in (doc, src, at, a)], names=["doc", "src", "b", "a"])

    found = together(docs.mapInArrow(giving_back(windows), "run bigint, doc bigint, at int"), "run").sortWithinPartitions("run", "doc", "at")
    found = found.mapInArrow(giving_back(with_first), "doc bigint, src bigint, b int, a int").withColumn("off", F.col("b") - F.col("a"))
    nth = F.dense_rank().over(W.partitionBy("doc", "src", "off").orderBy("b"))
    runs = found.withColumn("stretch", F.col("b") - nth).groupBy("doc", "src", "off", "stretch").agg(F.min("b").alias("b0"), F.max("b").alias("b1"))
    return runs.select(
        F.col("doc").alias("doc_id"), F.col("src").alias("source_id"), F.col("b0").alias("start_word"), (F.col("b1") + MIN_WORDS).alias("end_word"),
        (F.col("b0") - F.col("off")).alias("source_start"), (F.col("b1") - F.col("off") + MIN_WORDS).alias("source_end"),
    )


def _needed(runs: DataFrame) -> DataFrame:
    """Of the runs of a pair of documents those that others of the pair do not cover together: periodic stretches have one for each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 2):
            doc, src, start, end = (t.column(c).to_numpy() for c in ("doc_id", "source_id", "start_word", "end_word"))
            keep: list[int] = []
            pair, covered, best = None, -1, -1
            for x in range(len(doc)):  # by start; of the runs that begin within what is covered the one that reaches farthest
                if (doc[x], src[x]) != pair or (best >= 0 and start[x] > covered):
                    keep += [best] if best >= 0 else []
                    covered = end[best] if best >= 0 and (doc[x], src[x]) == pair else -1
                    pair, best = (doc[x], src[x]), -1
                if start[x] > covered:
                    keep.append(x)
                    covered = end[x]
                elif end[x] > covered and (best < 0 or end[x] > end[best]):
                    best = x
            keep += [best] if best >= 0 else []
            yield from t.take(pa.array(keep, pa.int64())).combine_chunks().to_batches()

    return together(runs, "doc_id", "source_id").sortWithinPartitions("doc_id", "source_id", "start_word", F.desc("end_word")).mapInArrow(giving_back(run), runs.schema)


def passages(docs: DataFrame) -> DataFrame:
    """``doc_id, source_id, start_word, end_word, source_start, source_end, identity, n_words``: passages that an earlier document has."""
    bounded_batches(docs.sparkSession)
    base = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bitmap = seen_twice.recurring(_recurring_keys(base), "key")
    release(docs.sparkSession)
    shared = _shared_seeds(base, bitmap)
    release(docs.sparkSession)
    matches = shared.where("doc <> src").select("doc", "src", F.col("at").alias("b"), F.col("first").alias("a"))
    found = cut(_fuzzy(base, matches))
    release(docs.sparkSession)
    found = cut(found.union(_needed(_beyond(exact_runs(base, bitmap), found)).withColumn("identity", F.lit(1.0))))
    release(docs.sparkSession)
    tried = None
    for pairs in (_first_of_links, _all_of_links):  # what the first holders of links cover is not asked of the others
        links = cut(_links(shared, found))
        release(docs.sparkSession)
        asked = pairs(base, links)
        asked = cut(asked if tried is None else asked.join(tried, ["doc", "src"], "left_anti"))
        tried = asked
        if not asked.isEmpty():
            found = cut(found.union(_beyond(_fuzzy(base, _matches_of(shared, asked)), found)))
        drop(links)
        release(docs.sparkSession)
    return found.select("*", (F.col("end_word") - F.col("start_word")).cast("bigint").alias("n_words"))


def _beyond(more: DataFrame, found: DataFrame) -> DataFrame:
    """Passages that no found one of the same two documents holds. One of another source does not stand for them: each pair is a link of its own."""
    held = found.select(F.col("doc_id").alias("id"), F.col("source_id").alias("of"), F.col("start_word").alias("lo"), F.col("end_word").alias("hi"))
    return more.join(held, (more.doc_id == held.id) & (more.source_id == held.of) & (held.lo <= more.start_word) & (held.hi >= more.end_word), "left_anti")


def _shared_seeds(base: DataFrame, bitmap: Broadcast) -> DataFrame:
    """``doc, at, seed, src, first``: every place of the seeds that several documents hold, with the first holder and its first place."""
    seeds = cut(_seed_rows(base, bitmap))
    shared = seeds.where("fresh").groupBy("seed").agg(F.min("doc").alias("src"), F.max("doc").alias("last"), F.min_by("at", "doc").alias("first"))
    out = cut(seeds.select("doc", "at", "seed").join(shared.where("src <> last").drop("last"), "seed").select("doc", "at", "seed", "src", "first"))
    drop(seeds)
    return out


def _following(place: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """Seeds and by how many seeds another one comes after them, within ``MAX_GAP`` words."""
    for k in range(1, MAX_GAP + 1):
        near = np.flatnonzero(place[k:] - place[:-k] <= MAX_GAP)
        if not len(near):
            return
        yield near, k


def _joint(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hashes of pairs in order."""
    return (tv.mix(tv.mix(x) * np.uint64(BASE) + y)).view(np.int64)


def _links(shared: DataFrame, found: DataFrame) -> DataFrame:
    """``key, doc, open``: pairs of shared seeds that can follow each other in a chain; in open ones, or between their seeds, a shared seed is outside the passages found so far.

    A chain has two seeds at least, in both documents in order and within ``MAX_GAP``, so documents without a common link have no common chain.
    Few links are open in one document and held by an earlier one: their keys travel packed first, and only what may be one of these becomes a row.
    """
    spans = found.select(F.col("doc_id").alias("doc"), F.lit(0).alias("kind"), F.col("start_word").alias("at"), F.col("end_word").cast("bigint").alias("seed"))
    rows = shared.select("doc", F.lit(1).alias("kind"), "at", "seed").union(spans)
    rows = together(rows, "doc").sortWithinPartitions("doc", "kind", "at")
    parts = seen_twice.parts_of(LINKS * shared.count())

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for t in _groups(batches, 1):
            doc, kind, at, seed = (t.column(c).to_numpy() for c in ("doc", "kind", "at", "seed"))
            base = np.cumsum(np.concatenate(([0], doc[1:] != doc[:-1]))) << 32  # places of all documents along one line
            span = kind == 0
            lo, hi = (base + at)[span], np.maximum.accumulate((base + seed)[span])
            begin = np.flatnonzero(np.concatenate(([True], lo[1:] > hi[:-1]))) if len(lo) else np.zeros(0, int)
            lo, hi = lo[begin], hi[np.concatenate((begin[1:] - 1, [len(hi) - 1]))] if len(lo) else hi
            doc, place, h = doc[~span], (base + at)[~span], seed[~span].view(np.uint64)
            i = np.searchsorted(lo, place, "right") - 1
            free = (i < 0) | (place + K > hi[i]) if len(lo) else np.ones(len(place), bool)
            freed = np.concatenate(([0], np.cumsum(free)))
            for near, k in _following(place):
                yield _joint(h[near], h[near + k]), doc[near], freed[near + k + 1] > freed[near]

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return seen_twice.packs(links(batches), parts)

    bitmap = seen_twice.asked(rows.mapInArrow(giving_back(keys), "part int, key binary, doc binary, asks binary"), parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, own, is_open in links(batches):
            may = seen_twice.may_be_asked(bitmap.value, key)
            if may.any():
                yield pa.RecordBatch.from_arrays([pa.array(key[may]), pa.array(own[may]), pa.array(is_open[may])], names=["key", "doc", "open"])

    few = rows.mapInArrow(giving_back(run), "key bigint, doc bigint, open boolean")
    return few.groupBy("key", "doc").agg(F.bool_or("open").alias("open"))


def _first_of_links(base: DataFrame, links: DataFrame) -> DataFrame:
    """``doc, src``: documents and the first holders of their open links."""
    first = links.groupBy("key").agg(F.min("doc").alias("src"), F.max(F.when(F.col("open"), F.col("doc"))).alias("last")).where("last > src")
    return links.where("open").join(first.select("key", "src"), "key").where("doc > src").select("doc", "src").distinct()


def _all_of_links(base: DataFrame, links: DataFrame) -> DataFrame:
    """``doc, src``: documents and all earlier holders of their open links, of links with more than ``OFTEN`` holders those that may have a passage along it."""
    holders = links.groupBy("key").agg(F.min("doc").alias("least"), F.max(F.when(F.col("open"), F.col("doc"))).alias("last"), F.count("*").alias("n")).where("last > least")
    of = cut(links.join(holders.drop("least"), "key"))
    asked = _asking(of.where(F.col("n") <= OFTEN))
    often = of.where(F.col("n") > OFTEN)
    if often.isEmpty():
        return asked
    keys = often.groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list("key").alias("keys"), F.collect_list("open").alias("open"))
    around = cut(_around(base.join(hinted(keys), "doc_id"), often.count()))
    last = around.groupBy("key").agg(F.min("doc").alias("least"), F.max(F.when(F.col("asks"), F.col("doc"))).alias("last"), F.count("*").alias("n")).where("last > least")
    of = cut(around.join(last.drop("least"), "key"))
    one, three = of.where("nth >= 0"), of.where("nth < 0")
    return asked.union(_askers(_cheapest(one), one)).union(_askers(three.where("long"), three)).union(_askers(three.where("not long"), three.where("long"))).distinct()


def _asking(of: DataFrame) -> DataFrame:
    """``doc, src``: documents with open links of few holders, with their earlier holders. Links of one line have much the same pairs, which become rows once for each document."""
    holders = of.where("doc < last").groupBy("key").agg(F.collect_list("doc").alias("srcs"))  # at most OFTEN
    srcs = F.array_distinct(F.flatten(F.collect_list(F.filter("srcs", lambda x: x < F.col("doc")))))
    return of.where("open").select("key", "doc").join(holders, "key").groupBy("doc").agg(srcs.alias("srcs")).select("doc", F.explode("srcs").alias("src"))


def _askers(mine: DataFrame, of: DataFrame) -> DataFrame:
    """``doc, src``: documents that ask for a key, with its earlier holders."""
    held = of.where("doc < last").select("key", F.col("doc").alias("src"))
    return mine.where("asks").select("key", "doc").join(held, "key").where("doc > src").select("doc", "src").distinct()


def _ends(b: pa.RecordBatch) -> Iterator[tuple[int, list[np.ndarray]]]:
    """For each document with links that very many hold ``doc`` and ``key, asks, long, nth, side, far, missing``: what else two of them share if a passage runs along it.

    A chain within ``MAX_GAP`` is one link from its first to its last seed. Its passage goes on without gaps on both sides together for
    all that is ``missing`` of ``MIN_WORDS``, and such an extension ends in three equal words, seeds included: the link, the place of
    its end and these three words are the key. A longer chain has two links that follow each other and together are longer: their three seeds are the key.
    """
    data, off = tv.string_bytes(b.column("text"))
    ids, many, is_open = b.column("doc_id").to_numpy(), b.column("keys"), b.column("open")
    for r in range(b.num_rows):
        low, o = tv.LOWER[data[off[r] : off[r + 1]]], np.array([0, off[r + 1] - off[r]])
        starts, ends, _ = tv.word_spans(low, o, tv.SPACE)
        words = tv.word_hashes(low, starts, ends)
        h, at = winnow(words)
        sought = np.array(many[r].as_py(), np.int64)
        order = np.argsort(sought)
        sought, free = sought[order], np.array(is_open[r].as_py(), bool)[order]
        first, second, asks, link = [], [], [], []
        for near, k in _following(at):
            key = _joint(h[near], h[near + k])
            n = np.minimum(np.searchsorted(sought, key), len(sought) - 1)
            hit = sought[n] == key
            first.append(near[hit])
            second.append(near[hit] + k)
            asks.append(free[n[hit]])
            link.append(key[hit])
        x, y, ask, key = (np.concatenate(c) for c in (first, second, asks, link))
        three = tv.shingle_hashes(words, 3)
        missing = MIN_WORDS - (at[y] + K - at[x])
        far = np.arange(1, MARGIN + PIECE + 1)
        for side, place in ((0, (at[y] + K - 3)[:, None] + far), (1, at[x][:, None] - far)):
            i, n = np.nonzero((place >= 0) & (place < len(three)))
            ends_in = _joint(key[i].view(np.uint64) + (2 * far[n] + side).astype(np.uint64), three[place[i, n]])
            yield ids[r], [ends_in, ask[i], np.ones(len(i), bool), i, np.full(len(i), side), far[n], missing[i]]
        by = np.argsort(x, kind="stable")
        lo, hi = np.searchsorted(x[by], y, "left"), np.searchsorted(x[by], y, "right")
        i = np.repeat(np.arange(len(x)), hi - lo)
        j = by[np.arange(len(i)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)]
        both, asking, long = _joint(key[i].view(np.uint64), h[y[j]]), ask[i] | ask[j], at[y[j]] - at[x[i]] > MAX_GAP
        one = np.unique(np.stack((both, asking, long)), axis=1)
        none = np.zeros(one.shape[1], int)
        yield ids[r], [one[0], one[1] > 0, one[2] > 0, none - 1, none, none, none]


def _around(docs: DataFrame, links: int) -> DataFrame:
    """``key, doc, asks, long, nth, side, far, missing``: the ends of ``links`` links (see ``_ends``) that a document asks for and an earlier one has too.

    Few of them are. So their keys alone, packed with their documents, first set a bitmap of those that are, and only these become rows.
    """
    parts = seen_twice.parts_of(2 * links * (MARGIN + PIECE))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = ((key, np.full(len(key), doc, np.int64), asks) for b in batches for doc, (key, asks, *_) in _ends(b))
        return seen_twice.packs(ends, parts)

    bitmap = seen_twice.asked(docs.mapInArrow(giving_back(keys), "part int, key binary, doc binary, asks binary"), parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "doc", "asks", "long", "nth", "side", "far", "missing"]
        for b in batches:
            for doc, (key, asks, long, *more) in _ends(b):
                may = seen_twice.may_be_asked(bitmap.value, key)
                if may.any():
                    cols = [pa.array(key[may]), pa.array(np.full(int(may.sum()), doc)), pa.array(asks[may]), pa.array(long[may]), *[pa.array(c[may].astype(np.int32)) for c in more]]
                    yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "key bigint, doc bigint, asks boolean, long boolean, nth int, side int, far int, missing int"
    return docs.mapInArrow(giving_back(run), schema)


def _cheapest(ends: DataFrame) -> DataFrame:
    """``key, doc, asks``: of the ends of extensions those to ask for, one way for each link of a document.

    Extensions that make up for ``missing`` words have ``p`` words on the right or more than ``missing - p`` on the left, whatever ``p``; taken is
    the one whose keys have fewest holders. Words that go on alike in all documents with the link are fewer than ``missing``, else they are a passage.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 2):
            doc, nth, key, side, far, missing, n = (t.column(c).to_numpy() for c in ("doc", "nth", "key", "side", "far", "missing", "n"))
            edge = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (nth[1:] != nth[:-1]), [True])))
            keep = np.zeros(len(doc), bool)
            for i, j in zip(edge[:-1], edge[1:], strict=True):
                cost = np.zeros((2, MARGIN + PIECE + 2))
                np.add.at(cost, (side[i:j], far[i:j]), n[i:j])
                right, left = cost[:, ::-1].cumsum(1)[:, ::-1]
                p = int((right[1 : missing[i] + 1] + left[missing[i] : 0 : -1]).argmin()) + 1
                keep[i:j] = np.where(side[i:j] == 0, far[i:j] >= p, far[i:j] > missing[i] - p)
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(doc[keep]), pa.array(np.ones(int(keep.sum()), bool))], names=["key", "doc", "asks"])

    asked = ends.where("asks").select("doc", "nth", "key", "side", "far", "missing", "n")
    return together(asked, "doc", "nth").sortWithinPartitions("doc", "nth").mapInArrow(giving_back(run), "key bigint, doc bigint, asks boolean")


def _matches_of(shared: DataFrame, pairs: DataFrame) -> DataFrame:
    """``doc, src, b, a``: all places of the seeds that the two documents of a pair share."""
    of = shared.select("doc", "at", "seed")
    mine = pairs.join(of.withColumnRenamed("at", "b"), "doc")
    return mine.join(of.select(F.col("doc").alias("src"), "seed", F.col("at").alias("a")), ["src", "seed"]).select("doc", "src", "b", "a")


def _fuzzy(base: DataFrame, matches: DataFrame) -> DataFrame:
    """``doc_id, source_id, start_word, end_word, source_start, source_end, identity``: passages along the matches ``doc, src, b, a``."""
    chains = cut(_chain_rows(together(matches, "doc", "src").sortWithinPartitions("doc", "src", "b", "a")))
    span = lambda c: F.sequence(
        F.floor(F.greatest(F.lit(0), F.array_min(c) - MARGIN) / PIECE).cast("int"), F.floor((F.array_max(c) + K + MARGIN) / PIECE).cast("int")
    )
    wanted = chains.select("doc", "src", "no", F.lit(1).alias("side"), F.col("doc").alias("id"), F.explode(span(F.col("b"))).alias("piece")).union(
        chains.select("doc", "src", "no", F.lit(0), F.col("src"), F.explode(span(F.col("a"))))
    )
    ids = chains.select(F.col("doc").alias("doc_id")).union(chains.select("src"))
    # a first holder that many documents share is asked for by all of them: its pieces go to where they are asked for
    hot = hot_keys(wanted, "id")
    often = F.col("id").isin(hot) if hot else F.lit(False)
    pieces = _piece_rows(rows_with(base.where(~F.col("doc_id").isin(hot)) if hot else base, ids, "doc_id")).dropDuplicates(["id", "piece"])
    parts = wanted.where(~often).join(pieces, ["id", "piece"])
    if hot:
        few = hinted(_piece_rows(base.where(F.col("doc_id").isin(hot))).dropDuplicates(["id", "piece"]))
        parts = parts.unionByName(wanted.where(often).join(few, ["id", "piece"]))
    parts = parts.select("doc", "src", "no", "side", "piece", "words")
    parts = parts.join(chains, ["doc", "src", "no"]).select("doc", "src", "no", "side", "piece", "words", "a", "b")
    parts = together(parts, "doc", "src", "no").sortWithinPartitions("doc", "src", "no", "side", "piece")
    return _aligned(parts)


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents less the passages that an earlier one has; rows of which nothing is left go, ``n_chars`` follows the text."""
    found = passages(docs).select("doc_id", "start_word", "end_word")
    spans = found.groupBy(F.col("doc_id").alias("id_")).agg(F.collect_list(F.struct("start_word", "end_word")).alias("spans_"))
    joined = docs.join(hinted(spans), F.col("doc_id").cast("bigint") == F.col("id_"), "left").drop("id_")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, keep = [], []
            for text, spans_ in zip(b.column("text").to_pylist(), b.column("spans_").to_pylist(), strict=True):
                if spans_:
                    text = _less(text, spans_)
                texts.append(text)
                keep.append(not spans_ or bool(text.strip()))
            cols = {n: b.column(n) for n in b.schema.names if n != "spans_"}
            cols["text"] = pa.array(texts, pa.string())
            if "n_chars" in cols:
                lengths = [n if not s else len(t) for n, s, t in zip(cols["n_chars"].to_pylist(), b.column("spans_").to_pylist(), texts, strict=True)]
                cols["n_chars"] = pa.array(lengths, cols["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols)).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(giving_back(run), docs.schema)


def _less(text: str, spans: list[dict]) -> str:
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    starts, ends, _ = tv.word_spans(raw, np.array([0, len(raw)]), tv.SPACE)
    gone = np.zeros(len(starts) + 1, int)
    for s in spans:
        gone[s["start_word"]] += 1
        gone[s["end_word"]] -= 1
    gone = np.cumsum(gone)[:-1] > 0
    out, at = [], 0
    for i in np.flatnonzero(gone & ~np.concatenate(([False], gone[:-1]))):
        j = i + int(np.argmin(gone[i:])) if not gone[i:].all() else len(gone)
        out.append(raw[at : starts[i]])
        at = starts[j] if j < len(starts) else len(raw)
    out.append(raw[at:])
    return b"".join(x.tobytes() for x in out).decode("utf-8", "replace")
