"""Exact Jaccard self-join of word n-gram sets by partitioning the universe of n-grams.

Sets of one size band are cut into segments by a hash of their n-grams. If two sets differ in at most H
n-grams and the allowances of the segments (0: equal, 1: one deletion) sum to H + 1 - segments or more, some
segment is within its allowance, so equal segment signatures, or signatures of one-deletion neighbourhoods,
find every pair (pigeonhole). For each band a cost model, fed with the number of sets in it, allocates
either equal segments or half as many with one-deletion neighbourhoods. A set also asks in the
lower bands whose sets it can still match.

Equal sets are folded into one node first. Within a signature group every member is compared with one
leader, so a group of any size gives as many pairs as members. Members of one leader that are still in
different components are then compared by their differences from the leader, which are small and settle
every Jaccard value exactly: in blocks of bounded size, as products of matrices, so that no list of all pairs is
made and no task holds a whole group. Components lose no link. A block holds the differences of its members once, so a
group of M members that stays open is shipped M / ``MEMBERS`` times; groups within one component are not shipped at all.

Defined cases: texts without words (null or empty) have empty sets, link with nothing and are their own
component; texts of fewer words than n are one n-gram; very long texts are taken whole; repeated rows and equal sets are linked; rows of one id
with different texts are sets of their own, which link by what they hold; rows without an id link like others, and a component of such rows
alone has no id; a similarity of exactly the threshold links; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm import seen_twice
from strandlake.llm import textvec as tv
from strandlake.llm.forest import forest
from strandlake.operators.graph import connected_components
from strandlake.runtime import bounded_batches, cut, giving_back, hinted, joined, release, rows_with

#: Growth of a size band; spare segments as a share of those needed; cost of one signature in units of a false pair; sets that one block of comparisons holds;
#: members of a leader compared in one block; columns of a product.
BAND_GROWTH, SPARE, SIGNATURE_COST, SETS, MEMBERS, COLUMNS = 1.5, 0.1, 0.05, 500, 1200, 2048
BLOCK = 1 << 21


@dataclass
class Plan:
    """Upper ends of the bands, and for each its number of segments, whether they take one-deletion neighbourhoods, and how many are spare.

    With ``spare`` segments beyond what the pigeonhole needs, two sets that link agree on at least one more than that.
    So a set may leave out as many signatures as are spare, as long as a rule that looks at the signature alone
    says which: those of empty segments first, then those that several sets share. A set that has more of them than are
    spare keeps all. What two linked sets have in common beyond these is kept by both.
    """

    ends: np.ndarray
    segments: np.ndarray
    deletions: np.ndarray
    spare: np.ndarray
    percent: int

    @classmethod
    def of(cls, largest: int, percent: int, sets_in: dict[int, int]) -> Plan:
        ends = band_ends(largest)
        segments, deletions, spare = [], [], []
        for b, hi in enumerate(ends):
            lo = int(ends[b - 1]) + 1 if b else 1
            both = hi + 100 * hi // percent
            apart = both * (100 - percent) // (100 + percent)  # most n-grams by which two linked sets differ
            n, mid = sets_in.get(b, 0) + sets_in.get(b + 1, 0), (lo + hi) / 2
            equal, half = apart + 1, -(-(apart + 1) // 2)
            extra = 0
            if equal > 2:  # as many as sets of the band have empty segments, and some
                while extra < equal and extra < SPARE * equal + 1.5 * (equal + extra) * math.exp(-lo / (equal + extra)):
                    extra += 1
            # signatures, and chance agreement of segments that hold nothing (or one n-gram at most) and are not left out
            chance = 0 if extra else equal * math.exp(-2 * min(300, lo / equal))
            cost_equal = SIGNATURE_COST * n * (equal + extra) + n * n / 2 * chance
            g = min(300, lo / half)
            cost_half = SIGNATURE_COST * n * (half + mid) + n * n / 2 * half * ((1 + g) * math.exp(-g)) ** 2
            deletions.append(cost_half < cost_equal)
            if deletions[-1]:
                extra = 0
            spare.append(extra)
            segments.append(half if deletions[-1] else equal + extra)
        return cls(ends, np.array(segments), np.array(deletions), np.array(spare), percent)


def band_ends(largest: int) -> np.ndarray:
    ends = [1]
    while ends[-1] < largest:
        ends.append(max(ends[-1] + 1, int((ends[-1] + 1) * BAND_GROWTH)))
    return np.array(ends)


def sets_of(data: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each row."""
    for i, j in tv.blocks(offsets, BLOCK):
        low, off = tv.LOWER[data[offsets[i] : offsets[j]]], offsets[i : j + 1] - offsets[i]
        starts, ends, first = tv.word_spans(low, off, tv.SPACE)
        words = tv.word_hashes(low, starts, ends)
        for a, b in zip(first[:-1], first[1:], strict=True):
            yield np.unique(tv.shingle_hashes(words[a:b], n))


def fingerprint(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def signatures(s: np.ndarray, plan: Plan) -> list[tuple[np.ndarray, int, int]]:
    """Signatures of a set in its own band and the lower bands that it can match, each band with what is left to spare."""
    out = []
    b = int(np.searchsorted(plan.ends, len(s)))
    least = -(-plan.percent * len(s) // 100)
    while b >= 0 and plan.ends[b] >= least:
        m = int(plan.segments[b])
        salt = np.uint64((b + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
        h = tv.mix(s ^ salt)
        seg = (h % np.uint64(m)).astype(np.int64)
        order = np.argsort(seg, kind="stable")
        run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h[order], dtype=np.uint64)))
        edge = np.searchsorted(seg[order], np.arange(m + 1))
        total, size = run[edge[1:]] - run[edge[:-1]], (edge[1:] - edge[:-1]).astype(np.uint64)
        tag = tv.mix(salt + np.arange(1, m + 1).astype(np.uint64))
        whole, room = tv.mix(total ^ tag) + size, int(plan.spare[b])
        empty = size == 0
        if empty.sum() <= room:
            whole, room = whole[~empty], room - int(empty.sum())
        else:
            room = 0
        if plan.deletions[b]:
            whole = np.unique(np.concatenate((whole, tv.mix((total[seg] - h) ^ tag[seg]) + size[seg] - np.uint64(1))))
        out.append((whole.view(np.int64), b, room))
        b -= 1
    return out


def _per_row(docs: DataFrame, n: int) -> DataFrame:
    """``doc_id, n, fp`` of every row; ``fp`` is null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, prints = [], []
            for s in sets_of(*tv.string_bytes(b.column("text")), n):
                sizes.append(len(s))
                prints.append(fingerprint(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(prints, pa.int64())], names=["doc_id", "n", "fp"])

    return docs.mapInArrow(giving_back(run), "doc_id bigint, n bigint, fp bigint")


def _signature_keys(docs: DataFrame, n: int, plan: Plan) -> DataFrame:
    """``sig`` of every set; a signature that recurs within a batch has two rows of it, for no more is asked than whether it recurs."""
    shared = docs.sparkSession.sparkContext.broadcast(plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for b in batches:
            own = [k for s in sets_of(*tv.string_bytes(b.column("text")), n) if len(s) for k, _, _ in signatures(s, p)]
            if own:
                keys, times = np.unique(np.concatenate(own), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((keys, keys[times > 1])))], names=["sig"])

    return docs.select("text").mapInArrow(giving_back(run), "sig bigint")


def _signature_rows(docs: DataFrame, n: int, plan: Plan, recurring: Broadcast) -> DataFrame:
    """``sig, fp, band, room`` of every set, signatures that may recur only."""
    shared = docs.sparkSession.sparkContext.broadcast(plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for b in batches:
            sig, fp, band, room = [], [], [], []
            for s in sets_of(*tv.string_bytes(b.column("text")), n):
                if len(s):
                    for keys, at, left in signatures(s, p):
                        sig.append(keys[seen_twice.may_recur(recurring.value, keys)])
                        fp.append(fingerprint(s))
                        band.append(at)
                        room.append(left)
            if sig:
                times = [len(x) for x in sig]
                again = lambda v, kind: pa.array(np.repeat(np.array(v, kind), times))  # noqa: B023, E731
                cols = [pa.array(np.concatenate(sig)), again(fp, np.int64), again(band, np.int32), again(room, np.int32)]
                yield pa.RecordBatch.from_arrays(cols, names=["sig", "fp", "band", "room"])

    return docs.select("text").mapInArrow(giving_back(run), "sig bigint, fp bigint, band int, room int")


def _set_rows(docs: DataFrame, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps, raw, held = [], [], 0
            for s in sets_of(*tv.string_bytes(b.column("text")), n):
                if len(s):
                    fps.append(fingerprint(s))
                    raw.append(s.tobytes())
                    held += len(raw[-1])
                if held > 8_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(fps, pa.int64()), pa.array(raw, pa.binary())], names=["fp", "grams"])
                    fps, raw, held = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(fps, pa.int64()), pa.array(raw, pa.binary())], names=["fp", "grams"])

    return docs.mapInArrow(giving_back(run), "fp bigint, grams binary")


def _compared(pairs: DataFrame, base: DataFrame, nodes: DataFrame, n: int, schema: str, found: Callable[[list], pa.RecordBatch]) -> DataFrame:
    """What ``found`` makes of the compared pairs ``(a, b)``, given as ``(a, b, set of a, set of b)``.

    The nodes ``b`` are dealt into blocks, those with the same first lead together unless they are many; each
    set of a ``b`` travels once, and each set of an ``a`` once to every block that asks for it. Sets are made anew from the
    first text of each node.
    """
    first = pairs.groupBy("b").agg(F.min("a").alias("p"))
    parts = first.groupBy("p").agg(F.ceil(F.count("*") / SETS).cast("int").alias("parts"))
    blocks = max(int(base.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8 * (first.count() // SETS))  # more than the sets need, as first leads are dealt whole
    own = first.join(parts, "p").select("b", F.pmod(F.xxhash64("p", F.pmod(F.xxhash64("b"), F.col("parts"))), F.lit(blocks)).cast("int").alias("block"))
    own = hinted(own)
    p = cut(pairs.join(own, "b").select("block", "a", "b"))
    rep = nodes.select("fp", F.col("rep").alias("doc_id"))
    nameless = base.where("doc_id is null").dropDuplicates(["text"])

    def texts(c: str) -> DataFrame:
        """Texts of the nodes on one side, by the first id that has them, and all that have no id."""
        wanted = rep.join(pairs.select(F.col(c).alias("fp")).distinct(), "fp", "left_semi").where("doc_id is not null").select("doc_id")
        return rows_with(base, wanted, "doc_id").union(nameless)

    none, null = F.lit(None).cast("binary"), F.lit(0).cast("bigint")
    leads = hinted(p.select("block", F.col("a").alias("fp")).distinct())
    rows = _set_rows(texts("a"), n).join(leads, "fp").select("block", F.lit(0).alias("kind"), F.col("fp").alias("a"), null.alias("b"), "grams")
    rows = rows.union(p.select("block", F.lit(1), "a", "b", none))
    rows = rows.union(_set_rows(texts("b"), n).join(own.withColumnRenamed("b", "fp"), "fp").select("block", F.lit(2), null, F.col("fp"), "grams"))
    rows = rows.repartitionById(blocks, "block").sortWithinPartitions("block", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, leads, asked, done = None, {}, {}, set()
        for batch in batches:
            out = []
            for block, kind, a, b, grams in zip(*[batch.column(c) for c in ("block", "kind", "a", "b", "grams")], strict=True):
                block, kind, a, b = block.as_py(), kind.as_py(), a.as_py(), b.as_py()
                if block != at:
                    at, leads, asked, done = block, {}, {}, set()
                if kind == 0:
                    leads[a] = np.frombuffer(grams.as_py(), np.uint64)
                elif kind == 1:
                    asked.setdefault(b, []).append(a)
                elif b in asked and b not in done:
                    done.add(b)
                    y = np.frombuffer(grams.as_py(), np.uint64)
                    out += [(a, b, leads[a], y) for a in asked[b] if a in leads]
                    if len(out) > 1000:
                        yield found(out)
                        out = []
            if out:
                yield found(out)

    return rows.mapInArrow(giving_back(run), schema)


def _within(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each element of ``y`` whether the sorted set ``x`` has it."""
    at = np.searchsorted(x, y)
    at[at == len(x)] = 0
    return x[at] == y


def _linked(pairs: DataFrame, base: DataFrame, nodes: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs that link, compared exactly."""

    def found(rows: list) -> pa.RecordBatch:
        keep = [(a, b) for a, b, x, y in rows if 100 * (s := int(_within(x, y).sum())) >= percent * (len(x) + len(y) - s)]
        return pa.RecordBatch.from_arrays([pa.array([k[i] for k in keep], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return _compared(pairs, base, nodes, n, "a bigint, b bigint", found)


def _differences(pairs: DataFrame, base: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """``a, b, n, diff``: what the set of ``b``, of size ``n``, lacks of that of ``a`` or has beyond it."""

    def found(rows: list) -> pa.RecordBatch:
        diff = [np.concatenate((y[~_within(x, y)], x[~_within(y, x)])).tobytes() for _, _, x, y in rows]
        cols = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([len(r[3]) for r in rows], pa.int64()), pa.array(diff, pa.binary())]
        return pa.RecordBatch.from_arrays(cols, names=["a", "b", "n", "diff"])

    return _compared(pairs, base, nodes, n, "a bigint, b bigint, n bigint, diff binary", found)


def _block_links(t: pa.Table, percent: int) -> pa.Table:
    """Links across components among the members of a leader in two blocks (or within one), as a forest."""
    cells = t.column("cell").to_pylist()
    first, last = cells[0]
    own = t.column("own").to_numpy()
    rows, cols = np.flatnonzero(own == first), np.flatnonzero(own == last)
    sizes, comp, ids = (t.column(c).to_numpy() for c in ("n", "component", "b"))
    diffs = [np.frombuffer(d.as_buffer(), np.uint64) for d in t.column("diff")]
    lens = np.array([len(d) for d in diffs])
    who = np.repeat(np.arange(len(diffs)), lens)
    _, at, times = np.unique(np.concatenate(diffs), return_inverse=True, return_counts=True)
    often = times[at] > 1
    who, at = who[often], np.unique(at[often], return_inverse=True)[1]
    both = np.zeros((len(rows), len(cols)), np.float32)
    row_at, col_at = np.full(len(diffs), -1), np.full(len(diffs), -1)
    row_at[rows], col_at[cols] = np.arange(len(rows)), np.arange(len(cols))
    for lo in range(0, int(at.max(initial=-1)) + 1, COLUMNS):
        part = (at >= lo) & (at < lo + COLUMNS)
        w, c = who[part], at[part] - lo
        x, y = np.zeros((len(rows), COLUMNS), np.float32), np.zeros((COLUMNS, len(cols)), np.float32)
        r, k = row_at[w] >= 0, col_at[w] >= 0
        x[row_at[w[r]], c[r]] = 1
        y[c[k], col_at[w[k]]] = 1
        both += x @ y
    apart = lens[rows][:, None] + lens[cols] - 2 * both.astype(np.int64)
    total = sizes[rows][:, None] + sizes[cols]
    # intersection (total - apart) / 2, union (total + apart) / 2
    link = (100 * (total - apart) >= percent * (total + apart)) & (comp[rows][:, None] != comp[cols])
    i, j = np.nonzero(link)
    far, near = forest(ids[rows[i]], ids[cols[j]]) if len(i) else (np.zeros(0, np.int64),) * 2
    return pa.table({"a": pa.array(far, pa.int64()), "b": pa.array(near, pa.int64())})


def components(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row; documents link when 100 * intersection >= percent * union."""
    bounded_batches(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = cut(_per_row(base, n))
    nodes = cut(rows.where("fp is not null").groupBy("fp", "n").agg(F.min("doc_id").alias("rep")))
    largest = rows.agg(F.max("n")).first()[0] or 1
    ends = band_ends(largest)
    band = F.lit(0)
    for e in ends[:-1]:
        band = band + F.when(F.col("n") > int(e), 1).otherwise(0)
    plan = Plan.of(int(largest), percent, {r.band: r["count"] for r in nodes.groupBy(band.alias("band")).count().collect()})

    # texts of ids that are the first of no set need not be read again; an id with several texts is left out only if all are copies
    named = joined(rows, nodes.select("fp", "rep"), "fp")
    copies = named.where("doc_id is not null and rep is not null").groupBy("doc_id").agg(F.bool_and(F.col("doc_id") != F.col("rep")).alias("again")).where("again")
    # rows without an id match nothing here; a key of their own keeps them from meeting in one task
    alone = F.when(F.col("doc_id").isNull(), F.xxhash64("text").bitwiseOR(F.lit(1))).otherwise(F.lit(0).cast("bigint"))
    keyed = base.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), alone.alias("alone"), "text")
    texts = keyed.join(hinted(copies.select("doc_id", F.lit(0).cast("bigint").alias("alone"))), ["doc_id", "alone"], "left_anti").select("text")
    recurring = seen_twice.recurring(_signature_keys(texts, n, plan), "sig")
    release(docs.sparkSession)
    every = _signature_rows(texts, n, plan, recurring).distinct().persist(StorageLevel.DISK_ONLY)
    several = every.groupBy("sig").agg(F.count("*").alias("holders")).where("holders > 2").select("sig", F.lit(True).alias("several"))
    marked = every.join(several, "sig", "left")
    spared = marked.where("several").groupBy("fp", "band").agg(F.count("*").alias("n"), F.first("room").alias("room")).where("n <= room").select("fp", "band", F.lit(True).alias("spared"))
    some = marked.join(spared, ["fp", "band"], "left").where("several is null or spared is null").select("sig", "fp").persist(StorageLevel.DISK_ONLY)
    leads = some.groupBy("sig").agg(F.min("fp").alias("a"), F.max("fp").alias("hi"), (F.count("*") > 2).alias("more")).where("a <> hi").select("sig", "a", "more")
    tried = cut(some.join(leads, "sig").where("fp <> a").groupBy("a", F.col("fp").alias("b")).agg(F.bool_or("more").alias("more")))
    some.unpersist()
    every.unpersist()
    del several, marked, spared, some, every, leads
    release(docs.sparkSession)
    links = cut(_linked(tried.select("a", "b"), base, nodes, n, percent))
    release(docs.sparkSession)
    comp = connected_components(links).select(F.col("node").alias("fp"), "component")

    # two members meet under a leader only in a group of three and more
    known = tried.where("more").join(comp.withColumnRenamed("fp", "b"), "b", "left").select("a", "b", F.coalesce("component", "b").alias("component"))
    sizes = known.groupBy("a").agg(F.count("*").alias("size"), F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 <> c1")
    open_ = hinted(known.join(sizes.select("a", F.ceil(F.col("size") / MEMBERS).cast("int").alias("blocks")), "a"))
    if not open_.limit(1).count():
        return _finish(rows, comp)
    diffs = _differences(open_.select("a", "b"), base, nodes, n)
    own = F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int")
    spread = diffs.join(open_, ["a", "b"]).select("a", "b", "n", "component", "diff", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    spread = spread.withColumn("cell", F.array(F.least("own", "other"), F.greatest("own", "other")))
    more = spread.groupBy("a", "cell").applyInArrow(lambda t: _block_links(t, percent), "a bigint, b bigint")
    every = connected_components(links.union(more))
    return _finish(rows, every.select(F.col("node").alias("fp"), "component"))


def _finish(rows: DataFrame, comp: DataFrame) -> DataFrame:
    named = cut(joined(rows, comp, "fp", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "fp").alias("c")))
    first = named.where("c is not null").groupBy("c").agg(F.min("doc_id").alias("first"))
    return joined(named, first, "c", "left").select("doc_id", "n_shingles", F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("first")).alias("component_id"))
