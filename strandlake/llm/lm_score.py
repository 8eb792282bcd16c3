"""Language-model scores by prediction by partial matching, with a word-count base beside them.

One pass over the training texts counts words and byte grams, exactly and over all of them. Every context of
orders 0 to ``DEPTH`` counts in the log10 probability of each whole lower-cased text and its end, so the model grows with
the corpus. Grams and words seen most (``HOT_GRAMS`` and ``HOT`` of them, fixed bounds) are looked up where the text is;
the rest of each text, once for each distinct one, meets the count tables by key, so no table that grows with the corpus
is broadcast. Grams are dealt by the last ``NEAR`` bytes of their context: their longer contexts are in one place,
and the shorter ones, no more than an alphabet allows, are at hand everywhere.

Defined cases: a null or empty text has one token, its end; very long texts are scored whole; repeated rows, and rows of one id with different
texts, are scored each; words equally frequent at the bound of the local tables change where they are looked up, not what is found; without training
rows all counts are 0; extra columns are ignored; a null id counts as held out; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandlake.llm import ppm
from strandlake.llm import textvec as tv
from strandlake.runtime import cut, giving_back

#: Bytes of the longest context, and last bytes of a context by which rare grams are dealt.
DEPTH, NEAR = 5, 3
#: Grams looked up locally, and slots of the two tables that hold them.
HOT_GRAMS, GRAM_SLOTS = 1_000_000, (1 << 21, 1 << 20)
#: Words looked up locally, and slots of the table that holds them.
HOT, SLOTS = 300_000, 1 << 20
#: The key of the end token: no word hash is reserved, so it is an ordinary hash of its own.
END_KEY = np.uint64(0x51ED270B7A4C9E33)


def _flush(kind: int, s: tv.Sums) -> pa.RecordBatch:
    k, n = s.take()
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int32)), pa.array(k.view(np.int64)), pa.array(n.astype(np.int64))], names=["kind", "key", "n"])


def count(texts: DataFrame) -> DataFrame:
    """``kind`` (0 word, 1 gram), ``key``, ``n`` over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, grams, ends = tv.Sums(), tv.Sums(), 0
        for batch in batches:
            data, off = tv.string_bytes(batch.column("text"))
            ends += len(off) - 1
            for i, j in tv.blocks(off, ppm.BLOCK):
                raw, o = data[off[i] : off[j]], off[i : j + 1] - off[i]
                low = tv.LOWER[raw]
                starts, stops, _ = tv.word_spans(low, o, tv.SPACE)
                words.add(tv.word_hashes(low, starts, stops))
                grams.add(ppm.grams(low, o, DEPTH))
                for kind, s in ((0, words), (1, grams)):
                    if s.full():
                        yield _flush(kind, s)
        if ends:
            words.add(np.array([END_KEY]), np.array([ends]))
        for kind, s in ((0, words), (1, grams)):
            yield _flush(kind, s)

    parts = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(giving_back(run), "kind int, key bigint, n bigint")
    return parts.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _table(hot: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts by slot (low bits of the key); where two words share a slot the more frequent one has it."""
    keys, n = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.int64)
    if len(hot):
        k, c = hot.column("key").to_numpy().view(np.uint64), hot.column("n").to_numpy()
        slot, first = np.unique(k & np.uint64(SLOTS - 1), return_index=True)
        keys[slot], n[slot] = k[first], c[first]
    return keys, n


def _gram_tables(hot: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """Keys and log10 probabilities by slot; of grams that share a slot the more frequent one has it, the others try the next table."""
    keys, n, logs = (hot.column(c).to_numpy() for c in ("key", "n", "logp"))
    order = np.lexsort((keys, -n))
    keys, logs, out = keys[order].view(np.uint64), logs[order], []
    for i, slots in enumerate(GRAM_SLOTS):
        table, value = np.full(slots, np.uint64(2**64 - 1)), np.zeros(slots)
        slot, first = np.unique(_gram_slot(keys, i), return_index=True)
        table[slot], value[slot] = keys[first], logs[first]
        out.append((table, value))
        rest = np.ones(len(keys), bool)
        rest[first] = False
        keys, logs = keys[rest], logs[rest]
    return out


def _gram_slot(keys: np.ndarray, i: int) -> np.ndarray:
    return ((tv.mix(keys) >> np.uint64(24 * i)) & np.uint64(GRAM_SLOTS[i] - 1)).astype(np.int64)


def _hot_grams(grams: DataFrame) -> pa.Table:
    """``key, n, logp`` of the grams seen most: all down to a count that leaves at most ``HOT_GRAMS``."""
    bucket = F.floor(F.log2("n") * 16).cast("int")
    room, least = HOT_GRAMS, None
    for b, size in sorted(map(tuple, grams.groupBy(bucket.alias("b")).count().collect()), reverse=True):
        room -= size
        if room < 0:
            break
        least = b
    if least is None:
        return pa.table({"key": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "logp": pa.array([], pa.float64())})
    ctx = W.partitionBy(F.shiftrightunsigned("key", 8))
    known = grams.select("key", "n", (F.sum("n").over(ctx) + F.count("*").over(ctx)).alias("whole"))
    return known.where(bucket >= least).select("key", "n", F.log10(F.col("n") / F.col("whole")).alias("logp")).toArrow()


def _rare(cold: DataFrame, grams: DataFrame) -> DataFrame:
    """``row, score``: sums over the grams ``(row, key, times)``, each by all its contexts in the counts ``(key, n)``."""
    last = F.col("key").bitwiseAND(F.lit((1 << 8 * NEAR) - 1).cast("bigint"))
    near = grams.groupBy(last.alias("key")).agg(F.sum("n").alias("n")).toArrow()
    below = ppm.levels(near.column("key").to_numpy(), near.column("n").to_numpy(), range(NEAR))
    shared = cold.sparkSession.sparkContext.broadcast(below)
    place = F.shiftrightunsigned("key", 8).bitwiseAND(F.lit((1 << 8 * NEAR) - 1).cast("bigint")).alias("place")
    dealt = grams.select(place, F.lit(-1).cast("bigint").alias("row"), "key", "n").union(cold.select(place, "row", "key", "times"))
    dealt = dealt.repartition("place").sortWithinPartitions("place", F.col("row") >= 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short = shared.value
        held_place, held_key, held_n = (np.zeros(0, np.int64) for _ in range(3))
        known = None
        for b in batches:
            if not b.num_rows:
                continue
            place, row, key, n = (b.column(c).to_numpy() for c in ("place", "row", "key", "n"))
            asks = row >= 0  # a place has its counts first, then what is asked of them
            if known is None or not asks.all() or place[-1] != place[0] or (len(held_place) and held_place[-1] != place[0]):
                held_place, held_key, held_n = (np.concatenate((x, y[~asks])) for x, y in ((held_place, place), (held_key, key), (held_n, n)))
                known = None
            if asks.any():
                known = known or short + ppm.levels(held_key, held_n, range(NEAR, DEPTH + 1), short[-1])
                rows, own = np.unique(row[asks], return_inverse=True)
                score = np.bincount(own, n[asks] * ppm.gram_logs(known, key[asks]), len(rows))
                yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(score)], names=["row", "score"])
            if len(held_place) and held_place[0] != place[-1]:
                stay = held_place == place[-1]
                held_place, held_key, held_n, known = held_place[stay], held_key[stay], held_n[stay], None

    return dealt.mapInArrow(giving_back(run), "row bigint, score double")


def score(docs: DataFrame, learned: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``, learned from all rows of ``learned``."""
    spark = docs.sparkSession
    counts = cut(count(learned))
    words = counts.where("kind = 0").select("key", "n")
    total, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    hot = words.orderBy(F.desc("n"), "key").limit(HOT).toArrow()
    grams = counts.where("kind = 1").select("key", "n")
    floor = total + 0.1 * (kinds + 1)
    shared = spark.sparkContext.broadcast((_gram_tables(_hot_grams(grams)), *_table(hot)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, keys, freq = shared.value
        gain = np.log10((freq + 0.1) / floor)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            data, off = tv.string_bytes(batch.column("text"))
            for i, j in tv.blocks(off, ppm.BLOCK):
                low, o = tv.LOWER[data[off[i] : off[j]]], off[i : j + 1] - off[i]
                n = j - i
                starts, stops, first = tv.word_spans(low, o, tv.SPACE)
                h = np.concatenate((tv.word_hashes(low, starts, stops), np.full(n, END_KEY)))
                doc = np.concatenate((np.repeat(np.arange(n), np.diff(first)), np.arange(n)))
                slot = (h & np.uint64(SLOTS - 1)).astype(np.int64)
                warm = (keys[slot] == h) & (freq[slot] > 0)
                ids = np.arange(row, row + n)
                row += n
                base = np.bincount(doc[warm], gain[slot[warm]], n)
                known = np.bincount(doc[warm], minlength=n)
                cold, where = h[~warm], doc[~warm]
                cold, where, times = _distinct(cold, where)
                g = ppm.grams(low, o, DEPTH)
                logs, unknown = np.zeros(len(g)), np.arange(len(g))
                for t, (table, value) in enumerate(tables):
                    own = g[unknown]
                    at = _gram_slot(own, t)
                    hit = table[at] == own
                    logs[unknown[hit]] = value[at[hit]]
                    unknown = unknown[~hit]
                firsts = o[:-1] + np.arange(n)
                rare, rare_where, rare_times = _distinct(g[unknown], np.searchsorted(firsts, unknown, "right") - 1)
                who = np.concatenate((where, rare_where))
                doc_ids = batch.column("doc_id").slice(i, n)
                zero, some = np.zeros(len(who), np.int64), np.zeros(len(who))
                cols = [
                    pa.array(np.repeat(np.array([0, 1], np.int32), [n + len(where), len(rare)])),
                    pa.array(np.concatenate((ids, ids[who]))),
                    pa.concat_arrays([doc_ids, doc_ids.take(pa.array(who))]),
                    pa.array(np.concatenate((tv.mix(ids.astype(np.uint64)), cold, rare)).view(np.int64)),
                    pa.array(np.concatenate((np.zeros(n, np.int64), times, rare_times))),
                    pa.array(np.concatenate((np.diff(first) + 1, zero))),
                    pa.array(np.concatenate((known, zero))),
                    pa.array(np.concatenate((base, some))),
                    pa.array(np.concatenate((np.add.reduceat(logs, firsts), some))),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=["kind", "row", "doc_id", "key", "times", "n_tokens", "known", "base", "score"])

    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = cut(picked.mapInArrow(giving_back(run), "kind int, row bigint, doc_id bigint, key bigint, times bigint, n_tokens bigint, known bigint, base double, score double"))
    found = parts.where("kind = 0").join(words, "key", "left")
    rare = F.when(F.col("times") > 0, F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 0.1) / F.lit(floor))).otherwise(0.0)
    by_word = found.select(
        "row", "doc_id", "n_tokens", (F.col("known") + F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("n_known"), (F.col("base") + rare).alias("base"), "score"
    )
    by_gram = _rare(parts.where("kind = 1").select("row", "key", "times"), grams).select(
        "row", F.lit(None).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("n_tokens"), F.lit(0).cast("bigint").alias("n_known"), F.lit(0.0).alias("base"), "score"
    )
    return by_word.union(by_gram).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"),
        F.lit(int(total)).cast("bigint").alias("train_tokens"),
        F.sum("base").alias("base_score"),
        F.sum("score").alias("score"),
    ).drop("row")


def _distinct(keys: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of key and row, and how often each comes."""
    order = np.lexsort((keys, where))
    keys, where = keys[order], where[order]
    new = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (where[1:] != where[:-1]))) if len(keys) else [])
    return keys[new], where[new], np.diff(np.append(new, len(keys))).astype(np.int64)
