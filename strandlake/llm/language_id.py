"""Language identification by prediction by partial matching: per-language byte context trees with frozen counts.

Every whole text is coded under each learned language, by that language's own contexts; the shortest exact code names the language.
All languages of the labelled rows are learned. Texts that are null, empty or have no letter get ``und`` and score 0. Very long
texts are coded whole; repeated rows get the same answer each; ties go to the language that sorts first; null ids are carried along;
extra columns are ignored; without learned rows every text is ``und``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.llm import ppm
from strandlake.llm import textvec as tv
from strandlake.runtime import bounded_batches, giving_back

#: Bytes of context, and labelled rows learned from for each language (expected, by hash of the id).
DEPTH, ROWS_PER_LANG = 4, 500
#: Contexts kept of one language, and of all together before each gets fewer, down to the last number: a model of hundreds of languages stays small enough to broadcast.
CONTEXTS, ALL_CONTEXTS, FEWEST_CONTEXTS = 6000, 48_000, 500
UNKNOWN = "und"


def bucket(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id) % parts, F.lit(0))


def train(labelled: DataFrame, rows_per_lang: int = ROWS_PER_LANG, contexts: int = CONTEXTS) -> dict[str, ppm.Automaton]:
    """An automaton for each language, learned from rows ``(doc_id, text, lang)``; rows without a language or text are left out."""
    rows = labelled.where("lang is not null and text is not null")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return {}
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, rows_per_lang / n))]), F.col("lang"))
    picked = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.coalesce(share, F.lit(0.0)) * 1_000_000)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tv.Sums] = {}
        for batch in batches:
            data, off = tv.string_bytes(batch.column("text"))
            for i, (lang, n) in enumerate(zip(batch.column("lang").to_pylist(), np.diff(off), strict=True)):
                for lo in range(0, int(n), ppm.BLOCK):  # a longer text goes on with the context that it had
                    part = data[off[i] + max(0, lo - DEPTH) : off[i] + min(n, lo + ppm.BLOCK)]
                    keys = ppm.grams(part, np.array([0, len(part)]), DEPTH)
                    sums.setdefault(lang, tv.Sums()).add(keys[DEPTH if lo else 0 : len(keys) - 1])
        for lang, s in sums.items():
            k, n = s.take()
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(k.astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "key", "n"])

    keyed = picked.select("lang", "text").mapInArrow(giving_back(count), "lang string, key bigint, n bigint")
    keyed = keyed.groupBy("lang", "key").agg(F.sum("n").alias("n"))
    kept = ppm.count_contexts(keyed, DEPTH, "lang", max(FEWEST_CONTEXTS, min(contexts, ALL_CONTEXTS // len(sizes))))
    lang = kept.column("lang").to_numpy(zero_copy_only=False)
    k, ctx, sym, n = (kept.column(x).to_numpy() for x in ("k", "ctx", "sym", "n"))
    out = {}
    for name in sorted(set(lang.tolist())):
        own = lang == name
        out[name] = ppm.build((k[own], ctx[own]), (np.zeros(own.sum(), np.int64), k[own], ctx[own], sym[own], n[own]), 1, DEPTH)
    return out


def predict(docs: DataFrame, models: dict[str, ppm.Automaton], keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id, lang_pred, score, bits`` and the columns in ``keep``; the score is the posterior of the language under equal priors, ``bits`` the length of its code for each byte of the text (null without a letter)."""
    kept = [c for c in keep if c not in ("doc_id", "text", "lang_pred", "score", "bits")] + ["text"] * ("text" in keep)
    types = dict(docs.dtypes)
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(models)
    letter = regex.compile(r"\p{L}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, automata = list(shared.value), list(shared.value.values())
        plain = np.zeros(256, bool)
        plain[65:91] = plain[97:123] = True
        for batch in batches:
            data, off = tv.string_bytes(batch.column("text"))
            n = len(off) - 1
            known = np.zeros(n, bool)
            for i, j in tv.blocks(off, ppm.BLOCK) if names else []:
                letters = np.concatenate(([0], np.cumsum(plain[data[off[i] : off[j]]], dtype=np.int32)))
                known[i:j] = letters[off[i + 1 : j + 1] - off[i]] > letters[off[i:j] - off[i]]
            for i in np.flatnonzero(~known & (np.diff(off) > 0)) if names else []:
                known[i] = bool(letter.search(bytes(data[off[i] : off[i + 1]]).decode("utf-8", "replace")))
            best, score, bits = np.zeros(n, int), np.zeros(n), np.zeros(n)
            if names:
                sums = np.column_stack([ppm.score_rows(a, data, off, False)[:, 0] for a in automata]) * np.log(10)
                best = sums.argmax(1)
                bits = -sums.max(1) / np.log(2) / np.maximum(1, np.diff(off))
                with np.errstate(under="ignore"):
                    score = np.where(known, 1 / np.exp(sums - sums.max(1, keepdims=True)).sum(1), 0.0)
            pred = [names[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
            cols = [batch.column("doc_id"), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(bits, pa.float64(), mask=~known), *[batch.column(c) for c in kept]]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "lang_pred", "score", "bits", *kept])

    others = [c for c in kept if c != "text"]
    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), *others)
    schema = "doc_id bigint, lang_pred string, score double, bits double" + "".join(f", `{c}` {types[c]}" for c in others) + ", text string" * ("text" in kept)
    return picked.mapInArrow(giving_back(run), schema)
