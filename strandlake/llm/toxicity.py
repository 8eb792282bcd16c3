"""Toxicity by a weighted finite-state grammar over clauses.

Words are read as insult (weights learned from labels), threat, target, negation, report or other symbols. Four
transducers run over the symbols of one clause, composed into one (``grammar``): reported speech marks the insults
after a verb of saying, negation those up to three words after a negation, and the insult and threat
transducers look for a target near them on either side; what is still to come they guess, and a guess that fails
is no path. The heaviest path says into which channel (plain, targeted, negated, reported, threat) each insult or
threat goes. Only clauses that hold an insult or threat are read; an Aho-Corasick scan finds them. A
logistic layer over the channel sums and the text's size, fitted on the same labelled rows, gives the score.

Insult patterns (whole words or word beginnings) are weighed by distinct clauses, so copies of a document do
not make its rare words look toxic.

Defined cases: null or empty texts score as texts without a match; very long texts and clauses are read whole; repeated rows score alike; without
labels of both classes the fixed weights below hold; conflicting labels of a row count as toxic; of paths of equal
weight the one whose channels sort first counts; a score of exactly 0.5 is predicted toxic; extra columns
are ignored; a null id is treated as held out; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm.transducers import Transducer, build, compose
from strandlake.runtime import giving_back

#: Labelled rows of each class learned from (expected, picked by a hash of the id), clauses that a pattern needs, least log odds.
ROWS_PER_CLASS, LEAST_CLAUSES, LEAST_ODDS = 4000, 6, 2.5
#: Lengths of word beginnings that can become patterns.
PREFIXES = range(4, 9)

#: Threats with their forms, in English, German, French and Spanish.
THREAT = (
    "kill kills killed killing hurt hurts hurting destroy destroys destroyed destroying strangle strangles strangled strangling stab stabs stabbed stabbing "
    "shoot shoots shot shooting beat beats beaten beating murder murders murdered murdering "
    "töten töte tötest tötet tötete töteten getötet umbringen umbringe umbringst umbringt umgebracht verprügeln verprügle verprügelt verprügelte erschießen erschieße erschießt erschossen "
    "tuer tue tues tuent tuera tué frapper frappe frappes frappent frappera frappé égorger égorge égorges égorgent égorgé "
    "matar mato matas mata matan mataré matado golpear golpeo golpeas golpea golpean golpeado degollar degüello degüella degollado"
).split()
TARGET = "you your yourself u they them he she du dich dir ihr euch sie tu te toi vous ils elle ti usted ustedes él ella ellos".split()
NEGATION = "not no never isn't aren't don't nicht kein keine nie pas jamais aucun nunca jamás ni".split()
REPORT = "said says say told quoted wrote claimed called sagte sagt schrieb nannte dit disait écrit appelé dijo dice escribió llamó".split()
SEED_INSULTS = "idiot moron scum".split()
#: Characters in a unit of a text's size, which tells chance matches of long texts from many matches in a short one.
SIZE_UNIT = 500
CHANNELS = ("plain", "targeted", "negated", "reported", "threat")
#: Words up to which a negation reaches, and up to which a target counts for an insult and for a threat.
NEGATION_REACH, INSULT_REACH, THREAT_REACH = 3, 4, 6
#: Symbols read (insult, threat, target, negation, report, other) and channel and weight of those written; others write nothing.
READ = "ITYNRW"
WRITTEN = {"p": ("plain", 1.0), "t": ("targeted", 1.0), "n": ("negated", 1.0), "r": ("reported", 1.0), "K": ("threat", 2.0), "k": ("threat", 1.0)}
#: Other words in a row beyond which one more changes no state, symbols of a clause up to which its reading is kept, and readings kept by a worker.
LONG_RUN, KEPT_LENGTH, KEPT = max(NEGATION_REACH, INSULT_REACH, THREAT_REACH) + 2, 80, 50_000
_CLAUSE = re.compile(r"[.!?;:\n|]+")
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")


@dataclass
class Grammar:
    words: dict[str, float] = field(default_factory=lambda: dict.fromkeys(SEED_INSULTS, 4.0))
    prefixes: dict[str, float] = field(default_factory=dict)
    coef: tuple[float, ...] = (1.5, 1.5, 1.0, 1.0, 1.5)
    size_coef: float = 0.0
    intercept: float = -3.0


def report() -> Transducer:
    """After a report word, insults are reported (``r``) and threats nobody's, to the end of the clause."""

    def step(on: bool, x: str) -> list[tuple[str, float, bool]]:
        if x == "R":
            return [("W", 0.0, True)]
        return [({"I": "r", "T": "W"}.get(x, x) if on else x, 0.0, on)]

    return build(False, step, READ, lambda s: True)


def negation() -> Transducer:
    """Insults within reach after a negation are negated (``n``), threats are none."""

    def step(reach: int, x: str) -> list[tuple[str, float, int]]:
        if x == "N":
            return [("W", 0.0, NEGATION_REACH)]
        return [({"I": "n", "T": "W"}.get(x, x) if reach else x, 0.0, max(0, reach - 1))]

    return build(0, step, "ITYNWr", lambda s: True)


def near(trigger: str, miss: str, before: str, after: str, gains: tuple[float, float], reach: int, alphabet: str) -> Transducer:
    """A trigger with a target up to ``reach`` words before it is written ``before``, up to so many after it ``after``, else ``miss``.

    States: words since the last target, and words left in which a guessed target must come; a path that owes one does not end.
    """

    def step(state: tuple[int, int], x: str) -> list[tuple[str, float, tuple[int, int]]]:
        since, due = state
        if x == "Y":
            return [("Y", 0.0, (1, 0))]
        if due == 1:
            return []
        owed, far = max(0, due - 1), min(since + 1, reach + 1)
        if x != trigger:
            return [(x, 0.0, (far, owed))]
        out = [(miss, 0.0, (far, owed)), (after, gains[1], (far, owed or reach))]
        return out + [(before, gains[0], (far, owed))] * (since <= reach)

    return build((reach + 1, 0), step, alphabet, lambda s: not s[1])


def grammar() -> Transducer:
    """The four transducers composed: symbols of a clause to channels."""
    insults = near("I", "p", "t", "t", (1.0, 1.0), INSULT_REACH, "ITYWrn")
    threats = near("T", "W", "k", "K", (1.0, 2.0), THREAT_REACH, "TYWrnpt")
    return compose(compose(compose(report(), negation()), insults), threats)


_grammar: list[Transducer] = []


class Matcher:
    """The learned words and the composed grammar made ready for scanning."""

    def __init__(self, g: Grammar):
        self.g, self.lengths = g, sorted({len(p) for p in g.prefixes})
        self.kind = dict.fromkeys(REPORT, "R") | dict.fromkeys(TARGET, "Y") | dict.fromkeys(NEGATION, "N") | dict.fromkeys(THREAT, "T")
        self.scan = ahocorasick.Automaton()
        for p in {*g.words, *g.prefixes, *THREAT}:
            self.scan.add_word(p, (len(p), p in g.prefixes))
        self.scan.make_automaton()
        if not _grammar:
            _grammar.append(grammar())
        self.machine, self.readings = _grammar[0], {}

    def weight(self, word: str) -> float:
        w = self.g.words.get(word, 0.0)
        for n in self.lengths:
            if n <= len(word):
                w = max(w, self.g.prefixes.get(word[:n], 0.0))
        return w

    def reading(self, symbols: str) -> tuple[str, ...]:
        """What the composed grammar writes for the symbols of a clause."""
        found = self.readings.get(symbols)
        if found is None:
            best = self.machine.best(symbols)
            assert best is not None  # every state passes every symbol on to some state that owes nothing
            found = best[1]
            if len(symbols) <= KEPT_LENGTH:
                if len(self.readings) >= KEPT:
                    self.readings.clear()
                self.readings[symbols] = found
        return found

    def clause(self, text: str) -> tuple[float, ...]:
        """Channel weights of one clause."""
        symbols, weights, run = [], [], 0
        for m in _WORD.finditer(text):
            w = self.weight(m[0])
            kind = "I" if w > 0 else self.kind.get(m[0], "W")
            run = run + 1 if kind == "W" else 0
            if run <= LONG_RUN:  # a longer run leaves every state as this one does
                symbols.append(kind)
                weights.append(w or 1.0)
        out = dict.fromkeys(CHANNELS, 0.0)
        for x, w in zip(self.reading("".join(symbols)), weights, strict=True):
            if x in WRITTEN:
                channel, times = WRITTEN[x]
                out[channel] += times * w
        return tuple(out[c] for c in CHANNELS)

    def channels(self, text: str) -> list[float]:
        """Sums over the clauses of a whole text that hold a match."""
        total = [0.0] * len(CHANNELS)
        low, done = text.lower(), -1
        for end, (length, prefix) in self.scan.iter(low):
            start = end - length + 1
            if start < done or start and low[start - 1].isalnum() or not prefix and end + 1 < len(low) and low[end + 1].isalnum():
                continue
            a = max(low.rfind(c, max(0, done), start) for c in ".!?;:\n|") + 1 or max(0, done)
            m = _CLAUSE.search(low, end + 1)
            done = m.end() if m else len(low)
            for k, v in enumerate(self.clause(low[a:done])):
                total[k] += v
        return total


def _labelled(docs: DataFrame, labels: DataFrame, rows_per_class: int) -> tuple[DataFrame, dict[int, float]]:
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {r.toxic: r.n for r in marks.where("toxic in (0, 1)").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {y: min(1.0, rows_per_class / max(1, sizes.get(y, 0))) for y in (0, 1)}
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    picked = marks.where(F.col("toxic").isin(0, 1) & (part < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0])))
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(picked), "doc_id").select("text", "toxic"), share if len(sizes) == 2 else {}


def _patterns(sample: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Weights of words and word beginnings by the log odds of distinct clauses of toxic and of other texts."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for text, y in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                for clause in _CLAUSE.split(text.lower()):
                    own = _WORD.findall(clause)
                    key = hash_text(" ".join(own))
                    found.update((w, y, key) for w in set(own))
            w, y, k = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(w, pa.string()), pa.array(y, pa.int32()), pa.array(k, pa.int64())], names=["word", "toxic", "clause"])

    rows = sample.mapInArrow(giving_back(words), "word string, toxic int, clause bigint").distinct()
    by_word = rows.groupBy("word").agg(F.count_if(F.col("toxic") == 1).alias("pos"), F.count_if(F.col("toxic") == 0).alias("neg")).persist()
    forms = by_word.select("word", "pos", "neg", F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.substring("word", 1, n).alias("p")) for n in (0, *PREFIXES)])).alias("f"))
    forms = forms.where((F.col("f.n") == 0) | (F.length("word") > F.col("f.n")))
    forms = forms.select(F.when(F.col("f.n") == 0, F.col("word")).otherwise(F.col("f.p")).alias("form"), (F.col("f.n") > 0).alias("prefix"), "pos", "neg")
    total = by_word.agg(F.coalesce(F.sum("pos"), F.lit(0)), F.coalesce(F.sum("neg"), F.lit(0))).first()
    odds = F.log((F.col("pos") + 0.5) / (total[0] + 1)) - F.log((F.col("neg") + 0.5) / (total[1] + 1))
    found = (
        forms.groupBy("form", "prefix").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.max("pos").alias("top"))
        .withColumn("odds", odds)
        .where((F.col("pos") >= LEAST_CLAUSES) & (F.col("odds") >= LEAST_ODDS) & (~F.col("prefix") | (F.col("pos") >= 1.5 * F.col("top"))))
        .collect()
    )
    by_word.unpersist()
    return {r.form: r.odds for r in found if not r.prefix}, {r.form: r.odds for r in found if r.prefix}


def hash_text(s: str) -> int:
    return xxhash.xxh3_64_intdigest(s.encode("utf-8", "replace")) - (1 << 63)


def _channels(texts: DataFrame, grammar: Grammar, keep: str, kept_type: str) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(grammar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Matcher(shared.value)
        for batch in batches:
            x = np.array([m.channels(t.as_py() or "") for t in batch.column("text")], float).reshape(-1, len(CHANNELS))
            size = pa.array([len(t.as_py() or "") / SIZE_UNIT for t in batch.column("text")], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(keep), *[pa.array(x[:, i]) for i in range(len(CHANNELS))], size], names=[keep, *CHANNELS, "size"])

    return texts.select(keep, "text").mapInArrow(giving_back(run), f"{keep} {kept_type}, " + ", ".join(f"{c} double" for c in (*CHANNELS, "size")))


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps; first the intercept."""
    a, w = np.column_stack([np.ones(len(x)), x]), np.zeros(x.shape[1] + 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + 0.5 * np.eye(len(w))
        w = w + np.linalg.solve(h, a.T @ (y - p) - 0.5 * w)
    return w


def train(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> Grammar:
    """A grammar learned from the labelled rows among ``docs``."""
    sample, share = _labelled(docs, labels, rows_per_class)
    if not share:
        return Grammar()
    words, prefixes = _patterns(sample)
    g = Grammar(words or Grammar().words, prefixes)
    found = _channels(sample, g, "toxic", "int").toArrow()
    x = np.log1p(np.column_stack([found.column(c).to_numpy() for c in (*CHANNELS, "size")]))
    w = _fit(x, found.column("toxic").to_numpy().astype(float))
    g.coef, g.size_coef = tuple(np.maximum(w[1:-1], 0.0)), float(min(w[-1], 0.0))
    g.intercept = float(w[0] - math.log(share[1] / share[0]))
    return g


def score(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """``doc_id, score, predicted`` and the channel weights of every whole text."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    z = F.lit(grammar.intercept)
    for c, w in zip(CHANNELS, grammar.coef, strict=True):
        z = z + F.lit(float(w)) * F.log1p(c)
    z = z + F.lit(grammar.size_coef) * F.log1p("size")
    found = _channels(texts, grammar, "doc_id", "bigint").withColumn("score", 1 / (1 + F.exp(-z)))
    return found.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), *CHANNELS)
