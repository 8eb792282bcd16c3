"""Sequence functions as Spark columns, and Arrow UDFs where a column cannot express them."""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

# The standard genetic code, codons in the order TCAG.
BASES = "TCAG"
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODONS = {"".join(c): a for c, a in zip(product(BASES, repeat=3), AMINO_ACIDS, strict=True)}


def reverse_complement(seq: Column) -> Column:
    """Reverse complement; letters other than A, C, G and T stay as they are."""
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def amino_acid(codon: Column) -> Column:
    """Amino acid of a codon; ``X`` for one that is not standard, null for null."""
    table = F.create_map(*[F.lit(x) for kv in CODONS.items() for x in kv])
    return F.when(codon.isNotNull(), F.coalesce(F.try_element_at(table, F.upper(codon)), F.lit("X")))


def translate_dna(seq: Column) -> Column:
    """Protein of the whole codons of a sequence, stops as ``*``."""
    n = F.floor(F.length(seq) / 3).cast("int")
    parts = F.transform(F.sequence(F.lit(1), n), lambda i: amino_acid(F.substring(seq, (i - 1) * 3 + 1, F.lit(3))))
    return F.when(n > 0, F.array_join(parts, "")).otherwise(F.when(seq.isNotNull(), F.lit("")))


def end_gaps(aligned: Column) -> Column:
    """Struct of the number of leading and trailing ``-``."""
    n = F.length(aligned)
    lead, trail = n - F.length(F.ltrim(aligned, F.lit("-"))), n - F.length(F.rtrim(aligned, F.lit("-")))
    return F.struct(lead.alias("leading"), trail.alias("trailing"))


def reverse_range(start: Column, end: Column, length: Column) -> Column:
    """The half-open range seen from the other strand."""
    return F.struct((length - end).alias("start"), (length - start).alias("end"))


def codon_change(orf_seq: Column, start0: Column, end0: Column, strand: Column, pos1: Column, ref: Column, alt: Column) -> Column:
    """Codon and amino acid before and after a substitution within a feature, by its own strand; ``-`` for other variants."""
    forward = pos1 - 1 - start0
    offset = F.when(strand >= 0, forward).otherwise(end0 - pos1)
    at, first = F.pmod(offset, F.lit(3)), (F.floor(offset / 3) * 3).cast("int")
    sense = F.when(strand >= 0, orf_seq).otherwise(reverse_complement(orf_seq))
    base = F.when(strand >= 0, alt).otherwise(reverse_complement(alt))
    codon = F.substring(sense, first + 1, F.lit(3))
    new = F.concat(F.substring(codon, F.lit(1), at.cast("int")), base, F.substring(codon, (at + 2).cast("int"), F.lit(3)))
    snp = (F.length(ref) == 1) & (F.length(alt) == 1) & (alt != "-")
    show = lambda c: F.when(snp, c).otherwise("-")
    return F.struct(show(codon).alias("codon"), show(new).alias("new_codon"), show(amino_acid(codon)).alias("aa"), show(amino_acid(new)).alias("new_aa"), F.when(snp, at + 1).alias("codon_pos"))


def normalise_indel(pos1: Column, ref: Column, alt: Column) -> Column:
    """An indel without the base that both alleles start with, one position on; an emptied allele is ``-``."""
    shared = ((F.length(ref) > 1) | (F.length(alt) > 1)) & (F.substring(ref, 1, 1) == F.substring(alt, 1, 1))
    rest = lambda c: F.when(F.length(c) > 1, F.substring(c, F.lit(2), F.length(c))).otherwise("-")
    return F.struct(F.when(shared, pos1 + 1).otherwise(pos1).alias("pos1"), F.when(shared, rest(ref)).otherwise(ref).alias("ref"), F.when(shared, rest(alt)).otherwise(alt).alias("alt"))


def back_translate_gaps(protein: Column, dna: Column) -> Column:
    """A gapped protein's codons from its DNA: ``---`` for each gap."""
    chars = F.split(protein, "")
    start = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))
    step = lambda acc, c: F.when(c == "-", F.struct(acc["at"].alias("at"), F.concat(acc["out"], F.lit("---")).alias("out"))).otherwise(
        F.struct((acc["at"] + 3).alias("at"), F.concat(acc["out"], F.substring(dna, acc["at"], F.lit(3))).alias("out")))
    return F.aggregate(F.filter(chars, lambda c: c != ""), start, step)["out"]


def alignment_variants(ref: Column, query: Column, start0: Column) -> Column:
    """Differences of two aligned rows as ``(pos1, ref, alt)``, end gaps left out; an inserted base has the position before it."""
    r, q = F.split(ref, ""), F.split(query, "")
    lead = F.greatest(end_gaps(ref)["leading"], end_gaps(query)["leading"])
    trail = F.greatest(end_gaps(ref)["trailing"], end_gaps(query)["trailing"])
    before = lambda i: F.length(F.translate(F.substring(ref, F.lit(1), i), "-", ""))
    rows = F.transform(F.sequence(F.lit(1), F.size(r)), lambda i: F.struct(F.element_at(r, i).alias("ref"), F.element_at(q, i).alias("alt"), i.alias("i")))
    kept = F.filter(rows, lambda x: (x["ref"] != x["alt"]) & (x["i"] > lead) & (x["i"] <= F.size(r) - trail))
    return F.transform(kept, lambda x: F.struct((start0 + before(x["i"])).alias("pos1"), x["ref"].alias("ref"), x["alt"].alias("alt")))


def window_identity(a: Column, b: Column, window: int = 100, step: int = 20) -> Column:
    """Share of equal columns in windows of two aligned rows, as ``(at, pid)`` with ``at`` the window's middle."""
    n = F.least(F.length(a), F.length(b))
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x == y).cast("int"))
    starts = F.when(n > window, F.sequence(F.lit(0), n - window - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))
    share = lambda i: F.aggregate(F.slice(same, i + 1, F.lit(window)), F.lit(0), lambda acc, x: acc + x) / F.lit(window)
    return F.transform(starts, lambda i: F.struct((i + window // 2).alias("at"), share(i).alias("pid")))


#: Scores of the global alignment; stated here because no others are prescribed.
MATCH, MISMATCH, GAP_OPEN, GAP_EXTEND = 1, -2, -4, -1
#: Cells of a matrix (one byte each) above which a pair is cut in two.
MOST_CELLS = 32_000_000


def _ends(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best scores of all of ``x`` against each beginning of ``y``, and of those that end in a gap of ``y``, row by row."""
    ext = np.arange(len(y) + 1) * GAP_EXTEND
    best = np.concatenate(([0], GAP_OPEN + ext[1:]))
    gap = np.full(len(y) + 1, -(10**8), np.int64)
    for i, c in enumerate(x, 1):
        gap = np.maximum(best + GAP_OPEN + GAP_EXTEND, gap + GAP_EXTEND)
        new = gap.copy()
        new[1:] = np.maximum(new[1:], best[:-1] + np.where(y == c, MATCH, MISMATCH))
        new[0] = GAP_OPEN + i * GAP_EXTEND
        new[1:] = np.maximum(new[1:], np.maximum.accumulate(new - ext)[:-1] + GAP_OPEN + ext[1:])
        best = new
    return best, gap


def align_pair(a: str, b: str, free_ends: bool = False) -> tuple[str, str]:
    """Global alignment with affine gaps, row-wise in NumPy; with ``free_ends`` gaps at either end of a row cost nothing.

    Memory is bounded by ``MOST_CELLS``: a larger pair is cut at the middle of ``a``, where the best alignment crosses it, and both parts are
    aligned by themselves; a gap that is cut counts as opened twice (with ``free_ends`` the outer ends stay free only if the whole pair fits).
    """
    if (len(a) + 1) * (len(b) + 1) > MOST_CELLS and len(a) > 1:
        x, y = np.frombuffer(a.encode(), np.uint8), np.frombuffer(b.encode(), np.uint8)
        half = len(a) // 2
        (h0, g0), (h1, g1) = _ends(x[:half], y), _ends(x[half:][::-1], y[::-1])
        at = int(np.maximum(h0 + h1[::-1], g0 + g1[::-1] - GAP_OPEN).argmax())
        left, right = align_pair(a[:half], b[:at]), align_pair(a[half:], b[at:])
        return left[0] + right[0], left[1] + right[1]
    x, y = np.frombuffer(a.encode(), np.uint8), np.frombuffer(b.encode(), np.uint8)
    n, m = len(x), len(y)
    low = -10**8
    ext = np.arange(m + 1) * GAP_EXTEND
    H = np.zeros(m + 1, np.int64) if free_ends else np.concatenate(([0], GAP_OPEN + ext[1:]))
    V = np.full(m + 1, low, np.int64)  # best score that ends in a gap of b
    back = np.zeros((n + 1, m + 1), np.uint8)  # 0 diagonal, 1 up, 2 left; 4: the gap upwards goes on, 8: leftwards
    back[0, 1:] = 2
    back[0, 2:] |= 8
    back[1:, 0] = 1
    back[2:, 0] |= 4
    last_col = [H[m]]
    for i in range(1, n + 1):
        opened, going = H + GAP_OPEN + GAP_EXTEND, V + GAP_EXTEND
        V = np.maximum(opened, going)
        diagonal = np.full(m + 1, low, np.int64)
        diagonal[1:] = H[:-1] + np.where(y == x[i - 1], MATCH, MISMATCH)
        best = np.maximum(diagonal, V)
        best[0] = 0 if free_ends else GAP_OPEN + i * GAP_EXTEND
        # gaps leftwards: a prefix maximum over the row, as extension costs are linear
        run = np.maximum.accumulate(best - ext)
        left = np.full(m + 1, low, np.int64)
        left[1:] = run[:-1] + GAP_OPEN + ext[1:]
        new = np.maximum(best, left)
        back[i, 1:] = np.where(new == diagonal, 0, np.where(new == V, 1, 2))[1:]
        back[i] |= np.where(going > opened, 4, 0).astype(np.uint8)
        back[i, 1:] |= np.where(left[1:] > best[:-1] + GAP_OPEN + GAP_EXTEND, 8, 0).astype(np.uint8)
        H = new
        last_col.append(H[m])
    i, j = n, m
    tail_a = tail_b = ""
    if free_ends:
        bi, bj = int(np.argmax(last_col)), int(H.argmax())
        if last_col[bi] >= H[bj]:
            tail_a, tail_b, i = a[bi:], "-" * (n - bi), bi
        else:
            tail_a, tail_b, j = "-" * (m - bj), b[bj:], bj
    out_a, out_b, state = [], [], 0
    while i or j:
        move = state or back[i, j] & 3
        if i and j and move == 0:
            i, j = i - 1, j - 1
            out_a.append(a[i])
            out_b.append(b[j])
            state = 0
        elif i and (move == 1 or not j):
            state = 1 if back[i, j] & 4 and j else 0
            i -= 1
            out_a.append(a[i])
            out_b.append("-")
        else:
            state = 2 if back[i, j] & 8 and i else 0
            j -= 1
            out_a.append("-")
            out_b.append(b[j])
    return "".join(reversed(out_a)) + tail_a, "".join(reversed(out_b)) + tail_b


@pandas_udf(T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())]))
def global_align(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """Gapped rows of the global alignment of two sequences."""
    return pd.DataFrame([align_pair(x or "", y or "") for x, y in zip(a, b, strict=True)], columns=["a", "b"])


@pandas_udf(T.StructType([T.StructField("seq", T.StringType()), T.StructField("qual", T.ArrayType(T.IntegerType())), T.StructField("kept", T.BooleanType())]))
def quality_trim(seq: pd.Series, qual: pd.Series) -> pd.DataFrame:
    """Sliding-window trim of both ends at a mean quality of 25; reads of fewer than 50 bases are not kept."""
    out = []
    for s, q in zip(seq, qual, strict=True):
        q = np.asarray(q, dtype=float)
        w = max(1, int(0.1 * len(q)))
        if len(q) < w or not len(q):
            out.append(("", [], False))
            continue
        mean = np.convolve(q, np.ones(w) / w, "valid")
        good = np.flatnonzero(mean >= 25)
        if not len(good):
            out.append(("", [], False))
            continue
        first = int(good[0] + np.flatnonzero(q[good[0] : good[0] + w] >= 25)[0])
        bad = np.flatnonzero(mean[good[0] :] < 25)
        stop = len(q) if not len(bad) else int(good[0] + bad[0] + next((k for k in range(w) if q[good[0] + bad[0] + k] < 25), w))
        out.append((s[first:stop], q[first:stop].astype(int).tolist(), stop - first >= 50))
    return pd.DataFrame(out, columns=["seq", "qual", "kept"])


def cut_adaptors(seq: Column, adaptors: list[str], least: int = 8) -> Column:
    """The sequence up to the first occurrence of an adaptor, or of at least ``least`` of its first bases at the 3' end."""
    parts = []
    for a in adaptors:
        parts.append(a)
        parts += [a[:k] + "$" for k in range(len(a) - 1, least - 1, -1)]
    return F.regexp_replace(seq, "(?:" + "|".join(parts) + ").*$" if parts else "$^", "")
