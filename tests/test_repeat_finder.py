from __future__ import annotations

import random

from strandlake.functions import sequence as fs
from strandlake.operators import repeats

COMP = str.maketrans("ACGT", "TGCA")


def mutated(s, share, r):
    return "".join(r.choice([c for c in "ACGT" if c != x]) if r.random() < share else x for x in s)


def test_repeats_of_a_genome(spark):
    """Two copied stretches, one of them reversed, a tandem copy, and a stretch too different: what is found covers the copies and nothing else."""
    r = random.Random(11)
    rand = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    one, two, three, four = rand(2400), rand(1500), rand(900), rand(1500)
    parts, at, spans = [], 0, {}
    for name, s in (("", rand(1500)), ("a", one), ("", rand(2000)), ("b", two), ("", rand(1800)), ("A", mutated(one, 0.01, r)), ("", rand(2100)), ("B", mutated(two, 0.01, r)[::-1].translate(COMP)), ("", rand(1700)), ("c", three), ("C", mutated(three, 0.005, r)), ("", rand(1600)), ("d", four), ("", rand(1500)), ("D", mutated(four, 0.15, r)), ("", rand(900))):
        if name:
            spans[name] = (at, at + len(s))
        parts.append(s)
        at += len(s)
    genes = []
    for name, (s, e) in spans.items():
        strand = -1 if name == "B" else 1
        size = e - s
        genes += [("chr", f"{name}1", s + size // 10, s + size // 2 - 30, strand), ("chr", f"{name}2", s + size // 2 + 30, e - size // 10, strand)]
    genome = spark.createDataFrame([("chr", "".join(parts))], "chrom string, seq string")
    features = spark.createDataFrame(genes, "chrom string, locus string, start0 int, end0 int, strand int")
    found = sorted((x.start, x.end) for x in repeats.find_repeats(genome, features, 0.95, 400).collect())
    print("FOUND", found, spans)
    covered = {p for s, e in found for p in range(s, e)}
    wanted = {p for n in "aAbBcC" for p in range(*spans[n])}
    inner = {p for n in "aAbBcC" for p in range(spans[n][0] + 120, spans[n][1] - 120)}
    assert inner <= covered, sorted(inner - covered)[:5]
    assert len(covered - wanted) <= 60 * 12 and not covered & set(range(*spans["d"])) and not covered & set(range(*spans["D"]))
    hits = {(x.query, x.hit) for x in repeats.feature_hits(features, genome).collect()}
    assert {("a1", "A1"), ("A1", "a1"), ("b1", "B2"), ("c2", "C2")} <= hits and not any(q[0].lower() != h[0].lower() for q, h in hits)


def test_long_alignments(monkeypatch):
    """Pairs above the bound are cut and aligned in parts, to the score of the whole."""
    r = random.Random(5)

    def score(x, y):
        total = 0
        for i, (p, q) in enumerate(zip(x, y, strict=True)):
            if "-" in (p, q):
                side = x if p == "-" else y
                total += fs.GAP_EXTEND + (0 if i and side[i - 1] == "-" else fs.GAP_OPEN)
            else:
                total += fs.MATCH if p == q else fs.MISMATCH
        return total

    for _ in range(10):
        a = "".join(r.choice("ACGT") for _ in range(300))
        b = mutated(a[:120] + a[135:], 0.03, r) + "ACG"
        whole = fs.align_pair(a, b)
        monkeypatch.setattr(fs, "MOST_CELLS", 12_000)
        parts = fs.align_pair(a, b)
        monkeypatch.undo()
        assert parts[0].replace("-", "") == a and parts[1].replace("-", "") == b
        assert score(*parts) >= score(*whole) - 4 * fs.GAP_OPEN * -1
    assert fs.align_pair("", "ACGT") == ("----", "ACGT") and fs.align_pair("A", "") == ("A", "-")
    big = "".join(r.choice("ACGT") for _ in range(9_000))
    x, y = fs.align_pair(big, big[:4_000] + big[4_010:])
    assert x == big and y == big[:4_000] + "-" * 10 + big[4_010:] or score(x, y) == 8_990 + fs.GAP_OPEN + 10 * fs.GAP_EXTEND
