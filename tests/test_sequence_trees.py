from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from strandlake.functions import sequence as fs
from strandlake.operators import msa, repeats, simulate, tree
from strandlake.operators.graph import connected_components
from strandlake.sources import reads as fq
from strandlake.sources import sinks
from strandlake.sources import text as tx


def one(spark, col, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values))
    return df.select(col.alias("x")).first().x


def test_scalars(spark):
    c = F.col
    assert one(spark, fs.reverse_complement(c("s")), s="AACGN") == "NCGTT"
    assert tuple(one(spark, fs.end_gaps(c("s")), s="--AC-")) == (2, 1)
    assert tuple(one(spark, fs.reverse_range(F.lit(2), F.lit(5), F.lit(10)), s="")) == (5, 8)
    assert one(spark, fs.translate_dna(c("s")), s="ATGGCCTAAC") == "MA*"
    assert one(spark, fs.back_translate_gaps(c("p"), c("d")), p="M-A", d="ATGGCC") == "ATG---GCC"
    got = one(spark, fs.alignment_variants(c("r"), c("q"), F.lit(10)), r="AC-GT", q="ATCG-")
    assert [tuple(x) for x in got] == [(12, "C", "T"), (12, "-", "C")]
    assert tuple(one(spark, fs.normalise_indel(F.lit(250), c("r"), c("a")), r="TA", a="T")) == (251, "A", "-")
    assert tuple(one(spark, fs.codon_change(c("s"), F.lit(0), F.lit(6), F.lit(1), F.lit(5), F.lit("C"), F.lit("A")), s="ATGGCC")) == ("GCC", "GAC", "A", "D", 2)
    assert tuple(one(spark, fs.codon_change(c("s"), F.lit(0), F.lit(6), F.lit(-1), F.lit(1), F.lit("G"), F.lit("T")), s="GGCCAT")) == ("GCC", "GCA", "A", "A", 3)
    w = one(spark, fs.window_identity(c("a"), c("b"), 4, 2), a="AAAATTTT", b="AAAAGTTT")
    assert [(x.at, x.pid) for x in w] == [(2, 1.0), (4, 0.75)]


def score(a, b):
    s, gap = 0, None
    for x, y in zip(a, b, strict=True):
        if "-" in (x, y):
            side = x == "-"
            s += fs.GAP_EXTEND + (fs.GAP_OPEN if gap != side else 0)
            gap = side
        else:
            s, gap = s + (fs.MATCH if x == y else fs.MISMATCH), None
    return s


def best(a, b):
    from functools import cache

    @cache
    def go(i, j, state):
        if i == len(a) and j == len(b):
            return 0
        out = []
        if i < len(a) and j < len(b):
            out.append(go(i + 1, j + 1, 0) + (fs.MATCH if a[i] == b[j] else fs.MISMATCH))
        if i < len(a):
            out.append(go(i + 1, j, 1) + fs.GAP_EXTEND + (fs.GAP_OPEN if state != 1 else 0))
        if j < len(b):
            out.append(go(i, j + 1, 2) + fs.GAP_EXTEND + (fs.GAP_OPEN if state != 2 else 0))
        return max(out)

    return go(0, 0, 0)


def test_alignment_is_best():
    r = random.Random(5)
    for _ in range(60):
        a, b = ("".join(r.choice("ACGT") for _ in range(r.randint(0, 9))) for _ in range(2))
        x, y = fs.align_pair(a, b)
        assert x.replace("-", "") == a and y.replace("-", "") == b and len(x) == len(y)
        assert score(x, y) == best(a, b), (a, b, x, y)
    x, y = fs.align_pair("TTACGTACGT", "ACGTACG", free_ends=True)
    assert x.replace("-", "") == "TTACGTACGT" and y.strip("-") == "ACGTACG"


def test_reads(spark, tmp_path):
    names = ["a_R1.fastq.gz", "a_R2.fastq.gz", "b_1_001.fq", "b_2_001.fq", "c_singletons.fq"]
    files = spark.createDataFrame([(f"/{'g' if n.endswith('gz') else 'p'}/{n}",) for n in names], "path string")
    assert {(r.pair, r.mate) for r in fq.pair_files(files).collect()} == {("a_R", 1), ("a_R", 2), ("b_", 1), ("b_", 2)}
    with pytest.raises(Exception, match="not a pair"):
        fq.pair_files(files.where("path like '%a_R1%'")).collect()
    (tmp_path / "x_1.fq").write_text("".join(f"@r{i}\nACGT\n+\nIIII\n" for i in range(5)))
    got = fq.fastq(spark, str(tmp_path / "x_1.fq")).orderBy("ordinal").collect()
    assert [r.name for r in got] == [f"r{i}" for i in range(5)] and got[0].qual == [40] * 4
    (tmp_path / "a.sam").write_text("@SQ\tSN:c\tLN:100\n@RG\tID:s1\nq1\t99\tc\t11\t60\t2S3M1I2M2D1M\t=\t40\t50\tACGTACGTA\tIIIIIIIII\n")
    r = fq.sam(spark, str(tmp_path / "a.sam")).first()
    assert (r["sample"], r.start0, r.end0, r.is_proper, r.is_read1) == ("s1", 10, 18, True, True)
    assert [tuple(p) for p in r.pairs] == [(2, 10), (3, 11), (4, 12), (6, 13), (7, 14), (8, 17)]
    t = spark.createDataFrame([("A" * 80, [40] * 60 + [2] * 20), ("A" * 30, [40] * 30)], "s string, q array<int>").select(fs.quality_trim("s", "q").alias("t")).collect()
    assert t[0].t.kept and 58 <= len(t[0].t.seq) <= 64 and not t[1].t.kept
    assert one(spark, fs.cut_adaptors(F.col("s"), ["AGATCGGAAGAG"]), s="TTTTAGATCGGAAGAGCC") == "TTTT"


def test_files(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">x one\nACGT\nAC\n>y\nTTTT\n")
    assert {(r.name, r.seq) for r in tx.fasta(spark, str(tmp_path / "a.fa")).collect()} == {("x", "ACGTAC"), ("y", "TTTT")}
    rows = spark.createDataFrame([("s1", "A" * 70), ("s2", "C" * 70)], "sample string, seq string")
    (tmp_path / "a.phy").write_text("\n".join(r.line for r in sinks.phylip_lines(rows).orderBy("block", "sample").collect()))
    assert {(r.name, r.seq) for r in tx.phylip(spark, str(tmp_path / "a.phy")).collect()} == {("s1", "A" * 70), ("s2", "C" * 70)}
    (tmp_path / "g.gbk").write_text('LOCUS       NC_1 12 bp\nACCESSION   NC_1\nFEATURES             Location/Qualifiers\n     CDS             complement(2..7)\n                     /locus_tag="L1"\n                     /gene="abc"\n     misc_feature    1..12\n                     /note="Genomic Island 1"\nORIGIN\n        1 acgtacgtac gt\n//\n')
    genome, feats = tx.genbank(spark, str(tmp_path / "g.gbk"))
    assert genome.first().seq == "ACGTACGTACGT" and [tuple(r) for r in feats.collect()] == [("NC_1", "L1", "CDS", 1, 7, -1, "abc")]
    assert sinks.orf_fasta(feats, genome).first().seq == "TACGTACGTACG"[4:10] or len(sinks.orf_fasta(feats, genome).first().seq) == 6


def test_trees(spark):
    t = tx.tree_table(spark, tx.parse_newick("(O:1,((A:1,B:2):1,(C:1,D:1):3):1);"))
    assert tx.write_newick(t) == "(O:1,((A:1,B:2):1,(C:1,D:1):3):1);"
    far = {r.label: r.distance for r in tree.depths(t).join(t.select("node", "label"), "node").collect() if r.label}
    assert far == {"O": 1.0, "A": 3.0, "B": 4.0, "C": 5.0, "D": 5.0}
    cl = tree.clades(t)
    assert sorted(len(r.tips) for r in cl.collect()) == [1, 1, 1, 1, 1, 2, 2, 4, 5]
    m = spark.createDataFrame([(s, col, ch) for col, chars in ((1, "ATTAT"), (2, "ATTTT")) for s, ch in zip("OABCD", chars, strict=True)], "sample string, col int, ch string")
    inner = cl.where(~F.array_contains("tips", "O"))
    got = {(r.col, tuple(sorted(r.tips)), r.n_clades) for r in msa.derived_clades(m, inner, "O").join(cl.select("node", "tips"), "node").collect()}
    assert got == {(1, ("A", "B"), 2), (1, ("D",), 2), (2, ("A", "B", "C", "D"), 1)}
    rooted = tree.root_at_outgroup(t, "C")
    d = {r.label: r.distance for r in tree.depths(rooted).join(rooted.select("node", "label"), "node").collect() if r.label}
    assert d["C"] == 0.5 and abs(d["D"] - 1.5) < 1e-9 and abs(d["O"] - 5.5) < 1e-9
    mid = tree.root_at_midpoint(t)
    d = {r.label: r.distance for r in tree.depths(mid).join(mid.select("node", "label"), "node").collect() if r.label}
    assert max(d.values()) == 3.5 and sum(v == 3.5 for v in d.values()) >= 2
    places = {n: x for n, x, _ in tree.layout(t)}
    assert len(places) == 9 and max(places.values()) == 4.0
    assert {r.name for r in msa.tips_differ(m.where("sample <> 'O'"), t).collect()} == {"O"}


def test_alignment_columns(spark):
    ref = spark.createDataFrame([("c", p, "A") for p in range(1, 8)], "chrom string, pos1 int, ch string")
    snps = spark.createDataFrame([("s1", "c", 2, "T"), ("s2", "c", 5, "G")], "sample string, chrom string, pos1 int, alt string")
    samples = spark.createDataFrame([("s1",), ("s2",), ("s3",)], "sample string")
    gaps = spark.createDataFrame([("s3", "c", 1, 3)], "sample string, chrom string, start int, end int")
    nc = spark.createDataFrame([("s2", "c", 2)], "sample string, chrom string, pos1 int")
    rows = {r["sample"]: r.seq for r in sinks.aligned_rows(msa.numbered(msa.columns(snps, samples, ref, gaps, nc))).collect()}
    assert rows == {"reference": "AA", "s1": "TA", "s2": "?G", "s3": "-A"}
    whole = {r["sample"]: r.seq for r in sinks.aligned_rows(msa.numbered(msa.columns(snps, samples, ref, gaps, nc, all_sites=True))).collect()}
    assert whole["s3"] == "A--AAAA" and len(set(map(len, whole.values()))) == 1
    core = msa.columns(snps, samples, ref, gaps, core_only=True)
    assert {r.pos1 for r in core.collect()} == {5}
    assert [tuple(r) for r in msa.gap_counts(msa.columns(snps, samples, ref, gaps)).collect()] == [("c", 2, 1)]


def test_components_and_repeats(spark):
    e = spark.createDataFrame([("a", "b"), ("c", "b"), ("x", "y"), ("z", "z")], "query string, hit string")
    assert {r.node: r.component for r in repeats.homology_groups(e).collect()} == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x", "z": "z"}
    assert connected_components(e.where("query = 'none'"), "query", "hit").count() == 0
    path = spark.createDataFrame([(i, i + 1) for i in range(60)], "a int, b int")
    assert {r.component for r in connected_components(path).collect()} == {0}
    f = spark.createDataFrame([("c", f"L{i}", i * 100, i * 100 + 90) for i in range(1, 12)], "chrom string, locus string, start0 int, end0 int")
    g = spark.createDataFrame([("L5", "g"), ("L8", "g"), ("L1", "h"), ("L5x", "h"), ("L9", "k"), ("L5", "k")], "node string, component string")
    assert {(r.component, r.locus) for r in repeats.tandem(f, g).collect()} == {("g", "L5"), ("g", "L8")}
    hits = spark.createDataFrame([("L1", "L7"), ("L2", "L8"), ("L3", "L9"), ("L7", "L1"), ("L8", "L2"), ("L9", "L3")], "query string, hit string")
    blocks = {(r.query_from, r.query_to, r.hit_from, r.hit_to, r.n) for r in repeats.contiguous_blocks(f, hits).collect()}
    assert blocks == {(100, 390, 700, 990, 3), (700, 990, 100, 390, 3)}
    r = random.Random(2)
    s = "".join(r.choice("ACGT") for _ in range(500))
    genome = spark.createDataFrame([("c", s + "G" + s[100:160])], "chrom string, seq string")
    assert sorted(r.pos0 for r in repeats.kmer_seeds(genome, 31, 64).collect()) == sorted([*range(100, 130), *range(501, 531)])


def test_simulation(spark):
    assert one(spark, simulate.shifted(F.col("p"), [(100, 150), (200, 260)]), p=500) == 390
    spots = spark.createDataFrame([("c", i, "ACGT"[i % 4]) for i in range(2000)], "chrom string, pos0 int, ref string")
    for kind, each in (("pseudo_tree", 60), ("random", 100), ("discrete", 100)):
        s = simulate.snps(spots, 100, 3, 1, kind)
        n = {r.rep: r["count"] for r in s.groupBy("rep").count().collect()}
        assert n == {0: each, 1: each, 2: each}, kind
        assert s.where("ref = base").count() == 0
    assert sorted(map(tuple, simulate.snps(spots, 100, 3, 1).collect())) == sorted(map(tuple, simulate.snps(spots, 100, 3, 1).collect()))
    d = simulate.indels(spots, [1, 2, 3, 4, 5, 6], 2, 4)
    assert d.count() == 2 * 2 + 4
    genome = spark.createDataFrame([("c", "ACGTACGT")], "chrom string, seq string")
    e = spark.createDataFrame([(0, "c", 1, 1, "T"), (0, "c", 4, 2, ""), (0, "c", 7, 0, "GG")], "rep int, chrom string, pos0 int, del_len int, ins string")
    assert simulate.apply_edits(genome, e).first().seq == "ATGTGGGT"
    pairs = spark.createDataFrame([(p, o, m) for p in "ab" for o in range(500) for m in (1, 2)], "pair string, ordinal int, mate int")
    kept = simulate.sample_pairs(pairs, 0.3, 9)
    n = kept.groupBy("pair", "ordinal").count()
    assert n.where("count <> 2").count() == 0 and 200 < n.count() < 400
    free = simulate.available(spark.createDataFrame([("c", 10)], "chrom string, length int"), spark.createDataFrame([("c", 4, 6)], "chrom string, start int, end int"), 1)
    assert sorted(r.pos0 for r in free.collect()) == [0, 1, 2, 7, 8, 9]
