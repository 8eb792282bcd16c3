"""Filters by header, linkage by sample and chromosome, annotations, reports and the commands that write them."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from strandlake import cli
from strandlake.functions import sequence as fs
from strandlake.operators import intervals, linkage, msa, signal, variants
from strandlake.plans import pipelines
from strandlake.sources import reads as fq
from strandlake.sources import sinks, text, vcf
from tests.test_signal_variants import VCF

#: Ordinary annotations whose values happen to be places of samples.
PLAIN = VCF.replace("AC=3\t", "AC=3;MLEAC=1;MQRankSum=0\t").replace("AC=2\t", "AC=2;MLEAC=0,1;rearrangements2=2\t").replace("AC=1;DB", "AC=1;DB;HOM=2")


def test_only_declared_names_are_filters(spark, tmp_path):
    (tmp_path / "a.vcf").write_text(PLAIN)
    lines = vcf.lines(spark, str(tmp_path / "a.vcf"))
    got = {(r["sample"], r.pos1): sorted(r.filters) for r in vcf.calls(lines).collect()}
    assert got == {("s1", 100): [], ("s2", 100): [], ("s3", 100): [], ("s2", 150): ["rearrangements1"], ("s1", 200): ["LowQual"], ("s2", 200): ["LowQual"], ("s3", 250): [], ("s2", 300): []}
    wide = {r.pos1: r for r in variants.summary(vcf.calls(lines), ["s1", "s2", "s3"], vcf.no_calls(lines)).collect() if r.pos1 != 200}
    assert (wide[100].s1, wide[100].s2, wide[100]["Frequency (filtered)"]) == ("1", "1", 3) and wide[150].s2 == "rearrangements1"
    chosen = {(r["sample"], r.pos1): r.filters for r in vcf.calls(lines, ["MLEAC", "rearrangements1"]).collect()}
    assert chosen["s1", 100] == [] and chosen["s2", 150] == ["rearrangements1"] and chosen["s1", 200] == []


def test_linkage_within_samples_and_chromosomes(spark):
    """The same places and read names on two chromosomes and in two samples, and two alternatives of one position."""
    seen = []
    for sample, chrom, n in (("p", "c1", 25), ("p", "c2", 25), ("q", "c1", 30)):
        for i in range(n):
            seen += [(sample, chrom, f"r{i}", 100, "G", "alt" if chrom == "c1" else "ref", 60), (sample, chrom, f"r{i}", 200, "T", "alt" if sample == "p" and chrom == "c1" else "ref", 60)]
            seen.append((sample, chrom, f"r{i}", 200, "C", "other" if sample == "p" and chrom == "c1" else "ref", 60))
    seen += [("p", "c1", "low", 100, "G", "alt", 10), ("p", "c1", "low", 200, "T", "alt", 60), ("p", "c1", "noisy", 100, "G", "low", 60), ("p", "c1", "noisy", 200, "T", "alt", 60)]
    df = spark.createDataFrame(seen, "sample string, chrom string, qname string, pos1 int, alt string, allele string, mapq int")
    got = {(r["sample"], r.chrom, r.pos_a, r.alt_a, r.pos_b, r.alt_b): (r.spanning, r.both, r.first_only, r.second_only, r.neither) for r in linkage.linkage_table(df.where("mapq >= 60")).collect()}
    assert got == {
        ("p", "c1", 100, "G", 200, "T"): (25, 25, 0, 0, 0), ("p", "c2", 100, "G", 200, "T"): (25, 0, 0, 0, 25), ("p", "c2", 100, "G", 200, "C"): (25, 0, 0, 0, 25),
        ("q", "c1", 100, "G", 200, "T"): (30, 0, 30, 0, 0), ("q", "c1", 100, "G", 200, "C"): (30, 0, 30, 0, 0),
    }
    classes = {(r["sample"], r.chrom, r["class"]): r.n for r in linkage.fragment_classes(df).collect()}
    assert classes == {("p", "c1", "linked"): 25, ("p", "c2", "none"): 25, ("q", "c1", "one"): 30, ("p", "c1", "low_quality"): 1, ("p", "c1", "too_noisy"): 1}
    counted = {(r["sample"], r.chrom, r.pos1): (r.alt_reads, r.reads) for r in linkage.counted_alleles(df.where("mapq >= 60")).collect()}
    assert counted["p", "c1", 200] == (27, 27) and counted["q", "c1", 100] == (30, 30) and counted["q", "c1", 200] == (0, 30)
    loci = spark.createDataFrame([("c1", 10), ("c1", 20), ("c2", 15)], "chrom string, pos1 int")
    assert {r.pos1 for r in linkage.clusters(loci, 100).collect()} == {10, 20}


def test_indel_alleles_on_reads(spark):
    """A deletion, an insertion and a substitution on reads that have them, do not, or show something else."""
    ref = "AACCGGTTACGTACGTTTGACC"
    cases = [  # cigar, sequence, what the read shows at the deletion of GT (5: GGT -> G), at the insertion (9: A -> ATT), at the substitution (12: T -> C)
        ("22M", ref, "ref", "ref", "ref"),
        ("5M2D15M", "AACCG" + "TACGTACGTTTGACC", "alt", "ref", "ref"),
        ("9M2I13M", "AACCGGTTA" + "TT" + "CGTACGTTTGACC", "ref", "alt", "ref"),
        ("22M", ref[:11] + "C" + ref[12:], "ref", "ref", "alt"),
        ("5M2D2M1I13M", "AACCG" + "TA" + "G" + "CGTACGTTTGACC", "alt", "other", "ref"),
        ("4M4D14M", "AACC" + "ACGTACGTTTGACC", "gap", "ref", "ref"),
    ]
    df = spark.createDataFrame([(i, c, s) for i, (c, s, *_) in enumerate(cases)], "i int, cigar string, seq string")
    df = df.select("*", fq.aligned_pairs(F.col("cigar"), F.lit(0)).alias("pairs"), F.array_repeat(F.lit(30), F.length("seq").cast("int")).alias("qual"))
    show = lambda p, r, a: linkage.allele_of_any(F.col("seq"), F.col("qual"), F.col("pairs"), F.lit(p), F.lit(r), F.lit(a))
    got = {x.i: (x.d, x.n, x.s) for x in df.select("i", show(5, "GGT", "G").alias("d"), show(9, "A", "ATT").alias("n"), show(12, "T", "C").alias("s")).collect()}
    assert got == {i: tuple(c[2:]) for i, c in enumerate(cases)}


GENBANK = """LOCUS       chr1
FEATURES             Location/Qualifiers
     CDS             101..160
                     /locus_tag="L1"
                     /gene="abc"
     CDS             complement(150..209)
                     /locus_tag="L2"
     CDS             250..309
                     /locus_tag="L3"
ORIGIN
"""


def test_annotated_summary_and_reports(spark, tmp_path):
    seq = "".join(random.Random(1).choice("ACGT") for _ in range(1000))
    (tmp_path / "g.gb").write_text(GENBANK + "        1 " + seq.lower() + "\n//\n")
    genome, features = text.genbank(spark, str(tmp_path / "g.gb"))
    orfs = variants.with_orfs(features, genome)
    base = lambda p, to: (seq[p - 1], next(c for c in to if c != seq[p - 1]))
    rows = [("s1", "chr1", p, *base(p, "ACGT"), f) for p, f in ((102, []), (155, ["LowQual"]), (160, []), (200, []), (209, []), (309, ["genome_repeats", "LowQual"]), (500, []))] + [("s2", "chr1", 110, seq[109:111], seq[109], [])]
    calls = spark.createDataFrame(rows, "sample string, chrom string, pos1 int, ref string, alt string, filters array<string>")
    got = {r["Position (bp)"]: r for r in variants.annotated_summary(calls, ["s1", "s2"], orfs).collect()}
    assert list(got[102].asDict())[:12] == list(variants.SUMMARY_COLUMNS)
    codon = seq[100:103]
    new = codon[0] + rows[0][4] + codon[2]
    assert tuple(got[102])[4:12] == ("L1", "abc", "1", codon, new, fs.CODONS[codon], fs.CODONS[new], "2")
    assert tuple(got[155])[4:12] == ("L1,L2", "abc,", "multi", "multi", "multi", "multi", "multi", "multi")
    assert got[160]["Gene ID"] == "L2" and got[209]["Gene ID"] == "" and got[309]["Gene ID"] == ""  # a range's end is left out
    comp = str.maketrans("ACGT", "TGCA")
    at = (209 - 200) // 3 * 3
    sense = seq[149:209][::-1].translate(comp)[at : at + 3]
    assert (got[200]["Reference codon"], got[200]["Strand"], got[200]["Codon position"]) == (sense, "-1", str((209 - 200) % 3 + 1))
    assert tuple(got[500])[4:12] == ("", "", "0", "", "", "", "", "-1") and tuple(got[110])[6:9] == ("1", "-", "-")
    report = sorted(map(tuple, variants.filtered_report(calls, ["LowQual", "genome_repeats"], features).collect()))
    assert [(r[0], r[1], r[2], r[5]) for r in report] == [("s1", 155, "L1 (abc),L2", "LowQual"), ("s1", 309, "L3", "LowQual"), ("s1", 309, "L3", "genome_repeats")]
    listed = variants.grouped_list(calls, ["LowQual"], 2, "x")
    assert listed["all"].columns == ["Position", "Reference", "Variant", "Frequency", "Sample Group", "Filter"] and listed["all"].count() == 8 and listed["to_reference"].count() == 0
    checked = variants.checked_report(calls.withColumn("status", F.lit("absent")))
    assert checked.where("Filters = 'LowQual+genome_repeats'").count() == 1


def test_region_totals(spark):
    r = spark.createDataFrame([("a", 0, 10), ("a", 5, 20), ("a", 30, 31), ("b", 7, 7), ("b", 1, 2)], "k string, start int, end int")
    assert {x.k: (x.n, x.bp) for x in intervals.totals(r, ["k"]).collect()} == {"a": (3, 21), "b": (1, 1)}
    assert tuple(intervals.totals(r).first()) == (4, 21)


def test_windows_of_their_own(spark):
    """Smoothing with a window for each sample is smoothing each sample with its window; totals ahead and behind by hand."""
    r = random.Random(6)
    rows = [(s, i, None if r.random() < 0.4 else r.random()) for s in "ab" for i in range(120)]
    width = {"a": 40, "b": 95}
    df = spark.createDataFrame([(s, i, v, width[s]) for s, i, v in rows], "s string, bin int, ratio double, window int")
    got = {(x.s, x.bin): x.smoothed for x in signal.smooth_by(df, ["s"], "bin", "ratio", "window", 10).collect()}
    want = {}
    for s, w in width.items():
        want |= {(s, x.bin): x.smoothed for x in signal.smooth(df.where(F.col("s") == s), ["s"], "bin", "ratio", w, 10).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    for ahead in (True, False):
        for x in signal.window_totals(df, ["s"], "bin", {"n": F.lit(1), "m": F.when(F.col("ratio").isNull(), 1).otherwise(0)}, F.lit(7), ahead).collect():
            own = [v for s, i, v in rows if s == x.s and (x.bin <= i < x.bin + 7 if ahead else x.bin - 7 < i <= x.bin)]
            assert (x.n, x.m) == (len(own), sum(v is None for v in own))


def test_alignments(spark):
    cells = spark.createDataFrame([("s", c, p, "A") for c, ps in (("c2", (5, 1)), ("c1", (7, 3, 9))) for p in ps], "sample string, chrom string, pos1 int, ch string")
    assert {(r.chrom, r.pos1): r.col for r in msa.numbered(cells).collect()} == {("c1", 3): 1, ("c1", 7): 2, ("c1", 9): 3, ("c2", 1): 4, ("c2", 5): 5}
    rows = spark.createDataFrame([("a_long_name_1", "ACGT"), ("a_long_name_2", "ACGT")], "sample string, seq string")
    with pytest.raises(Exception, match="alike in ten"):
        sinks.phylip_lines(rows).collect()
    genome = spark.createDataFrame([("c", "ACGTACGTAC")], "chrom string, seq string")
    v = spark.createDataFrame([("x", 3, "G", "T"), ("x", 4, "T", "-"), ("x", 5, "-", "G")], "contig string, pos1 int, ref string, alt string")
    ranges = spark.createDataFrame([("x", 1, 6), ("y", 0, 2), ("y", 8, 10)], "contig string, start int, end int")
    assert {r.name: r.seq for r in sinks.pseudo_alignment(genome, v, ranges).collect()} == {"c": "ACGTACGTAC", "x": "-CT-AC----", "y": "AC------AC"}


SAM = "@SQ\tSN:chr1\tLN:1000\n@RG\tID:s1\n" + "".join(
    f"r{i}\t{flag}\tchr1\t{at}\t60\t50M\t=\t{mate}\t{tlen}\t{'ACGTA' * 10}\t{'I' * 50}\tRG:Z:s1\n"
    for i in range(12) for flag, at, mate, tlen in ((99, 80 + i // 2, 200 + i // 2, 170), (147, 200 + i // 2, 80 + i // 2, -170))
)


def test_more_commands(spark, tmp_path):
    body = VCF.replace("AC=3\t", "AC=3;QD=1.0\t").replace("AC=1;DB", "AC=1;DB;FS=300.0")
    (tmp_path / "a.vcf").write_text(body)
    (tmp_path / "r.csv").write_text("chrom,start,end\nchr1,99,160\n")
    (tmp_path / "x.csv").write_text("sample,chrom,filter,start,end\ns3,chr1,rearrangements2,240,260\n")
    (tmp_path / "g.gb").write_text(GENBANK + "        1 " + "acgta" * 200 + "\n//\n")
    (tmp_path / "a.sam").write_text(SAM)
    at = lambda x: str(tmp_path / x)
    cli.main(["FilterVariants", "--vcf", at("a.vcf"), "--out", at("f"), "--repeats", at("r.csv"), "--regions", at("x.csv"), "--genbank", at("g.gb")], spark)
    lines = [r.value for r in spark.read.text(at("f/vcf")).collect()]
    rows = {x.split("\t")[1]: x.split("\t") for x in lines if not x.startswith("#")}
    assert rows["100"][6] == "genome_repeats" and rows["150"][6] == "genome_repeats" and rows["300"][6] == "PASS" and "rearrangements2=2" in rows["250"][7].split(";")
    assert [x.split("\t")[1] for x in lines if not x.startswith("#")] == ["100", "150", "200", "250", "300"] and lines[0] == "##fileformat=VCFv4.2"
    again = vcf.calls(vcf.lines(spark, at("f/vcf")))
    assert {(r["sample"], r.pos1) for r in again.where(F.array_contains("filters", "rearrangements2")).collect()} == {("s3", 250)}
    report = spark.read.csv(at("f/filtered"), header=True).collect()
    assert {(r["sample"], r.position, r.CDS, r["filter"]) for r in report} >= {("s2", "150", "L1 (abc),L2", "genome_repeats"), ("s3", "250", "L3", "rearrangements2")}
    cli.main(["CallVariants", "--vcf", at("a.vcf"), "--out", at("h")], spark)
    rows = {x.split("\t")[1]: x.split("\t") for x in (r.value for r in spark.read.text(at("h/hard_filtered")).collect()) if not x.startswith("#")}
    assert rows["100"][6] == "standard_hard_filter" and rows["250"][6] == "standard_indel_hard_filter" and rows["300"][6] == "PASS"
    cli.main(["SummariseVariants", "--vcf", at("a.vcf"), "--out", at("s"), "--genbank", at("g.gb")], spark)
    assert spark.read.csv(at("s/annotated"), header=True).columns[:12] == list(variants.SUMMARY_COLUMNS)
    assert spark.read.csv(at("s/masked_among"), header=True).count() > 0
    cli.main(["AlignReads", "--sam", at("a.sam"), "--out", at("al")], spark)
    kept = sinks.load_table(spark, at("al/reads"))
    assert kept.count() == 24 and kept.where("is_dup").select("qname").distinct().count() == 6
    pooled = "".join(VCF.split("#CHROM")[0]) + "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\n" + "".join(f"chr1\t{p}\t.\t{r}\t{a}\t9\tPASS\tAC=2\tGT:GQ\t0/1:50\n" for p, r, a in ((90, "A", "G"), (95, "C", "T")))
    (tmp_path / "p.vcf").write_text(pooled)
    cli.main(["CheckLinkage", "--vcf", at("p.vcf"), "--sam", at("a.sam"), "--out", at("l"), "--min-depth", "1"], spark)
    assert (tmp_path / "l/linkage").exists() and spark.read.csv(at("l/frequencies"), header=True).count() == 2 and spark.read.csv(at("l/missing"), header=True).count() == 0


def test_linked_alleles_by_sample(spark, tmp_path):
    """Calls of one sample never meet reads of another."""
    (tmp_path / "a.sam").write_text(SAM + SAM.split("\n", 2)[2].replace("RG:Z:s1", "RG:Z:s2").replace("ACGTA" * 10, "TTTTT" * 10))
    reads = fq.sam(spark, str(tmp_path / "a.sam"))
    calls = spark.createDataFrame([("s1", "chr1", 90, "A", "T"), ("s1", "chr1", 95, "C", "T")], "sample string, chrom string, pos1 int, ref string, alt string")
    got = pipelines.linked_alleles(calls, reads, min_depth=1).collect()
    assert {r["sample"] for r in got} <= {"s1"} and all(r.spanning <= 12 for r in got)
    fastq = sinks.region_fastq(reads, spark.createDataFrame([("s1", "chr1", 0, 90)], "sample string, chrom string, start int, end int")).collect()
    assert {r["sample"] for r in fastq} == {"s1"} and {r.target for r in fastq} == {"R1", "R2"} and len(fastq) == 24
    assert [r.start0 for r in fq.coordinate_sorted(reads).collect()] == sorted(r.start0 for r in reads.collect())
