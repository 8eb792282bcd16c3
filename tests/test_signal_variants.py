from __future__ import annotations

from pyspark.sql import functions as F

from strandlake.operators import linkage, signal, variants
from strandlake.sources import sinks, vcf

VCF = """##fileformat=VCFv4.2
##FILTER=<ID=LowQual,Description="Low quality">
##FILTER=<ID=standard_hard_filter,Description="QD < 2.0, or others">
##INFO=<ID=rearrangements1,Number=.,Type=Integer,Description="FILTER: sample specific">
##contig=<ID=chr1,length=1000>
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\ts3
chr1\t100\t.\tA\tG\t50\tPASS\tAC=3\tGT\t1\t1\t1
chr1\t150\t.\tC\tT\t50\tPASS\tAC=1;rearrangements1=1\tGT\t0\t1\t0
chr1\t200\t.\tG\tA,T\t50\tLowQual\tAC=2\tGT\t1\t2\t0
chr1\t250\t.\tTA\tT\t50\tPASS\tAC=1;DB\tGT\t0\t0\t1
chr1\t300\t.\tC\tG\t50\tPASS\tAC=1\tGT\t.\t1\t0
"""


def text(spark, tmp_path, body=VCF):
    (tmp_path / "a.vcf").write_text(body)
    return vcf.lines(spark, str(tmp_path / "a.vcf"))


def test_vcf(spark, tmp_path):
    t = text(spark, tmp_path)
    meta = vcf.meta(t)
    kv = {r.kv["ID"]: r.kv for r in meta.where("kv['ID'] is not null").collect()}
    assert kv["standard_hard_filter"]["Description"] == "QD < 2.0, or others"
    assert [(r.chrom, r.length) for r in vcf.contigs(meta).collect()] == [("chr1", 1000)]
    assert {(r["name"], r.per_sample) for r in variants.filter_names(meta).collect()} == {("LowQual", False), ("standard_hard_filter", False), ("rearrangements1", True)}
    c = vcf.calls(t, ["LowQual", "rearrangements1"])
    got = {(r["sample"], r.pos1, r.alt): sorted(r.filters) for r in c.collect()}
    assert set(got) == {("s1", 100, "G"), ("s1", 200, "A"), ("s2", 100, "G"), ("s2", 150, "T"), ("s2", 200, "T"), ("s2", 300, "G"), ("s3", 100, "G"), ("s3", 250, "T")}
    assert got["s2", 150, "T"] == ["rearrangements1"] and got["s1", 200, "A"] == ["LowQual"]
    assert [(r["sample"], r.pos1) for r in vcf.no_calls(t).collect()] == [("s1", 300)]
    freq = {(r.pos1, r.alt): (r["class"], r.frequency) for r in variants.frequency_class(c, 3).collect()}
    assert [k for k, v in freq.items() if v[0] == "to_reference"] == [(100, "G")]
    listed = {(r.pos1, r.alt, r["filter"]): r.frequency for r in variants.masked_and_retained(c, ["rearrangements1", "LowQual"]).collect()}
    assert listed == {(100, "G", "retained"): 3, (250, "T", "retained"): 1, (300, "G", "retained"): 1, (150, "T", "rearrangements1"): 1, (200, "A", "LowQual"): 1, (200, "T", "LowQual"): 1}
    wide = {r.pos1: r for r in variants.summary(c, ["s1", "s2", "s3"], vcf.no_calls(t)).collect() if r.pos1 == 300}[300]
    assert (wide.s1, wide.s2, wide.s3, wide["Frequency"], wide["Frequency (filtered)"]) == ("?", "1", "0", 1, 1)
    kinds = {r.pos1: r.k for r in c.select("pos1", variants.kind(F.col("ref"), F.col("alt")).alias("k")).collect()}
    assert kinds == {100: "snp", 150: "snp", 200: "snp", 250: "indel", 300: "snp"}


def test_marking(spark, tmp_path):
    t = text(spark, tmp_path)
    marked = variants.mark_by_ranges(vcf.calls(t), spark.createDataFrame([("chr1", 99, 150)], "chrom string, start int, end int"), "genome_repeats", width=50)
    assert {r.pos1 for r in marked.where(F.array_contains("filters", "genome_repeats")).collect()} == {100, 150}
    assert {r.pos1 for r in variants.keep_unfiltered(marked, ["genome_repeats"]).collect()} == {200, 250, 300}
    m = spark.createDataFrame([("chr1", 200), ("chr1", 100)], "chrom string, pos1 int")
    out = [r.line for r in sinks.marked_vcf(t, m, "genome_repeats", "ambiguous").orderBy("ord", "sub").collect()]
    body = {x.split("\t")[1]: x.split("\t") for x in out if not x.startswith("#")}
    assert body["200"][6] == "LowQual;genome_repeats" and body["100"][6] == "genome_repeats" and body["250"][7] == "AC=1;DB"
    assert any(x.startswith("##FILTER=<ID=genome_repeats") for x in out) and out.index(next(x for x in out if x.startswith("#CHROM"))) == 6


def test_pooled(spark, tmp_path):
    body = VCF.split("#CHROM")[0] + "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tp\nchr1\t10\t.\tA\tG\t9\tPASS\tset=x;AC=2\tGT:GQ\t0/0/1/1:50\nchr1\t11\t.\tA\tG\t9\tLowQual\tset=x\tGT:GQ\t0/1:50\n"
    r = vcf.pooled(text(spark, tmp_path, body), 20).collect()
    assert len(r) == 1 and r[0].gt == [0, 0, 1, 1] and "set" not in r[0].info
    counted = spark.createDataFrame([("chr1", 10, 5, 11)], "chrom string, pos1 int, alt_reads int, reads int")
    f = linkage.allele_frequencies(vcf.pooled(text(spark, tmp_path, body)), counted).first()
    assert (f.called, f.counted) == (20, 18)


def reads(spark, rows):
    cols = "sample string, chrom string, qname string, is_proper boolean, is_dup boolean, start0 int, end0 int, tlen int"
    df = spark.createDataFrame([("s", "c", *r) for r in rows], cols)
    return df.select("*", *[F.lit(False).alias(c) for c in ("is_qcfail", "is_secondary", "is_unmapped")], F.lit(True).alias("is_read1"), F.lit(60).alias("mapq"))


def test_depth_and_ratio(spark):
    r = reads(spark, [("a", True, False, 0, 25, 200), ("b", False, False, 5, 35, 90), ("d", True, True, 10, 30, 10)])
    got = {x.bin: (x.total, x.proper) for x in signal.depth(r, 10, 5).collect()}
    assert got == {0: (1, 1), 1: (2, 1), 2: (2, 1), 3: (1, 0)}
    d = spark.createDataFrame([(0, 1, 1), (1, 2, 1), (2, 2, 1), (3, 1, 0), (4, 0, 0)], "bin int, total int, proper int")
    ratios = [x.r for x in d.select("bin", signal.ratio(F.col("total"), F.col("proper")).alias("r")).orderBy("bin").collect()]
    assert ratios == [0.0, 1.0, 1.0, 1.0, None]
    assert signal.mean_insert_size(r).first().mean_insert == 200.0
    assert signal.mean_insert_size(r.where("qname = 'b'")).first().mean_insert == -1.0
    assert abs(signal.proper_proportion(r, 0, 40).first().proportion - 2 / 3) < 1e-12


def test_smoothing(spark):
    s = spark.createDataFrame([(i, v) for i, v in enumerate((1.0, None, None, None, None))], "bin int, ratio double")
    got = signal.smooth(s, [], "bin", "ratio", 40, 10).collect()
    assert [(r.bin, r.smoothed) for r in got] == [(0, 0.5)]


def test_extension(spark):
    missing = {*range(10, 15), *range(45, 60)}
    ratios = spark.createDataFrame([("s", b, None if b in missing else 1.0) for b in range(80)], "sample string, bin int, ratio double")
    regions = spark.createDataFrame([("s", 0, 100), ("s", 300, 400), ("s", 450, 460), ("s", 600, 700)], "sample string, start int, end int")
    got = sorted((r.start, r.end) for r in signal.extend_regions(regions, ratios, ["sample"], 10, 20, 0.5).collect())
    assert got == [(0, 150), (300, 400), (450, 700)]


def test_hard_filters_totals_and_merges(spark):
    q = spark.createDataFrame([(1, 1.0, 10.0, 50.0, None, None), (2, 9.0, 10.0, 50.0, None, None), (3, None, 99.0, 50.0, 0.0, 0.0)], "i int, QD double, FS double, MQ double, MQRankSum double, ReadPosRankSum double")
    got = {r.i: (r.a, r.b) for r in q.select("i", variants.hard_filter(F.lit(True)).alias("a"), variants.hard_filter(F.lit(False)).alias("b")).collect()}
    assert got == {1: ("standard_hard_filter", "standard_indel_hard_filter"), 2: (None, None), 3: ("standard_hard_filter", None)}
    c = spark.createDataFrame([("g", "x", "c", 1, ["a"]), ("g", "x", "c", 1, ["b"]), ("h", "x", "c", 1, []), ("h", "x", "c", 2, ["a", "b"])], "grp string, class string, chrom string, pos1 int, filters array<string>")
    got = {(r.grp, r.step): r.positions for r in variants.cumulative_totals(c, ["a", "b"], "grp").collect()}
    assert got == {("g", 0): 1, ("g", 1): 1, ("h", 0): 2, ("h", 1): 1, ("h", 2): 1, ("all", 0): 2, ("all", 1): 1, ("all", 2): 1}
    m = variants.merge_calls(spark.createDataFrame([("k", 2, "T"), ("k", 1, "G"), ("l", 1, "A")], "k string, o int, v string"), ["k"], "v", ["o"])
    assert {r.k: (r.v, r.conflict) for r in m.collect()} == {"k": ("G", True), "l": ("A", False)}


def test_linkage(spark):
    seen = [(f"r{i}", p, a) for i in range(25) for p, a in ((10, "alt" if i < 15 else "ref"), (20, "alt" if i < 10 else "ref"))] + [("x", 10, "low")]
    t = linkage.linkage_table(spark.createDataFrame(seen, "qname string, pos1 int, allele string")).collect()
    assert [(r.pos_a, r.pos_b, r.both, r.first_only, r.second_only, r.neither) for r in t] == [(10, 20, 10, 5, 0, 10)]
    cls = {r["class"]: r.n for r in linkage.read_classes(spark.createDataFrame(seen, "qname string, pos1 int, allele string")).collect()}
    assert cls == {"linked": 10, "one": 5, "none": 10, "low_quality": 1}
