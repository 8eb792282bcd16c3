from __future__ import annotations

import random

from pyspark.sql import functions as F

from strandlake import cli
from strandlake.operators import simulate
from strandlake.plans import pipelines
from tests.test_signal_variants import VCF


def test_rearranged_region_is_found(spark):
    rows = []
    for i in range(0, 9_700, 5):
        bad = 4_000 <= i < 5_000
        rows.append(("s", "c", f"r{i}", not bad, i, i + 100, 300))
    df = spark.createDataFrame(rows, "sample string, chrom string, qname string, is_proper boolean, start0 int, end0 int, tlen int")
    reads = df.select("*", *[F.lit(False).alias(c) for c in ("is_dup", "is_qcfail", "is_secondary", "is_unmapped")], F.lit(True).alias("is_read1"), F.lit(60).alias("mapq"))
    got = pipelines.rearranged_regions(reads, spark.createDataFrame([("c", 10_000)], "chrom string, length int")).where("filter = 'rearrangements1'").collect()
    assert len(got) == 1 and got[0].start <= 4_100 and got[0].end >= 4_900


def test_commands(spark, tmp_path):
    (tmp_path / "a.vcf").write_text(VCF)
    (tmp_path / "g.fa").write_text(">chr1\n" + "".join(random.Random(1).choice("ACGT") for _ in range(1000)) + "\n")
    (tmp_path / "r.csv").write_text("chrom,start,end\nchr1,99,160\n")
    v, g = str(tmp_path / "a.vcf"), str(tmp_path / "g.fa")
    cli.main(["FilterVariants", "--vcf", v, "--out", str(tmp_path / "f"), "--repeats", str(tmp_path / "r.csv")], spark)
    calls = spark.read.parquet(str(tmp_path / "f/calls"))
    assert {r.pos1 for r in calls.where(F.array_contains("filters", "genome_repeats")).collect()} == {100, 150}
    cli.main(["SummariseVariants", "--vcf", v, "--calls", str(tmp_path / "f/calls"), "--out", str(tmp_path / "s")], spark)
    assert spark.read.csv(str(tmp_path / "s/simple"), header=True).count() == 6
    cli.main(["ComparativeAnalysis", "--vcf", v, "--genome", g, "--out", str(tmp_path / "m")], spark)
    lines = [r.value for r in spark.read.text(str(tmp_path / "m/fasta")).collect()]
    assert sum(x.startswith(">") for x in lines) == 4
    cli.main(["SimulateReads", "--genome", g, "--out", str(tmp_path / "sim"), "--num-snps", "20"], spark)
    truth = spark.read.csv(str(tmp_path / "sim/snps"), header=True, inferSchema=True)
    assert truth.count() == 36


def test_simulated_truth_is_recovered(spark):
    s = "".join(random.Random(4).choice("ACGT") for _ in range(600))
    genome = spark.createDataFrame([("c", s)], "chrom string, seq string")
    spots = spark.createDataFrame([("c", i, ch) for i, ch in enumerate(s)], "chrom string, pos0 int, ref string")
    truth = simulate.snps(spots, 30, 3, 5)
    calls = truth.select(F.concat(F.lit("g"), "rep").alias("sample"), "chrom", (F.col("pos0") + 1).alias("pos1"), "ref", F.col("base").alias("alt"))
    samples = calls.select("sample").distinct()
    m = pipelines.alignment(calls, samples, genome, all_sites=True)
    made = {f"g{r.rep}": r.seq for r in simulate.apply_edits(genome, truth.select("rep", "chrom", "pos0", F.lit(1).alias("del_len"), F.col("base").alias("ins"))).collect()}
    from strandlake.sources import sinks

    rows = {r["sample"]: r.seq for r in sinks.aligned_rows(m).collect()}
    assert rows.pop("reference") == s and rows == made
