"""Command line: ``python -m strandlake.cli COMMAND --help``. Tables are written as Parquet, reports as CSV."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strandlake.operators import intervals, repeats, signal, simulate, variants
from strandlake.plans import pipelines
from strandlake.runtime import cut
from strandlake.sources import reads as fq
from strandlake.sources import sinks, text, vcf


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strandlake", description=__doc__)
    c = p.add_subparsers(dest="command", required=True)

    def command(name: str, *options: str, **more: dict) -> None:
        s = c.add_parser(name)
        for o in options:
            s.add_argument(f"--{o}", required=not o.startswith("opt-"), dest=o.removeprefix("opt-").replace("-", "_"), **({"nargs": "+"} if o in ("vcf", "sam", "fastq") else {}))
        for o, kw in more.items():
            s.add_argument("--" + o.replace("_", "-"), **kw)

    command("CollectData", "genbank", "out")
    command("PrepareReads", "fastq", "out", fraction={"type": float, "default": 0.5}, seed={"type": int, "default": 1})
    command("Structure", "sam", "out", ratio_threshold={"type": float, "default": 0.15}, min_mapq={"type": int, "default": 30})
    command("Repeats", "out", coords={"default": None}, chrom={"default": None}, genbank={"default": None}, min_identity={"type": float, "default": 98.0}, min_length={"type": int, "default": 400})
    command("AlignReads", "sam", "out")
    command("CallVariants", "vcf", "out")
    command("FilterVariants", "vcf", "out", repeats={"default": None}, regions={"default": None}, genbank={"default": None})
    command("SummariseVariants", "vcf", "out", calls={"default": None}, genbank={"default": None})
    command("CheckLinkage", "vcf", "sam", "out", min_depth={"type": int, "default": 20})
    command("ComparativeAnalysis", "vcf", "genome", "out", sam={"nargs": "+", "default": None}, all_sites={"action": "store_true"}, core_only={"action": "store_true"})
    command("SimulateReads", "genome", "out", num_snps={"type": int, "default": 100}, genomes={"type": int, "default": 3}, seed={"type": int, "default": 1})
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("strandlake").getOrCreate()
    out = a.out.rstrip("/")
    if a.command == "CollectData":
        genome, features = text.genbank(spark, a.genbank)
        sinks.save_table(genome, f"{out}/genome")
        sinks.save_table(features, f"{out}/feature")
    elif a.command == "PrepareReads":
        files = fq.pair_files(spark.createDataFrame([(f,) for f in a.fastq], "path string"))
        rows = [r for r in files.collect()]
        for pair in {r.pair for r in rows}:
            for r in (r for r in rows if r.pair == pair):
                x = fq.fastq(spark, r.path).withColumns({"pair": F.lit(pair), "mate": F.lit(r.mate)})
                sinks.save_table(simulate.sample_pairs(x, a.fraction, a.seed), f"{out}/{pair}_{r.mate}")
    elif a.command == "Structure":
        reads = fq.sam(spark, a.sam)
        lines = spark.read.text(a.sam).select(F.input_file_name().alias("file"), F.col("value").alias("line"))
        chroms = fq.sam_header(lines)[1].select("chrom", "length").distinct()
        sinks.save_table(signal.depth(reads, 10, a.min_mapq), f"{out}/depth")
        sinks.write_csv(pipelines.rearranged_regions(reads, chroms, 10, a.min_mapq, a.ratio_threshold), f"{out}/regions", ["chrom", "sample", "filter", "start"])
        found = spark.read.csv(f"{out}/regions", header=True, inferSchema=True)
        if found.columns:
            sinks.write_csv(intervals.totals(found, ["sample", "filter"]), f"{out}/totals", ["sample", "filter"])
    elif a.command == "AlignReads":
        sinks.save_table(fq.coordinate_sorted(signal.mark_duplicates(fq.sam(spark, a.sam))), f"{out}/reads")
    elif a.command == "CallVariants":
        lines = vcf.lines(spark, a.vcf)
        marked = sinks.marked_vcf_of(lines, pipelines.hard_filter_marks(vcf.rows(lines)))
        sinks.write_lines(marked, f"{out}/hard_filtered", ["ord"])
    elif a.command == "Repeats":
        if not a.coords:  # our own finder, from the features of a genome
            genome, features = text.genbank(spark, a.genbank)
            found = repeats.find_repeats(genome, features.where("kind <> 'mobile'"), a.min_identity / 100, a.min_length)
            sinks.write_csv(found, f"{out}/repeats", ["chrom", "start"])
            return
        hits = text.aligner_coords(spark, a.coords).where(F.col("identity") >= a.min_identity).withColumn("chrom", F.lit(a.chrom))
        ranges = repeats.merge_ranges(repeats.self_overlap_removed(hits), ["chrom"], a.min_length)
        sinks.write_csv(ranges, f"{out}/repeats", ["chrom", "start"])
    elif a.command == "FilterVariants":
        ranges = lambda p: spark.read.csv(p, header=True, inferSchema=True) if p else None
        lines = vcf.lines(spark, a.vcf)
        calls = cut(pipelines.filtered(vcf.calls(lines), ranges(a.repeats), ranges(a.regions)))
        sinks.save_table(calls, f"{out}/calls")
        features = text.genbank(spark, a.genbank)[1].where("kind <> 'mobile'") if a.genbank else None
        sinks.write_csv(variants.filtered_report(calls, pipelines.FILTER_ORDER, features), f"{out}/filtered", ["sample", "position", "filter"])
        sinks.write_lines(sinks.marked_vcf_of(lines, pipelines.range_marks(calls, vcf.sample_names(lines))), f"{out}/vcf", ["ord"])
    elif a.command == "SummariseVariants":
        lines = vcf.lines(spark, a.vcf)
        calls = spark.read.parquet(a.calls) if a.calls else vcf.calls(lines)
        samples = sorted(r["sample"] for r in vcf.sample_names(lines).select("sample").distinct().collect())
        for name, df in pipelines.summaries(calls, samples, vcf.no_calls(lines)).items():
            sinks.write_csv(df, f"{out}/{name}", df.columns[:4])
        for name, df in variants.grouped_list(calls, pipelines.FILTER_ORDER, len(samples), "reads").items():
            sinks.write_csv(df, f"{out}/masked_{name}", ["Position", "Reference", "Variant", "Filter"])
        if a.genbank:
            genome, features = text.genbank(spark, a.genbank)
            orfs = variants.with_orfs(features.where("kind <> 'mobile'"), genome)
            sinks.write_csv(variants.annotated_summary(calls, samples, orfs, vcf.no_calls(lines)), f"{out}/annotated", ["Chromosome", "`Position (bp)`", "Reference", "Variant"])
    elif a.command == "CheckLinkage":
        for name, df in pipelines.linkage_reports(vcf.pooled(vcf.lines(spark, a.vcf)), fq.sam(spark, a.sam), min_depth=a.min_depth).items():
            sinks.write_csv(df, f"{out}/{name}", df.columns[:4])
    elif a.command == "ComparativeAnalysis":
        lines = vcf.lines(spark, a.vcf)
        depth = signal.depth(fq.sam(spark, a.sam)) if a.sam else None
        genome = text.fasta(spark, a.genome).select(F.col("name").alias("chrom"), "seq")
        m = pipelines.alignment(vcf.calls(lines), vcf.sample_names(lines), genome, depth, vcf.no_calls(lines), all_sites=a.all_sites, core_only=a.core_only)
        sinks.save_table(m.where("sample = 'reference'").select("col", "chrom", "pos1"), f"{out}/positions")
        sinks.write_lines(sinks.fasta_lines(sinks.aligned_rows(m)), f"{out}/fasta", ["name"])
        sinks.write_lines(sinks.phylip_lines(sinks.aligned_rows(m)), f"{out}/phylip", ["block", "sample"])
    elif a.command == "SimulateReads":
        genome = text.fasta(spark, a.genome).select(F.col("name").alias("chrom"), "seq")
        spots = genome.select("chrom", F.posexplode(F.filter(F.split("seq", ""), lambda c: c != "")).alias("pos0", "ref"))
        truth = simulate.snps(spots, a.num_snps, a.genomes, a.seed)
        sinks.write_csv(truth, f"{out}/snps", ["rep", "pos0"])
        made = simulate.apply_edits(genome, truth.select("rep", "chrom", "pos0", F.lit(1).alias("del_len"), F.col("base").alias("ins")))
        sinks.write_lines(sinks.fasta_lines(made.withColumn("sample", F.concat_ws("_", "chrom", "rep"))), f"{out}/genomes", ["name"])


if __name__ == "__main__":
    main()
