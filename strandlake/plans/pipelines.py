"""The analyses end to end, as compositions of the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.operators import islands, linkage, msa, signal, variants
from strandlake.operators.intervals import merge_ranges
from strandlake.runtime import cut


def rearranged_regions(reads: DataFrame, chroms: DataFrame, resolution: int = 10, min_mapq: int = 30, threshold: float = 0.15, extend: float = 0.15) -> DataFrame:
    """``sample, chrom, filter, start, end``: regions where reads do not map in proper pairs, and the same extended.

    Depth by bins, ratio of other to proper reads, forward mean over half the mean insert size, runs over the
    threshold away from the chromosome's ends. ``chroms``: ``chrom, length``. Samples without proper pairs are left out.
    All samples and chromosomes are rows of one plan; each sample's window is a column.
    """
    keys = ["sample", "chrom"]
    depth = signal.depth(reads, resolution, min_mapq)
    inserts = signal.mean_insert_size(reads).where("mean_insert > 0")
    window = F.greatest(F.lit(resolution), F.floor(F.round("mean_insert") / 2)).cast("int")
    sizes = chroms.select("chrom", F.col("length").cast("bigint").alias("length")).distinct()
    each = cut(inserts.select("sample", F.col("mean_insert").cast("int").alias("mean"), window.alias("window")).crossJoin(sizes))  # a row for each result series
    spine = each.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("length") / resolution) - 1)).alias("bin"))
    d = spine.join(depth, [*keys, "bin"], "left").fillna(0, ["total", "proper"]).withColumn("ratio", signal.ratio(F.col("total"), F.col("proper")))
    d = cut(d.select(*keys, "bin", "ratio", "mean", "window"))
    s = signal.smooth_by(d, keys, "bin", "ratio", "window", resolution)
    runs = islands.runs(s, keys, "bin", F.col("smoothed") >= threshold).join(each, keys)
    place = lambda c: 5 * resolution + F.col(c) * resolution
    found = runs.select(*keys, "length", "mean", place("start").alias("start"), F.coalesce(place("end"), "length").alias("end"))
    inner = (F.col("start") > F.col("mean")) & (F.col("end") < F.floor(F.col("length") / resolution) * resolution + 5 * resolution - F.col("mean"))
    found = cut(found.where(inner).select(*keys, "start", "end"))
    grown = signal.extend_regions(found, d.select(*keys, "bin", "ratio", "mean"), keys, resolution, "mean", extend)
    out = found.withColumn("filter", F.lit("rearrangements1")).unionByName(grown.withColumn("filter", F.lit("rearrangements2")))
    return out.select(*keys, "filter", "start", "end")


def filtered(calls: DataFrame, repeats: DataFrame | None = None, rearranged: DataFrame | None = None) -> DataFrame:
    """Calls with the filters of ambiguous repeats (for all samples) and of rearranged regions (for each sample)."""
    out = calls
    if repeats is not None:
        out = variants.mark_by_ranges(out, merge_ranges(repeats.select("chrom", "start", "end"), ["chrom"]), "genome_repeats")
    if rearranged is not None:
        for name in ("rearrangements1", "rearrangements2"):
            own = rearranged.where(F.col("filter") == name).select("sample", "chrom", "start", "end")
            out = variants.mark_by_ranges(out, own, name, per_sample=True)
    return out


def hard_filter_marks(rows: DataFrame) -> dict[str, tuple[DataFrame, str]]:
    """Marks of both hard filters for the rows of a VCF, by their annotations in INFO; a missing annotation fails nothing."""
    notes = [F.col("info")[n].try_cast("double").alias(n) for n in ("QD", "FS", "MQ", "MQRankSum", "ReadPosRankSum")]
    snp = (F.length("ref") == 1) & F.forall(F.split("alt", ","), lambda x: F.length(x) == 1)
    failed = cut(rows.select("chrom", "pos1", snp.alias("snp"), *notes).select("chrom", "pos1", variants.hard_filter(F.col("snp")).alias("name")).where("name is not null"))
    return {n: (failed.where(F.col("name") == n).select("chrom", "pos1"), " or ".join(clauses)) for n, clauses in variants.HARD.items()}


def range_marks(calls: DataFrame, samples: DataFrame) -> dict[str, tuple[DataFrame, str]]:
    """Marks of the range filters that calls carry: repeats for all samples, rearrangements by the places of the samples (``sample, place``)."""
    own = calls.select("sample", "chrom", "pos1", F.explode("filters").alias("name")).distinct()
    out = {"genome_repeats": (own.where("name = 'genome_repeats'").select("chrom", "pos1"), "within a repeat of the genome")}
    for name in ("rearrangements1", "rearrangements2"):
        placed = own.where(F.col("name") == name).join(samples.select("sample", "place").distinct(), "sample")
        out[name] = (placed.groupBy("chrom", "pos1").agg(F.collect_set("place").alias("places")), "sample specific, near a rearrangement")
    return out


#: Filters in the order in which the cumulative table adds them.
FILTER_ORDER = ["genome_repeats", "rearrangements1", "rearrangements2", "LowQual", "standard_hard_filter", "standard_indel_hard_filter"]


def summaries(calls: DataFrame, samples: Sequence[str], no_calls: DataFrame | None = None) -> dict[str, DataFrame]:
    """The simple, list and cumulative tables of a set of calls."""
    classed = variants.frequency_class(calls, len(samples))
    return {
        "simple": variants.summary(calls, samples, no_calls),
        "lists": variants.masked_and_retained(calls, FILTER_ORDER),
        "cumulative": variants.cumulative_totals(classed, FILTER_ORDER, "sample"),
    }


def seen_alleles(calls: DataFrame, reads: DataFrame, min_mapq: int = 60) -> DataFrame:
    """``[sample,] chrom, qname, is_read1, mapq, pos1, alt, allele``: what reads show at called substitutions and indels with another one nearby; calls with a sample meet that sample's reads only."""
    by = ["sample"] * ("sample" in calls.columns)
    loci = linkage.clusters(calls.select(*by, "chrom", "pos1", "ref", "alt").distinct())
    seen = linkage.spanning_reads(reads, loci, min_mapq)
    allele = linkage.allele_of_any(F.col("seq"), F.col("qual"), F.col("pairs"), F.col("pos1"), F.col("ref"), F.col("alt"))
    return seen.select(*by, "chrom", "qname", "is_read1", "mapq", "pos1", "alt", allele.alias("allele"))


def linked_alleles(calls: DataFrame, reads: DataFrame, min_mapq: int = 60, min_depth: int = 20) -> DataFrame:
    """How nearby alleles of a pooled sample stand together on read fragments."""
    return linkage.linkage_table(seen_alleles(calls, reads, min_mapq), min_depth=min_depth)


def linkage_reports(pooled: DataFrame, reads: DataFrame, min_mapq: int = 60, min_depth: int = 20) -> dict[str, DataFrame]:
    """The linkage and frequency tables of pooled calls ``sample, chrom, pos1, ref, alts, gt``, and the samples that have no reads."""
    calls = pooled.select("sample", "chrom", "pos1", "ref", F.explode("alts").alias("alt"))
    seen = cut(seen_alleles(calls, reads, min_mapq))
    return {
        "linkage": linkage.linkage_table(seen, min_depth=min_depth),
        "frequencies": linkage.allele_frequencies(pooled, linkage.counted_alleles(seen)),
        "missing": variants.missing_samples(calls, reads),
    }


def alignment(calls: DataFrame, samples: DataFrame, genome: DataFrame, depth: DataFrame | None = None, no_calls: DataFrame | None = None, resolution: int = 10, all_sites: bool = False, core_only: bool = False) -> DataFrame:
    """A numbered alignment of all samples and the reference; gaps come from bins without depth."""
    snps = calls.where(variants.kind(F.col("ref"), F.col("alt")) == "snp")
    reference = genome.select("chrom", F.posexplode(F.filter(F.split("seq", ""), lambda c: c != "")).alias("p", "ch")).select("chrom", (F.col("p") + 1).alias("pos1"), "ch")
    none = calls.sparkSession.createDataFrame([], "sample string, chrom string, start bigint, end bigint")
    gaps = none if depth is None else msa.missing_regions(signal.dense(depth, ["sample", "chrom"], "bin", F.lit(0)), resolution)
    return msa.numbered(msa.columns(snps, samples, reference, gaps, no_calls, all_sites, core_only))
