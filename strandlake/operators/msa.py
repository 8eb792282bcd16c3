"""Multiple alignments: columns from variants and coverage, gap counts, derived clades and imports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandlake.operators.intervals import points_in_ranges
from strandlake.operators.islands import runs


def missing_regions(depth: DataFrame, resolution: int = 10, keys: Sequence[str] = ("sample", "chrom")) -> DataFrame:
    """Ranges of dense bins without depth; a run that is still open at the last bin is left out."""
    found = runs(depth, list(keys), "bin", F.coalesce(F.col("total"), F.lit(0)) == 0).where("end is not null")
    return found.select(*keys, (F.col("start") * resolution).alias("start"), (F.col("end") * resolution).alias("end"))


def columns(snps: DataFrame, samples: DataFrame, reference: DataFrame, gaps: DataFrame, no_calls: DataFrame | None = None, all_sites: bool = False, core_only: bool = False, width: int = 1000) -> DataFrame:
    """``sample, chrom, pos1, ch``: variable positions (or all) of every sample and of ``reference``.

    ``reference``: ``chrom, pos1, ch``. A sample has its alternative base, else ``-`` in a gap ``(start, end]``, else
    ``?`` without a call, else the reference base. With ``core_only`` positions with a gap in any sample go.
    """
    sites = reference if all_sites else reference.join(snps.select("chrom", "pos1").distinct(), ["chrom", "pos1"], "left_semi")
    grid = sites.crossJoin(samples.select("sample").distinct())  # the result itself has a row for each site and sample
    holes = points_in_ranges(grid.select("sample", "chrom", "pos1"), gaps.select("sample", "chrom", "start", "end"), "pos1", ["sample", "chrom"], "left_semi", width).withColumn("_gap", F.lit(True))
    own = snps.groupBy("sample", "chrom", "pos1").agg(F.min("alt").alias("_alt"))
    on = ["sample", "chrom", "pos1"]
    x = grid.join(own, on, "left").join(holes, on, "left")
    if no_calls is not None:
        x = x.join(no_calls.select(*on).distinct().withColumn("_nc", F.lit(True)), on, "left")
    ch = F.coalesce("_alt", F.when(F.col("_gap"), "-"), F.when(F.col("_nc"), "?") if no_calls is not None else F.lit(None), "ch")
    out = x.select("sample", "chrom", "pos1", ch.alias("ch"))
    if core_only:
        bad = out.where("ch = '-'").select("chrom", "pos1").distinct()
        out, sites = out.join(bad, ["chrom", "pos1"], "left_anti"), sites.join(bad, ["chrom", "pos1"], "left_anti")
    return out.select("sample", "chrom", "pos1", "ch").union(sites.select(F.lit("reference").alias("sample"), "chrom", "pos1", "ch"))


def numbered(cells: DataFrame) -> DataFrame:
    """Cells with an alignment column (from 1) by chromosome and position: numbered within each chromosome, plus those of the chromosomes before it."""
    place = cells.select("chrom", "pos1").distinct()
    sizes = place.groupBy("chrom").agg(F.count("*").alias("_n"))
    before = sizes.select("chrom", F.coalesce(F.sum("_n").over(W.orderBy("chrom").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))  # a row for each chromosome
    own = place.withColumn("_r", F.row_number().over(W.partitionBy("chrom").orderBy("pos1")))
    place = own.join(before, "chrom").select("chrom", "pos1", (F.col("_before") + F.col("_r")).cast("int").alias("col"))
    return cells.join(place, ["chrom", "pos1"])


def gap_counts(cells: DataFrame) -> DataFrame:
    """Samples with a gap at each position that has any."""
    return cells.where("ch = '-'").groupBy("chrom", "pos1").agg(F.count("*").alias("samples"))


def column_counts(sequences: DataFrame, seq: str) -> DataFrame:
    """``col, gaps, letters``: gaps and kinds of letters in each column of the sequences, taken as padded with ``-`` to the longest.

    Padding is counted, not made: rows between are one for each letter, whatever the longest sequence.
    """
    cells = sequences.select(F.posexplode(F.split(seq, "")).alias("p", "ch")).where("ch <> ''")
    found = cells.groupBy((F.col("p") + 1).alias("col")).agg(
        F.count_if(F.col("ch") != "-").alias("_filled"), F.count_distinct(F.when(F.col("ch") != "-", F.col("ch"))).alias("letters")
    )
    rows = sequences.agg(F.count(seq).alias("_rows"))
    return found.crossJoin(F.broadcast(rows)).select("col", (F.col("_rows") - F.col("_filled")).alias("gaps"), "letters")


def derived_clades(msa: DataFrame, clades: DataFrame, outgroup: str) -> DataFrame:
    """``col, node, n_clades``: the largest clades all of whose tips differ from the outgroup; more than one is a homoplasy.

    ``msa``: ``sample, col, ch``; ``clades``: ``node, parent, tips array<string>`` of the tree without the outgroup.
    """
    out = msa.where(F.col("sample") == outgroup).select("col", F.col("ch").alias("og"))
    derived = msa.where((F.col("sample") != outgroup) & ~F.col("ch").isin("-", "?")).join(out, "col").where("ch <> og")
    tips = clades.select("node", "parent", F.size("tips").alias("size"), F.explode("tips").alias("sample"))
    full = derived.join(tips, "sample").groupBy("node", "parent", "size", "col").agg(F.count("*").alias("n")).where("n = size")
    above = full.select(F.col("node").alias("parent"), "col")
    top = full.join(above, ["parent", "col"], "left_anti").select("col", "node")
    return top.join(top.groupBy("col").agg(F.count("*").alias("n_clades")), "col")


def import_variants(msa: DataFrame, reference: DataFrame, imports: DataFrame, clades: DataFrame, positions: DataFrame) -> DataFrame:
    """``node, beg, end, col, pos1, samples``: samples below a node that differ from the reference within its imports (inclusive columns)."""
    tips = clades.select("node", F.explode("tips").alias("sample"))
    spans = imports.select("node", "beg", "end", (F.col("beg") - 1).alias("start"))
    ref = reference.select("col", F.col("ch").alias("ref"))
    diff = msa.join(ref, "col").where("ch <> ref and ch not in ('-', '?')")
    hit = diff.join(tips, "sample")
    inside = points_in_ranges(hit, spans.select("node", "beg", "start", "end"), "col", ["node"], "inner")
    grouped = inside.groupBy("node", "beg", "end", "col").agg(F.array_sort(F.collect_set("sample")).alias("samples"))
    return grouped.join(positions, "col")


def tips_differ(msa: DataFrame, tree: DataFrame) -> DataFrame:
    """Names on one side only of an alignment and the tips of a tree."""
    inner = tree.select(F.col("parent").alias("node")).where("node is not null").distinct()
    tips = tree.join(inner, "node", "left_anti").select(F.col("label").alias("name"))
    own = msa.select(F.col("sample").alias("name")).distinct()
    return own.subtract(tips).withColumn("only_in", F.lit("alignment")).union(tips.subtract(own).withColumn("only_in", F.lit("tree")))


def contig_summary(variants: DataFrame, ranges: DataFrame) -> DataFrame:
    """For each contig: aligned range and length, and its number of variants."""
    n = variants.groupBy("contig").agg(F.count("*").alias("variants"))
    r = ranges.groupBy("contig").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum(F.col("end") - F.col("start")).alias("aligned"))
    return r.join(n, "contig", "left").fillna({"variants": 0})


def best_strand(pids: DataFrame, least: float = 0.9) -> DataFrame:
    """For each contig the strand with the larger sum of identities, if its best window reaches ``least``."""
    s = pids.groupBy("contig", "strand").agg(F.sum("pid").alias("total"), F.max("pid").alias("best"))
    return s.groupBy("contig").agg(F.max(F.struct("total", "best", "strand")).alias("b")).where(F.col("b.best") >= least).select("contig", "b.strand", F.col("b.best").alias("best"))
