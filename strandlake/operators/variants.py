"""Variant tables: classification, filters, frequencies, totals, summaries and merges.

A call is a row ``sample, chrom, pos1, ref, alt, filters array<string>``, one for each called allele.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandlake.functions.sequence import codon_change
from strandlake.operators.intervals import points_in_ranges

SITE = ["chrom", "pos1", "ref", "alt"]


def kind(ref: Column, alt: Column) -> Column:
    """``snp``, ``gap`` or ``indel``."""
    one = (F.length(ref) == 1) & (F.length(alt) == 1)
    return F.when(one & (alt != "-"), "snp").when(one, "gap").otherwise("indel")


def filter_names(meta: DataFrame) -> DataFrame:
    """Names that mark calls: all FILTER entries, and INFO entries whose description starts with ``FILTER:``."""
    own = (F.col("section") == "FILTER") | ((F.col("section") == "INFO") & F.col("kv")["Description"].startswith("FILTER:"))
    return meta.where(own).select(F.col("kv")["ID"].alias("name"), (F.col("section") == "INFO").alias("per_sample")).distinct()


#: Thresholds of the hard filters; a missing annotation fails no clause.
HARD = {
    "standard_hard_filter": ("QD < 2.0", "FS > 60.0", "MQ < 40.0", "MQRankSum < -12.5", "ReadPosRankSum < -8.0"),
    "standard_indel_hard_filter": ("QD < 2.0", "FS > 200.0", "ReadPosRankSum < -20.0"),
}


def hard_filter(is_snp: Column, snp: Sequence[str] = HARD["standard_hard_filter"], indel: Sequence[str] = HARD["standard_indel_hard_filter"], names: Sequence[str] = tuple(HARD)) -> Column:
    """The name of the hard filter that a row fails, or null; rows carry the annotations as columns."""
    any_of = lambda clauses: F.coalesce(F.expr(" or ".join(f"coalesce({c}, false)" for c in clauses)), F.lit(False))
    return F.when(is_snp & any_of(snp), names[0]).when(~is_snp & any_of(indel), names[1])


def obeyed(filters: Column, names: Sequence[str]) -> Column:
    return F.arrays_overlap(filters, F.array(*map(F.lit, names))) if names else F.lit(False)


def keep_unfiltered(calls: DataFrame, names: Sequence[str]) -> DataFrame:
    return calls.where(~obeyed(F.col("filters"), names))


def choose_samples(calls: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    out = calls.where(F.col("sample").isin(*include)) if include else calls
    return out.where(~F.col("sample").isin(*exclude)) if exclude else out


def mark_by_ranges(calls: DataFrame, ranges: DataFrame, name: str, per_sample: bool = False, width: int = 1000) -> DataFrame:
    """Adds the filter ``name`` to calls in a range ``(start, end]`` of their chromosome (and sample)."""
    keys = ["chrom", "sample"] if per_sample else ["chrom"]
    hit = points_in_ranges(calls.select("sample", "chrom", "pos1").distinct(), ranges.select("start", "end", *keys), "pos1", keys, "left_semi", width)
    marked = calls.join(hit.withColumn("_hit", F.lit(True)), ["sample", "chrom", "pos1"], "left")
    return marked.withColumn("filters", F.when(F.col("_hit"), F.array_union("filters", F.array(F.lit(name)))).otherwise(F.col("filters"))).drop("_hit")


def frequency_class(calls: DataFrame, samples: int) -> DataFrame:
    """Calls with their frequency over samples, and whether they differ among samples or only from the reference."""
    n = calls.groupBy("chrom", "pos1", "alt").agg(F.count_distinct("sample").alias("frequency"))
    return calls.join(n, ["chrom", "pos1", "alt"]).withColumn("class", F.when(F.col("frequency") < samples, "among").otherwise("to_reference"))


def masked_and_retained(calls: DataFrame, names: Sequence[str]) -> DataFrame:
    """``chrom, pos1, ref, alt, filter, frequency``: samples in which an allele passes (filter ``retained``) or carries each filter."""
    own = F.array_intersect("filters", F.array(*map(F.lit, names)).cast("array<string>"))
    shown = F.when(F.size(own) == 0, F.array(F.lit("retained"))).otherwise(own)
    return calls.select(*SITE, "sample", F.explode(shown).alias("filter")).groupBy(*SITE, "filter").agg(F.count_distinct("sample").alias("frequency"))


def cumulative_totals(calls: DataFrame, order: Sequence[str], group: str, cls: str = "class") -> DataFrame:
    """Distinct positions left as filters are added one by one, for each group and class and over all groups together.

    ``step`` 0 obeys no filter, step ``i`` the first ``i`` of the order; the groups' numbers need not sum to that of all.
    """
    place = F.array(*[F.when(F.array_contains("filters", f), F.lit(i + 1)) for i, f in enumerate(order)])
    first = F.coalesce(F.array_min(place), F.lit(len(order) + 1))  # the step that removes the call
    steps = calls.select(group, cls, "chrom", "pos1", first.alias("gone")).groupBy(group, cls, "chrom", "pos1").agg(F.max("gone").alias("gone"))
    left = steps.select(group, cls, "chrom", "pos1", F.explode(F.sequence(F.lit(0), F.col("gone") - 1)).alias("step"))
    per = left.groupBy(group, cls, "step").agg(F.count("*").alias("positions"))
    every = left.groupBy(cls, "step").agg(F.count_distinct("chrom", "pos1").alias("positions")).select(F.lit("all").alias(group), cls, "step", "positions")
    return per.select(F.col(group).cast("string").alias(group), cls, "step", "positions").union(every)


def summary(calls: DataFrame, samples: Sequence[str], no_calls: DataFrame | None = None, no_data: str = "?") -> DataFrame:
    """One row for each allele, one column for each sample: 0, 1, the joined filters, or the no-data sign; and two frequencies."""
    shown = F.when(F.size("filters") == 0, F.coalesce(F.col("value") if "value" in calls.columns else F.lit(None), F.lit("1"))).otherwise(F.array_join(F.array_sort("filters"), "+"))
    cells = calls.select(*SITE, "sample", shown.alias("cell"), (F.size("filters") == 0).alias("clean"))
    freq = cells.groupBy(*SITE).agg(F.count_distinct("sample").alias("Frequency"), F.count_distinct(F.when(F.col("clean"), F.col("sample"))).alias("Frequency (filtered)"))
    wide = cells.groupBy(*SITE).pivot("sample", list(samples)).agg(F.first("cell"))
    out = wide.join(freq, SITE)
    if no_calls is not None:
        holes = no_calls.groupBy("chrom", "pos1").agg(F.collect_set("sample").alias("_holes"))
        out = out.join(holes, ["chrom", "pos1"], "left")
    for s in samples:
        hole = F.array_contains("_holes", s) if no_calls is not None else F.lit(False)
        out = out.withColumn(s, F.coalesce(F.col(s), F.when(F.coalesce(hole, F.lit(False)), no_data), F.lit("0")))
    return out.drop("_holes")


def merge_calls(rows: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """The first value of each key in a stated order, the number of rows and of differing values, and whether they conflict."""
    first = F.min(F.struct(*order, value))[value]
    return rows.groupBy(*keys).agg(first.alias(value), F.count("*").alias("n_rows"), F.count_distinct(value).alias("n_values")).withColumn("conflict", F.col("n_values") > 1)


def corroborate(called: DataFrame, de_novo: DataFrame, covered: DataFrame, keys: Sequence[str] = ("sample", "chrom", "pos1")) -> DataFrame:
    """Calls against variants of local assemblies: corroborated, negative, ambiguous or absent (not covered)."""
    found = de_novo.groupBy(*keys).agg(F.collect_set("alt").alias("_alts"))
    x = called.join(found, list(keys), "left").join(covered.select(*keys).distinct().withColumn("_c", F.lit(True)), list(keys), "left")
    agrees = F.array_contains("_alts", F.col("alt"))
    status = F.when(F.col("_alts").isNotNull() & (F.size("_alts") > 1), "ambiguous").when(agrees, "corroborated").when(F.col("_alts").isNotNull() | F.col("_c"), "negative").otherwise("absent")
    return x.withColumn("status", status).drop("_alts", "_c")


def name_of_samples(samples: Sequence[str]) -> Column:
    """A short name for a set of samples: the md5 of their sorted names."""
    return F.md5(F.lit(",".join(sorted(samples))))


def annotate(calls: DataFrame, features: DataFrame, width: int = 10_000) -> DataFrame:
    """Calls with the sorted names of all features ``(start0, end0]`` that hold them, and ``multi`` if there are several; ``annotate_open`` leaves out the end."""
    ranges = features.select("chrom", "locus", F.col("start0").alias("start"), F.col("end0").alias("end"))
    hits = points_in_ranges(calls.select("chrom", "pos1").distinct(), ranges, "pos1", ["chrom"], "inner", width)
    named = hits.groupBy("chrom", "pos1").agg(F.array_sort(F.collect_set("locus")).alias("_l"))
    out = calls.join(named, ["chrom", "pos1"], "left")
    return out.select(*calls.columns, F.array_join(F.coalesce("_l", F.array().cast("array<string>")), ",").alias("features"), (F.size(F.coalesce("_l", F.array().cast("array<string>"))) > 1).alias("multi"))


def annotate_open(calls: DataFrame, features: DataFrame, width: int = 10_000) -> DataFrame:
    """Calls (one row for each allele) with the feature that holds them, ``start0 < pos1 < end0``, and what a substitution does to its codon.

    ``features``: ``chrom, locus, start0, end0, strand, gene, orf`` with ``orf`` the feature's own forward sequence. Adds ``gene_id, gene_name,
    strand, ref_codon, var_codon, ref_aa, var_aa, codon_pos``; where several features hold a call they are named together and the rest is
    ``multi`` (strand and place in the codon are null); calls in no feature have empty strings.
    """
    ranges = features.select("chrom", "locus", "gene", "strand", "start0", "end0", "orf", F.col("start0").alias("start"), F.col("end0").alias("end"))
    sites = calls.select(*SITE).distinct()
    hits = points_in_ranges(sites, ranges, "pos1", ["chrom"], "inner", width, closed_end=False)
    change = codon_change(F.col("orf"), F.col("start0"), F.col("end0"), F.col("strand"), F.col("pos1"), F.col("ref"), F.col("alt"))
    own = hits.select(*SITE, F.struct("locus", F.coalesce("gene", F.lit("")).alias("gene"), "strand", change.alias("c")).alias("h"))
    per = own.groupBy(*SITE).agg(F.array_sort(F.collect_list("h")).alias("h"))
    n, first = F.size("h"), F.col("h")[0]
    single = lambda c: F.when(n == 1, c)
    word = lambda c: F.when(n == 1, c).otherwise("multi")
    named = per.select(
        *SITE, F.array_join(F.transform("h", lambda x: x["locus"]), ",").alias("gene_id"), F.array_join(F.transform("h", lambda x: x["gene"]), ",").alias("gene_name"),
        single(first["strand"]).alias("strand"), word(first["c"]["codon"]).alias("ref_codon"), word(first["c"]["new_codon"]).alias("var_codon"),
        word(first["c"]["aa"]).alias("ref_aa"), word(first["c"]["new_aa"]).alias("var_aa"), single(first["c"]["codon_pos"]).alias("codon_pos"),
    )
    return calls.join(named, SITE, "left").fillna("", ["gene_id", "gene_name", "ref_codon", "var_codon", "ref_aa", "var_aa"])


def with_orfs(features: DataFrame, genome: DataFrame) -> DataFrame:
    """Features with their own forward sequence ``orf``."""
    return features.join(genome.select("chrom", "seq"), "chrom").withColumn("orf", F.substring("seq", F.col("start0") + 1, F.col("end0") - F.col("start0"))).drop("seq")


# The columns of the simple summary before those of the samples, and ours.
SUMMARY_COLUMNS = {
    "Chromosome": "chrom", "Position (bp)": "pos1", "Reference": "ref", "Variant": "alt", "Gene ID": "gene_id", "Gene name": "gene_name", "Strand": "strand",
    "Reference codon": "ref_codon", "Variant codon": "var_codon", "Reference AA": "ref_aa", "Variant AA": "var_aa", "Codon position": "codon_pos",
}


def annotated_summary(calls: DataFrame, samples: Sequence[str], features: DataFrame, no_calls: DataFrame | None = None, no_data: str = "?") -> DataFrame:
    """The summary with the columns of the features and codons; ``features`` as for ``annotate_open``. Outside features strand is 0 and the codon position -1."""
    wide = annotate_open(summary(calls, samples, no_calls, no_data), features)
    several = F.col("gene_id").contains(",")
    wide = wide.withColumn("strand", F.coalesce(F.col("strand").cast("string"), F.when(several, "multi").otherwise("0")))
    wide = wide.withColumn("codon_pos", F.coalesce(F.col("codon_pos").cast("string"), F.when(several, "multi").when(F.col("gene_id") != "", "-").otherwise("-1")))
    return wide.select(*[F.col(c).alias(n) for n, c in SUMMARY_COLUMNS.items()], *[F.col(f"`{x}`") for x in (*samples, "Frequency", "Frequency (filtered)")])


def filtered_report(calls: DataFrame, names: Sequence[str], features: DataFrame | None = None) -> DataFrame:
    """``sample, position, CDS, reference, variant, filter``: a row for each call and filter that masks it; CDS names the features ``(start0, end0]`` that hold it."""
    own = F.array_intersect("filters", F.array(*map(F.lit, names)).cast("array<string>"))
    rows = calls.select("sample", *SITE, F.explode(own).alias("filter"))
    if features is None:
        rows = rows.withColumn("features", F.lit(""))
    else:
        shown = F.when(F.coalesce("gene", F.lit("")) != "", F.concat("locus", F.lit(" ("), "gene", F.lit(")"))).otherwise(F.col("locus"))
        rows = annotate(rows, features.withColumn("locus", shown))
    return rows.select("sample", F.col("pos1").alias("position"), F.col("features").alias("CDS"), F.col("ref").alias("reference"), F.col("alt").alias("variant"), "filter")


def grouped_list(calls: DataFrame, names: Sequence[str], samples: int, group: str) -> dict[str, DataFrame]:
    """The list of masked and retained alleles (``Position, Reference, Variant, Frequency, Sample Group, Filter``): of all calls, of those that differ among samples, and of those that only differ from the reference."""
    classed = frequency_class(calls, samples)
    parts = {"all": classed, "among": classed.where("class = 'among'"), "to_reference": classed.where("class = 'to_reference'")}
    return {
        n: masked_and_retained(x, names).select(F.col("pos1").alias("Position"), F.col("ref").alias("Reference"), F.col("alt").alias("Variant"), F.col("frequency").alias("Frequency"), F.lit(group).alias("Sample Group"), F.col("filter").alias("Filter"))
        for n, x in parts.items()
    }


def checked_report(checked: DataFrame) -> DataFrame:
    """``Sample, Chromosome, Position, Reference, Variant, Status, Filters`` of calls compared with local assemblies."""
    return checked.select(
        F.col("sample").alias("Sample"), F.col("chrom").alias("Chromosome"), F.col("pos1").alias("Position"), F.col("ref").alias("Reference"),
        F.col("alt").alias("Variant"), F.col("status").alias("Status"), F.array_join(F.array_sort("filters"), "+").alias("Filters"),
    )


def missing_samples(calls: DataFrame, alignments: DataFrame) -> DataFrame:
    """Samples with calls but no alignment, which later steps need."""
    return calls.select("sample").distinct().join(alignments.select("sample").distinct(), "sample", "left_anti")


def positions_only_in(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    return a.select(*cols).distinct().join(b.select(*cols).distinct(), list(cols), "left_anti")


def most_filtered(files: DataFrame) -> DataFrame:
    """Of the files of a base name the one with most filters applied (``__F_`` in the name), then the first by name."""
    n = F.size(F.split("path", "__F_")) - 1
    w = W.partitionBy("base").orderBy(F.desc("_n"), "path")
    return files.withColumn("_n", n).withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "_n")
