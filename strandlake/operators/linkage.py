"""Linkage of nearby alleles on reads and fragments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.operators.intervals import overlap_join
from strandlake.operators.islands import gap_clusters


def _place(df: DataFrame, extra: tuple[str, ...] = ()) -> list[str]:
    """Of sample, chromosome and ``extra`` the columns that a table has: nothing is linked across them."""
    return [c for c in ("sample", "chrom", *extra) if c in df.columns]


def clusters(variants: DataFrame, max_gap: int = 1000) -> DataFrame:
    """Variants (by chromosome, and by sample if they have one) with a cluster number; only clusters of two and more can be linked."""
    by = _place(variants)
    x = gap_clusters(variants, by, "pos1", max_gap)
    n = x.groupBy(*by, "cluster").agg(F.count_distinct("pos1").alias("_n"))
    return x.join(n.where("_n > 1"), [*by, "cluster"]).drop("_n")


def spanning_reads(reads: DataFrame, loci: DataFrame, min_mapq: int = 60, width: int = 1000) -> DataFrame:
    """Reads that span each locus whole (``pos1 + del_len <= end0``), mapped well enough; of the locus's own sample if it has one."""
    by = _place(loci)
    l = loci.select(
        *[F.col(c).alias(f"l_{c}") for c in by], "pos1", "ref", "alt", (F.col("pos1") - 1).alias("l_start"),
        (F.col("pos1") + F.greatest(F.lit(0), F.length("ref") - F.length("alt"))).alias("l_end"),
    )
    r = reads.where(F.col("mapq") >= min_mapq).withColumnsRenamed({"start0": "r_start", "end0": "r_end"})
    hit = overlap_join(r, l, "r_start", "r_end", "l_start", "l_end", [(c, f"l_{c}") for c in by], width)
    inside = hit.where((F.col("r_start") <= F.col("l_start")) & (F.col("l_end") <= F.col("r_end")))
    return inside.drop(*[f"l_{c}" for c in by], "l_start", "l_end")


def allele_of(seq: Column, qual: Column, pairs: Column, pos1: Column, ref: Column, alt: Column, min_quality: int = 20) -> Column:
    """What a read shows at a substitution: ``alt``, ``ref``, ``other``, or ``low`` under the base quality asked for."""
    at = F.get(F.filter(pairs, lambda p: p["r"] == pos1 - 1), 0)["q"]
    base, q = F.substring(seq, at + 1, F.lit(1)), F.try_element_at(qual, at + 1)
    return F.when(at.isNull(), "gap").when(q < min_quality, "low").when(base == alt, "alt").when(base == ref, "ref").otherwise("other")


def allele_of_any(seq: Column, qual: Column, pairs: Column, pos1: Column, ref: Column, alt: Column, min_quality: int = 20) -> Column:
    """What a read shows at a substitution or indel (alleles as in VCF, with the base before an indel).

    The read's piece from the first reference base of the locus to the one after it is compared with both alleles: ``ref`` if it
    equals the reference, ``alt`` if it has the alternative's length and equals it wherever the base quality is enough, else
    ``other``; ``gap`` if either end of the piece is not aligned.
    """
    place = lambda r: F.get(F.filter(pairs, lambda p: p["r"] == r), 0)["q"]
    first, after = place(pos1 - 1), place(pos1 - 1 + F.length(ref))
    piece = F.substring(seq, first + 1, after - first)
    good = F.transform(F.slice(qual, first + 1, F.greatest(after - first, F.lit(0))), lambda q: q >= min_quality)
    chars = lambda x: F.filter(F.split(x, ""), lambda c: c != "")
    masked = lambda x: F.zip_with(chars(x), good, lambda c, g: F.when(g, c).otherwise("-"))
    of_indel = (
        F.when(first.isNull() | after.isNull(), "gap").when(piece == ref, "ref")
        .when((F.length(piece) == F.length(alt)) & (masked(piece) == masked(alt)), "alt").otherwise("other")
    )
    one = (F.length(ref) == 1) & (F.length(alt) == 1)
    return F.when(one, allele_of(seq, qual, pairs, pos1, ref, alt, min_quality)).otherwise(of_indel)


def linkage_table(seen: DataFrame, fragment: str = "qname", min_depth: int = 20) -> DataFrame:
    """For each pair of loci on the same fragments: numbers with both alleles, only the first, only the second, neither.

    ``seen``: ``fragment, pos1, allele`` (``alt`` or ``ref``; other values are not counted), and ``sample``, ``chrom`` and ``alt`` if
    there are several: loci are linked within a sample and chromosome only, and each alternative of a position is a locus of its
    own (columns ``alt_a, alt_b``). Fragments that show one locus twice with different alleles are left out of it.
    """
    by, several = _place(seen), "alt" in seen.columns
    locus = ["pos1", "alt"] if several else ["pos1"]
    known = seen.where(F.col("allele").isin("alt", "ref")).groupBy(*by, fragment, *locus)
    one = known.agg(F.min("allele").alias("a"), F.max("allele").alias("z")).where("a = z")
    loci = one.groupBy(*by, fragment).agg(F.array_sort(F.collect_list(F.struct(*locus, F.col("a").alias("allele")))).alias("l"))
    later = lambda x, i: F.filter(F.slice("l", i + 2, F.size("l")), lambda y: y["pos1"] > x["pos1"])
    pairs = F.flatten(F.transform("l", lambda x, i: F.transform(later(x, i), lambda y: F.struct(x.alias("x"), y.alias("y")))))
    p = loci.select(*by, F.explode(pairs).alias("p")).select(*by, "p.x", "p.y")
    is_alt = lambda c: F.col(f"{c}.allele") == "alt"
    names = [F.col("x.pos1").alias("pos_a"), F.col("y.pos1").alias("pos_b")]
    names += [F.col("x.alt").alias("alt_a"), F.col("y.alt").alias("alt_b")] * several
    out = p.groupBy(*by, *names).agg(
        F.count("*").alias("spanning"), F.count_if(is_alt("x") & is_alt("y")).alias("both"),
        F.count_if(is_alt("x") & ~is_alt("y")).alias("first_only"),
        F.count_if(~is_alt("x") & is_alt("y")).alias("second_only"), F.count_if(~is_alt("x") & ~is_alt("y")).alias("neither"),
    )
    return out.where(F.col("spanning") >= min_depth)


def read_classes(seen: DataFrame, fragment: str = "qname") -> DataFrame:
    """Fragments by what they show: low quality, none, one or several variants."""
    per = seen.groupBy(fragment).agg(F.count_if(F.col("allele") == "low").alias("low"), F.count_if(F.col("allele") == "alt").alias("alt"))
    cls = F.when(F.col("alt") > 1, "linked").when(F.col("alt") == 1, "one").when(F.col("low") > 0, "low_quality").otherwise("none")
    return per.groupBy(cls.alias("class")).agg(F.count("*").alias("n"))


def fragment_classes(seen: DataFrame, fragment: str = "qname", min_mapq: int = 60) -> DataFrame:
    """``class, n`` of the fragments that span two loci and more, for each sample and chromosome that the table has.

    ``seen``: ``fragment, pos1, allele, mapq``. A fragment with a read mapped below ``min_mapq`` is ``low_quality``; one that shows
    fewer than two loci as ``alt`` or ``ref`` is ``too_noisy``; the others have no (``none``), ``one`` or ``linked`` variants.
    """
    by = _place(seen)
    clear = F.col("allele").isin("alt", "ref")
    per = seen.groupBy(*by, fragment).agg(
        F.min("mapq").alias("mapq"), F.count_distinct(F.when(clear, F.col("pos1"))).alias("clear"),
        F.count_distinct(F.when(F.col("allele") == "alt", F.col("pos1"))).alias("alt"),
    )
    cls = F.when(F.col("mapq") < min_mapq, "low_quality").when(F.col("clear") < 2, "too_noisy").when(F.col("alt") == 0, "none").when(F.col("alt") == 1, "one").otherwise("linked")
    return per.groupBy(*by, cls.alias("class")).agg(F.count("*").alias("n"))


def mates_on_different_loci(spanning: DataFrame) -> DataFrame:
    """Fragments (of a sample and chromosome, if the table has them) whose two mates span different loci."""
    one, two = (F.collect_set(F.when(c, F.col("pos1"))) for c in (F.col("is_read1"), ~F.col("is_read1")))
    m = spanning.groupBy(*_place(spanning), "qname").agg(one.alias("one"), two.alias("two"))
    return m.where((F.size(F.array_except("one", "two")) > 0) & (F.size(F.array_except("two", "one")) > 0))


def counted_alleles(seen: DataFrame, fragment: str = "qname") -> DataFrame:
    """``[sample, chrom,] pos1, alt_reads, reads``: fragments with any alternative at a position, and with any allele that is clear."""
    by = [*_place(seen), "pos1"]
    clear = seen.where(F.col("allele").isin("alt", "ref"))
    return clear.groupBy(*by).agg(F.count_distinct(F.when(F.col("allele") == "alt", F.col(fragment))).alias("alt_reads"), F.count_distinct(fragment).alias("reads"))


def allele_frequencies(pooled: DataFrame, counted: DataFrame, scale: int = 40) -> DataFrame:
    """Called against counted allele frequency, both as numbers of ``scale``: ``gt array<int>`` and counts ``alt_reads, reads``."""
    called = F.round(F.size(F.filter("gt", lambda x: x != 0)) * scale / F.size("gt")).cast("int")
    by = [c for c in ("sample",) if c in pooled.columns and c in counted.columns] + ["chrom", "pos1"]
    return pooled.join(counted, by).select(*by, called.alias("called"), F.round(F.lit(scale) * F.col("alt_reads") / F.col("reads")).cast("int").alias("counted"))
