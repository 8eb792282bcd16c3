"""Text outputs. Tables go to Parquet; these are the exchange formats. Single files are written by one task, in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandlake.functions.sequence import reverse_complement
from strandlake.operators.intervals import overlap_join, points_in_ranges


def safe_name(name: Column) -> Column:
    """A name without spaces and punctuation other than dot and dash."""
    return F.regexp_replace(name, r"[^A-Za-z0-9.\-_]", "_")


def with_suffix(path: Column, suffix: str) -> Column:
    """A suffix before the ending of a file name."""
    return F.regexp_replace(path, r"(\.[^./]+(?:\.gz)?)$", suffix + "$1")


def write_csv(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    (df.orderBy(*order) if order else df).coalesce(1).write.csv(path, header=True)


def marked_vcf(text: DataFrame, marks: DataFrame, name: str, description: str) -> DataFrame:
    """``ord, line`` of a VCF with a filter added to the rows in ``marks`` (chrom, pos1, optional sample places)."""
    c = F.split("line", "\t")
    body = text.where(~F.col("line").startswith("#")).select("ord", c.alias("c"), F.get(c, 0).alias("chrom"), F.get(c, 1).try_cast("int").alias("pos1"))
    per_sample = "places" in marks.columns
    m = marks.select("chrom", "pos1", *(["places"] if per_sample else []), F.lit(True).alias("_m")).dropDuplicates(["chrom", "pos1"])
    x = body.join(m, ["chrom", "pos1"], "left")
    old = F.get("c", 7)
    if per_sample:
        entry = F.concat(F.lit(name + "="), F.array_join(F.transform(F.array_sort("places"), lambda p: p.cast("string")), ","))
        new8 = F.when(F.col("_m"), F.when(old == ".", entry).otherwise(F.concat_ws(";", old, entry))).otherwise(old)
        cells = F.concat(F.slice("c", 1, 7), F.array(new8), F.slice(F.col("c"), F.lit(9), F.size("c")))
        head = f'##INFO=<ID={name},Number=.,Type=Integer,Description="FILTER: {description}">'
    else:
        f = F.get("c", 6)
        new7 = F.when(F.col("_m"), F.when(f.isin("PASS", "."), F.lit(name)).otherwise(F.concat_ws(";", f, F.lit(name)))).otherwise(f)
        cells = F.concat(F.slice("c", 1, 6), F.array(new7), F.slice(F.col("c"), F.lit(8), F.size("c")))
        head = f'##FILTER=<ID={name},Description="{description}">'
    rows = x.select("ord", F.lit(0).alias("sub"), F.array_join(cells, "\t").alias("line"))
    heads = text.where(F.col("line").startswith("#")).select("ord", F.lit(0).alias("sub"), "line")
    names = text.where(F.col("line").startswith("#CHROM")).select("ord", F.lit(-1).alias("sub"), F.lit(head).alias("line"))
    return heads.union(names).union(rows)


def marked_vcf_of(text: DataFrame, marks: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """``ord, line`` of a VCF with several filters added: ``name -> (marks, description)``, in order."""
    out = text.select("ord", "line")
    for name, (own, description) in marks.items():
        out = marked_vcf(out, own, name, description).select((F.col("ord") * 2 + F.col("sub")).alias("ord"), "line")  # a new head line comes before the one it stands at
    return out


def write_lines(df: DataFrame, path: str, order: Sequence[str]) -> None:
    df.orderBy(*order).select("line").coalesce(1).write.text(path)


def aligned_rows(msa: DataFrame) -> DataFrame:
    """``sample, seq`` of a long alignment ``sample, col, ch``."""
    return msa.groupBy("sample").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", "ch"))), lambda x: x["ch"]), "").alias("seq"))


def fasta_lines(rows: DataFrame, name: str = "sample", width: int = 60) -> DataFrame:
    """``name, line`` of FASTA records."""
    wrapped = F.regexp_replace("seq", f"(.{{{width}}})(?=.)", "$1\n")
    return rows.select(F.col(name).alias("name"), F.concat(F.lit(">"), F.col(name), F.lit("\n"), wrapped).alias("line"))


def phylip_lines(rows: DataFrame, width: int = 60) -> DataFrame:
    """``block, sample, line`` of an interleaved alignment; names are cut to ten characters, and names that are then the same raise. ``block`` 0 is the head."""
    n = F.ceil(F.length("seq") / width).cast("int")
    short = F.substring("sample", 1, 10)
    alike = F.count("*").over(W.partitionBy(short))
    name = F.when(alike > 1, F.raise_error(F.concat(F.lit("names are alike in ten characters: "), short))).otherwise(F.rpad(short, 10, " "))
    x = rows.select("sample", "seq", name.alias("name")).select("sample", "seq", "name", F.explode(F.sequence(F.lit(1), n)).alias("block"))
    part = F.substring("seq", (F.col("block") - 1) * width + 1, F.lit(width))
    body = x.select("block", "sample", F.when(F.col("block") == 1, F.concat("name", part)).otherwise(part).alias("line"))
    head = rows.agg(F.count("*").alias("n"), F.max(F.length("seq")).alias("l")).select(F.lit(0).alias("block"), F.lit("").alias("sample"), F.format_string(" %d %d", "n", "l").alias("line"))
    return head.union(body)


def orf_fasta(features: DataFrame, genome: DataFrame) -> DataFrame:
    """``name, seq`` of features in their own sense; rRNA names get a suffix."""
    raw = F.substring("seq", F.col("start0") + 1, F.col("end0") - F.col("start0"))
    name = F.when(F.col("kind") == "rRNA", F.concat("locus", F.lit("__rRNA"))).otherwise(F.col("locus"))
    return features.join(genome.select("chrom", "seq"), "chrom").select(name.alias("name"), F.when(F.col("strand") < 0, reverse_complement(raw)).otherwise(raw).alias("seq"))


def fastq_lines(mates: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``target, qname, line``: R1 and R2 for fragments with two mates, S for others (``mates`` as made by ``poorly_mapped``)."""
    x = mates.select(*keys, "qname", F.size("mates").alias("n"), F.explode("mates").alias("m"))
    q = F.array_join(F.transform("m.qual", lambda v: F.chr(v + 33)), "")
    target = F.when(F.col("n") == 2, F.concat(F.lit("R"), F.col("m.mate"))).otherwise("S")
    return x.select(*keys, target.alias("target"), "qname", F.concat_ws("\n", F.concat(F.lit("@"), "qname", F.lit("/"), F.col("m.mate")), "m.seq", F.lit("+"), q).alias("line"))


def save_table(df: DataFrame, path: str) -> None:
    """An artefact as Parquet; an existing one is never overwritten."""
    df.write.mode("errorifexists").parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    """An artefact that ``save_table`` wrote."""
    return spark.read.parquet(path)


def pseudo_alignment(genome: DataFrame, variants: DataFrame, ranges: DataFrame) -> DataFrame:
    """``name, seq`` of the reference and of each contig as rows of one alignment to the chromosome: the contig's variants (``contig, pos1, ref, alt``) within its aligned
    ranges (``contig, start, end``), ``-`` elsewhere; inserted bases have no column. One chromosome in ``genome(chrom, seq)``."""
    chrom = genome.select("seq", F.col("chrom").alias("name"))
    spots = genome.select(F.posexplode(F.filter(F.split("seq", ""), lambda c: c != "")).alias("p", "ch")).select((F.col("p") + 1).alias("pos1"), "ch")
    own = points_in_ranges(spots, ranges.select("contig", "start", "end"), "pos1", [], "inner", 10_000).select("contig", "pos1", "ch").distinct()
    cells = own.join(variants.where("ref <> '-'").select("contig", "pos1", "alt"), ["contig", "pos1"], "left").select("contig", "pos1", F.coalesce("alt", "ch").alias("ch"))
    names = ranges.select("contig").distinct().crossJoin(spots.select("pos1"))  # the alignment has a cell for each contig and position
    rows = names.join(cells, ["contig", "pos1"], "left").select(F.col("contig").alias("sample"), F.col("pos1").alias("col"), F.coalesce("ch", F.lit("-")).alias("ch"))
    return chrom.select("name", "seq").union(aligned_rows(rows))


def region_fastq(reads: DataFrame, regions: DataFrame, width: int = 10_000) -> DataFrame:
    """``sample, region, target, qname, line``: FASTQ records of all reads of the fragments that touch a region ``(sample, chrom, start, end)``."""
    name = F.concat_ws("_", "chrom", "start", "end")
    r = regions.select(F.col("sample").alias("r_sample"), F.col("chrom").alias("r_chrom"), F.col("start").alias("r_start"), F.col("end").alias("r_end"), name.alias("region"))
    own = reads.select("sample", "chrom", "qname", "start0", "end0")
    hit = overlap_join(own, r, "start0", "end0", "r_start", "r_end", [("sample", "r_sample"), ("chrom", "r_chrom")], width).select("sample", "qname", "region").distinct()
    mate = F.struct(F.when(F.col("is_read1"), 1).otherwise(2).alias("mate"), "seq", "qual")
    mates = reads.join(hit, ["sample", "qname"]).groupBy("sample", "region", "qname").agg(F.array_sort(F.collect_list(mate)).alias("mates"))
    return fastq_lines(mates, ["sample", "region"])
