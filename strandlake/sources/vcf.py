"""VCF text as typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.operators.variants import filter_names as names_in
from strandlake.runtime import hinted

# The columns that a VCF body starts with.
FIXED = ["CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT"]


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, ord, line`` of every line; ``ord`` keeps the order within a file."""
    return spark.read.text(path).select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("ord"), F.col("value").alias("line"))


def meta(text: DataFrame) -> DataFrame:
    """``file, section, ord, value, kv``: the ``##`` lines; ``kv`` of ``<k=v,...>``, in which quotes hide commas."""
    head = text.where(F.col("line").startswith("##"))
    section, value = F.regexp_extract("line", "^##([^=]+)=", 1), F.regexp_extract("line", "^##[^=]+=(.*)$", 1)
    inner = F.regexp_extract(value, "^<(.*)>$", 1)
    parts = F.filter(F.split(inner, ',(?=(?:[^"]*"[^"]*")*[^"]*$)'), lambda p: p.contains("="))
    entry = lambda p: F.struct(F.regexp_extract(p, "^([^=]+)=", 1).alias("key"), F.regexp_replace(F.regexp_extract(p, "^[^=]+=(.*)$", 1), '^"|"$', "").alias("value"))
    return head.select("file", section.alias("section"), "ord", value.alias("value"), F.map_from_entries(F.transform(parts, entry)).alias("kv"))


def contigs(meta_rows: DataFrame) -> DataFrame:
    return meta_rows.where("section = 'contig'").select("file", F.col("kv")["ID"].alias("chrom"), F.col("kv")["length"].cast("bigint").alias("length"))


def sample_names(text: DataFrame) -> DataFrame:
    """``file, sample, place`` (from 0) of the columns after FORMAT."""
    head = text.where(F.col("line").startswith("#CHROM")).select("file", F.split("line", "\t").alias("c"))
    return head.select("file", F.posexplode(F.slice("c", 10, F.greatest(F.lit(0), F.size("c") - 9))).alias("place", "sample"))


def rows(text: DataFrame) -> DataFrame:
    """The body: fixed columns, ``info`` (flags have a null value) and ``cells``, one for each sample."""
    c = F.split("line", "\t")
    body = text.where(~F.col("line").startswith("#") & (F.trim("line") != "")).select("file", "ord", c.alias("c"))
    entries = F.array_distinct(F.filter(F.split(F.get("c", 7), ";"), lambda x: (x != "") & (x != ".")))
    keys = F.transform(entries, lambda e: F.element_at(F.split(e, "=", 2), 1))
    pairs = F.filter(F.transform(entries, lambda e, i: F.struct(F.element_at(F.split(e, "=", 2), 1).alias("k"), F.try_element_at(F.split(e, "=", 2), F.lit(2)).alias("v"), i.alias("i"))), lambda p: F.array_position(keys, p["k"]) == p["i"] + 1)
    info = F.map_from_entries(F.transform(pairs, lambda p: F.struct(p["k"].alias("k"), p["v"].alias("v"))))
    fixed = [F.get("c", i).alias(n.lower()) for i, n in enumerate(FIXED) if n not in ("POS", "INFO", "FORMAT")]
    return body.select("file", "ord", *fixed, F.get("c", 1).try_cast("int").alias("pos1"), info.alias("info"), F.split(F.get("c", 8), ":").alias("format"), F.slice("c", 10, F.greatest(F.lit(0), F.size("c") - 9)).alias("cells"))


def calls(text: DataFrame, filter_names: list[str] | None = None) -> DataFrame:
    """``file, sample, chrom, pos1, ref, alt, alt_count, ploidy, filters``: one row for each called allele of a sample.

    ``filters`` holds the row's FILTER entries, and those INFO entries ``name=i,j`` listing the sample's place (from 0) whose name the header
    describes as a filter; with ``filter_names`` only these names. Other INFO entries never are filters, whatever their
    values. Reference and missing genotypes have no row; see ``no_calls``.
    """
    declared = [r.name for r in names_in(meta(text)).where("per_sample").select("name").distinct().collect()]  # of the header only
    per_sample = [n for n in declared if filter_names is None or n in filter_names]
    g = _genotypes(text)
    lists_sample = lambda e: e["key"].isin(per_sample) & e["value"].isNotNull() & F.array_contains(F.split(e["value"], ","), F.col("place").cast("string"))
    own = F.transform(F.filter(F.map_entries("info"), lists_sample), lambda e: e["key"]) if per_sample else F.array().cast("array<string>")
    marks = F.array_union(F.filter(F.split("filter", ";"), lambda f: ~f.isin("PASS", ".")), own)
    if filter_names is not None:
        marks = F.array_intersect(marks, F.array(*map(F.lit, filter_names)).cast("array<string>"))
    alleles = F.array_distinct(F.filter("gt", lambda x: x > 0))
    out = g.select("file", "sample", "chrom", "pos1", "ref", "gt", F.split("alt", ",").alias("alts"), marks.alias("filters"), F.explode(alleles).alias("a"))
    count = F.size(F.filter("gt", lambda x: x == F.col("a")))
    return out.select("file", "sample", "chrom", "pos1", "ref", F.element_at("alts", F.col("a")).alias("alt"), count.alias("alt_count"), F.size("gt").alias("ploidy"), "filters")


def no_calls(text: DataFrame) -> DataFrame:
    """Samples and positions without a genotype: every allele is ``.``."""
    return _genotypes(text).where(F.forall("gt", lambda x: x.isNull())).select("file", "sample", "chrom", "pos1")


def _genotypes(text: DataFrame) -> DataFrame:
    body = rows(text).select("file", "chrom", "pos1", "ref", "alt", "filter", "info", "format", F.posexplode("cells").alias("place", "cell"))
    gt = F.try_element_at(F.split("cell", ":"), F.array_position("format", F.lit("GT")).cast("int"))
    return body.join(hinted(sample_names(text)), ["file", "place"]).withColumn("gt", F.transform(F.split(gt, "[/|]"), lambda x: x.try_cast("int")))


def pooled(text: DataFrame, min_gq: int = 0) -> DataFrame:
    """Pooled calls of single-sample files: ``sample``, PASS rows with genotype quality, ``gt array<int>``, ``alts`` and the rest of INFO and FORMAT."""
    r = rows(text).join(hinted(sample_names(text).where("place = 0").select("file", "sample")), "file", "left").where(F.col("filter") == "PASS")
    data = F.map_from_arrays("format", F.slice(F.concat(F.split(F.get("cells", 0), ":"), F.array_repeat(F.lit(None).cast("string"), F.size("format"))), F.lit(1), F.size("format")))
    r = r.withColumn("data", data).where(F.coalesce(F.col("data")["GQ"].try_cast("double"), F.lit(0.0)) >= min_gq)
    info = F.map_filter("info", lambda k, v: v.isNotNull() & (k != "set"))
    return r.select("file", "sample", "chrom", "pos1", "ref", F.split("alt", ",").alias("alts"), F.transform(F.split(F.col("data")["GT"], "[/|]"), lambda x: x.try_cast("int")).alias("gt"), info.alias("info"), "data")
