"""Sequencing reads: FASTQ files and pairs, and alignments as SAM text."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.runtime import hinted

_NAME = r"([^/]+?)(?:\.fastq|\.fq)(?:\.gz)?$"


def pair_files(files: DataFrame) -> DataFrame:
    """``pair, mate, path``: the last 1 or 2 of a name is the mate; a trailing ``_NNN`` goes first; singletons and staged files are left out.

    If some files of a folder are compressed, only these count. A pair without exactly two files raises on use.
    """
    base = F.regexp_replace(F.regexp_extract("path", _NAME, 1), r"_\d{3}$", "")
    gz = F.col("path").endswith(".gz")
    x = files.select("path", base.alias("base"), gz.alias("gz"), F.regexp_replace("path", "[^/]+$", "").alias("folder"))
    x = x.where((F.col("base") != "") & ~F.lower("base").contains("singleton") & ~F.col("base").rlike("(_subsmp|_adpt|_qual|_cutadapt|_trimmed)"))
    some = x.groupBy("folder").agg(F.bool_or("gz").alias("some"))
    x = x.join(some, "folder").where(F.col("gz") | ~F.col("some"))
    mate, rest = F.regexp_extract("base", r"^(.*)([12])([^12]*)$", 2), F.regexp_replace("base", r"^(.*)([12])([^12]*)$", "$1$3")
    x = x.where(mate != "").select(rest.alias("pair"), mate.cast("int").alias("mate"), "path")
    n = x.groupBy("pair").agg(F.count("*").alias("n"), F.count_distinct("mate").alias("m"))
    ok = (F.col("n") == 2) & (F.col("m") == 2)
    checked = F.when(ok, F.col("path")).otherwise(F.raise_error(F.concat(F.lit("not a pair of files: "), F.col("pair"))))
    return x.join(n, "pair").select("pair", "mate", checked.alias("path"))


def fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, ordinal, name, seq, qual`` of four-line records. A file is one task (compressed text cannot be split); order is kept."""
    schema = "file string, ordinal bigint, name string, seq string, qual array<int>"
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, text in zip(b.column("file").to_pylist(), b.column("text").to_pylist(), strict=True):
                rec = text.splitlines()
                for lo in range(0, len(rec) - 3, 40_000):
                    own = rec[lo : lo + 40_000]
                    names, seqs, quals = own[0::4], own[1::4], own[3::4]
                    n = len(quals)
                    cols = [[file] * n, range(lo // 4, lo // 4 + n), [x[1:].split(" ")[0] for x in names[:n]], seqs[:n], [[ord(c) - 33 for c in q] for q in quals]]
                    kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["file", "ordinal", "name", "seq", "qual"])

    return raw.mapInArrow(run, schema)


def sam_header(text: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Read groups ``file, sample`` and chromosomes ``file, chrom, length`` of SAM lines ``file, line``."""
    groups = text.where(F.col("line").startswith("@RG")).select("file", F.regexp_extract("line", r"\tID:([^\t]+)", 1).alias("sample"))
    chroms = text.where(F.col("line").startswith("@SQ")).select("file", F.regexp_extract("line", r"\tSN:([^\t]+)", 1).alias("chrom"), F.regexp_extract("line", r"\tLN:(\d+)", 1).cast("bigint").alias("length"))
    return groups, chroms


def cigar_ops(cigar: Column) -> Column:
    """Array of ``(n, op)``."""
    return F.transform(F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), 0), lambda x: F.struct(F.regexp_extract(x, r"^(\d+)", 1).cast("int").alias("n"), F.substring(x, -1, 1).alias("op")))


def aligned_pairs(cigar: Column, start0: Column) -> Column:
    """Array of ``(q, r)``: read and reference places (from 0) of every aligned base."""
    zero = F.struct(F.lit(0).alias("q"), start0.cast("int").alias("r"), F.array().cast("array<struct<q:int,r:int>>").alias("out"))

    def step(acc: Column, c: Column) -> Column:
        on_q, on_r = c["op"].isin("M", "I", "S", "=", "X"), c["op"].isin("M", "D", "N", "=", "X")
        new = F.when(on_q & on_r, F.transform(F.sequence(F.lit(0), c["n"] - 1), lambda i: F.struct((acc["q"] + i).alias("q"), (acc["r"] + i).alias("r")))).otherwise(F.array().cast("array<struct<q:int,r:int>>"))
        return F.struct((acc["q"] + F.when(on_q, c["n"]).otherwise(0)).alias("q"), (acc["r"] + F.when(on_r, c["n"]).otherwise(0)).alias("r"), F.concat(acc["out"], new).alias("out"))

    return F.aggregate(cigar_ops(cigar), zero, step)["out"]


def sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Alignments of SAM text: names, flags, places, mapping quality, sequence, qualities and aligned pairs; the sample is the read group."""
    text = spark.read.text(path).select(F.input_file_name().alias("file"), F.col("value").alias("line"))
    groups, _ = sam_header(text)
    c = F.split("line", "\t")
    body = text.where(~F.col("line").startswith("@")).select("file", c.alias("c"), F.regexp_extract("line", r"\tRG:Z:([^\t]+)", 1).alias("rg"))
    bit = lambda b: F.col("flag").bitwiseAND(b) > 0
    x = body.select("file", "rg", F.get("c", 0).alias("qname"), F.get("c", 1).try_cast("int").alias("flag"), F.get("c", 2).alias("chrom"), (F.get("c", 3).try_cast("int") - 1).alias("start0"), F.get("c", 4).try_cast("int").alias("mapq"), F.get("c", 5).alias("cigar"), F.get("c", 8).try_cast("int").alias("tlen"), F.get("c", 9).alias("seq"), F.get("c", 10).alias("q"))
    span = F.aggregate(F.filter(cigar_ops(F.col("cigar")), lambda o: o["op"].isin("M", "D", "N", "=", "X")), F.lit(0), lambda acc, o: acc + o["n"])
    flags = {"is_proper": 2, "is_unmapped": 4, "mate_unmapped": 8, "is_reverse": 16, "is_read1": 64, "is_read2": 128, "is_secondary": 256, "is_qcfail": 512, "is_dup": 1024}
    x = x.join(hinted(groups.groupBy("file").agg(F.min("sample").alias("own"))), "file", "left")
    qual = F.transform(F.filter(F.split("q", ""), lambda ch: ch != ""), lambda ch: F.ascii(ch) - 33)
    return x.select(F.coalesce(F.nullif("rg", F.lit("")), "own").alias("sample"), "chrom", "qname", *[bit(b).alias(n) for n, b in flags.items()], "mapq", "start0", (F.col("start0") + span).alias("end0"), "tlen", "seq", F.when(F.col("q") == "*", F.array().cast("array<int>")).otherwise(qual).alias("qual"), aligned_pairs(F.col("cigar"), F.col("start0")).alias("pairs"))


def coordinate_sorted(reads: DataFrame) -> DataFrame:
    """Reads in the order of their places, unmapped ones last; a range shuffle, so a chromosome spreads over tasks."""
    return reads.orderBy(F.col("is_unmapped"), "chrom", "start0", "end0", "qname", "is_read2")
