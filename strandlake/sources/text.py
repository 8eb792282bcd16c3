"""Genomes, alignments, trees and the text outputs of other programs."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _whole(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("text"))


def fasta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``name, seq`` of every record."""
    rec = _whole(spark, path).select(F.explode(F.filter(F.split("text", "(?m)^>"), lambda r: F.trim(r) != "")).alias("r"))
    return rec.select(F.regexp_extract("r", r"^(\S+)", 1).alias("name"), F.regexp_replace(F.regexp_replace("r", r"^[^\n]*\n?", ""), r"\s+", "").alias("seq"))


def phylip(spark: SparkSession, path: str) -> DataFrame:
    """``name, seq`` of an interleaved or sequential alignment with names of ten characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text in b.column("text").to_pylist():
                head, *rest = [x for x in text.splitlines() if x.strip()]
                n = int(head.split()[0])
                names = [x[:10].strip() for x in rest[:n]]
                seqs = ["".join(("".join(x[10:].split())) if k == 0 else "".join(x.split()) for k, x in enumerate(rest[i::n])) for i in range(n)]
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(seqs)], names=["name", "seq"])

    return _whole(spark, path).mapInArrow(run, "name string, seq string")


def alignment_columns(rows: DataFrame) -> DataFrame:
    """``sample, col, ch`` of aligned rows ``name, seq``; columns count from 1."""
    return rows.select(F.col("name").alias("sample"), F.posexplode(F.filter(F.split("seq", ""), lambda c: c != "")).alias("c", "ch")).select("sample", (F.col("c") + 1).alias("col"), "ch")


def parse_genbank(text: str) -> tuple[str, str, list[tuple[str, str, str, int, int, int, str]]]:
    """``chrom, sequence, features`` of the first record; features are ``(locus, kind, note, start0, end0, strand, gene)``."""
    chrom = re.search(r"^(?:ACCESSION|LOCUS)\s+(\S+)", text, re.M)
    seq = "".join(re.findall(r"[a-zA-Z]+", re.sub(r"^\s*\d+", "", text[text.find("\nORIGIN") + 7 : (text + "\n//").find("\n//")], flags=re.M))).upper() if "\nORIGIN" in text else ""
    table = text[text.find("\nFEATURES") : text.find("\nORIGIN")] if "\nFEATURES" in text else ""
    out = []
    for m in re.finditer(r"^     (\S+)\s+(.+(?:\n {21}[^/\n].*)*)((?:\n {21}.*)*)", table, re.M):
        kind, place, notes = m[1], m[2].replace("\n", ""), re.sub(r"\n {21}(?!/)", " ", m[3])
        field = {k: v for k, v in re.findall(r'/(\w+)="?([^"\n]*)"?', notes)}
        spans = [int(x) for x in re.findall(r"\d+", place)]
        if kind in ("CDS", "rRNA", "misc_feature") and spans:
            strand = -1 if "complement" in place else 1
            out.append((field.get("locus_tag", field.get("note", "")), kind, field.get("note", ""), min(spans) - 1, max(spans), strand, field.get("gene", "")))
    return chrom[1] if chrom else "", seq, out


#: Mobile elements: their notes, and the length that they exceed.
MOBILE, MOBILE_LENGTH = r"[Ii]sland|[Pp]hage|GI", 10_000


def genbank(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``genome(chrom, length, seq)`` and ``feature(chrom, locus, kind, start0, end0, strand, gene)``; mobile elements have the kind ``mobile``."""
    schema = "chrom string, seq string, f array<struct<locus:string,kind:string,note:string,start0:int,end0:int,strand:int,gene:string>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ("locus", "kind", "note", "start0", "end0", "strand", "gene")
        kind = pa.list_(pa.struct([(k, pa.int32() if k in ("start0", "end0", "strand") else pa.string()) for k in keys]))
        for b in batches:
            for text in b.column("text").to_pylist():
                chrom, seq, f = parse_genbank(text)
                yield pa.RecordBatch.from_arrays([pa.array([chrom]), pa.array([seq]), pa.array([[dict(zip(keys, x, strict=True)) for x in f]], kind)], names=["chrom", "seq", "f"])

    got = _whole(spark, path).mapInArrow(run, schema)
    mobile = (F.col("kind") == "misc_feature") & F.col("note").rlike(MOBILE) & (F.col("end0") - F.col("start0") > MOBILE_LENGTH)
    feats = got.select("chrom", F.explode("f").alias("f")).select("chrom", "f.*").where((F.col("kind") != "misc_feature") | mobile)
    feats = feats.select("chrom", F.when(mobile, F.col("note")).otherwise(F.col("locus")).alias("locus"), F.when(mobile, "mobile").otherwise(F.col("kind")).alias("kind"), "start0", "end0", "strand", "gene")
    return got.select("chrom", F.length("seq").alias("length"), "seq"), feats


def imports(spark: SparkSession, path: str) -> DataFrame:
    """``node, beg, end`` (columns from 1, inclusive) of a recombination import table."""
    return spark.read.csv(path, sep="\t", header=True).select(F.col("Node").alias("node"), F.col("Beg").cast("int").alias("beg"), F.col("End").cast("int").alias("end"))


# What the statistics report calls its numbers.
TREE_STATISTICS = {
    "lnL": r"Log-likelihood:\s*(-?[\d.]+)",
    "parsimony": r"Parsimony:\s*(\d+)",
    "tree_size": r"Tree size:\s*([\d.]+)",
    "gamma_shape": r"Gamma shape parameter:\s*([\d.]+)",
    "ts_tv": r"Transition/transversion ratio:\s*([\d.]+)",
    "f_a": r"f\(A\)=\s*([\d.]+)",
    "f_c": r"f\(C\)=\s*([\d.]+)",
    "f_g": r"f\(G\)=\s*([\d.]+)",
    "f_t": r"f\(T\)=\s*([\d.]+)",
}


def tree_statistics(spark: SparkSession, path: str) -> DataFrame:
    """One row for each file with the numbers of a phylogeny's statistics report; missing ones are null."""
    num = lambda p: F.nullif(F.regexp_extract("text", p, 1), F.lit("")).cast("double")
    return _whole(spark, path).select("file", *[num(p).alias(k) for k, p in TREE_STATISTICS.items()])


def aligner_coords(spark: SparkSession, path: str) -> DataFrame:
    """``a_start, a_end, b_start, b_end, identity`` (0-based, half-open) of a table of coordinates; reverse matches are turned round."""
    c = F.split(F.trim("value"), r"[\s|]+")
    n = lambda i: F.col("c")[i].try_cast("int")
    x = spark.read.text(path).select(c.alias("c")).where((F.size("c") > 5) & n(0).isNotNull() & n(1).isNotNull() & n(2).isNotNull() & n(3).isNotNull())
    return x.select((n(0) - 1).alias("a_start"), n(1).alias("a_end"), (F.least(n(2), n(3)) - 1).alias("b_start"), F.greatest(n(2), n(3)).alias("b_end"), F.col("c")[6].try_cast("double").alias("identity"))


def names(spark: SparkSession, path: str, columns: tuple[str, str] = ("old", "new")) -> DataFrame:
    """A two-column table of names, separated by tabs."""
    return spark.read.csv(path, sep="\t").toDF(*columns)


def parse_newick(text: str) -> list[tuple[int, int | None, str, float | None]]:
    """``(node, parent, label, length)`` of a tree, parents first; nodes are numbered in reading order."""
    nodes: list[list] = [[0, None, "", None]]
    at, i = 0, 0
    s = text.strip().rstrip(";")
    while i < len(s):
        c = s[i]
        if c == "(":
            nodes.append([len(nodes), at, "", None])
            at = len(nodes) - 1
        elif c == ",":
            nodes.append([len(nodes), nodes[at][1], "", None])
            at = len(nodes) - 1
        elif c == ")":
            at = nodes[at][1]
        elif c == ":":
            m = re.match(r"[-+0-9.eE]+", s[i + 1 :])
            nodes[at][3] = float(m[0])
            i += len(m[0])
        elif c == "'":
            end = s.index("'", i + 1)
            nodes[at][2] = s[i + 1 : end]
            i = end
        elif c == "[":
            i = s.index("]", i)
        elif not c.isspace():
            m = re.match(r"[^():,;\[\]\s]+", s[i:])
            nodes[at][2] = m[0]
            i += len(m[0]) - 1
        i += 1
    return [tuple(x) for x in nodes]


def newick(spark: SparkSession, path: str) -> DataFrame:
    """``node, parent, label, edge_length`` of one tree; a tree has few nodes and is read on the driver."""
    text = spark.read.text(path, wholetext=True).first()[0]
    return tree_table(spark, parse_newick(text))


def tree_table(spark: SparkSession, nodes: list) -> DataFrame:
    return spark.createDataFrame(nodes, "node int, parent int, label string, edge_length double")


def write_newick(tree: DataFrame) -> str:
    """The tree as text, children in the order of their numbers."""
    rows = sorted(tree.collect(), key=lambda r: r.node)
    kids: dict = {}
    for r in rows:
        kids.setdefault(r.parent, []).append(r)

    def show(r) -> str:
        inner = "(" + ",".join(show(k) for k in kids[r.node]) + ")" if r.node in kids else ""
        return inner + (r.label or "") + (f":{r.edge_length:g}" if r.edge_length is not None else "")

    return show(kids[None][0]) + ";"
