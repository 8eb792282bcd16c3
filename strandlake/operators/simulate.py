"""Seeded simulation with known truth, and paired subsampling. All draws are hashes of a seed and a row's own key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def draw(seed: int, *key: str | Column) -> Column:
    """A number in [0, 1) that depends on the seed and the key only."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *key), 11) / F.lit(float(1 << 53))


def sample_pairs(reads: DataFrame, fraction: float, seed: int, pair: str = "pair", ordinal: str = "ordinal") -> DataFrame:
    """A share of read pairs: both mates of an ordinal are in or out together."""
    return reads.where(draw(seed, pair, ordinal) < fraction)


def subsample_fraction(read_length: Column, pairs: Column, genome_length: int, depth: int, loss: float = 0.0) -> Column:
    """The share of pairs that gives a depth, from the expected coverage ``2 * length * pairs * (1 - loss) / genome``."""
    wanted = F.round(F.lit(genome_length * depth) / (2 * read_length) / (1 - loss))
    return F.least(F.lit(1.0), wanted / pairs)


def available(genome: DataFrame, deletions: DataFrame, pad: int = 0) -> DataFrame:
    """Positions ``chrom, pos0`` that no padded deletion covers; ``genome``: ``chrom, length``."""
    from strandlake.operators.intervals import points_in_ranges

    spots = genome.select("chrom", F.explode(F.sequence(F.lit(0), F.col("length") - 1)).alias("pos0"))
    holes = deletions.select("chrom", (F.col("start") - pad - 1).alias("start"), (F.col("end") + pad).alias("end"))
    return points_in_ranges(spots, holes, "pos0", ["chrom"], "left_anti", closed_end=False)


def snps(spots: DataFrame, number: int, genomes: int, seed: int, distribution: str = "pseudo_tree") -> DataFrame:
    """``rep, pos0, base``: substitutions of each of ``genomes`` simulated genomes.

    ``pseudo_tree``: 30 % of the number shared by all, the same number private to each genome; ``random``: drawn for each
    genome by itself; ``discrete``: dealt out, so that no position varies in two genomes. ``spots``: ``chrom, pos0, ref``.
    """
    share = int(0.3 * number)
    order = W.orderBy("_d")
    reps = F.explode(F.sequence(F.lit(0), F.lit(genomes - 1)))
    bases = lambda rep: F.element_at(F.array_remove(F.array(*map(F.lit, "ACGT")), F.col("ref")), (F.floor(draw(seed + 1, "chrom", "pos0", rep) * 3) + 1).cast("int"))
    if distribution == "random":
        x = spots.select("*", reps.alias("rep")).withColumn("_d", draw(seed, "chrom", "pos0", "rep"))
        x = x.withColumn("_r", F.row_number().over(W.partitionBy("rep").orderBy("_d"))).where(F.col("_r") <= number)
        return x.select("rep", "chrom", "pos0", "ref", bases("rep").alias("base"))
    most = number * genomes if distribution == "discrete" else share * (genomes + 1)
    x = spots.withColumn("_d", draw(seed, "chrom", "pos0")).orderBy("_d").limit(most)
    x = x.withColumn("_r", F.row_number().over(order) - 1)
    if distribution == "discrete":
        return x.select(F.floor(F.col("_r") / number).cast("int").alias("rep"), "chrom", "pos0", "ref", bases(F.lit(0)).alias("base"))
    old = x.where(F.col("_r") < share).select(reps.alias("rep"), "chrom", "pos0", "ref", bases(F.lit(-1)).alias("base"))
    new = x.where(F.col("_r") >= share).select((F.floor(F.col("_r") / max(1, share)) - 1).cast("int").alias("rep"), "chrom", "pos0", "ref", bases(F.lit(0)).alias("base"))
    return old.union(new)


def indels(spots: DataFrame, sizes: Sequence[int], genomes: int, seed: int) -> DataFrame:
    """``rep, pos0, kind, del_len, ins_seq``: one for each size; the first third shared by all genomes, the rest private in turn."""
    n = len(sizes)
    x = spots.withColumn("_d", draw(seed, "chrom", "pos0")).orderBy("_d").limit(n).withColumn("_r", F.row_number().over(W.orderBy("_d")) - 1)
    size = F.element_at(F.array(*map(F.lit, sizes)), F.col("_r") + 1)
    old = F.col("_r") < n // 3
    reps = F.when(old, F.sequence(F.lit(0), F.lit(genomes - 1))).otherwise(F.array((F.col("_r") % genomes).cast("int")))
    letters = F.array_join(F.transform(F.sequence(F.lit(1), size), lambda i: F.element_at(F.array(*map(F.lit, "ACGT")), (F.floor(draw(seed + 2, "chrom", "pos0", i) * 4) + 1).cast("int"))), "")
    deletion = draw(seed + 3, "chrom", "pos0") < 0.5
    return x.select(F.explode(reps).alias("rep"), "chrom", "pos0", F.when(deletion, "deletion").otherwise("insertion").alias("kind"), F.when(deletion, size).alias("del_len"), F.when(~deletion, letters).alias("ins_seq"))


def apply_edits(genome: DataFrame, edits: DataFrame) -> DataFrame:
    """``rep, chrom, seq``: the genome with each genome's edits ``rep, chrom, pos0, del_len, ins`` (a substitution deletes one and inserts one)."""
    e = edits.groupBy("rep", "chrom").agg(F.array_sort(F.collect_list(F.struct("pos0", "del_len", "ins"))).alias("e"))
    x = e.join(genome.select("chrom", "seq"), "chrom")
    step = lambda acc, v: F.struct(F.concat(acc["out"], F.substring("seq", acc["at"] + 1, v["pos0"] - acc["at"]), v["ins"]).alias("out"), (v["pos0"] + v["del_len"]).cast("int").alias("at"))
    folded = F.aggregate("e", F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step)
    return x.withColumn("f", folded).select("rep", "chrom", F.concat(F.col("f.out"), F.substring("seq", F.col("f.at") + 1, F.length("seq"))).alias("seq"))


def shifted(pos0: Column, deletions: Sequence[tuple[int, int]]) -> Column:
    """A position after large deletions ``[start, end)`` before it are gone."""
    gone = F.lit(0)
    for s, e in deletions:
        gone = gone + F.when(pos0 > e, e - s).otherwise(0)
    return pos0 - gone


def reads(spark: SparkSession, genome: DataFrame, pairs: int, length: int, insert: int, seed: int) -> DataFrame:
    """``qname, mate, chrom, start0, seq``: error-free read pairs at uniform places; for fixtures."""
    from strandlake.functions.sequence import reverse_complement

    x = spark.range(pairs).withColumnRenamed("id", "ordinal").crossJoin(F.broadcast(genome.select("chrom", "seq", F.length("seq").alias("n")).limit(1)))
    at = F.floor(draw(seed, "ordinal") * (F.col("n") - insert)).cast("int")
    x = x.withColumn("at", at)
    one = F.struct(F.lit(1).alias("mate"), F.col("at").alias("start0"), F.substring("seq", F.col("at") + 1, F.lit(length)).alias("s"))
    two = F.struct(F.lit(2).alias("mate"), (F.col("at") + insert - length).alias("start0"), reverse_complement(F.substring("seq", F.col("at") + insert - length + 1, F.lit(length))).alias("s"))
    y = x.select(F.concat(F.lit("read"), "ordinal").alias("qname"), "chrom", F.explode(F.array(one, two)).alias("m"))
    return y.select("qname", "m.mate", "chrom", "m.start0", F.col("m.s").alias("seq"))
