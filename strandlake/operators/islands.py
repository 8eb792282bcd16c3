"""Gaps and islands: runs, clusters and sessions along a position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_TESTS = {">=": lambda a, b: a >= b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, "<": lambda a, b: a < b}


def runs(df: DataFrame, keys: Sequence[str], pos: str, flag: Column) -> DataFrame:
    """Maximal runs of consecutive rows with a true ``flag``: ``start``, ``end`` (the next row's position, null if none), ``n``."""
    w = W.partitionBy(*keys).orderBy(pos)
    x = df.select(*keys, F.col(pos).alias("_p"), F.coalesce(flag, F.lit(False)).alias("_f"))
    w2 = W.partitionBy(*keys).orderBy("_p")
    x = x.withColumns({"_next": F.lead("_p").over(w2), "_new": (F.col("_f") & ~F.coalesce(F.lag("_f").over(w2), F.lit(False))).cast("int")})
    x = x.withColumn("_run", F.sum("_new").over(w2.rowsBetween(W.unboundedPreceding, 0)))
    last = F.max(F.struct("_p", "_next"))["_next"]
    return x.where("_f").groupBy(*keys, "_run").agg(F.min("_p").alias("start"), last.alias("end"), F.count("*").alias("n")).drop("_run")


def threshold_islands(df: DataFrame, keys: Sequence[str], index: str, value: str, threshold: float, test: str = ">=", resolution: int = 1, offset: int = 0, length: int | None = None, buffer: int = 0, keep_open: bool = True) -> DataFrame:
    """Runs of bins whose value meets a threshold, as positions ``offset + index * resolution``; nulls never meet it.

    A run ends at the position of the next bin; an open last run ends at ``length`` (or one bin on if it is not
    given) or, without ``keep_open``, is dropped. With ``length`` runs that touch the buffer at either end go.
    """
    found = runs(df, keys, index, _TESTS[test](F.col(value), F.lit(threshold)))
    place = lambda c: F.lit(offset) + F.col(c) * resolution
    closing = F.lit(length) if length is not None else F.lit(offset) + (F.col("start") + F.col("n")) * resolution
    out = found if keep_open else found.where("end is not null")
    out = out.select(*keys, place("start").alias("start"), F.coalesce(place("end"), closing).alias("end"), "n")
    if length is None:
        return out
    bins = length // resolution
    return out.where((F.col("start") > buffer) & (F.col("end") < bins * resolution + offset - buffer))


def consecutive_ranges(df: DataFrame, keys: Sequence[str], pos: str) -> DataFrame:
    """Distinct consecutive integers as ranges ``[start, end)``."""
    w = W.partitionBy(*keys).orderBy(pos)
    x = df.select(*keys, pos).distinct().withColumn("_g", F.col(pos) - F.row_number().over(w))
    return x.groupBy(*keys, "_g").agg(F.min(pos).alias("start"), (F.max(pos) + 1).alias("end")).drop("_g")


def gap_clusters(df: DataFrame, keys: Sequence[str], pos: str, max_gap: int) -> DataFrame:
    """Rows with a cluster number: a distance of ``max_gap`` or more to the row before starts a new one."""
    w = W.partitionBy(*keys).orderBy(pos)
    x = df.withColumn("_new", F.when(F.col(pos) - F.lag(pos).over(w) < max_gap, 0).otherwise(1))
    return x.withColumn("cluster", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_new")


def assembly_regions(ranges: DataFrame, keys: Sequence[str], max_gap: int = 10_000, pad: int = 500, most: int = 20_000, overlap: int = 100) -> DataFrame:
    """Ranges joined over gaps below ``max_gap``, padded, and cut into equal pieces with an overlap where longer than ``most``."""
    w = W.partitionBy(*keys).orderBy("start", "end")
    far = F.max("end").over(w.rowsBetween(W.unboundedPreceding, -1))
    x = ranges.withColumn("_new", F.when(F.col("start") - far < max_gap, 0).otherwise(1))
    x = x.withColumn("_g", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    x = x.groupBy(*keys, "_g").agg(F.greatest(F.lit(0), F.min("start") - pad).alias("_s"), (F.max("end") + pad).alias("_e")).drop("_g")
    k = F.ceil((F.col("_e") - F.col("_s")) / F.lit(most)).cast("int")
    x = x.select(*keys, "_s", "_e", k.alias("_k")).select("*", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)).alias("piece"))
    step = (F.col("_e") - F.col("_s")) / F.col("_k")
    start = F.floor(F.col("_s") + F.col("piece") * step) - F.when(F.col("piece") > 0, overlap).otherwise(0)
    return x.select(*keys, "piece", start.cast("bigint").alias("start"), F.floor(F.col("_s") + (F.col("piece") + 1) * step).cast("bigint").alias("end"))


def binned_ambiguous(pids: DataFrame, keys: Sequence[str], pos: str, pid: str, least: float, step: int) -> DataFrame:
    """Ranges where percent identities sampled every ``step`` positions reach ``least``."""
    marks = pids.where(F.col(pid) >= least).select(*keys, F.floor(F.col(pos) / step).alias("_b"))
    return consecutive_ranges(marks, keys, "_b").select(*keys, (F.col("start") * step).alias("start"), (F.col("end") * step).alias("end"))
