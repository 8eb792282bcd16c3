"""Interval joins and interval sets. Ranges are half-open ``[start, end)`` unless a function says otherwise.

Joins on ranges become equi-joins on fixed-width bins with the range condition as residual, so Spark shuffles (or
broadcasts) by key instead of comparing all pairs. A pair is reported in one bin only, the one that holds
the later start, so nothing has to be deduplicated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def bin_of(pos: str | Column, width: int) -> Column:
    return F.floor((F.col(pos) if isinstance(pos, str) else pos) / F.lit(width)).cast("bigint")


def with_bins(ranges: DataFrame, width: int, start: str = "start", end: str = "end", name: str = "_bin") -> DataFrame:
    """One row for each bin that a range touches; empty ranges touch none."""
    full = ranges.where(F.col(start) < F.col(end))
    return full.withColumn(name, F.explode(F.sequence(bin_of(start, width), bin_of(F.col(end) - 1, width))))


def points_in_ranges(points: DataFrame, ranges: DataFrame, pos: str, keys: Sequence[str] = (), how: str = "left_semi", width: int = 1000, closed_end: bool = True) -> DataFrame:
    """Join of points with ranges ``(start, end]`` (or ``(start, end)`` unless ``closed_end``); ``how`` as for ``DataFrame.join``.

    Key columns have the same names on both sides; range columns are ``start`` and ``end``.
    """
    inside = ranges.withColumnsRenamed({k: f"_r_{k}" for k in keys}).withColumns({"_s": F.col("start"), "_e": F.col("end") + (1 if closed_end else 0)})
    binned = with_bins(inside.withColumn("_s1", F.col("_s") + 1), width, "_s1", "_e")
    p = points.withColumn("_pbin", bin_of(pos, width))
    on = (F.col("_pbin") == F.col("_bin")) & (F.col("_s") < F.col(pos)) & (F.col(pos) < F.col("_e"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"_r_{k}"))
    return p.join(binned, on, how).drop("_pbin", "_bin", "_s", "_e", "_s1", *[f"_r_{k}" for k in keys])


def overlap_join(left: DataFrame, right: DataFrame, ls: str, le: str, rs: str, re: str, keys: Sequence[tuple[str, str]] = (), width: int = 1000) -> DataFrame:
    """Inner join on ``ls < re and rs < le`` and equal keys; all four column names differ."""
    a, b = with_bins(left, width, ls, le, "_lbin"), with_bins(right, width, rs, re, "_rbin")
    on = (F.col("_lbin") == F.col("_rbin")) & (F.col(ls) < F.col(re)) & (F.col(rs) < F.col(le))
    on = on & (F.col("_lbin") == bin_of(F.greatest(F.col(ls), F.col(rs)), width))
    for x, y in keys:
        on = on & (F.col(x) == F.col(y))
    return a.join(b, on).drop("_lbin", "_rbin")


def not_contained(ranges: DataFrame, start: str, end: str, keys: Sequence[str] = (), width: int = 1000) -> DataFrame:
    """Ranges that lie strictly inside no other range (``start' < start`` and ``end < end'``) of the same keys."""
    other = with_bins(ranges.select(F.col(start).alias("_s"), F.col(end).alias("_e"), *[F.col(k).alias(f"_r_{k}") for k in keys]), width, "_s", "_e")
    own = ranges.withColumn("_pbin", bin_of(start, width))
    on = (F.col("_pbin") == F.col("_bin")) & (F.col("_s") < F.col(start)) & (F.col(end) < F.col("_e"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"_r_{k}"))
    return own.join(other, on, "left_anti").drop("_pbin")


def merge_ranges(ranges: DataFrame, keys: Sequence[str] = (), min_length: int = 0) -> DataFrame:
    """Union of the ranges of each key: overlapping and touching ones become one; only those longer than ``min_length``."""
    w = W.partitionBy(*keys).orderBy("start", "end")
    far = F.max("end").over(w.rowsBetween(W.unboundedPreceding, -1))
    marked = ranges.where("start < end").select(*keys, "start", "end", F.when(F.col("start") <= far, 0).otherwise(1).alias("_new"))
    grouped = marked.withColumn("_island", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    merged = grouped.groupBy(*keys, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")
    return merged.where(F.col("end") - F.col("start") > min_length)


def subtract_ranges(a: DataFrame, b: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """What the union of ``a`` covers and that of ``b`` does not, as ranges: one sweep over the ends, no positions."""
    ends = lambda df, n: df.where("start < end").select(*keys, F.explode(F.array(
        F.struct(F.col("start").alias("at"), F.lit(1).alias("d")), F.struct(F.col("end").alias("at"), F.lit(-1).alias("d")))).alias("e")).select(*keys, "e.at", *[(F.col("e.d") if n == x else F.lit(0)).alias(x) for x in ("da", "db")])
    both = ends(a, "da").union(ends(b, "db")).groupBy(*keys, "at").agg(F.sum("da").alias("da"), F.sum("db").alias("db"))
    w = W.partitionBy(*keys).orderBy("at")
    run = w.rowsBetween(W.unboundedPreceding, 0)
    swept = both.select(*keys, F.col("at").alias("start"), F.lead("at").over(w).alias("end"), F.sum("da").over(run).alias("na"), F.sum("db").over(run).alias("nb"))
    return merge_ranges(swept.where("na > 0 and nb = 0 and end is not null").select(*keys, "start", "end"), keys)


def totals(ranges: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``n, bp``: number of ranges of each key and the positions that they cover together."""
    n = ranges.where("start < end").groupBy(*keys).agg(F.count("*").alias("n"))
    bp = merge_ranges(ranges, keys).groupBy(*keys).agg(F.sum(F.col("end") - F.col("start")).alias("bp"))
    return n.join(bp, list(keys)) if keys else n.crossJoin(F.broadcast(bp))  # one row each


def drop_shared_ends(ranges: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Ranges fused where one ends exactly where another starts: ends that occur twice vanish, the rest pair up in order."""
    points = ranges.select(*keys, F.explode(F.array("start", "end")).alias("at")).groupBy(*keys, "at").agg(F.count("*").alias("n")).where("n = 1")
    w = W.partitionBy(*keys).orderBy("at")
    return points.select(*keys, F.col("at").alias("start"), F.lead("at").over(w).alias("end"), F.row_number().over(w).alias("_r")).where("_r % 2 = 1").drop("_r")


def window_view(features: DataFrame, view_start: int, view_end: int, start: str = "start", end: str = "end") -> DataFrame:
    """Features that touch a view, clipped to it, with how: complete, left, right or span."""
    s, e = F.greatest(F.col(start), F.lit(view_start)), F.least(F.col(end), F.lit(view_end))
    how = F.when((F.col(start) >= view_start) & (F.col(end) <= view_end), "complete").when((F.col(start) < view_start) & (F.col(end) > view_end), "span").when(F.col(start) < view_start, "left").otherwise("right")
    return features.where((F.col(start) < view_end) & (F.col(end) > view_start)).select("*", s.alias("clip_start"), e.alias("clip_end"), how.alias("shown"))


def circular_reads(reads: DataFrame, length: int, start: int, end: int, padding: int = 0) -> DataFrame:
    """Reads ``(start0, end0)`` that touch ``[start - padding, end + padding)`` on a circular chromosome of a length."""
    lo, hi = start - padding, end + padding
    parts = [(max(lo, 0), min(hi, length))] + [(length + lo, length)] * (lo < 0) + [(0, hi - length)] * (hi > length)
    cond = F.lit(False)
    for a, b in parts:
        cond = cond | ((F.col("start0") < b) & (F.col("end0") > a))
    return reads.where(cond)
