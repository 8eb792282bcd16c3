"""Read-depth signals: depth, insert size, ratios, smoothing and region extension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandlake.operators.intervals import merge_ranges, points_in_ranges


def usable(min_mapq: int) -> Column:
    """Reads that count for depth: neither failed, duplicate nor secondary, and mapped well enough."""
    return ~F.col("is_qcfail") & ~F.col("is_dup") & ~F.col("is_secondary") & ~F.col("is_unmapped") & (F.col("mapq") >= min_mapq)


def depth(reads: DataFrame, resolution: int = 10, min_mapq: int = 30) -> DataFrame:
    """``sample, chrom, bin, total, proper``: reads whose aligned span covers the position ``bin * resolution``; as in a pileup column, a deletion or skip counts as covered."""
    first, last = F.ceil(F.col("start0") / resolution).cast("bigint"), F.floor((F.col("end0") - 1) / resolution).cast("bigint")
    seen = reads.where(usable(min_mapq)).select("sample", "chrom", "is_proper", first.alias("a"), last.alias("z")).where("a <= z")
    seen = seen.select("sample", "chrom", "is_proper", F.explode(F.sequence("a", "z")).alias("bin"))
    return seen.groupBy("sample", "chrom", "bin").agg(F.count("*").alias("total"), F.count_if("is_proper").alias("proper"))


def mean_insert_size(reads: DataFrame, upper: int = 10_000, min_mapq: int = 30) -> DataFrame:
    """``sample, mean_insert``: mean absolute template length of first reads of proper pairs below ``upper``; -1 if none."""
    fits = F.col("is_proper") & F.col("is_read1") & ~F.col("is_dup") & ~F.col("is_qcfail") & (F.col("mapq") >= min_mapq) & (F.abs("tlen") < upper)
    return reads.groupBy("sample").agg(F.coalesce(F.avg(F.when(fits, F.abs("tlen"))), F.lit(-1.0)).alias("mean_insert"))


def proper_proportion(reads: DataFrame, start: int, end: int) -> DataFrame:
    """``sample, proportion`` of distinct fragments in a region that map properly; a name can be in both buckets."""
    seen = reads.where((F.col("start0") < end) & (F.col("end0") > start))
    return seen.groupBy("sample").agg(F.count_distinct(F.when(F.col("is_proper"), F.col("qname"))).alias("p"), F.count_distinct(F.when(~F.col("is_proper"), F.col("qname"))).alias("n")).select(
        "sample", (F.col("p") / F.nullif(F.col("p") + F.col("n"), F.lit(0))).alias("proportion")
    )


def poorly_mapped(reads: DataFrame, threshold: int = 10) -> DataFrame:
    """``sample, qname`` with the mates that are unmapped or mapped with at most the threshold, in read order."""
    bad = reads.where(F.col("is_unmapped") | (F.col("mapq") <= threshold))
    return bad.groupBy("sample", "qname").agg(F.array_sort(F.collect_list(F.struct(F.when(F.col("is_read1"), 1).otherwise(2).alias("mate"), "seq", "qual"))).alias("mates"))


def ratio(total: Column, proper: Column) -> Column:
    """Other reads to proper ones; the total where there are only others; null without reads."""
    return F.when((proper > 0) & (total >= proper), (total - proper) / proper).when((proper == 0) & (total > 0), total.cast("double"))


def smooth(df: DataFrame, keys: Sequence[str], index: str, value: str, window: int, resolution: int, out: str = "smoothed") -> DataFrame:
    """Forward moving mean over dense bins, nulls left out; where at most half the window is known, zeros fill it up to the half.

    Only bins whose whole window lies within the data have a row.
    """
    n_bins, half = window // resolution, window / 2 / resolution
    w = W.partitionBy(*keys).orderBy(index).rowsBetween(0, n_bins - 1)
    known, total = F.count(value).over(w), F.coalesce(F.sum(value).over(w), F.lit(0.0))
    rest = F.count(F.lit(1)).over(W.partitionBy(*keys).orderBy(index).rowsBetween(0, W.unboundedFollowing))
    pad = F.when(known <= half, F.floor(F.lit(half) - known)).otherwise(0)
    x = df.select("*", known.alias("_n"), total.alias("_t"), pad.alias("_pad"), rest.alias("_rest"))
    x = x.where(F.col("_rest") * resolution > window)
    return x.withColumn(out, F.when(F.col("_n") + F.col("_pad") > 0, F.col("_t") / (F.col("_n") + F.col("_pad"))).otherwise(0.0)).drop("_n", "_t", "_pad", "_rest")


def window_totals(df: DataFrame, keys: Sequence[str], index: str, values: dict[str, Column], bins: Column, ahead: bool = True) -> DataFrame:
    """Sums of ``values`` over the ``bins`` bins from each one on (or up to each one), which may differ from row to row.

    ``df`` has every bin of a key once. Running sums meet themselves ``bins`` further on by an equi-join; give whole
    numbers or decimals, so that differences of running sums are exact. Windows end with the data.
    """
    run = W.partitionBy(*keys).orderBy(index).rowsBetween(W.unboundedPreceding, 0)
    x = df.withColumns({"_bins": bins, **{f"_own_{n}": v for n, v in values.items()}})
    x = x.withColumns({"_last": F.max(index).over(W.partitionBy(*keys)), **{f"_run_{n}": F.sum(f"_own_{n}").over(run) for n in values}})
    other = x.select(*keys, F.col(index).alias("_at"), *[F.col(f"_run_{n}").alias(f"_far_{n}") for n in values])
    x = x.withColumn("_at", F.least(F.col(index) + F.col("_bins") - 1, "_last") if ahead else F.col(index) - F.col("_bins"))
    x = x.join(other, [*keys, "_at"], "left")
    total = lambda n: F.col(f"_far_{n}") - F.col(f"_run_{n}") + F.col(f"_own_{n}") if ahead else F.col(f"_run_{n}") - F.coalesce(f"_far_{n}", F.lit(0))
    return x.select(*df.columns, *[total(n).alias(n) for n in values])


def smooth_by(df: DataFrame, keys: Sequence[str], index: str, value: str, window: str, resolution: int, out: str = "smoothed") -> DataFrame:
    """``smooth`` with a window (in positions) of its own for each row's key, in the column ``window``: all samples and chromosomes in one plan."""
    n_bins, half = F.floor(F.col(window) / resolution), F.col(window) / 2 / resolution
    known = F.when(F.col(value).isNotNull(), 1).otherwise(0)
    exact = F.coalesce(F.col(value).cast("decimal(28,12)"), F.lit(0).cast("decimal(28,12)"))
    x = window_totals(df, keys, index, {"_n": known, "_t": exact}, n_bins)
    last = F.max(index).over(W.partitionBy(*keys))
    x = x.withColumn("_rest", last - F.col(index) + 1).where(F.col("_rest") * resolution > F.col(window))
    pad = F.when(F.col("_n") <= half, F.floor(half - F.col("_n"))).otherwise(0)
    filled = F.col("_n") + pad
    return x.withColumn(out, F.when(filled > 0, F.col("_t").cast("double") / filled).otherwise(0.0)).drop("_n", "_t", "_rest")


def dense(df: DataFrame, keys: Sequence[str], index: str, first: Column | None = None, last: Column | None = None) -> DataFrame:
    """Every bin from the first to the last of each key (or those given), left-joined with the rows there are."""
    ends = df.groupBy(*keys).agg((first if first is not None else F.min(index)).alias("_a"), (last if last is not None else F.max(index)).alias("_z"))
    return ends.select(*keys, F.explode(F.sequence("_a", "_z")).alias(index)).join(df, [*keys, index], "left")


def extend_regions(regions: DataFrame, ratios: DataFrame, keys: Sequence[str], resolution: int, window: int | str, threshold: float) -> DataFrame:
    """Regions grown into the gap to the next one while at least ``threshold`` of the next window has no ratio.

    ``regions``: keys, ``start``, ``end``; ``ratios``: keys, ``bin``, ``ratio`` (dense, null if missing); ``window`` in positions, or the
    column of ``ratios`` that has it. Each gap is walked from its left side, then from its right, to the first bin from
    which the window is known well enough; a gap of which more than ``threshold`` is missing or not above 0 is closed. The
    outer sides of the first and the last region stay as they are. Bins meet their gap by a binned join, not by comparing all.
    """
    width = F.col(window) if isinstance(window, str) else F.lit(window)
    order = W.partitionBy(*keys).orderBy("start")
    r = regions.select(*keys, "start", "end", F.lead("start").over(order).alias("next"), F.lag("end").over(order).alias("prev"))
    gaps = r.where("next is not null").select(*keys, F.col("end").alias("ga"), F.col("next").alias("gb"))
    n = F.greatest(F.lit(1), F.floor(width / resolution))
    x = ratios.select(*keys, "bin", "ratio", n.alias("_size"))
    missing = F.when(F.col("ratio").isNull(), 1).otherwise(0)
    for name, ahead in (("ahead", True), ("behind", False)):
        x = window_totals(x, keys, "bin", {f"_m_{name}": missing, f"_k_{name}": F.lit(1)}, F.col("_size"), ahead)
        x = x.withColumn(name, F.col(f"_m_{name}") / F.col(f"_k_{name}"))
    signal = x.select(*keys, "bin", "ratio", (F.col("bin") * resolution).alias("at"), "ahead", "behind")
    spans = gaps.select(*keys, "ga", "gb", (F.col("ga") - 1).alias("start"), (F.col("gb") - 1).alias("end"))
    inside = points_in_ranges(signal, spans, "at", list(keys), "inner", 1000 * resolution)
    found = inside.groupBy(*keys, "ga", "gb").agg(
        F.min(F.when(F.col("ahead") < threshold, F.col("at"))).alias("left"),
        F.max(F.when(F.col("behind") < threshold, F.col("at") + resolution)).alias("right"),
        F.avg(F.when(F.col("ratio").isNull() | (F.col("ratio") <= 0), 1).otherwise(0)).alias("empty"),
    )
    found = gaps.join(found, [*keys, "ga", "gb"], "left")
    shut = F.coalesce(F.col("empty") > threshold, F.lit(False))
    grown = found.select(*keys, "ga", "gb", F.when(shut, F.col("gb")).otherwise(F.coalesce("left", "gb")).alias("new_end"), F.when(shut, F.col("gb")).otherwise(F.greatest(F.coalesce("right", "ga"), F.coalesce("left", "gb"))).alias("new_start"))
    a = r.join(grown.select(*keys, F.col("ga").alias("end"), "new_end"), [*keys, "end"], "left")
    b = a.join(grown.select(*keys, F.col("gb").alias("start"), "new_start"), [*keys, "start"], "left")
    return merge_ranges(b.select(*keys, F.coalesce("new_start", "start").alias("start"), F.coalesce("new_end", "end").alias("end")), keys)


def plot_values(signal: DataFrame, start: int, end: int, resolution: int) -> DataFrame:
    """One row for each sampled position of a view; missing values are 0."""
    spark = signal.sparkSession
    spine = spark.range(-(-start // resolution) * resolution, end, resolution).withColumnRenamed("id", "at")
    return spine.join(signal.where(F.col("at").between(start, end)), "at", "left").fillna(0)


def plot_range(start: Column, end: Column, pad: int = 600, least: int = 2500) -> tuple[Column, Column]:
    """A view around a region: rounded to thousands and at least ``least`` wide."""
    a, b = F.round(start - pad, -3), F.round(end + pad, -3)
    return a, F.greatest(b, a + least)


def mark_duplicates(reads: DataFrame) -> DataFrame:
    """Duplicate flag by position and orientation of both mates: the fragment with the highest base-quality sum stays."""
    five = F.when(F.col("is_reverse"), F.col("end0")).otherwise(F.col("start0"))
    quality = F.aggregate("qual", F.lit(0), lambda acc, q: acc + F.when(q >= 15, q).otherwise(0))
    ends = reads.where("not is_unmapped and not is_secondary").groupBy("sample", "qname").agg(
        F.array_sort(F.collect_list(F.struct("chrom", five.alias("five"), "is_reverse"))).alias("place"), F.sum(quality).alias("q"))
    w = W.partitionBy("sample", "place").orderBy(F.desc("q"), "qname")
    rank = ends.select("sample", "qname", (F.row_number().over(w) > 1).alias("dup"))
    return reads.drop("is_dup").join(rank, ["sample", "qname"], "left").withColumn("is_dup", F.coalesce("dup", F.lit(False))).drop("dup")
