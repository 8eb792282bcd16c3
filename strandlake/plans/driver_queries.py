"""The operators over the driver tables, each with the SQL that gives the same rows.

The driver tables hold no genomes, so each query takes a driver table in the role of a genomic one: an event's
hour is a position, a key range of orders a region, a part number a locus, a flag a sample.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandlake.functions import sequence as fs
from strandlake.operators import intervals, islands, linkage, msa, repeats, signal, simulate, variants
from strandlake.operators.graph import connected_components
from strandlake.runtime import table

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(spark, sf_dir).withColumnRenamed("end", "stop")  # end is a word of SQL
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def hours(name: str = "ts") -> F.Column:
    return F.expr(f"timestampdiff(HOUR, TIMESTAMP_NTZ'1970-01-01 00:00:00', {name})").cast("bigint")


def hourly(spark: SparkSession, sf_dir: str, samples: int = 1) -> DataFrame:
    """Events as a signal: ``sample, bin, total, proper`` (errors are the reads that are not proper)."""
    e = table(spark, sf_dir, "events").select((F.col("user_id") % samples).alias("sample"), hours().alias("bin"), (F.col("event_type") != "error").alias("ok"))
    return e.groupBy("sample", "bin").agg(F.count("*").alias("total"), F.count_if("ok").alias("proper"))


_H = "date_diff('hour', TIMESTAMP '1970-01-01 00:00:00', ts)"
_HOURLY = f"""h as (select user_id % {{n}} as sample, {_H} as bin, count(*) as total, count(*) filter (event_type <> 'error') as proper from events group by all),
ends as (select sample, min(bin) as a, max(bin) as z from h group by sample),
dense as (select e.sample, b.bin, coalesce(total, 0) as total, coalesce(proper, 0) as proper
  from (select sample, unnest(generate_series(a, z)) as bin from ends) b join ends e using (sample) left join h using (sample, bin)),
ratios as (select sample, bin, case when proper > 0 and total >= proper then (total - proper) / proper::double when proper = 0 and total > 0 then total::double end as ratio from dense)"""
_SMOOTH = """smooth as (select sample, bin, n, t, rest, case when n <= 2.5 then floor(2.5 - n) else 0 end as pad from (
  select sample, bin, count(ratio) over w as n, coalesce(sum(ratio) over w, 0) as t, count(*) over (partition by sample order by bin rows between current row and unbounded following) as rest
  from ratios window w as (partition by sample order by bin rows between current row and 4 following)) where rest > 5),
values_ as (select sample, bin, case when n + pad > 0 then t / (n + pad) else 0 end as v from smooth)"""


def _smoothed(spark: SparkSession, sf_dir: str, samples: int) -> DataFrame:
    d = signal.dense(hourly(spark, sf_dir, samples), ["sample"], "bin").fillna(0, ["total", "proper"])
    d = d.withColumn("ratio", signal.ratio(F.col("total"), F.col("proper")))
    return signal.smooth(d, ["sample"], "bin", "ratio", 5, 1)


@query(f"""with {_HOURLY.format(n=4)}, {_SMOOTH},
f as (select *, v >= 0.3 as on_ from values_),
g as (select *, sum(case when on_ and not coalesce(prev, false) then 1 else 0 end) over (partition by sample order by bin) as run from (select *, lag(on_) over (partition by sample order by bin) as prev, lead(bin) over (partition by sample order by bin) as nxt from f))
select sample, min(bin) as start, coalesce(max_by(nxt, bin), min(bin) + count(*)) as stop, count(*) as n from g where on_ group by sample, run""")
def error_ratio_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of hours with a high smoothed error ratio."""
    return islands.threshold_islands(_smoothed(spark, sf_dir, 4), ["sample"], "bin", "smoothed", 0.3)


@query(f"with {_HOURLY.format(n=4)}, {_SMOOTH} select sample, bin, cast(floor(v * 1e6 + 0.5) as bigint) as smoothed_ppm from values_")
def smoothed_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smoothed ratio itself, in millionths."""
    return _smoothed(spark, sf_dir, 4).select("sample", "bin", F.floor(F.col("smoothed") * 1e6 + 0.5).cast("bigint").alias("smoothed_ppm"))


@query(f"""with {_HOURLY.format(n=40)},
g as (select *, total = 0 as on_, lag(total = 0) over (partition by sample order by bin) as prev, lead(bin) over (partition by sample order by bin) as nxt from dense),
r as (select *, sum(case when on_ and not coalesce(prev, false) then 1 else 0 end) over (partition by sample order by bin) as run from g)
select sample, min(bin) as start, max_by(nxt, bin) as stop from r where on_ group by sample, run having max_by(nxt, bin) is not null""")
def zero_activity_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of hours without events."""
    d = signal.dense(hourly(spark, sf_dir, 40), ["sample"], "bin").withColumn("chrom", F.lit(1))
    return msa.missing_regions(d, 1, ["sample"])


@query(f"with {_HOURLY.format(n=10)} select sample, bin, total, proper from h")
def depth_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: total and good events for each hour and sample."""
    return hourly(spark, sf_dir, 10)


_RANGES = "ranges as (select o_orderkey as start, o_orderkey + 3 as \"end\" from orders where o_orderpriority = '1-URGENT')"


def _order_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    return o.select(F.col("o_orderkey").alias("start"), (F.col("o_orderkey") + 3).alias("end"))


@query(f"with {_RANGES} select l_orderkey, l_linenumber, l_partkey from lineitem where exists (select 1 from ranges where start < l_orderkey and l_orderkey <= \"end\")")
def range_filter_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points in ranges ``(start, end]``, semi-join."""
    points = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return intervals.points_in_ranges(points, _order_ranges(spark, sf_dir), "l_orderkey", [], "left_semi", 64)


@query(f"with {_RANGES} select l_orderkey, l_linenumber, l_partkey from lineitem where not exists (select 1 from ranges where start < l_orderkey and l_orderkey <= \"end\")")
def range_anti_retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points in no range, anti-join."""
    points = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return intervals.points_in_ranges(points, _order_ranges(spark, sf_dir), "l_orderkey", [], "left_anti", 64)


_A = 'a as (select s_suppkey, s_suppkey * 10 as a_start, s_suppkey * 10 + s_suppkey % 17 + 5 as a_end from supplier)'
_B = 'b as (select p_partkey, p_partkey as b_start, p_partkey + p_size as b_end, p_brand from part)'


def _a(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(k, (k * 10).alias("a_start"), (k * 10 + k % 17 + 5).alias("a_end"))


def _b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.col("p_partkey").alias("b_start"), (F.col("p_partkey") + F.col("p_size")).alias("b_end"), "p_brand")


@query(f"with {_A}, {_B} select s_suppkey, p_partkey, least(a_end, b_end) - greatest(a_start, b_start) as overlap from a join b on a_start < b_end and b_start < a_end")
def overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping ranges."""
    x = intervals.overlap_join(_a(spark, sf_dir), _b(spark, sf_dir), "a_start", "a_end", "b_start", "b_end", [], 64)
    return x.select("s_suppkey", "p_partkey", (F.least("a_end", "b_end") - F.greatest("a_start", "b_start")).alias("overlap"))


@query(f"with {_B} select p_partkey, b_start, b_end from b where not exists (select 1 from b o where o.p_brand = b.p_brand and o.b_start < b.b_start and b.b_end < o.b_end)")
def containment_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges strictly inside no other of the same brand."""
    return intervals.not_contained(_b(spark, sf_dir), "b_start", "b_end", ["p_brand"], 64).select("p_partkey", "b_start", "b_end")


@query(f"""with {_A}, p as (select distinct l_partkey from lineitem)
select l_partkey, coalesce(string_agg(cast(s_suppkey as varchar), ',' order by cast(s_suppkey as varchar)), '') as features, count(s_suppkey) > 1 as multi
from p left join a on a_start < l_partkey and l_partkey <= a_end group by l_partkey""")
def annotate_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions with the names of all ranges that hold them."""
    feats = _a(spark, sf_dir).select(F.lit("c").alias("chrom"), F.col("s_suppkey").cast("string").alias("locus"), F.col("a_start").alias("start0"), F.col("a_end").alias("end0"))
    calls = table(spark, sf_dir, "lineitem").select("l_partkey").distinct().select(F.lit("c").alias("chrom"), F.col("l_partkey").alias("pos1"))
    return variants.annotate(calls, feats, 64).select(F.col("pos1").alias("l_partkey"), "features", "multi")


_MERGE = """select {k}min(start) as start, max("end") as "end" from (select *, sum(case when start <= far then 0 else 1 end) over ({p}order by start, "end" rows unbounded preceding) as g
  from (select *, max("end") over ({p}order by start, "end" rows between unbounded preceding and 1 preceding) as far from {t})) group by {k}g"""


@query(f"""with {_B}, r as (select p_brand, b_start as start, b_end as "end" from b), m as ({_MERGE.format(k='p_brand, ', p='partition by p_brand ', t='r')})
select p_brand, start, "end" as stop from m where "end" - start > 40""")
def merge_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of the ranges of a brand, longer than 40."""
    r = _b(spark, sf_dir).select("p_brand", F.col("b_start").alias("start"), F.col("b_end").alias("end"))
    return intervals.merge_ranges(r, ["p_brand"], 40)


@query("""with a as (select distinct unnest(generate_series(s_suppkey * 10, s_suppkey * 10 + s_suppkey % 17 + 4)) as x from supplier),
b as (select distinct unnest(generate_series(p_partkey, p_partkey + p_size - 1)) as x from part where p_size >= 45),
d as (select 'a' as side, x from (select x from a except select x from b) union all select 'b', x from (select x from b except select x from a)),
i as (select side, x, x - row_number() over (partition by side order by x) as g from d)
select side, min(x) as start, max(x) + 1 as stop from i group by side, g""")
def range_set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of two sets of ranges covers alone, by a sweep over ends."""
    a = _a(spark, sf_dir).select(F.lit(1).alias("k"), F.col("a_start").alias("start"), F.col("a_end").alias("end"))
    b = _b(spark, sf_dir).where("b_end - b_start >= 45").select(F.lit(1).alias("k"), F.col("b_start").alias("start"), F.col("b_end").alias("end"))
    one = lambda x, y, n: intervals.subtract_ranges(x, y, ["k"]).select(F.lit(n).alias("side"), "start", "end")
    return one(a, b, "a").union(one(b, a, "b"))


_CALLS = """calls as (select distinct l_returnflag as sample, 'c' as chrom, l_partkey as pos1, l_linestatus as alt from lineitem)"""


def _calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("sample"), F.lit("c").alias("chrom"), F.col("l_partkey").alias("pos1"), F.col("l_linestatus").alias("alt")).distinct()


@query(f"with {_CALLS}, f as (select chrom, pos1, alt, count(distinct sample) as frequency from calls group by all) select sample, chrom, pos1, alt, frequency, case when frequency < 3 then 'among' else 'to_reference' end as class from calls join f using (chrom, pos1, alt)")
def among_vs_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: alleles by the number of samples that have them."""
    return variants.frequency_class(_calls(spark, sf_dir), 3).select("sample", "chrom", "pos1", "alt", "frequency", "class")


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = F.filter(F.array(F.when(F.col("l_discount") >= 0.08, F.lit("discount")), F.when(F.col("l_tax") >= 0.06, F.lit("tax")), F.when(F.col("l_quantity") >= 40, F.lit("quantity"))), lambda x: x.isNotNull())
    return table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("sample"), F.lit("c").alias("chrom"), F.col("l_partkey").alias("pos1"), F.lit("r").alias("ref"), F.col("l_linestatus").alias("alt"), flags.alias("filters"), F.col("l_linestatus").alias("class"))


_FLAGGED = """calls as (select l_returnflag as sample, 'c' as chrom, l_partkey as pos1, 'r' as ref, l_linestatus as alt, l_linestatus as class, l_discount >= 0.08 as f1, l_tax >= 0.06 as f2, l_quantity >= 40 as f3 from lineitem)"""


@query(f"""with {_FLAGGED}, left_ as (select sample, class, pos1, step from calls cross join (select unnest(generate_series(0, 3)) as step) where not ((step >= 1 and f1) or (step >= 2 and f2) or (step >= 3 and f3)))
select sample, class, cast(step as integer) as step, count(distinct pos1) as positions from left_ group by all
union all select 'all', class, cast(step as integer), count(distinct pos1) from left_ group by all""")
def cumulative_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct positions left as filters are added, for each group and over all."""
    return variants.cumulative_totals(_flagged(spark, sf_dir), ["discount", "tax", "quantity"], "sample").select("sample", "class", F.col("step").cast("int").alias("step"), "positions")


@query(f"""with {_FLAGGED}, marks as (select *, unnest(case when not (f1 or f2) then ['retained'] when f1 and f2 then ['discount', 'tax'] when f1 then ['discount'] else ['tax'] end) as "filter" from calls)
select chrom, pos1, ref, alt, "filter", count(distinct sample) as frequency from marks group by all""")
def masked_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alleles with the filters that mask them and their frequencies."""
    return variants.masked_and_retained(_flagged(spark, sf_dir), ["discount", "tax"])


@query("""with c as (select distinct n_regionkey, c_mktsegment, c_custkey % 50 as pos1, c_acctbal < 0 as bad from customer join nation on c_nationkey = n_nationkey),
cells as (select pos1, n_regionkey, bool_and(bad) as bad from c group by all)
select pos1, case when count(*) filter (n_regionkey = 0) = 0 then '0' when bool_or(bad) filter (n_regionkey = 0) then 'negative' else '1' end as s0,
  case when count(*) filter (n_regionkey = 1) = 0 then '0' when bool_or(bad) filter (n_regionkey = 1) then 'negative' else '1' end as s1,
  case when count(*) filter (n_regionkey = 2) = 0 then '0' when bool_or(bad) filter (n_regionkey = 2) then 'negative' else '1' end as s2,
  count(*) as frequency, count(*) filter (not bad) as frequency_filtered from cells where n_regionkey in (0, 1, 2) group by pos1""")
def pivot_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for an allele, one column for a sample."""
    x = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).where("n_regionkey < 3")
    x = x.groupBy(F.concat(F.lit("s"), "n_regionkey").alias("sample"), (F.col("c_custkey") % 50).alias("pos1")).agg(F.bool_and(F.col("c_acctbal") < 0).alias("bad"))
    calls = x.select("sample", F.lit("c").alias("chrom"), "pos1", F.lit("r").alias("ref"), F.lit("a").alias("alt"), F.when(F.col("bad"), F.array(F.lit("negative"))).otherwise(F.array().cast("array<string>")).alias("filters"))
    out = variants.summary(calls, ["s0", "s1", "s2"])
    return out.select("pos1", "s0", "s1", "s2", F.col("Frequency").alias("frequency"), F.col("Frequency (filtered)").alias("frequency_filtered"))


@query("select l_partkey, l_suppkey, min_by(l_returnflag, l_orderkey * 100 + l_linenumber) as l_returnflag, count(*) as n_rows, count(distinct l_returnflag) as n_values, count(distinct l_returnflag) > 1 as conflict from (select * from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber order by l_returnflag, l_partkey, l_suppkey) = 1) group by l_partkey, l_suppkey")
def merge_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first value of a key by order, and whether others differ."""
    l = table(spark, sf_dir, "lineitem")
    w = W.partitionBy("l_orderkey", "l_linenumber").orderBy("l_returnflag", "l_partkey", "l_suppkey")
    one = l.withColumn("_r", F.row_number().over(w)).where("_r = 1")
    return variants.merge_calls(one, ["l_partkey", "l_suppkey"], "l_returnflag", ["l_orderkey", "l_linenumber"])


@query(f"""with e as (select user_id % 10 as sample, user_id, event_type <> 'error' as ok from events where {_H} % 24 between 6 and 11)
select sample, cast(floor(count(distinct user_id) filter (ok) * 1e6 / (count(distinct user_id) filter (ok) + count(distinct user_id) filter (not ok)) + 0.5) as bigint) as proportion_ppm from e group by sample""")
def fragment_proportion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: share of distinct fragments that are proper; a name can count in both."""
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("sample"), F.col("user_id").alias("qname"), (F.col("event_type") != "error").alias("is_proper"), (hours() % 24).alias("start0"))
    reads = e.withColumn("end0", F.col("start0") + 1)
    return signal.proper_proportion(reads, 6, 12).select("sample", F.floor(F.col("proportion") * 1e6 + 0.5).cast("bigint").alias("proportion_ppm"))


@query("""select l_returnflag as sample, cast(floor(coalesce(avg(abs(d)) filter (l_linestatus = 'O' and l_quantity >= 30 and abs(d) < 60), -1.0) * 1e6 + 0.5) as bigint) as mean_insert_ppm
from (select *, date_diff('day', o_orderdate, l_shipdate) as d from lineitem join orders on l_orderkey = o_orderkey) group by 1""")
def mean_insert_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean bounded distance of good rows, -1 without any."""
    x = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    no = F.lit(False)
    reads = x.select(F.col("l_returnflag").alias("sample"), (F.col("l_linestatus") == "O").alias("is_proper"), F.lit(True).alias("is_read1"), no.alias("is_dup"), no.alias("is_qcfail"), F.col("l_quantity").alias("mapq"), F.date_diff("l_shipdate", "o_orderdate").alias("tlen"))
    return signal.mean_insert_size(reads, 60, 30).select("sample", F.floor(F.col("mean_insert") * 1e6 + 0.5).cast("bigint").alias("mean_insert_ppm"))


@query("""select l_orderkey, l_linenumber, case when l_returnflag = 'A' and (l_quantity < 2.0 or l_extendedprice > 60000 or l_discount < 0.01) then 'standard_hard_filter'
 when l_returnflag <> 'A' and (l_quantity < 2.0 or l_extendedprice > 90000) then 'standard_indel_hard_filter' end as label from lineitem""")
def hard_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: the name of the failed filter."""
    label = variants.hard_filter(F.col("l_returnflag") == "A", ("l_quantity < 2.0", "l_extendedprice > 60000", "l_discount < 0.01"), ("l_quantity < 2.0", "l_extendedprice > 90000"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", label.alias("label"))


_SEEN = """seen as (select l_orderkey as qname, l_partkey % 7 as pos1, min(case when l_returnflag = 'A' then 'alt' else 'ref' end) as a, max(case when l_returnflag = 'A' then 'alt' else 'ref' end) as z from lineitem group by 1, 2),
one as (select qname, pos1, a from seen where a = z)"""


@query(f"""with {_SEEN} select x.pos1 as pos_a, y.pos1 as pos_b, count(*) as spanning, count(*) filter (x.a = 'alt' and y.a = 'alt') as n_both, count(*) filter (x.a = 'alt' and y.a = 'ref') as first_only,
count(*) filter (x.a = 'ref' and y.a = 'alt') as second_only, count(*) filter (x.a = 'ref' and y.a = 'ref') as neither from one x join one y on x.qname = y.qname and x.pos1 < y.pos1 group by 1, 2 having count(*) >= 20""")
def linked_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alleles of two loci on the same fragments."""
    seen = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("qname"), (F.col("l_partkey") % 7).alias("pos1"), F.when(F.col("l_returnflag") == "A", "alt").otherwise("ref").alias("allele"))
    return linkage.linkage_table(seen).withColumnRenamed("both", "n_both")


@query("""with s as (select l_orderkey, count(*) filter (l_returnflag = 'N' and l_quantity < 5) as low, count(*) filter (l_returnflag = 'A') as alt from lineitem group by 1)
select case when alt > 1 then 'linked' when alt = 1 then 'one' when low > 0 then 'low_quality' else 'none' end as class, count(*) as n from s group by 1""")
def read_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments by what they show."""
    allele = F.when(F.col("l_returnflag") == "A", "alt").when((F.col("l_returnflag") == "N") & (F.col("l_quantity") < 5), "low").otherwise("ref")
    return linkage.read_classes(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("qname"), allele.alias("allele")))


@query(f"""with e as (select user_id, {_H} as h, event_id from events), g as (select *, case when h - lag(h) over (partition by user_id order by h, event_id) < 6 then 0 else 1 end as new from e),
c as (select *, sum(new) over (partition by user_id order by h, event_id rows unbounded preceding) as cluster from g) select user_id, cluster::bigint as cluster, min(h) as first_h, max(h) as last_h, count(*) as n from c group by 1, 2""")
def cluster_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters by a gap."""
    e = table(spark, sf_dir, "events").select("user_id", hours().alias("h"))
    x = islands.gap_clusters(e, ["user_id"], "h", 6)
    return x.groupBy("user_id", F.col("cluster").cast("bigint").alias("cluster")).agg(F.min("h").alias("first_h"), F.max("h").alias("last_h"), F.count("*").alias("n"))


@query("""with a as (select distinct p_size, p_partkey from part where p_type = 'ECONOMY'), i as (select p_size, p_partkey, p_partkey - row_number() over (partition by p_size order by p_partkey) as g from a)
select p_size, min(p_partkey) as start, max(p_partkey) + 1 as stop from i group by p_size, g""")
def consecutive_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of consecutive integers."""
    return islands.consecutive_ranges(table(spark, sf_dir, "part").where("p_type = 'ECONOMY'").select("p_size", "p_partkey"), ["p_size"], "p_partkey")


_DNA = "translate(lower(text), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC')"
_DNA_SQL = f"regexp_replace({_DNA}, '[^ACGT]', '', 'g')"


def _dna(spark: SparkSession, sf_dir: str, name: str = "benchmark", key: str = "item_id") -> DataFrame:
    """Texts as sequences: letters become bases, everything else goes."""
    return table(spark, sf_dir, name).select(F.col(key).alias("item_id"), F.regexp_replace(F.expr(_DNA), "[^ACGT]", "").alias("seq"))


@query(f"select item_id, reverse(translate({_DNA_SQL}, 'ACGT', 'TGCA')) as revcomp, length({_DNA_SQL}) as n from benchmark")
def revcomp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """reverse complement."""
    return _revcomp(_dna(spark, sf_dir))


@query()
def revcomp_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 over whole documents."""
    return _revcomp(_dna(spark, sf_dir, "documents", "doc_id"))


def _revcomp(d: DataFrame) -> DataFrame:
    return d.select("item_id", fs.reverse_complement(F.col("seq")).alias("revcomp"), F.length("seq").cast("bigint").alias("n"))


_CODON_SQL = "[" + ", ".join(f"'{c}'" for c in fs.CODONS) + "]"
_AA_SQL = "[" + ", ".join(f"'{a}'" for a in fs.CODONS.values()) + "]"


@query(f"""with d as (select item_id, {_DNA_SQL} as seq from benchmark), c as (select item_id, i, substr(seq, cast(i * 3 + 1 as bigint), 3) as codon from (select *, unnest(generate_series(0, length(seq) // 3 - 1)) as i from d))
select item_id, string_agg({_AA_SQL}[list_position({_CODON_SQL}, codon)], '' order by i) as protein from c group by item_id""")
def translated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """protein of a sequence."""
    return _dna(spark, sf_dir).where(F.length("seq") >= 3).select("item_id", fs.translate_dna(F.col("seq")).alias("protein"))


@query(f"""with d as (select item_id, {_DNA_SQL} as seq from benchmark), m as (select item_id, p, substr(seq, cast(p + 1 as bigint), 21) as m from (select *, unnest(generate_series(0, length(seq) - 21)) as p from d where length(seq) >= 21)),
k as (select item_id as chrom, p as pos0, least(m, reverse(translate(m, 'ACGT', 'TGCA'))) as kmer from m)
select chrom, cast(pos0 as bigint) as pos0, kmer from k where kmer in (select kmer from k group by kmer having count(*) > 1)""")
def kmer_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: k-mers that occur again on either strand."""
    return _kmer_seed(_dna(spark, sf_dir))


@query()
def kmer_seed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 over whole documents."""
    return _kmer_seed(_dna(spark, sf_dir, "documents", "doc_id"))


def _kmer_seed(d: DataFrame) -> DataFrame:
    g = d.withColumnRenamed("item_id", "chrom")
    return repeats.kmer_seeds(g, 21).select("chrom", F.col("pos0").cast("bigint").alias("pos0"), "kmer")


@query(f"""with d as (select item_id, {_DNA_SQL} as seq from benchmark), p as (select a.item_id as a_id, a.seq as a, b.seq as b, least(length(a.seq), length(b.seq)) as n from d a join d b on b.item_id = a.item_id + 1),
w as (select *, unnest(generate_series(0, n - 101, 20)) as i from p where n > 100)
select a_id, cast(i + 50 as bigint) as middle, sum(case when substr(a, cast(i + j as bigint), 1) = substr(b, cast(i + j as bigint), 1) then 1 else 0 end)::bigint as same from w cross join (select unnest(generate_series(1, 100)) as j) group by 1, 2""")
def pid_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identity in windows of two rows."""
    return _pid_window(_dna(spark, sf_dir))


@query()
def pid_window_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W8 over whole documents."""
    return _pid_window(_dna(spark, sf_dir, "documents", "doc_id"))


def _pid_window(d: DataFrame) -> DataFrame:
    x = d.select(F.col("item_id").alias("a_id"), F.col("seq").alias("a")).join(d.select((F.col("item_id") - 1).alias("a_id"), F.col("seq").alias("b")), "a_id")
    x = x.select("a_id", F.explode(fs.window_identity(F.col("a"), F.col("b"), 100, 20)).alias("w"))
    return x.select("a_id", F.col("w.at").cast("bigint").alias("middle"), F.round(F.col("w.pid") * 100).cast("bigint").alias("same"))


@query(f"""with d as (select item_id % 8 as g, item_id, rpad({_DNA_SQL}, 60, '-') as seq from benchmark), c as (select item_id, cast(col as integer) as col, substr(seq, col, 1) as ch from (select *, unnest(generate_series(1, 60)) as col from d))
select col, count(*) filter (ch = '-') as gaps, count(distinct ch) filter (ch <> '-') as letters from c group by col""")
def consensus_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of an alignment with gap counts."""
    d = _dna(spark, sf_dir).select("item_id", F.rpad("seq", 60, "-").alias("seq"))
    c = d.select("item_id", F.posexplode(F.filter(F.split("seq", ""), lambda x: x != "")).alias("p", "ch")).select("item_id", (F.col("p") + 1).alias("col"), "ch")
    return c.groupBy("col").agg(F.count_if(F.col("ch") == "-").alias("gaps"), F.count_distinct(F.when(F.col("ch") != "-", F.col("ch"))).alias("letters"))


@query()
def consensus_columns_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G12, A14 over whole documents, as if padded to the longest."""
    return msa.column_counts(_dna(spark, sf_dir, "documents", "doc_id"), "seq")


@query("""with recursive e as (select distinct l_suppkey as s, l_partkey % 5000 as p from lineitem where l_quantity >= 50 and l_discount = 0.1),
n as (select distinct s as node from e), l as (select x.s as a, y.s as b from e x join e y on x.p = y.p and x.s <> y.s),
r(node, reach) as (select node, node from n union select r.node, l.b from r join l on l.a = r.reach)
select node, min(reach) as component from r group by node""")
def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connected components of suppliers by shared parts, as edges to the first supplier of a part."""
    e = table(spark, sf_dir, "lineitem").where("l_quantity >= 50 and l_discount = 0.1").select(F.col("l_suppkey").alias("s"), (F.col("l_partkey") % 5000).alias("p")).distinct()
    first = e.groupBy("p").agg(F.min("s").alias("f"))
    return connected_components(e.join(first, "p"), "s", "f")


@query()
def components_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J13 over all rows and true part numbers."""
    e = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("p")).where("s is not null").distinct()
    first = e.groupBy("p").agg(F.min("s").alias("f"))
    edges = e.join(first, "p", "left").select("s", F.coalesce("f", "s").alias("f"))  # a row without a part joins nothing but is a node
    return connected_components(edges, "s", "f")


@query("""with recursive edges as (select 'r' || r_regionkey as node, cast(null as varchar) as parent from region union all select 'n' || n_nationkey, 'r' || n_regionkey from nation union all select 'c' || c_custkey, 'n' || c_nationkey from customer),
t as (select node, 0 as depth, node as root from edges where parent is null union all select e.node, depth + 1, root from edges e join t on e.parent = t.node)
select root, depth, count(*) as n from t group by 1, 2""")
def tree_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels below the root, by a recursive query."""
    table(spark, sf_dir, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("node"), F.lit(None).cast("string").alias("parent")).union(
        table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), "n_nationkey"), F.concat(F.lit("r"), "n_regionkey"))).union(
        table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey"), F.concat(F.lit("n"), "c_nationkey"))).createOrReplaceTempView("strandlake_edges")
    return spark.sql("""with recursive t(node, depth, root) as (select node, 0, node from strandlake_edges where parent is null
      union all select e.node, depth + 1, root from strandlake_edges e join t on e.parent = t.node) select root, depth, count(*) as n from t group by 1, 2""")


@query()
def paired_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the conversations, all turns of one together."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.length("text").alias("n_chars"), F.lit(1).alias("pair"))
    return simulate.sample_pairs(c, 0.25, 7, "pair", "conv_id").drop("pair")


@query("select r_name, n_name, count(*) as customers, cast(round(sum(cast(c_acctbal as decimal(18,2))) * 100) as bigint) as cents from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by rollup (r_name, n_name)")
def rollup_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by region and nation, by region, and over all."""
    x = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return x.rollup("r_name", "n_name").agg(F.count("*").alias("customers"), F.round(F.sum(F.col("c_acctbal").cast("decimal(18,2)")) * 100).cast("bigint").alias("cents"))


@query("""with r as (select p_brand, p_partkey as x from part union all select p_brand, p_partkey + p_size from part), s as (select p_brand, x from r group by 1, 2 having count(*) = 1),
o as (select p_brand, x as start, lead(x) over (partition by p_brand order by x) as "end", row_number() over (partition by p_brand order by x) as n from s) select p_brand, start, "end" as stop from o where n % 2 = 1""")
def shared_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges fused where an end meets a start."""
    r = _b(spark, sf_dir).select("p_brand", F.col("b_start").alias("start"), F.col("b_end").alias("end"))
    return intervals.drop_shared_ends(r, ["p_brand"])


@query("""with c as (select o_custkey % 200 as k, o_orderkey, o_totalprice, row_number() over (partition by o_custkey % 200 order by o_totalprice desc, o_orderkey) as r from orders) select k, o_orderkey, o_totalprice from c where r = 1""")
def top_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of each group by a stated order."""
    w = W.partitionBy("k").orderBy(F.desc("o_totalprice"), "o_orderkey")
    x = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 200).alias("k"), "o_orderkey", "o_totalprice")
    return x.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")


@query("""with a as (select distinct l_returnflag as sample from lineitem where l_linestatus = 'O'), b as (select distinct l_returnflag as sample from lineitem where l_linestatus = 'F')
select sample, 'both' as side from a where sample in (select sample from b) union all select sample, 'a' from a where sample not in (select sample from b) union all select sample, 'b' from b where sample not in (select sample from a)""")
def sample_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intersection and both differences of two sets of names."""
    l = table(spark, sf_dir, "lineitem")
    a, b = (l.where(F.col("l_linestatus") == s).select(F.col("l_returnflag").alias("sample")).distinct() for s in "OF")
    return a.intersect(b).withColumn("side", F.lit("both")).union(a.subtract(b).withColumn("side", F.lit("a"))).union(b.subtract(a).withColumn("side", F.lit("b")))


@query("""select p_partkey, greatest(b_start, 500) as clip_start, least(b_end, 1500) as clip_end,
 case when b_start >= 500 and b_end <= 1500 then 'complete' when b_start < 500 and b_end > 1500 then 'span' when b_start < 500 then 'left' else 'right' end as shown
 from (select p_partkey, p_partkey as b_start, p_partkey + p_size * 20 as b_end from part) where b_start < 1500 and b_end > 500""")
def window_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of a view, clipped."""
    f = table(spark, sf_dir, "part").select("p_partkey", F.col("p_partkey").alias("start"), (F.col("p_partkey") + F.col("p_size") * 20).alias("end"))
    return intervals.window_view(f, 500, 1500).select("p_partkey", "clip_start", "clip_end", "shown")


@query("""with r as (select p_partkey, p_partkey % 1000 as s, p_partkey % 1000 + p_size as e from part) select p_partkey from r where (s < 30 and e > 0) or (s < 1000 and e > 985)""")
def circular_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads that touch a range across the end of a circular chromosome."""
    r = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % 1000).alias("start0"), (F.col("p_partkey") % 1000 + F.col("p_size")).alias("end0"))
    return intervals.circular_reads(r, 1000, 5, 10, 20).select("p_partkey")


@query(f"""with h as (select {_H} as x, count(*) as total from events group by 1) select b.x, coalesce(total, 0) as total from (select unnest(generate_series(473400, 473499, 3)) as x) b left join h using (x)""")
def plot_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled values of a view, zero where there are none."""
    h = table(spark, sf_dir, "events").groupBy(hours().alias("at")).agg(F.count("*").alias("total"))
    return signal.plot_values(h, 473400, 473500, 3).withColumnRenamed("at", "x")


@query("""with r as (select n_nationkey % 5 as k, s_suppkey * 997 as start, s_suppkey * 997 + 100 + s_suppkey % 7 * 2000 as stop from supplier join nation on s_nationkey = n_nationkey),
g as (select *, case when start - max(stop) over (partition by k order by start, stop rows between unbounded preceding and 1 preceding) < 4000 then 0 else 1 end as new from r),
m as (select k, greatest(0, min(start) - 500) as s, max(stop) + 500 as e from (select *, sum(new) over (partition by k order by start, stop rows unbounded preceding) as i from g) group by k, i),
p as (select *, cast(ceil((e - s) / 20000.0) as bigint) as n from m), x as (select *, unnest(generate_series(0, n - 1)) as piece from p)
select k, piece, cast(floor(s + piece * ((e - s) / n::double)) as bigint) - case when piece > 0 then 100 else 0 end as start, cast(floor(s + (piece + 1) * ((e - s) / n::double)) as bigint) as stop from x""")
def assembly_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions joined over gaps, padded and cut into overlapping pieces."""
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    k = F.col("s_suppkey")
    r = s.select((F.col("n_nationkey") % 5).alias("k"), (k * 997).alias("start"), (k * 997 + 100 + k % 7 * 2000).alias("end"))
    return islands.assembly_regions(r, ["k"], 4000).select("k", F.col("piece").cast("bigint").alias("piece"), "start", "end")


@query("""with g as (select p_brand, p_partkey, row_number() over (order by p_retailprice, p_partkey) as rank from part where p_size < 10),
x as (select *, rank - lag(rank) over (partition by p_brand order by rank) as a, lead(rank) over (partition by p_brand order by rank) - rank as b from g)
select p_brand, p_partkey, rank, least(coalesce(a, 4), coalesce(b, 4)) as gap from x where least(coalesce(a, 4), coalesce(b, 4)) <= 3""")
def tandem_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of a group within three ranks of another."""
    return _tandem_groups(table(spark, sf_dir, "part").where("p_size < 10"))


@query()
def tandem_groups_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W15, W16 over all parts."""
    return _tandem_groups(table(spark, sf_dir, "part"))


def _tandem_groups(p: DataFrame) -> DataFrame:
    f = p.select(F.lit("c").alias("chrom"), F.col("p_partkey").alias("locus"), F.col("p_retailprice").alias("start0"), F.col("p_partkey").alias("end0"))
    out = repeats.tandem(f, p.select(F.col("p_partkey").alias("node"), F.col("p_brand").alias("component")))
    return out.select(F.col("component").alias("p_brand"), F.col("locus").alias("p_partkey"), F.col("rank").cast("bigint").alias("rank"), F.col("gap").cast("bigint").alias("gap"))


@query("""with c as (select distinct l_returnflag as sample, l_partkey as pos, l_linestatus as alt from lineitem where l_quantity > 48), d as (select distinct l_returnflag as sample, l_partkey as pos, l_linestatus as alt from lineitem where l_quantity < 6),
v as (select distinct l_returnflag as sample, l_partkey as pos from lineitem where l_quantity between 10 and 15), f as (select sample, pos, list(alt) as alts from d group by 1, 2)
select c.sample, c.pos, c.alt, case when alts is not null and len(alts) > 1 then 'ambiguous' when list_contains(alts, alt) then 'corroborated' when alts is not null or v.pos is not null then 'negative' else 'absent' end as status
from c left join f on c.sample = f.sample and c.pos = f.pos left join v on c.sample = v.sample and c.pos = v.pos""")
def corroborated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls against another method's."""
    l = table(spark, sf_dir, "lineitem")
    cols = [F.col("l_returnflag").alias("sample"), F.lit("c").alias("chrom"), F.col("l_partkey").alias("pos1")]
    take = lambda cond: l.where(cond).select(*cols, F.col("l_linestatus").alias("alt")).distinct()
    out = variants.corroborate(take("l_quantity > 48"), take("l_quantity < 6"), take("l_quantity between 10 and 15"))
    return out.select("sample", F.col("pos1").alias("pos"), "alt", "status")


@query(f"""with d as (select item_id, {_DNA_SQL} as seq from benchmark), x as (select item_id, substr(seq, 1, cast(item_id % 3 + 1 as bigint)) as ref, substr(seq, 1, cast(item_id % 2 + 1 as bigint)) as alt from d where length(seq) > 4)
select item_id, case when s then item_id + 1 else item_id end as pos, case when not s then ref when length(ref) > 1 then substr(ref, 2) else '-' end as ref_, case when not s then alt when length(alt) > 1 then substr(alt, 2) else '-' end as alt_
from (select *, (length(ref) > 1 or length(alt) > 1) and substr(ref, 1, 1) = substr(alt, 1, 1) as s from x)""")
def indel_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """indels without their shared first base."""
    x = _dna(spark, sf_dir).where(F.length("seq") > 4)
    x = x.select("item_id", F.expr("substring(seq, 1, cast(item_id % 3 + 1 as int))").alias("ref"), F.expr("substring(seq, 1, cast(item_id % 2 + 1 as int))").alias("alt"))
    x = x.select("item_id", fs.normalise_indel(F.col("item_id"), F.col("ref"), F.col("alt")).alias("n"))
    return x.select("item_id", F.col("n.pos1").alias("pos"), F.col("n.ref").alias("ref_"), F.col("n.alt").alias("alt_"))


@query(f"""with d as (select item_id, {_DNA_SQL} as seq from benchmark), t as (select item_id, col, substr(seq, col, 1) as ch from (select *, unnest(generate_series(1, 40)) as col from d where length(seq) >= 40 and item_id < 5)),
o as (select col, ch as og from t where item_id = 0), v as (select t.item_id, t.col from t join o using (col) where t.item_id > 0 and ch <> og),
c as (select unnest(['AB', 'CD', 'ABCD', 'A', 'B', 'C', 'D']) as node, unnest(['ABCD', 'ABCD', null, 'AB', 'AB', 'CD', 'CD']) as parent),
f as (select node, parent, col from v join c on contains(node, substr('ABCD', cast(item_id as bigint), 1)) group by 1, 2, 3 having count(*) = length(node)),
top as (select col, node from f where not exists (select 1 from f g where g.node = f.parent and g.col = f.col))
select cast(col as integer) as col, node, count(*) over (partition by col) as n_clades from top""")
def homoplasies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest clades that differ from the outgroup whole, for each column."""
    d = _dna(spark, sf_dir).where("length(seq) >= 40 and item_id < 5")
    m = d.select(F.element_at(F.array(*map(F.lit, "OABCD")), (F.col("item_id") + 1).cast("int")).alias("sample"), F.posexplode(F.split(F.substring("seq", 1, 40), "")).alias("p", "ch"))
    m = m.where("ch <> ''").select("sample", (F.col("p") + 1).alias("col"), "ch")
    clades = spark.createDataFrame([(n, p, list(n)) for n, p in (("AB", "ABCD"), ("CD", "ABCD"), ("ABCD", None), ("A", "AB"), ("B", "AB"), ("C", "CD"), ("D", "CD"))], "node string, parent string, tips array<string>")
    return msa.derived_clades(m, clades, "O").select("col", "node", "n_clades")


@query()
def homoplasies_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A15 over all columns of all rows: the first row by id is the outgroup, the others are the tips of a balanced tree in order of id."""
    d = _dna(spark, sf_dir).where("item_id is not null").groupBy("item_id").agg(F.min("seq").alias("seq"))
    m = d.select(F.col("item_id").cast("string").alias("sample"), F.posexplode(F.split("seq", "")).alias("p", "ch")).where("ch <> ''")
    first, *tips = [str(r.item_id) for r in d.select("item_id").orderBy("item_id").collect()] or [""]  # a tree is small
    clades, size = [], 1
    while tips and size < 2 * len(tips):
        parent = lambda i, up=2 * size: f"{up}:{i // up}" if up < 2 * len(tips) else None
        clades += [(f"{size}:{i // size}", parent(i), tips[i : i + size]) for i in range(0, len(tips), size)]
        size *= 2
    tree = spark.createDataFrame(clades, "node string, parent string, tips array<string>")
    return msa.derived_clades(m.select("sample", (F.col("p") + 1).alias("col"), "ch"), tree, first).select("col", "node", "n_clades")
