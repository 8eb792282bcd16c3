"""More operators over the driver tables with the SQL that gives the same rows; each query calls the library's operator.

As in ``driver_queries`` a driver table takes the role of a genomic one: a part number is a position, a remainder of the supplier a sample.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.functions import sequence as fs
from strandlake.operators import intervals, linkage, msa, repeats, signal, tree, variants
from strandlake.plans.driver_queries import _DNA_SQL, _dna, query
from strandlake.runtime import table
from strandlake.sources import sinks

_READS = """reads as (
  select 's' || l_suppkey % 5 as sample, 'c' as chrom, l_orderkey as qname, l_linenumber as line, l_partkey as start0, l_partkey + cast(l_quantity as bigint) as end0,
    l_linestatus = 'O' as is_proper, l_returnflag = 'R' as is_dup, l_linenumber % 2 = 1 as is_read1, l_linenumber * 10 as mapq from lineitem)"""


def _sample() -> Column:
    return F.concat(F.lit("s"), F.col("l_suppkey") % 5)


def _reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    no = F.lit(False)
    return table(spark, sf_dir, "lineitem").select(
        _sample().alias("sample"), F.lit("c").alias("chrom"), F.col("l_orderkey").alias("qname"), F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("start0"), (F.col("l_partkey") + F.col("l_quantity").cast("bigint")).alias("end0"), (F.col("l_linestatus") == "O").alias("is_proper"),
        (F.col("l_returnflag") == "R").alias("is_dup"), (F.col("l_linenumber") % 2 == 1).alias("is_read1"), (F.col("l_linenumber") * 10).alias("mapq"),
        no.alias("is_qcfail"), no.alias("is_secondary"), no.alias("is_unmapped"), (F.col("l_linestatus") == "F").alias("is_reverse"),
        F.array(F.col("l_quantity").cast("int")).alias("qual"), F.lit("").alias("seq"),
    )


@query(f"""with {_READS}, b as (select sample, chrom, is_proper, unnest(generate_series(cast(ceil(start0 / 10.0) as bigint), (end0 - 1) // 10)) as bin from reads where not is_dup and mapq >= 30)
select sample, chrom, bin, count(*) as total, count(*) filter (is_proper) as proper from b group by sample, chrom, bin""")
def depth_by_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads that cover each tenth position, usable ones only."""
    return signal.depth(_reads(spark, sf_dir), 10, 30)


@query(f"""with {_READS} select sample, qname, cast(count(*) as bigint) as mates from reads where mapq <= 10 group by sample, qname""")
def poorly_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments with mates that map badly."""
    return signal.poorly_mapped(_reads(spark, sf_dir), 10).select("sample", "qname", F.size("mates").cast("bigint").alias("mates"))


@query(f"""with {_READS}, ends as (
  select sample, qname, list_sort(list([case when is_proper then start0 else end0 end, case when is_proper then 0 else 1 end])) as place, sum(case when end0 - start0 >= 15 then end0 - start0 else 0 end) as q from reads group by sample, qname),
r as (select sample, qname, row_number() over (partition by sample, place order by q desc, qname) > 1 as dup from ends)
select sample, count(*) as fragments, count(*) filter (dup) as duplicates from r group by sample""")
def duplicate_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate marking by place and orientation: the fragment of the highest quality stays."""
    marked = signal.mark_duplicates(_reads(spark, sf_dir)).groupBy("sample", "qname").agg(F.bool_or("is_dup").alias("dup"))
    return marked.groupBy("sample").agg(F.count("*").alias("fragments"), F.count_if("dup").alias("duplicates"))


_SEEN = """seen as (select 's' || l_suppkey % 5 as sample, 'c' as chrom, l_orderkey as qname, l_partkey % 9 as pos1, l_linenumber * 20 as mapq, case when l_returnflag = 'A' then 'alt' when l_returnflag = 'R' then 'ref' else 'low' end as allele from lineitem)"""


def _seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    allele = F.when(F.col("l_returnflag") == "A", "alt").when(F.col("l_returnflag") == "R", "ref").otherwise("low")
    return table(spark, sf_dir, "lineitem").select(
        _sample().alias("sample"), F.lit("c").alias("chrom"), F.col("l_orderkey").alias("qname"), (F.col("l_partkey") % 9).alias("pos1"),
        (F.col("l_linenumber") * 20).alias("mapq"), allele.alias("allele"),
    )


@query(f"""with {_SEEN}, p as (select sample, chrom, qname, min(mapq) as mapq, count(distinct case when allele <> 'low' then pos1 end) as clear, count(distinct case when allele = 'alt' then pos1 end) as alt from seen group by all)
select sample, chrom, case when mapq < 60 then 'low_quality' when clear < 2 then 'too_noisy' when alt = 0 then 'none' when alt = 1 then 'one' else 'linked' end as class, count(*) as n from p group by all""")
def fragment_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments by what they show, within samples."""
    return linkage.fragment_classes(_seen(spark, sf_dir))


@query(f"""with {_SEEN}, one as (select sample, chrom, qname, pos1, min(allele) as a from seen where allele <> 'low' group by all having min(allele) = max(allele))
select sample, chrom, x.pos1 as pos_a, y.pos1 as pos_b, count(*) as spanning, count(*) filter (x.a = 'alt' and y.a = 'alt') as n_both, count(*) filter (x.a = 'alt' and y.a = 'ref') as first_only,
  count(*) filter (x.a = 'ref' and y.a = 'alt') as second_only, count(*) filter (x.a = 'ref' and y.a = 'ref') as neither
from one x join one y using (sample, chrom, qname) where x.pos1 < y.pos1 group by all having count(*) >= 2""")
def linked_pairs_by_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alleles of two loci on the fragments of one sample and chromosome."""
    return linkage.linkage_table(_seen(spark, sf_dir), min_depth=2).withColumnRenamed("both", "n_both")


@query(f"""with {_SEEN}, c as (select sample, chrom, pos1, count(distinct case when allele = 'alt' then qname end) as alt_reads, count(distinct qname) as reads from seen where allele <> 'low' group by all)
select sample, chrom, pos1, 20 as called, cast(floor(40.0 * alt_reads / reads + 0.5) as integer) as counted from c""")
def allele_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: called against counted frequencies of a pooled sample, as parts of forty."""
    counted = linkage.counted_alleles(_seen(spark, sf_dir))
    pooled = counted.select("sample", "chrom", "pos1", F.array(F.lit(0), F.lit(1)).alias("gt"))
    return linkage.allele_frequencies(pooled, counted)


_FEATURES = """feats as (select 'c' as chrom, cast(s_suppkey as varchar) as locus, s_suppkey * 30 as start0, s_suppkey * 30 + 30 + s_suppkey % 3 * 12 as end0, case when s_suppkey % 2 = 0 then -1 else 1 end as strand from supplier),
calls as (select distinct 'c' as chrom, l_partkey as pos1, 'C' as ref, 'T' as alt from lineitem)"""


@query(f"""with {_FEATURES}, hits as (select pos1, count(*) as n, string_agg(locus, ',' order by locus) as loci, min(start0) as start0, min(end0) as end0, min(strand) as strand from calls join feats using (chrom) where start0 < pos1 and pos1 < end0 group by pos1)
select pos1, coalesce(loci, '') as gene_id, case when n = 1 then strand end as strand, case when n > 1 then 'multi' when n = 1 then case when strand = 1 then 'CCC' else 'GGG' end else '' end as ref_codon,
  case when n > 1 then 'multi' when n is null then '' when strand = 1 then ['TCC', 'CTC', 'CCT'][(pos1 - 1 - start0) % 3 + 1] else ['AGG', 'GAG', 'GGA'][(end0 - pos1) % 3 + 1] end as var_codon,
  case when n = 1 then cast(case when strand = 1 then (pos1 - 1 - start0) % 3 else (end0 - pos1) % 3 end + 1 as bigint) end as codon_pos
from calls left join hits using (pos1)""")
def annotate_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature that holds a call, its end left out, and the change of its codon."""
    k = F.col("s_suppkey")
    feats = table(spark, sf_dir, "supplier").select(
        F.lit("c").alias("chrom"), k.cast("string").alias("locus"), F.lit("").alias("gene"), (k * 30).cast("int").alias("start0"), (k * 30 + 30 + k % 3 * 12).cast("int").alias("end0"),
        F.when(k % 2 == 0, -1).otherwise(1).alias("strand"),
    ).withColumn("orf", F.repeat(F.lit("C"), F.col("end0") - F.col("start0")))
    calls = table(spark, sf_dir, "lineitem").select(F.lit("c").alias("chrom"), F.col("l_partkey").alias("pos1"), F.lit("C").alias("ref"), F.lit("T").alias("alt")).distinct()
    return variants.annotate_open(calls, feats, 64).select("pos1", "gene_id", "strand", "ref_codon", "var_codon", F.col("codon_pos").cast("bigint").alias("codon_pos"))


_MARKED = """calls as (select distinct 's' || l_suppkey % 5 as sample, 'c' as chrom, l_partkey as pos1, 'C' as ref, l_linestatus as alt, l_discount >= 0.08 as f1, l_tax >= 0.06 as f2 from lineitem)"""


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = F.filter(F.array(F.when(F.col("l_discount") >= 0.08, F.lit("discount")), F.when(F.col("l_tax") >= 0.06, F.lit("tax"))), lambda x: x.isNotNull())
    return table(spark, sf_dir, "lineitem").select(
        _sample().alias("sample"), F.lit("c").alias("chrom"), F.col("l_partkey").alias("pos1"), F.lit("C").alias("ref"), F.col("l_linestatus").alias("alt"), flags.alias("filters")
    ).distinct()


@query(f"""with {_MARKED}, feats as (select cast(s_suppkey as varchar) as locus, s_suppkey * 10 as a, s_suppkey * 10 + s_suppkey % 17 + 5 as z from supplier),
named as (select pos1, string_agg(locus, ',' order by locus) as cds from (select distinct pos1 from calls) join feats on a < pos1 and pos1 <= z group by pos1)
select sample, pos1 as position, coalesce(cds, '') as cds, ref as reference, alt as variant, mark from (select *, unnest(case when f1 and f2 then ['discount', 'tax'] when f1 then ['discount'] else ['tax'] end) as mark from calls where f1 or f2) left join named using (pos1)""")
def filtered_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: calls that filters mask, with the features that hold them."""
    k = F.col("s_suppkey")
    feats = table(spark, sf_dir, "supplier").select(F.lit("c").alias("chrom"), k.cast("string").alias("locus"), F.lit("").alias("gene"), (k * 10).alias("start0"), (k * 10 + k % 17 + 5).alias("end0"))
    return variants.filtered_report(_marked(spark, sf_dir), ["discount", "tax"], feats).withColumnsRenamed({"CDS": "cds", "filter": "mark"})


@query(f"""with {_MARKED}, f as (select pos1, alt, count(distinct sample) as frequency from calls group by all),
marks as (select calls.*, unnest(case when not (f1 or f2) then ['retained'] when f1 and f2 then ['discount', 'tax'] when f1 then ['discount'] else ['tax'] end) as mark from calls join f using (pos1, alt) where frequency < 5)
select pos1 as position, ref as reference, alt as variant, count(distinct sample) as frequency, 'rows' as sample_group, mark from marks group by pos1, ref, alt, mark""")
def grouped_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alleles that differ among samples, with the filters that mask them."""
    out = variants.grouped_list(_marked(spark, sf_dir), ["discount", "tax"], 5, "rows")["among"]
    return out.withColumnsRenamed({"Position": "position", "Reference": "reference", "Variant": "variant", "Frequency": "frequency", "Sample Group": "sample_group", "Filter": "mark"})


@query(f"""with {_MARKED} select sample, pos1, alt from calls where not (f1 or f2) and sample in ('s0', 's1', 's2') and sample <> 's1'""")
def chosen_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls without filters of samples that are asked for."""
    own = variants.choose_samples(variants.keep_unfiltered(_marked(spark, sf_dir), ["discount", "tax"]), ["s0", "s1", "s2"], ["s1"])
    return own.select("sample", "pos1", "alt")


@query("""with r as (select p_brand, p_partkey as a, p_partkey + p_size as z from part), n as (select p_brand, count(*) as n from r group by 1), x as (select distinct p_brand, unnest(generate_series(a, z - 1)) as x from r)
select p_brand, n, bp from n join (select p_brand, count(*) as bp from x group by 1) using (p_brand)""")
def region_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of ranges and positions that they cover."""
    return intervals.totals(table(spark, sf_dir, "part").select("p_brand", F.col("p_partkey").alias("start"), (F.col("p_partkey") + F.col("p_size")).alias("end")), ["p_brand"])


@query("""with t as (select cast(c_custkey as bigint) as pos1, 's' || c_nationkey % 5 as sample, min(substr(c_mktsegment, 1, 1)) as alt from customer where c_acctbal < 0 group by all),
grid as (select p_partkey as pos1, sample from part cross join (select distinct sample from t)),
gap as (select distinct g.pos1, g.sample from grid g join supplier on 's' || s_nationkey % 5 = g.sample and s_suppkey * 7 < g.pos1 and g.pos1 <= s_suppkey * 7 + s_suppkey % 11)
select pos1, count(*) as samples from gap anti join t using (pos1, sample) group by pos1""")
def alignment_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of an alignment from variants and gaps at all sites, and the samples with a gap in each."""
    sample = lambda c: F.concat(F.lit("s"), F.col(c) % 5)
    snps = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(sample("c_nationkey").alias("sample"), F.lit("c").alias("chrom"), F.col("c_custkey").alias("pos1"), F.substring("c_mktsegment", 1, 1).alias("alt"))
    reference = table(spark, sf_dir, "part").select(F.lit("c").alias("chrom"), F.col("p_partkey").alias("pos1"), F.lit("r").alias("ch"))
    k = F.col("s_suppkey")
    gaps = table(spark, sf_dir, "supplier").select(sample("s_nationkey").alias("sample"), F.lit("c").alias("chrom"), (k * 7).alias("start"), (k * 7 + k % 11).alias("end"))
    cells = msa.columns(snps, snps.select("sample"), reference, gaps, all_sites=True, width=64)
    return msa.gap_counts(cells).select("pos1", "samples")


_TREE = """edges as (select 1000000 + r_regionkey as node, 0 as parent, r_name as label from region union all select 2000000 + n_nationkey, 1000000 + n_regionkey, n_name from nation
union all select 3000000 + c_custkey, 2000000 + c_nationkey, 'c' || c_custkey from customer)"""


def _tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = lambda name, node, parent, label: table(spark, sf_dir, name).select(node.alias("node"), parent.alias("parent"), label.alias("label"), F.lit(0.5).alias("edge_length"))
    root = spark.range(1).select(F.lit(0).cast("bigint").alias("node"), F.lit(None).cast("bigint").alias("parent"), F.lit("").alias("label"), F.lit(None).cast("double").alias("edge_length"))
    regions = row("region", F.col("r_regionkey").cast("bigint") + 1_000_000, F.lit(0).cast("bigint"), F.col("r_name"))
    nations = row("nation", F.col("n_nationkey").cast("bigint") + 2_000_000, F.col("n_regionkey").cast("bigint") + 1_000_000, F.col("n_name"))
    return root.union(regions).union(nations).union(row("customer", F.col("c_custkey").cast("bigint") + 3_000_000, F.col("c_nationkey").cast("bigint") + 2_000_000, F.concat(F.lit("c"), "c_custkey")))


@query(f"with recursive {_TREE}, t as (select 0 as node, 0 as depth union all select e.node, depth + 1 from edges e join t on e.parent = t.node) select cast(node as bigint) as node, depth, depth * 0.5::double as distance from t")
def tree_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels and distances below the root of every node."""
    return tree.depths(_tree(spark, sf_dir))


@query(f"""with {_TREE}, tips as (select label as name from edges where node not in (select parent from edges)), own as (select distinct 'c' || o_custkey * 2 as name from orders where o_orderstatus = 'F')
select name, 'alignment' as only_in from own where name not in (select name from tips) union all select name, 'tree' from tips where name not in (select name from own)""")
def tips_differ(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in an alignment or a tree only."""
    own = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.concat(F.lit("c"), F.col("o_custkey") * 2).alias("sample"))
    return msa.tips_differ(own, _tree(spark, sf_dir))


@query("select distinct c_nationkey as sample from customer where c_nationkey not in (select s_nationkey from supplier where s_acctbal > 5000)")
def missing_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples with calls but no alignment."""
    calls = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("sample"))
    return variants.missing_samples(calls, table(spark, sf_dir, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("sample")))


@query("select distinct l_partkey, l_suppkey from lineitem where l_linestatus = 'O' and (l_partkey, l_suppkey) not in (select l_partkey, l_suppkey from lineitem where l_linestatus = 'F')")
def positions_only_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of one table that another lacks."""
    l = table(spark, sf_dir, "lineitem")
    return variants.positions_only_in(l.where("l_linestatus = 'O'"), l.where("l_linestatus = 'F'"), ["l_partkey", "l_suppkey"])


_FILES = "files as (select 'b' || o_custkey % 200 as base, 'f' || o_orderkey || case when o_orderstatus = 'F' then '__F_a' else '' end || case when o_orderpriority like '1%' then '__F_b' else '' end as path from orders)"


@query(f"with {_FILES} select base, path from files qualify row_number() over (partition by base order by len(path) - len(replace(path, '__F_', '')) desc, path) = 1")
def most_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each base name the file with most filters."""
    tag = lambda cond, t: F.when(cond, t).otherwise("")
    path = F.concat(F.lit("f"), "o_orderkey", tag(F.col("o_orderstatus") == "F", "__F_a"), tag(F.col("o_orderpriority").startswith("1"), "__F_b"))
    return variants.most_filtered(table(spark, sf_dir, "orders").select(F.concat(F.lit("b"), F.col("o_custkey") % 200).alias("base"), path.alias("path"))).select("base", "path")


@query("""with f as (select o_orderkey as id, o_custkey as a, o_orderkey % 1000 as b from orders), z as (select s_suppkey * 10 as s, s_suppkey * 10 + s_suppkey % 4 as e from supplier where s_suppkey % 4 > 0)
select id, a as a_start, a + 5 as a_end, b as b_start, b + 8 as b_end from f where exists (select 1 from z where a < e and s < a + 5) and exists (select 1 from z where b < e and s < b + 8)""")
def both_sides_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of ranges both of which touch a final one."""
    c, o, k = F.col("o_custkey"), F.col("o_orderkey"), F.col("s_suppkey")
    pairs = table(spark, sf_dir, "orders").select(o.alias("id"), F.lit("c").alias("chrom"), c.alias("a_start"), (c + 5).alias("a_end"), (o % 1000).alias("b_start"), (o % 1000 + 8).alias("b_end"))
    final = table(spark, sf_dir, "supplier").select(F.lit("c").alias("chrom"), (k * 10).alias("start"), (k * 10 + k % 4).alias("end"))
    return repeats.both_sides_final(pairs, final, 64).drop("chrom")


_HITS = """feats as (select cast(p_partkey as varchar) as locus, row_number() over (order by p_partkey, p_partkey + p_size, cast(p_partkey as varchar)) as rank from part),
hits as (select distinct cast(l_partkey as varchar) as query, cast(l_suppkey as varchar) as hit from lineitem where l_partkey <> l_suppkey)"""


def _hits(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p = table(spark, sf_dir, "part")
    feats = p.select(F.lit("c").alias("chrom"), F.col("p_partkey").cast("string").alias("locus"), F.col("p_partkey").alias("start0"), (F.col("p_partkey") + F.col("p_size")).alias("end0"))
    hits = table(spark, sf_dir, "lineitem").where("l_partkey <> l_suppkey").select(F.col("l_partkey").cast("string").alias("query"), F.col("l_suppkey").cast("string").alias("hit")).distinct()
    return feats, hits


@query(f"""with {_HITS}, e as (select h.*, q.rank as qr, t.rank as hr from hits h join feats q on q.locus = query join feats t on t.locus = hit),
n as (select e.query, e.hit, o.query as near_query, o.hit as near_hit, s.step, e.hr - o.hr as d from e cross join (select unnest([-2, -1, 1, 2]) as step) s join e o on o.qr = e.qr + s.step where abs(e.hr - o.hr) < 3 and e.hr <> o.hr)
select query, hit, near_query, near_hit, step from n qualify row_number() over (partition by query, hit, sign(step) order by abs(step), abs(d), near_query, near_hit) = 1""")
def adjacent_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest hit pair on each side of a hit pair."""
    return repeats.adjacent_hits(*_hits(spark, sf_dir))


@query(f"""with {_HITS}, x as (select h.query, f.locus, len(h.query) * 9 + 1 as aligned, cast(h.hit as bigint) as hs, cast(h.hit as bigint) + 12 as he, p_partkey as fs, p_partkey + p_size as fe, 10 as ql
  from hits h join part on p_partkey < cast(h.hit as bigint) + 12 and cast(h.hit as bigint) < p_partkey + p_size join feats f on f.locus = cast(p_partkey as varchar))
select distinct query, locus as hit from x where aligned * (least(he, fe) - greatest(hs, fs)) / 12.0 > 0.5 * (fe - fs) and aligned * (least(he, fe) - greatest(hs, fs)) / 12.0 > 5 and query <> locus""")
def double_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits that cover most of another feature and of the query."""
    feats, hits = _hits(spark, sf_dir)
    at = F.col("hit").cast("bigint")
    h = hits.select("query", F.lit(10).alias("query_length"), F.lit("c").alias("chrom"), at.alias("start0"), (at + 12).alias("end0"), (F.length("query") * 9 + 1).alias("aligned"))
    return repeats.double_hits(h, feats, 0.5, 64)


@query("""with h as (select o_orderkey % 100 as a, o_orderkey % 100 + 20 as b, o_custkey % 100 as c, o_custkey % 100 + 20 as d from orders), x as (select * from h where not (a = c and b = d)),
parts as (select case when a < d and c < b then [[a, least(b, c)], [greatest(a, d), b], [c, least(d, a)], [greatest(c, b), d]] else [[a, b], [c, d]] end as p from x)
select r[1] as start, r[2] as stop, count(*) as n from (select unnest(p) as r from parts) where r[1] < r[2] group by 1, 2""")
def self_overlap_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sides of hits of a genome with itself, without what they share."""
    a, c = F.col("o_orderkey") % 100, F.col("o_custkey") % 100
    hits = table(spark, sf_dir, "orders").select(F.lit("c").alias("chrom"), a.alias("a_start"), (a + 20).alias("a_end"), c.alias("b_start"), (c + 20).alias("b_end"))
    return repeats.self_overlap_removed(hits).groupBy("start", "end").agg(F.count("*").alias("n"))


@query("""with b as (select distinct l_returnflag as k, l_partkey // 20 as b from lineitem where l_discount >= 0.1), i as (select k, b, b - row_number() over (partition by k order by b) as g from b)
select k, min(b) * 20 as start, max(b) * 20 + 20 as stop from i group by k, g having count(*) * 20 > 40""")
def ambiguous_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled identities over a threshold as ranges, long ones."""
    pids = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("k"), F.col("l_partkey").alias("pos0"), F.col("l_discount").alias("pid"))
    return repeats.ambiguous_regions(pids, ["k"], 0.1, 20, 40)


@query(f"""with d as (select item_id, {_DNA_SQL} as seq from benchmark), a as (select item_id, replace(seq, 'T', '-') as a, seq as b, least(length(seq), length(seq)) as n from d),
w as (select *, unnest(generate_series(0, n - 101, 20)) as i from a where n > 100)
select item_id as grp, cast(case when item_id % 2 = 0 then 1000 + length(replace(substr(a, 1, cast(i + 50 as bigint)), '-', '')) else 4999 - length(replace(substr(a, 1, cast(i + 50 as bigint)), '-', '')) end as bigint) as pos0,
  length(replace(substr(a, cast(i + 1 as bigint), 100), '-', '')) as same from w""")
def chromosome_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of an alignment at their places on the chromosome, by strand."""
    x = _dna(spark, sf_dir).select(F.col("item_id").alias("group"), F.replace("seq", F.lit("T"), F.lit("-")).alias("a_seq"), F.col("seq").alias("b_seq"))
    x = x.withColumns({"start": F.lit(1000), "end": F.lit(5000), "strand": F.when(F.col("group") % 2 == 0, 1).otherwise(-1), "pid": fs.window_identity(F.col("a_seq"), F.col("b_seq"))})
    placed = repeats.chromosome_places(x, "a", "start", "end", "strand")
    return placed.select(F.col("group").alias("grp"), F.col("pos0").cast("bigint").alias("pos0"), F.round(F.col("pid") * 100).cast("bigint").alias("same"))


@query("""with s as (select l_suppkey as contig, l_linestatus as strand, sum(l_linenumber) as total, max(l_linenumber) as best from lineitem group by all)
select contig, strand, best from s where true qualify row_number() over (partition by contig order by total desc, best desc, strand desc) = 1 and best >= 7""")
def best_strand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strand on which a contig aligns best."""
    return msa.best_strand(table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("contig"), F.col("l_linestatus").alias("strand"), F.col("l_linenumber").alias("pid")), 7)


@query("""select p_brand as contig, min(p_partkey) as start, max(p_partkey + p_size) as stop, sum(p_size) as aligned, coalesce(n, 0) as variants
from part left join (select p_brand as b, count(*) as n from lineitem join part on p_partkey = l_partkey where l_discount > 0.09 group by 1) on b = p_brand group by p_brand, n""")
def contig_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned range and length of a contig, and its variants."""
    p = table(spark, sf_dir, "part")
    v = table(spark, sf_dir, "lineitem").where("l_discount > 0.09").join(p, F.col("p_partkey") == F.col("l_partkey")).select(F.col("p_brand").alias("contig"))
    return msa.contig_summary(v, p.select(F.col("p_brand").alias("contig"), F.col("p_partkey").alias("start"), (F.col("p_partkey") + F.col("p_size")).alias("end")))


@query("""with m as (select 's' || c_nationkey as sample, c_custkey % 97 as col, min(substr(c_mktsegment, 1, 1)) as ch from customer group by all),
i as (select n_regionkey as node, n_regionkey * 15 + 3 as beg, n_regionkey * 15 + 30 as "end", 's' || n_nationkey as sample from nation)
select node, beg, "end" as stop, col, col * 3 as pos1, string_agg(sample, ',' order by sample) as samples from m join i using (sample) where ch <> 'B' and beg <= col and col <= "end" group by all""")
def import_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples below a node that differ within its imports, at their places."""
    sample = lambda c: F.concat(F.lit("s"), F.col(c))
    m = table(spark, sf_dir, "customer").groupBy(sample("c_nationkey").alias("sample"), (F.col("c_custkey") % 97).alias("col")).agg(F.min(F.substring("c_mktsegment", 1, 1)).alias("ch"))
    n = table(spark, sf_dir, "nation")
    k = F.col("n_regionkey")
    imports = n.select(k.alias("node"), (k * 15 + 3).alias("beg"), (k * 15 + 30).alias("end")).distinct()
    clades = n.groupBy(k.alias("node")).agg(F.collect_set(sample("n_nationkey")).alias("tips"))
    cols = spark.range(97).select(F.col("id").alias("col"))
    got = msa.import_variants(m, cols.withColumn("ch", F.lit("B")), imports, clades, cols.withColumn("pos1", F.col("col") * 3))
    return got.select("node", "beg", "end", "col", "pos1", F.array_join("samples", ",").alias("samples"))


@query("select c_custkey, regexp_replace(c_name, '[^A-Za-z0-9.\\-_]', '_', 'g') as safe, regexp_replace('x/' || c_mktsegment || '.fq.gz', '\\.fq\\.gz$', '_sub.fq.gz') as path, cast(round((c_custkey - 600) / 1000.0) * 1000 as bigint) as view_start from customer where (c_custkey + 400) % 1000 <> 500")
def names_and_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Safe names, suffixes of files, and views around a place."""
    c = table(spark, sf_dir, "customer").where("(c_custkey + 400) % 1000 <> 500")
    path = F.concat(F.lit("x/"), "c_mktsegment", F.lit(".fq.gz"))
    view, _ = signal.plot_range(F.col("c_custkey"), F.col("c_custkey") + 10)
    return c.select("c_custkey", sinks.safe_name(F.col("c_name")).alias("safe"), sinks.with_suffix(path, "_sub").alias("path"), view.cast("bigint").alias("view_start"))
