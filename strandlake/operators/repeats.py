"""Repeats within a genome: homologous features, contiguous blocks, tandem groups, seeds and ambiguous ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandlake.functions.sequence import global_align, reverse_complement, window_identity
from strandlake.operators.graph import connected_components
from strandlake.operators.intervals import merge_ranges, overlap_join, points_in_ranges
from strandlake.operators.islands import binned_ambiguous
from strandlake.runtime import cut


def ranked(features: DataFrame) -> DataFrame:
    """Features with their place by start and end on each chromosome."""
    return features.withColumn("rank", F.row_number().over(W.partitionBy("chrom").orderBy("start0", "end0", "locus")))


def double_hits(hits: DataFrame, features: DataFrame, least: float = 0.5, width: int = 10_000) -> DataFrame:
    """``query, hit``: hits of a feature's sequence that cover more than ``least`` of another feature and of their own.

    ``hits``: ``query, query_length, chrom, start0, end0, aligned`` with the aligned positions of the hit.
    """
    h = hits.withColumnsRenamed({"start0": "h_start", "end0": "h_end", "chrom": "h_chrom"})
    f = features.select(F.col("chrom").alias("f_chrom"), "locus", F.col("start0").alias("f_start"), F.col("end0").alias("f_end"))
    x = overlap_join(h, f, "h_start", "h_end", "f_start", "f_end", [("h_chrom", "f_chrom")], width)
    shared = F.least("h_end", "f_end") - F.greatest("h_start", "f_start")
    part = F.col("aligned") * shared / (F.col("h_end") - F.col("h_start"))
    return x.where((part > least * (F.col("f_end") - F.col("f_start"))) & (part > least * F.col("query_length")) & (F.col("query") != F.col("locus"))).select("query", F.col("locus").alias("hit")).distinct()


def feature_hits(features: DataFrame, genome: DataFrame, k: int = 15, least: float = 0.15) -> DataFrame:
    """``query, hit``: features (``chrom, locus, start0, end0``) that share ``least`` of the k-mers of the shorter one, on either strand, both ways round.

    An equi-join of distinct k-mers takes the place of searching features in the genome; k-mers that are their own are dropped before.
    """
    own = features.join(genome.select("chrom", "seq"), "chrom").select("locus", F.substring("seq", F.col("start0") + 1, F.col("end0") - F.col("start0")).alias("s"))
    own = own.where(F.length("s") >= k)
    mers = own.select("locus", F.explode(F.transform(F.sequence(F.lit(1), F.length("s") - k + 1), lambda i: F.substring("s", i, F.lit(k)))).alias("m"))
    mers = cut(mers.select("locus", F.xxhash64(F.least("m", reverse_complement(F.col("m")))).alias("m")).distinct())
    sizes = mers.groupBy("locus").agg(F.count("*").alias("n"))
    often = mers.groupBy("m").agg(F.count("*").alias("_c")).where("_c > 1").select("m")
    shared = mers.join(often, "m")
    both = shared.select("m", F.col("locus").alias("query")).join(shared.select("m", F.col("locus").alias("hit")), "m").where("query <> hit")
    n = both.groupBy("query", "hit").agg(F.count("*").alias("common"))
    n = n.join(sizes.withColumnsRenamed({"locus": "query", "n": "nq"}), "query").join(sizes.withColumnsRenamed({"locus": "hit", "n": "nh"}), "hit")
    return n.where(F.col("common") >= least * F.least("nq", "nh")).select("query", "hit")


def extended_pairs(blocks: DataFrame, genome: DataFrame, extend: int = 1000) -> DataFrame:
    """Blocks (each pair once) with both ends moved out by ``extend`` and the sequences of both sides, the second on the first one's strand.

    Sides that would overlap are cut at the middle between them, so no sequence is compared with itself.
    """
    once = blocks.where((F.col("query_chrom") < F.col("hit_chrom")) | ((F.col("query_chrom") == F.col("hit_chrom")) & (F.col("query_from") < F.col("hit_from"))))
    g = genome.select(F.col("chrom"), F.length("seq").alias("len"), "seq")
    x = once.join(g.withColumnsRenamed({"chrom": "query_chrom", "len": "a_len", "seq": "a_chr"}), "query_chrom").join(g.withColumnsRenamed({"chrom": "hit_chrom", "len": "b_len", "seq": "b_chr"}), "hit_chrom")
    same = F.col("query_chrom") == F.col("hit_chrom")
    middle = F.floor((F.col("query_to") + F.col("hit_from")) / 2).cast("int")
    a_to, b_from = F.least(F.col("query_to") + extend, "a_len"), F.greatest(F.col("hit_from") - extend, F.lit(0))
    x = x.select(
        F.col("block").alias("group"), "query_chrom", "hit_chrom", "strand", F.greatest(F.col("query_from") - extend, F.lit(0)).alias("a_start"),
        F.when(same, F.least(a_to, middle)).otherwise(a_to).alias("a_end"), F.when(same, F.greatest(b_from, middle)).otherwise(b_from).alias("b_start"),
        F.least(F.col("hit_to") + extend, "b_len").alias("b_end"), "a_chr", "b_chr",
    ).where("a_start < a_end and b_start < b_end")
    b = F.substring("b_chr", F.col("b_start") + 1, F.col("b_end") - F.col("b_start"))
    return x.withColumns({
        "a": F.substring("a_chr", F.col("a_start") + 1, F.col("a_end") - F.col("a_start")), "b": F.when(F.col("strand") < 0, reverse_complement(b)).otherwise(b),
    }).drop("a_chr", "b_chr")


def find_repeats(genome: DataFrame, features: DataFrame, min_identity: float = 0.95, min_length: int = 400, extend: int = 1000, max_distance: int = 3, step: int = 20) -> DataFrame:
    """``chrom, start, end``: ranges of a genome that reads cannot be told apart in, longer than ``min_length``.

    ``genome``: ``chrom, seq``; ``features``: ``chrom, locus, start0, end0, strand``. Features with shared k-mers are hits; contiguous hits are
    blocks; blocks are extended, aligned and read in windows; windows of ``min_identity`` are placed back on both sides and
    united. The extension reaches as far as the windows stay that much alike.
    """
    hits = cut(feature_hits(features, genome))
    pairs = extended_pairs(contiguous_blocks(features, hits, max_distance), genome, extend)
    aligned = cut(pairs.withColumn("al", global_align("a", "b")).select(
        "group", "query_chrom", "hit_chrom", "strand", "a_start", "a_end", "b_start", "b_end", F.lit(1).alias("plus"),
        F.col("al.a").alias("a_seq"), F.col("al.b").alias("b_seq"), window_identity(F.col("al.a"), F.col("al.b"), 100, step).alias("pid"),
    ))
    sides = []
    for side, chrom, strand in (("a", "query_chrom", "plus"), ("b", "hit_chrom", "strand")):
        placed = chromosome_places(aligned, side, f"{side}_start", f"{side}_end", strand)
        sides.append(placed.join(aligned.select("group", F.col(chrom).alias("chrom")), "group").select("chrom", "pos0", "pid"))
    return ambiguous_regions(sides[0].union(sides[1]), ["chrom"], min_identity, step, min_length)


def homology_groups(hits: DataFrame) -> DataFrame:
    """``node, component`` of loci connected by hits, whichever way they point."""
    return connected_components(hits, "query", "hit")


def adjacent_hits(features: DataFrame, hits: DataFrame, max_distance: int = 3) -> DataFrame:
    """For each hit pair the nearest features within ``max_distance`` ranks of the query that hit a neighbour of the target.

    Rows ``query, hit, near_query, near_hit, step``: ``step`` is the distance on the query's side, signed.
    """
    r = ranked(features).select("chrom", "locus", "rank")
    e = hits.join(r.select(F.col("locus").alias("query"), F.col("chrom").alias("qc"), F.col("rank").alias("qr")), "query").join(r.select(F.col("locus").alias("hit"), F.col("chrom").alias("hc"), F.col("rank").alias("hr")), "hit")
    other = e.select(F.col("query").alias("near_query"), F.col("hit").alias("near_hit"), F.col("qc").alias("qc2"), F.col("hc").alias("hc2"), F.col("qr").alias("qr2"), F.col("hr").alias("hr2"))
    steps = F.explode(F.array(*[F.lit(d) for d in range(-max_distance + 1, max_distance) if d]))
    cand = e.select("*", steps.alias("step")).join(other, (F.col("qc") == F.col("qc2")) & (F.col("hc") == F.col("hc2")) & (F.col("qr") + F.col("step") == F.col("qr2")))
    near = cand.where((F.abs(F.col("hr") - F.col("hr2")) < max_distance) & (F.col("hr") != F.col("hr2")))
    w = W.partitionBy("query", "hit", F.signum("step")).orderBy(F.abs("step"), F.abs(F.col("hr") - F.col("hr2")), "near_query", "near_hit")
    return near.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("query", "hit", "near_query", "near_hit", "step")


def contiguous_blocks(features: DataFrame, hits: DataFrame, max_distance: int = 3) -> DataFrame:
    """``block, query_from, query_to, hit_from, hit_to, n``: runs of hits between two stretches of nearby features.

    A hit pair is a node; pairs that are each other's neighbours on both sides are linked; the components of this graph are
    the blocks. With a column ``strand`` order is kept: hits on the same strand go on in the same direction, hits on opposite strands in
    opposite ones, and neither goes over into the other; without it both directions count.
    """
    near = adjacent_hits(features, hits, max_distance)
    if "strand" in features.columns:
        place = ranked(features).select("locus", "rank", "strand")
        for n, c in enumerate(("query", "hit", "near_query", "near_hit")):
            near = near.join(place.select(F.col("locus").alias(c), F.col("rank").alias(f"_r{n}"), F.col("strand").alias(f"_s{n}")), c)
        turn = F.col("_s0") * F.col("_s1")
        near = near.where((turn == F.col("_s2") * F.col("_s3")) & (F.signum("step") * F.signum(F.col("_r3") - F.col("_r1")) == turn))
    name = lambda a, b: F.concat_ws("\t", a, b)
    pairs = near.select(name("query", "hit").alias("a"), name("near_query", "near_hit").alias("b"))
    single = hits.select(name("query", "hit").alias("a"), name("query", "hit").alias("b"))
    comp = connected_components(pairs.union(single))
    loci = comp.select("component", F.split("node", "\t")[0].alias("query"), F.split("node", "\t")[1].alias("hit"))
    r = ranked(features)
    strand = F.col("strand") if "strand" in features.columns else F.lit(1)
    side = lambda name, c: r.select(F.col("locus").alias(name), F.col("chrom").alias(f"{c}c"), F.col("start0").alias(f"{c}s"), F.col("end0").alias(f"{c}e"), strand.alias(f"{c}d"))
    x = loci.join(side("query", "q"), "query").join(side("hit", "h"), "hit")
    return x.groupBy(F.col("component").alias("block")).agg(
        F.min("qs").alias("query_from"), F.max("qe").alias("query_to"), F.min("hs").alias("hit_from"), F.max("he").alias("hit_to"), F.count("*").alias("n"),
        F.min("qc").alias("query_chrom"), F.min("hc").alias("hit_chrom"), F.when(F.sum(F.col("qd") * F.col("hd")) < 0, -1).otherwise(1).alias("strand"),
    )


def tandem(features: DataFrame, groups: DataFrame, most: int = 3) -> DataFrame:
    """Members of a homology group within one to ``most`` ranks of another member."""
    r = ranked(features).join(groups.withColumnRenamed("node", "locus"), "locus")
    w = W.partitionBy("chrom", "component").orderBy("rank")
    gap = F.least(F.coalesce(F.col("rank") - F.lag("rank").over(w), F.lit(most + 1)), F.coalesce(F.lead("rank").over(w) - F.col("rank"), F.lit(most + 1)))
    return r.withColumn("gap", gap).where(F.col("gap") <= most).select("component", "locus", "rank", "gap")


def kmer_seeds(genome: DataFrame, k: int = 31, chunk: int = 100_000) -> DataFrame:
    """``kmer, chrom, pos0``: k-mers that occur more than once, on either strand (the smaller of a k-mer and its reverse complement)."""
    n = F.greatest(F.lit(0), F.ceil((F.length("seq") - k + 1) / chunk)).cast("int")
    parts = genome.where(F.length("seq") >= k).select("chrom", "seq", F.explode(F.sequence(F.lit(0), n - 1)).alias("c"))
    parts = parts.select("chrom", (F.col("c") * chunk).alias("base"), F.substring("seq", F.col("c") * chunk + 1, F.lit(chunk + k - 1)).alias("s"))
    mers = parts.select("chrom", "base", F.posexplode(F.transform(F.sequence(F.lit(1), F.length("s") - k + 1), lambda i: F.substring("s", i, F.lit(k)))).alias("i", "m"))
    mers = mers.select("chrom", (F.col("base") + F.col("i")).alias("pos0"), F.least("m", reverse_complement(F.col("m"))).alias("kmer"))
    often = mers.groupBy("kmer").agg(F.count("*").alias("n")).where("n > 1").select("kmer")
    return mers.join(often, "kmer")


def aligned_blocks(pairs: DataFrame, window: int = 100, step: int = 20) -> DataFrame:
    """``group, a_seq, b_seq, pid``: pairs of block sequences aligned, with windowed identities."""
    x = pairs.withColumn("al", global_align("a", "b"))
    return x.select("group", F.col("al.a").alias("a_seq"), F.col("al.b").alias("b_seq"), window_identity(F.col("al.a"), F.col("al.b"), window, step).alias("pid"))


def chromosome_places(aligned: DataFrame, side: str, start: str, end: str, strand: str) -> DataFrame:
    """``group, pos0, pid``: windowed identities at chromosome positions of one side (``a`` or ``b``), by its strand."""
    x = aligned.select("group", F.col(f"{side}_seq").alias("s"), start, end, strand, F.explode("pid").alias("p")).select("*", "p.at", F.col("p.pid").alias("pid_"))
    bases = F.length(F.regexp_replace(F.substring("s", F.lit(1), F.col("at")), "-", ""))
    place = F.when(F.col(strand) >= 0, F.col(start) + bases).otherwise(F.col(end) - 1 - bases)
    return x.select("group", place.alias("pos0"), F.col("pid_").alias("pid"))


def ambiguous_regions(pids: DataFrame, keys: Sequence[str], least: float = 0.98, step: int = 20, min_length: int = 400) -> DataFrame:
    """Ranges of high identity, united over all pairs, longer than ``min_length``."""
    return merge_ranges(binned_ambiguous(pids, list(keys), "pos0", "pid", least, step), keys, min_length)


def both_sides_final(pairs: DataFrame, final: DataFrame, width: int = 10_000) -> DataFrame:
    """Pairs of ranges both of which touch a final range: ``id, chrom, a_start, a_end, b_start, b_end``."""
    out = pairs
    f = final.select(F.col("chrom").alias("f_chrom"), F.col("start").alias("f_start"), F.col("end").alias("f_end"))
    for side in ("a", "b"):
        hit = overlap_join(pairs.select("id", "chrom", f"{side}_start", f"{side}_end"), f, f"{side}_start", f"{side}_end", "f_start", "f_end", [("chrom", "f_chrom")], width)
        out = out.join(hit.select("id").distinct(), "id", "left_semi")
    return out


def self_overlap_removed(hits: DataFrame) -> DataFrame:
    """Both sides of hits of a genome with itself, each less the part that it shares with the other."""
    a, b = ("a_start", "a_end"), ("b_start", "b_end")
    cut = lambda x, y: F.filter(F.array(F.struct(F.col(x[0]).alias("start"), F.least(F.col(x[1]), F.col(y[0])).alias("end")), F.struct(F.greatest(F.col(x[0]), F.col(y[1])).alias("start"), F.col(x[1]).alias("end"))), lambda r: r["start"] < r["end"])
    shared = (F.col("a_start") < F.col("b_end")) & (F.col("b_start") < F.col("a_end"))
    whole = lambda x: F.array(F.struct(F.col(x[0]).alias("start"), F.col(x[1]).alias("end")))
    parts = F.concat(F.when(shared, cut(a, b)).otherwise(whole(a)), F.when(shared, cut(b, a)).otherwise(whole(b)))
    same = (F.col("a_start") == F.col("b_start")) & (F.col("a_end") == F.col("b_end"))
    return hits.where(~same).select("chrom", F.explode(parts).alias("r")).select("chrom", "r.*")


def in_regions(calls: DataFrame, regions: DataFrame) -> DataFrame:
    return points_in_ranges(calls, regions, "pos1", ["chrom"], "left_semi")
