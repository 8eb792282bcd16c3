from __future__ import annotations

import random

from strandlake.operators import intervals as iv
from strandlake.operators import islands as il


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_range_ends(spark):
    points = spark.createDataFrame([(p,) for p in (99, 100, 150, 151)], "pos1 int")
    ranges = spark.createDataFrame([(99, 150)], "start int, end int")
    assert rows(iv.points_in_ranges(points, ranges, "pos1", width=10), "pos1") == [(100,), (150,)]
    assert rows(iv.points_in_ranges(points, ranges, "pos1", how="left_anti", width=10), "pos1") == [(99,), (151,)]
    assert rows(iv.points_in_ranges(points, ranges, "pos1", width=10, closed_end=False), "pos1") == [(100,)]


def test_joins_equal_naive(spark):
    r = random.Random(3)
    a = [(i, r.randint(0, 300), r.choice("xy")) for i in range(60)]
    a = [(i, s, s + r.randint(0, 40), k) for i, s, k in a]
    b = [(i, s, s + r.randint(0, 60), r.choice("xy")) for i in range(60) for s in [r.randint(0, 300)]]
    left, right = spark.createDataFrame(a, "i int, ls int, le int, k string"), spark.createDataFrame(b, "j int, rs int, re int, q string")
    want = sorted((i, j) for i, ls, le, k in a for j, rs, re, q in b if k == q and ls < le and rs < re and ls < re and rs < le)
    assert rows(iv.overlap_join(left, right, "ls", "le", "rs", "re", [("k", "q")], 16), "i", "j") == want
    kept = sorted((i,) for i, ls, le, k in a if not any(o[1] < ls and le < o[2] and o[3] == k for o in a))
    assert rows(iv.not_contained(left, "ls", "le", ["k"], 16), "i") == kept


def test_nested_features(spark):
    f = spark.createDataFrame([("L1", 0, 99), ("L2", 10, 40), ("L3", 90, 150), ("L4", 0, 50)], "locus string, s int, e int")
    assert rows(iv.not_contained(f, "s", "e", [], 20), "locus") == [("L1",), ("L3",), ("L4",)]


def test_merge_subtract_and_shared_ends(spark):
    r = spark.createDataFrame([(0, 100), (100, 200), (150, 300), (500, 950)], "start int, end int")
    assert rows(iv.merge_ranges(r), "start", "end") == [(0, 300), (500, 950)]
    assert rows(iv.merge_ranges(r, min_length=400), "start", "end") == [(500, 950)]
    s = spark.createDataFrame([(50, 60), (290, 600)], "start int, end int")
    assert rows(iv.subtract_ranges(r, s), "start", "end") == [(0, 50), (60, 290), (600, 950)]
    t = spark.createDataFrame([(0, 100), (100, 200), (300, 400)], "start int, end int")
    assert rows(iv.drop_shared_ends(t), "start", "end") == [(0, 200), (300, 400)]
    assert iv.merge_ranges(r.where("start > 9999")).count() == 0


def test_views_and_circles(spark):
    f = spark.createDataFrame([("in", 10, 20), ("left", 0, 12), ("right", 18, 40), ("span", 0, 99), ("out", 50, 60)], "n string, start int, end int")
    got = {r["n"]: (r["clip_start"], r["clip_end"], r["shown"]) for r in iv.window_view(f, 10, 30).collect()}
    assert got == {"in": (10, 20, "complete"), "left": (10, 12, "left"), "right": (18, 30, "right"), "span": (10, 30, "span")}
    reads = spark.createDataFrame([("a", 0, 10), ("b", 95, 100), ("c", 50, 60)], "q string, start0 int, end0 int")
    assert rows(iv.circular_reads(reads, 100, 2, 5, 5), "q") == [("a",), ("b",)]


def test_threshold_islands(spark):
    s = spark.createDataFrame([(0, 0.0), (1, 0.2), (2, 0.3), (3, 0.0), (4, 0.2)], "bin int, v double")
    got = il.threshold_islands(s, [], "bin", "v", 0.15, resolution=10, offset=50, length=1000)
    assert rows(got, "start", "end") == [(60, 80), (90, 1000)]
    cut = il.threshold_islands(s, [], "bin", "v", 0.15, resolution=10, offset=50, length=50)
    assert rows(cut, "start", "end") == [(60, 80), (90, 50)] or rows(cut, "start", "end") == [(60, 80)]
    zero = spark.createDataFrame([(i, t) for i, t in enumerate((5, 0, 0, 3, 0))], "bin int, total int")
    got = il.threshold_islands(zero, [], "bin", "total", 0, "<=", resolution=10, keep_open=False)
    assert rows(got, "start", "end") == [(10, 30)]


def test_consecutive_clusters_and_pieces(spark):
    n = spark.createDataFrame([(x,) for x in (1, 2, 3, 7, 9, 10, 10)], "p int")
    assert rows(il.consecutive_ranges(n, [], "p"), "start", "end") == [(1, 4), (7, 8), (9, 11)]
    c = il.gap_clusters(spark.createDataFrame([(1,), (5,), (30,), (31,)], "p int"), [], "p", 10)
    assert rows(c, "p", "cluster") == [(1, 1), (5, 1), (30, 2), (31, 2)]
    r = spark.createDataFrame([("c", 20_000, 30_000), ("c", 35_000, 60_000), ("c", 90_000, 91_000)], "chrom string, start int, end int")
    pieces = rows(il.assembly_regions(r, ["chrom"]), "start", "end")
    assert pieces[0][0] == 19_500 and pieces[-1] == (89_500, 91_500) and max(e - s for s, e in pieces) <= 20_100
    assert rows(il.consecutive_ranges(n.where("p > 99"), [], "p"), "start") == []
