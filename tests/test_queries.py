from __future__ import annotations

import collections
import datetime as dt
import random

import duckdb
import pytest

import __spark_entry__ as entry_points
from strandlake.plans import driver_queries
from strandlake.streaming import signals

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from read_parquet('{DIR}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(driver_queries.SQL))
def test_same_as_sql(spark, duck, name):
    df = driver_queries.QUERIES[name](spark, DIR)
    cols = sorted(df.columns)
    rel = duck.sql(driver_queries.SQL[name])
    assert sorted(rel.columns) == cols
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    at = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr)
    assert got == want


def test_entry(spark):
    assert entry_points.entry(spark).count() >= 0
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_whole_sequences(spark, tmp_path):
    """Long texts of all rows against plain Python, and columns and rows beyond those of the queries with SQL."""
    r = random.Random(3)
    texts = ["".join(r.choice("abcd xyz") for _ in range(k)) for k in (900, 0, 700, 650, 300, 45, 500)]
    texts[3] = texts[0][:400] + texts[3][400:]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(3 * i + 2, t) for i, t in enumerate(texts)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    letters = {c: "ACGT"[i % 4] for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")}
    seqs = ["".join(letters.get(c, "") for c in t) for t in texts]
    run = lambda name: driver_queries.QUERIES[name](spark, str(tmp_path)).collect()
    rc = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    assert {(x.item_id, x.revcomp, x.n) for x in run("revcomp_documents")} == {(i, rc(s), len(s)) for i, s in enumerate(seqs)}
    kmers = [(i, p, min(s[p : p + 21], rc(s[p : p + 21]))) for i, s in enumerate(seqs) for p in range(len(s) - 20)]
    often = collections.Counter(k for *_, k in kmers)
    assert sorted((x.chrom, x.pos0, x.kmer) for x in run("kmer_seed_documents")) == sorted(k for k in kmers if often[k[2]] > 1)
    pid = []
    for i, (a, b) in enumerate(zip(seqs, seqs[1:], strict=False)):
        n = min(len(a), len(b))
        pid += [(i, at + 50, sum(x == y for x, y in zip(a[at : at + 100], b[at : at + 100], strict=True))) for at in range(0, n - 100, 20)]
    assert sorted((x.a_id, x.middle, x.same) for x in run("pid_window_documents")) == sorted(pid) and max(m for _, m, _ in pid) > 200
    columns = [{s[j] for s in seqs if j < len(s)} for j in range(max(map(len, seqs)))]
    got = {x.col: (x.gaps, x.letters) for x in run("consensus_columns_documents")}
    assert got == {j + 1: (sum(j >= len(s) for s in seqs), len(c)) for j, c in enumerate(columns)} and len(got) > 60
    want, tips = set(), seqs[1:]
    for j, og in enumerate(seqs[0]):
        differs = [j < len(s) and s[j] != og for s in tips]
        full = {(k, g) for k in (1, 2, 4, 8) for g in range(-(-len(tips) // k)) if all(differs[g * k : g * k + k])}
        top = {(k, g) for k, g in full if (2 * k, g // 2) not in full}
        want |= {(j + 1, f"{k}:{g}", len(top)) for k, g in top}
    assert {(x.col, x.node, x.n_clades) for x in run("homoplasies_whole")} == want and max(c for c, *_ in want) > 40


def test_components_of_all_rows(spark, tmp_path):
    """A hub, long chains, lone suppliers and rows without a part against union-find."""
    r = random.Random(4)
    rows = [(s, 7) for s in range(100, 160)] + [(s, 1000 + s // 2) for s in range(200, 240)] + [(s, 2000 + (s + 1) // 2) for s in range(200, 240)]
    rows += [(r.randrange(300, 400), r.randrange(10_000, 10_060)) for _ in range(90)] + [(500, 5007), (501, 10_007), (502, None), (503, None), (None, 7)]
    df = spark.createDataFrame([(s, p, 1.0, 0.0) for s, p in rows], "l_suppkey bigint, l_partkey bigint, l_quantity double, l_discount double")
    df.write.parquet(str(tmp_path / "lineitem.parquet"))
    up = {s: s for s, _ in rows if s is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    first = {}
    for s, p in rows:
        if s is not None and p is not None:
            a, b = find(s), find(first.setdefault(p, s))
            up[max(a, b)] = min(a, b)
    got = {(x.node, x.component) for x in driver_queries.QUERIES["components_whole"](spark, str(tmp_path)).collect()}
    assert got == {(s, find(s)) for s in up}


def test_tandem_groups_of_all_parts(spark, duck):
    rows = duck.sql("select p_brand, p_partkey from part order by p_retailprice, p_partkey").fetchall()
    ranks, want = {}, set()
    for rank, (brand, _) in enumerate(rows, 1):
        ranks.setdefault(brand, []).append(rank)
    for rank, (brand, key) in enumerate(rows, 1):
        gap = min((abs(rank - x) for x in ranks[brand] if x != rank), default=4)
        if gap <= 3:
            want.add((brand, key, rank, gap))
    assert {(x.p_brand, x.p_partkey, x.rank, x.gap) for x in driver_queries.QUERIES["tandem_groups_whole"](spark, DIR).collect()} == want


def test_paired_sample(spark):
    df = driver_queries.QUERIES["paired_sample"](spark, DIR)
    whole = spark.read.parquet(f"{DIR}/conversations.parquet").groupBy("conv_id").count()
    assert df.groupBy("conv_id").count().subtract(whole).count() == 0


def test_stream_equals_batch(spark, tmp_path):
    e = [(dt.datetime(2024, 1, 1, h, m), "error" if (h + m) % 3 == 0 else "view") for h in range(6) for m in range(0, 60, 7)]
    df = spark.createDataFrame(e, "ts timestamp, event_type string")
    df.write.parquet(str(tmp_path / "in"))
    stream = signals.alarms(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("alarms").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("alarms").collect())) == sorted(map(tuple, signals.alarms(df).collect()))
