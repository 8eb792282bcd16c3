from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from strandlake import runtime
from strandlake.llm import decontaminate, embedding_dups, jaccard_join, seen_twice, substring_dedup
from strandlake.llm.queries import OP6_SQL
from strandlake.operators import graph
from tests.llm.helpers import FOLD, WORD, frame, jaccard_components, make_docs, odd


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (1, 60)])
def test_jaccard(spark, n, percent):
    rows = make_docs(130, seed=n)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.components(frame(spark, rows), n, percent).collect()}
    assert got == jaccard_components(rows, n, percent)


def test_jaccard_dense_group(spark, monkeypatch):
    """Many near copies of one text: several components around the threshold, in blocks."""
    monkeypatch.setattr(jaccard_join, "MEMBERS", 12)
    monkeypatch.setattr(jaccard_join, "SETS", 7)
    r = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(r.randint(0, 4)):
            w[r.randrange(60)] = f"x{r.randrange(500)}"
        rows.append((i, " ".join(w), "en", "s", 0))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_join.components(frame(spark, rows), 3, 90).collect()}
    want = jaccard_components(rows, 3, 90)
    assert got == want and 1 < len({c for _, c in want.values()}) < 90


def test_jaccard_odd_rows(spark):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.components(odd(spark)).collect()), key=str)
    assert got == sorted([(1, 6, 1), (1, 6, 1), (2, 0, 2), (3, 0, 3), (None, 1, None)], key=str)
    assert jaccard_join.components(odd(spark).limit(0)).count() == 0


def test_jaccard_repeated_and_missing_ids(spark, monkeypatch):
    """Rows of one id with different texts, rows without an id, hot sets: every row against every row."""
    monkeypatch.setattr(runtime, "HOT_ROWS", 5)
    r = random.Random(21)
    word = lambda: f"w{r.randrange(3000)}"
    t, v, lone = ([word() for _ in range(60)] for _ in range(3))
    texts = [(0, t), (1, t), (1, v), (2, [*v, "z"]), (None, [*v[1:], "y"]), (None, lone), (None, ["q", *lone]), (7, [*t, "end"]), (7, None), (None, None), (8, ["x" * 300, *t[1:], "a", "b"])]
    texts += [(r.choice([1, 3, 5, None, 20 + i]), t if i % 2 else [*t[: r.randint(56, 60)], *[word() for _ in range(r.randint(0, 3))]]) for i in range(60)]
    rows = [(i, None if w is None else " ".join(w), "en", "s", 0) for i, w in texts]
    sets = jaccard_components([(k, x[1]) for k, x in enumerate(rows)], 3, 90)  # by place, so ids may repeat
    least: dict[int, int | None] = {}
    for k, (_, c) in sets.items():
        if rows[k][0] is not None:
            least[c] = min(rows[k][0], least.get(c, 10**9))
    want = sorted(((rows[k][0], n, least.get(c) if n else rows[k][0]) for k, (n, c) in sets.items()), key=str)
    got = sorted(((x.doc_id, x.n_shingles, x.component_id) for x in jaccard_join.components(frame(spark, rows)).collect()), key=str)
    assert got == want


def test_jaccard_long_texts(spark):
    long = " ".join(f"w{i}" for i in range(40_000))
    rows = [(1, long, "", "", 0), (2, long + " end", "", "", 0), (3, "n" * 2_000_000, "", "", 0), (4, "n" * 2_000_000, "", "", 0), (5, "n" * 2_000_001, "", "", 0)]
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_join.components(frame(spark, rows)).collect()}
    assert got == {1: (39_998, 1), 2: (39_999, 1), 3: (1, 3), 4: (1, 3), 5: (1, 5)}


def test_signatures_find_every_pair():
    r = random.Random(3)
    sizes = {b: 1000 for b in range(40)}
    for percent in (80, 90):
        plan = jaccard_join.Plan.of(400, percent, sizes)
        for _ in range(400):
            n = r.randint(1, 300)
            x = np.unique(np.array([r.getrandbits(64) for _ in range(n)], np.uint64))
            y = set(x.tolist())
            for _ in range(r.randint(0, n // 4 + 1)):
                if r.random() < 0.5 and len(y) > 1:
                    y.remove(r.choice(sorted(y)))
                else:
                    y.add(r.getrandbits(64))
            y = np.array(sorted(y), np.uint64)
            same = len(set(x.tolist()) & set(y.tolist()))
            if 100 * same >= percent * (len(x) + len(y) - same):
                a, b = ({(k, at): room for keys, at, room in jaccard_join.signatures(s, plan) for k in keys.tolist()} for s in (x, y))
                common = a.keys() & b.keys()
                # whatever either may leave out, something in common is kept
                assert any(sum(k[1] == band for k in common) > min(room for k, room in [*a.items(), *b.items()] if k[1] == band) for band in {k[1] for k in common}), (n, percent)


def test_recurring_keys(spark):
    rows = [(i,) for i in range(-500, 500)] + [(7,), (-9,), (7,)]
    bitmap = seen_twice.recurring(spark.createDataFrame(rows, "k bigint"), "k").value
    keys = np.arange(-500, 500)
    assert set(keys[seen_twice.may_recur(bitmap, keys)]) >= {7, -9}


def test_decontamination(spark):
    import duckdb

    r = random.Random(6)
    vocab = [f"w{i}" for i in range(60)] + ["Ä", "ä", "x1"]
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.choice([3, 7, 8, 9, 20])))) for i in range(25)] + [(90, "a b"), (91, ""), (92, None), (93, "Solo"), (94, "-")]
    docs = []
    for i in range(60):
        t = [r.choice(vocab) for _ in range(r.randint(0, 60))]
        if i % 2:
            t[5:5] = (r.choice(items)[1] or "").upper().split(" ")
        docs.append((i, (", " if i % 5 == 0 else " ").join(t) + r.choice(["", ".", " solo"]), "en", "s", 0))
    docs += [(100, None, "", "", 0), (101, "", "", "", 0), (102, "!", "", "", 0)]
    bench = spark.createDataFrame([(*x, "z") for x in items], "item_id bigint, text string, word string")
    got = sorted((tuple(x) for x in decontaminate.find(frame(spark, docs), bench).collect()), key=str)
    c = duckdb.connect()
    c.sql("create table documents (doc_id bigint, text varchar)")
    c.sql("create table benchmark (item_id bigint, text varchar)")
    c.executemany("insert into documents values (?, ?)", [d[:2] for d in docs])
    c.executemany("insert into benchmark values (?, ?)", items)
    want = sorted(c.sql(OP6_SQL).fetchall(), key=str)
    assert got == want and any(x[-1] for x in got)
    again = decontaminate.find(odd(spark), bench).collect()
    assert len(again) == 5
    assert decontaminate.find(frame(spark, docs), bench.limit(0)).where("n_hit > 0 or contaminated").count() == 0
    assert decontaminate.find(frame(spark, docs).limit(0), bench).count() == 0


def test_decontamination_without_broadcast(spark, monkeypatch):
    docs = [(i, f"one two three four five six seven eight nine {i}", "en", "s", 0) for i in range(30)]
    bench = spark.createDataFrame([(1, "two three four five six seven eight nine"), (2, "three four five six seven eight nine 7")], "item_id bigint, text string")
    first = sorted(map(tuple, decontaminate.find(frame(spark, docs), bench).collect()))
    monkeypatch.setattr(decontaminate, "hinted", lambda df, most=0: df)
    assert sorted(map(tuple, decontaminate.find(frame(spark, docs), bench).collect())) == first
    assert {x[0]: x[3] for x in first}[7] == 2


def test_components_release_every_round(spark, monkeypatch):
    """Shuffle files of the rounds before are let go in each round, not when the driver happens to collect its garbage."""
    rounds, released = [], []
    monkeypatch.setattr(graph, "release", lambda session: released.append(session))
    monkeypatch.setattr(graph, "drop", lambda *tables, drop=runtime.drop: (rounds.append(len(released)), drop(*tables)))
    out = graph.connected_components(spark.createDataFrame([(i, i + 1) for i in range(40)], "a bigint, b bigint"))
    assert out.agg({"component": "max"}).first()[0] == 0
    assert rounds[:-1] == list(range(len(released))) and len(released) > 3


def test_passages(spark):
    r = random.Random(2)
    vocab = [f"w{i}" for i in range(5000)]
    text = lambda k: [r.choice(vocab) for _ in range(k)]
    p = text(80)
    fuzzy = list(p)
    fuzzy[20:21] = ["new", "words"]
    del fuzzy[60]
    rows = [text(60) + p + text(30), text(10) + p + text(200), text(5) + fuzzy + text(5), text(300), text(40) + p[:30] + text(40), ["z"] * 90, text(3) + ["z"] * 120]
    rows = [(i, " ".join(w).upper() if i == 1 else " ".join(w), "en", "s", 0) for i, w in enumerate(rows)]
    got = {r.doc_id: r for r in substring_dedup.passages(frame(spark, rows)).collect()}
    assert set(got) == {1, 2, 6}
    assert (got[1].source_id, got[1].start_word, got[1].end_word, got[1].identity) == (0, 10, 90, 1.0)
    assert got[2].source_id == 0 and abs(got[2].start_word - 5) <= 2 and abs(got[2].end_word - 85) <= 2 and 0.9 < got[2].identity < 1
    assert got[6].source_id == 5
    left = {r.doc_id: r for r in substring_dedup.without_repeats(frame(spark, rows).drop("spans_")).collect()}
    assert left[1].text.split() == rows[1][1].split()[:10] + rows[1][1].split()[90:] and left[1].n_chars == len(left[1].text)
    assert left[3].text == rows[3][1] and left[4].text == rows[4][1] and left[0].text == rows[0][1]
    assert substring_dedup.passages(odd(spark)).count() == 0 and substring_dedup.passages(odd(spark).limit(0)).count() == 0


def test_long_texts(spark):
    """Texts of hundreds of thousands of words and words of millions of bytes, read whole: what is at their very end is found."""
    r = random.Random(31)
    tail = [f"t{r.randrange(10**6)}" for _ in range(60)]
    long = " ".join(f"w{i}" for i in range(200_000))
    rows = [(1, " ".join(tail), "", "", 0), (2, long + " " + " ".join(tail), "", "", 0), (3, "n" * 3_000_000 + " " + " ".join(tail), "", "", 0)]
    found = {x.doc_id: x for x in substring_dedup.passages(frame(spark, rows)).collect()}
    assert set(found) == {2, 3} and (found[2].start_word, found[2].end_word) == (200_000, 200_060) and (found[3].start_word, found[3].end_word) == (1, 61)
    bench = spark.createDataFrame([(7, " ".join(tail[-8:])), (8, " ".join(tail[-9:-1]))], "item_id bigint, text string")
    got = {x.doc_id: (x.n_words, x.n_hit, x.n_items) for x in decontaminate.find(frame(spark, rows), bench).collect()}
    assert got == {1: (60, 9, 2), 2: (200_060, 9, 2), 3: (61, 9, 2)}


def test_passages_of_a_hot_source(spark, monkeypatch):
    """Many documents with a passage of one first holder: the same rows, whether or not its pieces are taken out of the shuffle."""
    r = random.Random(17)
    text = lambda k: [f"w{r.randrange(9000)}" for _ in range(k)]
    p = text(70)
    rows = [(i, " ".join(text(r.randint(0, 30)) + p[: 35 + i % 4] + ["other"] * (i % 2) + p[35 + i % 4 :] + text(10)), "en", "s", 0) for i in range(40)]
    plain = sorted(map(tuple, substring_dedup.passages(frame(spark, rows)).collect()))
    monkeypatch.setattr(runtime, "HOT_ROWS", 2)
    assert sorted(map(tuple, substring_dedup.passages(frame(spark, rows)).collect())) == plain and {x[0] for x in plain} == set(range(1, 40))


def test_joins_with_hot_keys(spark, monkeypatch):
    """Hot, missing and repeated keys: the rows of a plain join."""
    monkeypatch.setattr(runtime, "HOT_ROWS", 3)
    left = runtime.cut(spark.createDataFrame([(k, j, v) for v, (k, j) in enumerate([(1, 1)] * 30 + [(2, 1), (2, 2), (None, 1), (3, None), (9, 9)])], "k bigint, j bigint, v int"))
    right = runtime.cut(spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (4, 4, "c")], "k bigint, j bigint, w string"))
    assert runtime.hot_keys(left, "k") == [1]
    for how in ("inner", "left"):
        want = sorted(map(tuple, left.join(right, ["k", "j"], how).select("k", "j", "v", "w").collect()), key=str)
        assert sorted(map(tuple, runtime.joined(left, right, ["k", "j"], how).select("k", "j", "v", "w").collect()), key=str) == want
    assert runtime.joined(left.limit(0), right, ["k", "j"], "left").count() == 0


def test_passages_whose_pieces_are_held_earlier(spark):
    """A whole passage of which earlier documents hold pieces, also with holders of pieces in between."""
    r = random.Random(12)
    text = lambda k: [f"w{r.randrange(5000)}" for _ in range(k)]
    p, q = text(60), text(90)
    rows = [[], text(20) + p[:30] + text(20), text(20) + p[30:] + text(20), text(10) + p + text(10), text(15) + p + text(15)]
    rows += [text(30) + p[:30] + text(9), p[30:] + text(40), text(7) + p + text(3)]
    rows += [text(9) + q[:65] + text(9), text(9) + q + text(9), text(40) + q + text(40)]
    rows += [["z"] * 130, text(3) + ["z"] * 400, text(49) + text(1) * 2]
    docs = frame(spark, [(i, " ".join(w).upper() if i == 4 else " ".join(w), "en", "s", 0) for i, w in enumerate(rows)])
    gone = {}
    for x in substring_dedup.passages(docs).collect():
        assert x.source_id < x.doc_id and x.n_words == x.end_word - x.start_word >= 50
        if x.identity == 1.0 and x.end_word - x.start_word == x.source_end - x.source_start:
            assert rows[x.doc_id][x.start_word : x.end_word] == rows[x.source_id][x.source_start : x.source_end]
        gone.setdefault(x.doc_id, set()).update(range(x.start_word, x.end_word))
    held: dict[tuple, int] = {}
    for i, w in enumerate(rows):
        for j in range(len(w) - 49):
            if held.setdefault(tuple(w[j : j + 50]), i) < i:
                assert gone.get(i, set()) >= set(range(j, j + 50)), (i, j)
    assert set(gone) == {4, 7, 9, 10, 12}
    left = {x.doc_id: x.text.split() for x in substring_dedup.without_repeats(docs.drop("spans_")).collect()}
    assert left[4] == [w.upper() for w in rows[4][:15] + rows[4][75:]] and left[3] == rows[3]


def test_passages_with_edits_whose_pieces_are_held_earlier(spark, monkeypatch):
    """Passages with edits in every run of 50 words, of which earlier documents hold pieces or other versions: no link of an earlier document is lost,
    whether links of seeds are rare or so frequent that they are asked for with their surroundings."""
    r = random.Random(5)
    text = lambda k: [f"w{r.randrange(50000)}" for _ in range(k)]
    line, rows, want = text(24), [], set()
    for _ in range(6):
        p, q, i = text(60), text(70), len(rows)
        rows += [text(20) + p[:30] + text(20), text(20) + p[30:] + text(20), text(10) + p + text(10), text(15) + p[:30] + ["edit"] + p[31:] + text(15)]
        rows += [text(5) + q[:35] + ["other"] + q[36:], q + text(9), text(7) + q + text(7), text(30) + line + text(30)]
        want |= {(i + 3, i + 2, 58), (i + 5, i + 4, 65), (i + 6, i + 4, 65), (i + 6, i + 5, 70)}
    docs = frame(spark, [(i, " ".join(w), "en", "s", 0) for i, w in enumerate(rows)])
    found = sorted(map(tuple, substring_dedup.passages(docs).collect()))
    most = {pair: max(x[-1] for x in found if x[:2] == pair) for pair in {x[:2] for x in found}}
    assert set(most) == {x[:2] for x in want} and all(most[d, s] >= n for d, s, n in want)
    monkeypatch.setattr(substring_dedup, "OFTEN", 1)
    assert sorted(map(tuple, substring_dedup.passages(docs).collect())) == found


def test_passages_where_joins_split_partitions(spark):
    """Spark may split a large partition of a join; what is aligned together stays together."""
    r = random.Random(23)
    text = lambda k: [f"w{r.randrange(50000)}" for _ in range(k)]
    rows = []
    for _ in range(12):
        p = text(700)
        rows += [text(9) + p, text(40) + [w if i % 30 else "edit" for i, w in enumerate(p)] + text(20), text(90) + p[:350] + ["x", "y"] + p[350:]]
    docs = frame(spark, [(i, " ".join(w), "en", "s", 0) for i, w in enumerate(rows)]).repartition(8)
    plain = sorted(map(tuple, substring_dedup.passages(docs).collect()))
    split = {"skewJoin.skewedPartitionThresholdInBytes": "1", "skewJoin.skewedPartitionFactor": "0.1", "advisoryPartitionSizeInBytes": "1k", "coalescePartitions.enabled": "false", "autoBroadcastJoinThreshold": "-1"}
    split = {f"spark.sql.adaptive.{k}": v for k, v in split.items()} | {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in split}
    try:
        for k, v in split.items():
            spark.conf.set(k, v)
        assert sorted(map(tuple, substring_dedup.passages(docs).collect())) == plain and {x[0] for x in plain} == {i for i in range(36) if i % 3}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_keys_asked_for_and_held_earlier():
    """Packed keys: the bitmap has all that a document asks for and an earlier one holds, and hardly others."""
    r = np.random.default_rng(4)
    keys = r.integers(-(2**63), 2**63 - 1, 4000)
    packs = []
    for doc, lo, hi, asks in ((7, 0, 1000, True), (3, 500, 700, False), (9, 900, 1100, False), (9, 1050, 2000, True), (9, 1050, 2000, True), (5, 1900, 4000, False)):
        packs.append(seen_twice.packed(keys[lo:hi], np.full(hi - lo, doc), np.full(hi - lo, asks), 8))
    packs = pa.Table.from_batches(packs)
    bits = np.zeros(seen_twice.WORDS, np.uint64)
    each = seen_twice.WORDS // 8
    for part in range(8):
        own = seen_twice.bits_of(packs.filter(pc.equal(packs.column("part"), part)), each)
        bits[part * each : (part + 1) * each] = np.frombuffer(own.column("bits")[0].as_py(), np.uint64)
    may = seen_twice.may_be_asked(bits, keys)
    want = np.zeros(4000, bool)
    want[500:700] = want[1900:2000] = True
    assert may[want].all() and may.sum() <= want.sum() + 5


def test_chaining_is_best():
    """The Fenwick tree's chains against the quadratic recurrence."""
    r = random.Random(9)
    for _ in range(80):
        m = sorted({(r.randint(0, 40), r.randint(0, 40)) for _ in range(r.randint(1, 14))}, key=lambda x: (x[1], x[0]))
        a, b = (np.array(c) for c in zip(*m, strict=True))
        score = []
        for i in range(len(m)):
            prior = [score[j] - substring_dedup.GAP_COST * float(a[i] - a[j] + b[i] - b[j]) for j in range(i) if a[j] < a[i] and b[j] < b[i]]
            score.append(substring_dedup.K + max([0.0, *prior]))
        chains = substring_dedup.chain(a, b)
        assert sorted(x for c in chains for x in c) == list(range(len(m)))
        assert all((np.diff(a[c]) > 0).all() and (np.diff(b[c]) > 0).all() for c in chains)
        top = max(chains, key=lambda c: substring_dedup.K * len(c) - substring_dedup.GAP_COST * float(a[c[-1]] - a[c[0]] + b[c[-1]] - b[c[0]]))
        if np.abs(np.diff(a)).max(initial=0) <= substring_dedup.MAX_GAP:
            got = substring_dedup.K * len(top) - substring_dedup.GAP_COST * float(a[top[-1]] - a[top[0]] + b[top[-1]] - b[top[0]])
            assert got >= max(score) - 1e-9


def test_embeddings(spark, monkeypatch):
    r = np.random.default_rng(1)
    x = r.normal(size=(300, 16))
    x[100:160] = x[0] + 0.15 * r.normal(size=(60, 16))
    x[160:180] = x[1] * r.uniform(0.5, 2, size=(20, 1))
    x[200:230] = x[2]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(400, None, 0), (401, [], 0), (402, [0.0] * 16, 0), (403, [float("nan")] * 16, 0), (404, [None] + [1.0] * 15, 0), (405, x[3].tolist(), 0), (405, x[3].tolist(), 0)]
    df = spark.createDataFrame([(*v, 9) for v in rows], "vec_id bigint, embedding array<double>, label int, copies int")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = ((unit @ unit.T) >= 0.9).sum(1) - 1
    want[3] += 2
    for block in (embedding_dups.BLOCK, 25):
        got = [(v.vec_id, v.n_links, v.component_id, v.kept) for v in embedding_dups.near_duplicates(df, 0.9, block=block).collect()]
        assert len(got) == len(rows)
        n = {i: k for i, k, _, _ in got if i < 300}
        assert sum(n.values()) >= 0.9 * want.sum() and all(n[i] <= want[i] for i in n)
        assert all((k, c, kept) == (0, i, True) for i, k, c, kept in got if 400 <= i < 405)
        assert [(k, c, kept) for i, k, c, kept in got if i == 405] == [(2, 3, False)] * 2
        assert all(kept == (i == c) for i, _, c, kept in got)
        comp = {i: c for i, _, c, _ in got}
        assert {comp[i] for i in range(160, 180)} == {1} and {comp[i] for i in range(200, 230)} == {2}
    assert embedding_dups.near_duplicates(df.limit(0)).count() == 0
    assert embedding_dups.near_duplicates(df.where("vec_id in (400, 401)")).count() == 2


def test_embeddings_with_repeated_and_missing_ids(spark, monkeypatch):
    """Different vectors of one id, vectors without an id, a hot vector: every row against every row."""
    monkeypatch.setattr(runtime, "HOT_ROWS", 5)
    r = np.random.default_rng(4)
    base = r.normal(size=(6, 12))
    rows = [(5, [1.0, 0.0, 0.0]), (5, [0.0, 1.0, 0.0]), (6, [1.0, 0.01, 0.0]), (7, [0.01, 1.0, 0.0]), (None, [0.0, 0.0, 1.0]), (None, [0.0, 0.01, 1.0]), (None, None), (8, [0.0] * 3)]
    rows += [(int(r.integers(0, 9)) if i % 3 else None, (base[i % 6] + 0.05 * r.normal(size=12)).tolist()) for i in range(60)]
    rows += [(int(r.integers(20, 40)), base[0].tolist()) for _ in range(30)]
    x = np.array([np.pad(np.array(v or [0.0], float), (0, 12 - len(v or [0]))) for _, v in rows])
    size = np.linalg.norm(x, axis=1)
    link = ((x / np.maximum(size, 1e-9)[:, None]) @ (x / np.maximum(size, 1e-9)[:, None]).T >= 0.9) & (size[:, None] > 0)
    np.fill_diagonal(link, False)
    comp = np.arange(len(rows))
    for _ in rows:
        comp = np.array([min([comp[i], *comp[link[i]]]) for i in range(len(rows))])
    named = {c: min((rows[i][0] for i in np.flatnonzero(comp == c) if rows[i][0] is not None), default=None) for c in set(comp.tolist())}
    want = sorted(((i, int(link[k].sum()), named[comp[k]] if size[k] else i, (i == named[comp[k]]) if size[k] and i is not None and named[comp[k]] is not None else not size[k]) for k, (i, _) in enumerate(rows)), key=str)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted(((v.vec_id, v.n_links, v.component_id, v.kept) for v in embedding_dups.near_duplicates(df, 0.9).collect()), key=str)
    assert got == want


def test_words_are_split_alike():
    import pyarrow as pa

    from strandlake.llm import textvec as tv

    texts = ["", "A b\tC\x0bd", "  x ", "Ü\u00a0y\nz", "one" * 50, "y" * 64 + " " + "y" * 65 + " " + "y" * 66]
    data, off = tv.string_bytes(pa.array(texts))
    low = tv.LOWER[data]
    starts, ends, first = tv.word_spans(low, off, tv.SPACE)
    h = tv.word_hashes(low, starts, ends)
    words = [WORD.findall(t.translate(FOLD)) for t in texts]
    assert np.diff(first).tolist() == [len(w) for w in words]
    flat = [w for own in words for w in own]
    assert [bytes(low[s:e]).decode() for s, e in zip(starts, ends, strict=True)] == flat
    assert len({*h.tolist()}) == len({*flat})


def test_links_that_no_later_document_asks_for_are_no_rows(spark):
    rng = np.random.default_rng(77)
    words = np.array([f"w{i}" for i in range(4000)])
    own = lambda n: list(rng.choice(words, n))
    line = own(40)  # too short a passage
    rows = [(i, " ".join(own(200) + (line if i % 3 == 0 else []) + own(200))) for i in range(30)]
    base = spark.createDataFrame([*rows, (100, rows[1][1])], "doc_id bigint, text string")
    shared = substring_dedup._shared_seeds(base, seen_twice.recurring(substring_dedup._recurring_keys(base), "key"))
    found = spark.createDataFrame([(100, 1, 0, 400, 0, 400, 1.0)], "doc_id bigint, source_id bigint, start_word int, end_word int, source_start int, source_end int, identity double")
    links = {}
    for key, doc, is_open in substring_dedup._links(shared, found).collect():
        assert doc not in links.setdefault(key, {})
        links[key][doc] = is_open
    assert links and all(set(held) == set(range(0, 30, 3)) for held in links.values())  # those of the copy are covered
    assert all(any(held.values()) for held in links.values())
