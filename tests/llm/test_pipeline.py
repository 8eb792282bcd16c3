from __future__ import annotations

import hashlib
import re

import public_tokenizers as P
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from strandlake.llm.byte_bpe import ByteBPE  # noqa: E402
from tests.llm.helpers import FOLD, SCHEMA, WORD, jaccard_components, make_docs  # noqa: E402


def leaks(text, items):
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD)) if w]
    runs = {tuple(words[i : i + k]) for k in range(1, 9) for i in range(len(words) - k + 1)}
    for t in items:
        own = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(FOLD)) if w]
        k = min(8, len(own))
        if own and any(tuple(own[i : i + k]) in runs for i in range(len(own) - k + 1)):
            return True
    return False


def long_runs(rows, k=50):
    """Ids of documents that share an exact run of words with an earlier one."""
    first, out = {}, set()
    for i, t in sorted(rows.items()):
        w = WORD.findall((t or "").translate(FOLD))
        for j in range(len(w) - k + 1):
            if first.setdefault(tuple(w[j : j + k]), i) != i:
                out.add(i)
    return out


def test_stages_on_their_own_input(spark, tmp_path):
    docs = make_docs(110, seed=12)
    words = docs[1][1].split(" ") * 3
    items = [(1, " ".join(words[:12])), (2, None), (3, " ".join(docs[3][1].split(" ")[:9]))]
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    table = spark.read.parquet(str(tmp_path / "documents.parquet"))
    outs = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, table, str(tmp_path)).write.parquet(str(tmp_path / f"out{k}"))
        outs.append((table, spark.read.parquet(str(tmp_path / f"out{k}"))))
        table = outs[-1][1]
    rows = [({r.doc_id: r for r in a.collect()}, {r.doc_id: r for r in b.collect()}) for a, b in outs]
    for _, b in outs[:-1]:
        assert b.columns == corpus_pipeline.COLUMNS
    before, after = rows[0]
    assert set(after) == {i for i, r in before.items() if re.search(r"[^\W\d_]", r.text or "")}
    before, after = rows[1]
    want = jaccard_components([tuple(r) for r in before.values()], 5, 80)
    assert set(after) == {i for i, (_, c) in want.items() if c == i}
    before, after = rows[2]
    cut = {i for i in before if i not in after or after[i].text != before[i].text}
    assert long_runs({i: r.text for i, r in before.items()}) <= cut
    assert all(after[i].n_chars == (len(after[i].text) if i in cut else before[i].n_chars) for i in after)
    assert not long_runs({i: r.text for i, r in after.items()}, 60)
    before, after = rows[3]
    assert set(after) == {i for i, r in before.items() if not leaks(r.text, [t for _, t in items])} and len(after) < len(before)
    before, after = rows[4]
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        bpe = ByteBPE(f.read(), P.PATTERN)
    assert set(before) == set(after)
    for i, r in after.items():
        assert r.ids == bpe.encode(before[i].text) and r.decoded_sha256 == hashlib.sha256(before[i].text.encode()).hexdigest()


def test_odd_rows_through_every_stage(spark, tmp_path):
    """Missing and repeated ids, null columns, clashing columns, a long text: each stage judges rows, not ids."""
    from pyspark.sql import functions as F

    words = [f"wort{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    a, b, c = (" ".join(words[i : i + 70]) for i in (0, 100, 200))
    leak = "one two three four five six seven eight"
    long = "n" * 300_000 + " " + " ".join(words[300:360])
    rows = [(1, a, "en", "s", 1), (1, b, "en", "s", 1), (None, c, None, None, None), (8, c + " more", "en", "s", 1), (None, leak + " nine", "en", "s", 1), (2, a + " end", None, "s", 1)]
    rows += [(3, None, "en", "s", 0), (3, "", "de", "s", 0), (4, "12 !!", "en", "s", 0), (5, long, "en", "s", 1), (5, leak.upper(), "en", "s", 1), (6, "".join(chr(0x2000 + 37 * i) for i in range(90)) + "A", "en", "s", 1)]
    rows += [(None, "x y " + b + " z", "en", "s", 1), (7, "kurz", "de", "s", 4), (7, "kurz", "de", "s", 4)]
    spark.createDataFrame([(9, leak)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3).select("*", *[F.lit(1).alias(x) for x in ("key", "given_id", "component_id", "spans_", "id_", "n", "bits")])
    run = lambda k: sorted(((r.doc_id, r.text) for r in corpus_pipeline.STAGES[k][1](spark, docs, str(tmp_path)).collect()), key=str)
    every = [(i, t) for i, t, *_ in rows]
    less = lambda *gone: sorted([x for k, x in enumerate(every) if k not in gone], key=str)
    kept = run(0)
    assert set(less(6, 7, 8)) >= set(kept) and not {3, 4} & {i for i, _ in kept} and (7, "kurz") in kept and (None, c) in kept
    assert {r.lang for r in corpus_pipeline.identify_language(spark, docs, str(tmp_path)).where(F.col("text") == c).collect()} <= {"en", "de"}
    got = run(1)
    assert got == less(2, 4, 5, 12, 14)  # the later copies: c and the leak without an id, a of a later id, b without an id, the repeated row
    got = run(2)
    assert (1, a) in got and (1, b) in got and (8, c + " more") in got and (None, c) not in got and (2, "end") in got
    assert (None, "x y z") in got and len(got) == len(rows) - 1
    assert run(3) == less(4, 10)
    assert len(run_last := corpus_pipeline.encode(spark, docs, str(tmp_path)).collect()) == len(rows) and {r.n_tokens for r in run_last if r.doc_id == 3} == {0}


def test_language_stage_decides(spark, tmp_path):
    """Texts in no learned language go, though they have letters; a missing language is filled in."""
    en, de = "the house and of with a garden ".split(" "), "der und mit schön häuser garten im ".split(" ")
    rows = [(i, " ".join((en if i % 2 else de)[(i + j) % 7] for j in range(40)), ["de", "en"][i % 2] if i < 60 else None, "s", 0) for i in range(80)]
    rows += [(101, "漢字鬱龜" * 9, None, "s", 0), (102, "1 2 3", None, "s", 0)]
    out = {r.doc_id: r.lang for r in corpus_pipeline.identify_language(spark, spark.createDataFrame(rows, SCHEMA), str(tmp_path)).collect()}
    assert out == {i: ["de", "en"][i % 2] for i in range(80)}
    none = spark.createDataFrame([(1, "abc", None, None, None), (2, "12", None, None, None), (3, None, None, None, None)], SCHEMA)
    assert [r.doc_id for r in corpus_pipeline.identify_language(spark, none, str(tmp_path)).collect()] == [1]


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "a b c")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
