from __future__ import annotations

import base64
import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers as P
import tiktoken

from strandlake.llm import byte_bpe, language_id, lm_score, ppm, toxicity
from strandlake.llm import textvec as tv
from tests.llm.helpers import FOLD, WORD, frame, make_docs, odd

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def bpe():
    with open(PATH, "rb") as f:
        return byte_bpe.ByteBPE(f.read(), P.PATTERN)


@pytest.fixture(scope="module")
def reference(bpe):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def test_bpe_as_tiktoken(bpe, reference):
    r = random.Random(4)
    for i in range(3000):
        s = "".join(r.choice("aabbccéèß  \n\t=-=-1234567890ÄñÑ漢字😀\u200d!?.") for _ in range(r.randint(0, 50)))
        s = r.choice("a= -é") * r.randint(0, 80) + s if i % 3 else s
        ids = bpe.encode(s)
        assert ids == reference.encode_ordinary(s)
        assert bpe.decode(ids) == s


def test_bpe_offsets_and_chunks(bpe, reference, monkeypatch):
    s = "añ 漢字😀x"
    found = bpe.encode_with_offsets(s)
    assert [i for i, _, _ in found] == bpe.encode(s)
    assert found[0][1] == 0 and found[-1][2] == len(s) and all(a < b for _, a, b in found)
    assert b"".join(bpe.bytes_of[i] for i, _, _ in found).decode() == s
    assert bpe.decode(bpe.encode("é")[:1]) in ("é", "\ufffd")
    monkeypatch.setattr(byte_bpe, "CHUNK", 50)
    monkeypatch.setattr(byte_bpe, "CACHE_PIECES", 5)
    bpe.cache.clear()
    long = "Das ist ein Satz, mit 12 Wörtern und   Lücken!\n" * 40
    assert bpe.encode(long) == reference.encode_ordinary(long)


def test_bpe_query(spark, bpe):
    rows = make_docs(40)
    got = {r.doc_id: r for r in byte_bpe.encode_documents(frame(spark, rows), PATH, P.PATTERN).collect()}
    assert len(got) == len(rows)
    for i, t, *_ in rows:
        packed = np.array(bpe.encode(t or ""), "<u4").tobytes()
        assert got[i].n_tokens == len(packed) // 4
        assert got[i].ids_sha256 == hashlib.sha256(packed).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert byte_bpe.encode_documents(odd(spark), PATH, P.PATTERN).count() == 5
    assert byte_bpe.encode_documents(odd(spark).limit(0), PATH, P.PATTERN).count() == 0


def slow_ppm(counts, alphabet, depth, history, byte):
    """PPM with escapes (method C) and exclusion, straight from counts {(context): {symbol: n}}."""
    p, gone = 1.0, set()
    for k in range(depth, -1, -1):
        own = {s: n for s, n in counts.get(history[len(history) - k :], {}).items() if s not in gone}
        if own:
            total = sum(own.values()) + len(own)
            if byte in own:
                return p * own[byte] / total
            p *= len(own) / total
            gone |= set(own)
    return p / (256 - len(gone) + (0 if len(gone) < 256 else 1))


def test_automaton_is_ppm():
    texts = ["abracadabra", "abrakadabra!", "über", "", "banana bandana"]
    depth = 3
    data, off = tv.string_bytes(pa.array(texts))
    keys, n = np.unique(ppm.grams(data, off, depth), return_counts=True)
    counts, flat, contexts = {}, [], set()
    for k, c in zip(keys.tolist(), n.tolist(), strict=True):
        for d in range(depth + 1):
            ctx, sym = (k >> 8) & ((1 << 8 * d) - 1), k & 255
            contexts.add((d, ctx))
            own = counts.setdefault(ctx.to_bytes(d, "big"), {})
            own[sym] = own.get(sym, 0) + c
    flat = [(0, len(ctx), int.from_bytes(ctx, "big"), s, c) for ctx, own in counts.items() for s, c in own.items()]
    a = ppm.build(tuple(zip(*contexts, strict=True)), tuple(zip(*flat, strict=True)), 1, depth)
    more = texts + ["abba", "zzz", "bandabra é"]
    data, off = tv.string_bytes(pa.array(more))
    got = ppm.score_rows(a, data, off, True)[:, 0]
    for t, x in zip(more, got, strict=True):
        raw, want = bytes([ppm.BEFORE]) * depth + t.encode() + bytes([ppm.END]), 0.0
        for i in range(depth, len(raw)):
            want += math.log10(slow_ppm(counts, None, depth, raw[:i], raw[i]))
        assert abs(want - x) < 1e-4 * max(1, abs(want)), (t, want, x)
    long = "".join(more) * 40  # lanes and a single row give the same sum
    data, off = tv.string_bytes(pa.array([long]))
    whole = ppm.score_rows(a, data, off, False)[0, 0]
    assert abs(whole - sum(math.log10(slow_ppm(counts, None, depth, (bytes([ppm.BEFORE]) * depth + long.encode())[: depth + i], b)) for i, b in enumerate(long.encode()))) < 1e-2


def test_language(spark):
    r = random.Random(1)
    en, de = ["the", "and", "of", "with", "house"], ["der", "und", "mit", "schön", "häuser"]
    rows = [(i, " ".join(r.choice(en if i % 2 else de) for _ in range(30)), "en" if i % 2 else "de", "s", 0) for i in range(80)]
    models = language_id.train(frame(spark, rows))
    langs = list(models)
    assert langs == ["de", "en"]
    tests = [(1, "the house and of", None, None, 0), (2, "und der mit häuser", None, None, 0), (3, None, None, None, 0), (4, "", None, None, 0), (5, "12 !!", None, None, 0), (6, "é", None, None, 0), (None, "und und", None, None, 0), (1, "the house and of", None, None, 0)]
    got = [(x.doc_id, x.lang_pred) for x in language_id.predict(frame(spark, tests), models).collect()]
    assert sorted(got, key=str) == sorted([(1, "en"), (1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (6, got[[x[0] for x in got].index(6)][1]), (None, "de")], key=str)
    assert dict((x for x in got if x[0] == 6))[6] in langs
    none = language_id.train(frame(spark, rows).limit(0))
    assert none == {} and {x.lang_pred for x in language_id.predict(frame(spark, tests), none).collect()} == {"und"}


def test_language_against_slow_ppm(spark):
    """Several languages, one of them rare and in a script of its own: each text's code length under every language's own tree."""
    r = random.Random(3)
    vocab = {"aa": ["abra", "kadabra", "bra"], "bb": ["Über", "öde", "abra"], "el": ["αβγ", "δελ", "γαβ"]}
    size = {"aa": 40, "bb": 30, "el": 3}
    rows = [(i, " ".join(r.choice(vocab[x]) for _ in range(12)), x, "s", 0) for i, x in enumerate(k for k, n in size.items() for _ in range(n))]
    counts: dict[str, dict[bytes, dict[int, int]]] = {}
    for _, t, lang, *_ in rows:
        raw = bytes([ppm.BEFORE]) * language_id.DEPTH + t.translate(FOLD).encode()
        for i in range(language_id.DEPTH, len(raw)):
            for k in range(language_id.DEPTH + 1):
                own = counts.setdefault(lang, {}).setdefault(raw[i - k : i], {})
                own[raw[i]] = own.get(raw[i], 0) + 1
    tests = [(i, t, None, "s", 0) for i, t in enumerate(["abra kadabra", "öde öde über", "αβγ", "γαβ δελ abra", "zebra 9", "x", "abra " * 900])]
    got = {x.doc_id: x for x in language_id.predict(frame(spark, tests), language_id.train(frame(spark, rows))).collect()}
    for i, t, *_ in tests:
        raw = bytes([ppm.BEFORE]) * language_id.DEPTH + t.translate(FOLD).encode()
        bits = {x: -sum(math.log2(slow_ppm(c, None, language_id.DEPTH, raw[:j], raw[j])) for j in range(language_id.DEPTH, len(raw))) for x, c in counts.items()}
        best = min(sorted(bits), key=bits.get)
        assert got[i].lang_pred == best and abs(got[i].bits - bits[best] / len(t.encode())) < 1e-3
        assert abs(got[i].score - 1 / sum(2.0 ** max(-1000, bits[best] - b) for b in bits.values())) < 1e-3


def test_every_language_has_contexts_of_its_own(spark, monkeypatch):
    monkeypatch.setattr(language_id, "CONTEXTS", 120)
    monkeypatch.setattr(language_id, "FEWEST_CONTEXTS", 20)
    rows = [(i, "one two three four five six seven " * 5, "big", "s", 0) for i in range(300)] + [(1000 + i, f"ж{chr(0x430 + i)} щит", f"l{i:03}", "s", 0) for i in range(24)]
    models = language_id.train(frame(spark, rows), contexts=120)
    assert len(models) == 25 and all(len(a.move) > a.width for a in models.values())
    tests = [(i, f"ж{chr(0x430 + i)} щит", None, "s", 0) for i in range(24)]
    got = {x.doc_id: x.lang_pred for x in language_id.predict(frame(spark, tests), models).collect()}
    assert sum(got[i] == f"l{i:03}" for i in range(24)) >= 20


def test_lm_scores(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "HOT", 20)
    rows = make_docs(60)
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    df = frame(spark, rows)
    got = {r.doc_id: r for r in lm_score.score(df, df.where(language_id.bucket("doc_id", 10) != 0)).collect()}
    toks = {i: WORD.findall((t or "").translate(FOLD)) + [None] for i, t, *_ in rows}
    counts = {}
    for i, w in toks.items():
        if not held(i):
            for x in w:
                counts[x] = counts.get(x, 0) + 1
    total, kinds = sum(counts.values()), len(counts)
    for i, w in toks.items():
        base = sum(math.log10((counts.get(x, 0) + 0.1) / (total + 0.1 * (kinds + 1))) for x in w)
        g = got[i]
        assert (g.n_tokens, g.n_known, g.train_tokens) == (len(w), sum(x in counts for x in w), total)
        assert abs(g.base_score - base) < 1e-6 and g.score < 0
    o = lm_score.score(odd(spark), odd(spark).limit(0)).collect()
    assert len(o) == 5 and {r.train_tokens for r in o} == {0}
    assert lm_score.score(df.limit(0), df).count() == 0


def test_lm_score_uses_every_context(spark, monkeypatch):
    """Far more contexts than an automaton of fixed size holds, looked up locally and by key."""
    r = random.Random(5)
    text = lambda k: "".join(r.choice("abcdefghijklmnopqrstuvwxyz é") for _ in range(k))
    texts = [text(1500) for _ in range(50)]
    held = ["", "xx", text(80), texts[3][100:160] + text(30), "Ω漢" + texts[7][:40].upper()]
    counts = {}
    for t in texts:
        raw = bytes([ppm.BEFORE]) * lm_score.DEPTH + t.encode() + bytes([ppm.END])
        for i in range(lm_score.DEPTH, len(raw)):
            for k in range(lm_score.DEPTH + 1):
                own = counts.setdefault(raw[i - k : i], {})
                own[raw[i]] = own.get(raw[i], 0) + 1
    assert len(counts) > 60_000
    learned = frame(spark, [(100 + i, t, "en", "s", 0) for i, t in enumerate(texts)])
    docs = frame(spark, [(i, t, "en", "s", 0) for i, t in enumerate(held + texts[:2])])
    for hot in (0, 2000, 1_000_000):
        monkeypatch.setattr(lm_score, "HOT_GRAMS", hot, raising=False)
        got = {x.doc_id: x.score for x in lm_score.score(docs, learned).collect()}
        for i, t in enumerate(held + texts[:2]):
            raw, want = bytes([ppm.BEFORE]) * lm_score.DEPTH + t.translate(FOLD).encode() + bytes([ppm.END]), 0.0
            for j in range(lm_score.DEPTH, len(raw)):
                want += math.log10(slow_ppm(counts, None, lm_score.DEPTH, raw[:j], raw[j]))
            assert abs(want - got[i]) < 1e-6 * max(1, abs(want)), (hot, i, want, got[i])


def test_long_texts(spark):
    """Texts of a million words: scored whole, one by one, as many short ones would be."""
    long = "ab cd " * 500_000
    rows = [(1, long, "en", "s", 0), (2, "x" * 2_000_000, "en", "s", 0), (3, "ab cd", "en", "s", 0)]
    df = frame(spark, rows)
    got = {x.doc_id: x for x in lm_score.score(df, df.where("doc_id = 3")).collect()}
    one = math.log10((1 + 0.1) / (3 + 0.1 * 4))
    assert (got[1].n_tokens, got[1].n_known) == (1_000_001, 1_000_001) and abs(got[1].base_score - 1_000_001 * one) < 1e-3
    assert (got[2].n_tokens, got[2].n_known) == (2, 1) and got[1].score < got[3].score < 0
    models = language_id.train(df.where("doc_id = 3"))
    assert {x.doc_id: x.lang_pred for x in language_id.predict(df, models).collect()} == {1: "en", 2: "en", 3: "en"}
    assert {x.doc_id: x.n_tokens for x in byte_bpe.encode_documents(df, PATH, P.PATTERN).collect()}[1] >= 1_000_000


def test_toxicity_grammar():
    g = toxicity.Matcher(toxicity.Grammar({"clown": 4.0}, {"foul": 3.0}))
    one = lambda t: dict(zip(toxicity.CHANNELS, g.channels(t), strict=True))
    assert one("a clown came")["plain"] == 4 and one("You are a clown!")["targeted"] == 4
    assert one("this is not a clown")["negated"] == 4 and one("he said: the judge said the clown left")["reported"] == 4
    assert one("they will kill you")["threat"] == 2 and one("foulest words")["plain"] == 3
    assert sum(one("clowning about, afoul").values()) == 0 and sum(one("").values()) == 0
    assert one("clown. " * 500)["plain"] == 2000


def test_toxicity_learns(spark):
    r = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(600):
        w = [r.choice(words) for _ in range(20)]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                w[r.randrange(20)] = r.choice(["gnarf", "blixish", "blixen", "blixor"])
        rows.append((i, " ".join(w) + ".", "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    y = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    df = frame(spark, rows)
    g = toxicity.train(df.where("doc_id < 400"), y.where("doc_id < 400"))
    out = {x.doc_id: x for x in toxicity.score(df, g).collect()}
    right = sum(out[i].predicted == (i % 4 == 0) for i in range(400, 600))
    assert right >= 196 and all(0 <= x.score <= 1 for x in out.values())
    o = toxicity.score(odd(spark), g).collect()
    assert len(o) == 5 and {x.predicted for x in o} == {0}
    assert toxicity.train(df, y.limit(0)).words and toxicity.score(df.limit(0), g).count() == 0
