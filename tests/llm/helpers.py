from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def make_docs(n=120, seed=1):
    """Random texts with exact copies, near copies, shared passages and odd rows."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 6))) for _ in range(400)]
    text = lambda k: " ".join(r.choice(vocab) for _ in range(k))
    out = [text(r.randint(1, 160)) for _ in range(n)]
    passage = text(70)
    for i in range(0, n, 9):
        out[i] = out[r.randrange(n)]
    for i in range(4, n, 7):
        w = out[r.randrange(n)].split(" ")
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = r.choice(vocab)
        out[i] = " ".join(w)
    for i in range(5, n, 11):
        out[i] = text(30) + " " + passage + " " + text(20)
    out += [None, "", " \n\t", "A", "Ünïcödé 漢字 😀", "x " * 300, "!!! ???"]
    return [(i, t, "en" if i % 3 else "de", "s", len(t or "")) for i, t in enumerate(out)]


def frame(spark, rows):
    """The documents with further columns whose names clash with those that operators use inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.select("*", *[F.lit(f"extra {c}").alias(c) for c in ("id", "key", "n", "fp", "sig", "block", "row", "word", "at", "seed", "score", "component", "p", "cs", "spans_")])


def odd(spark):
    """Repeated rows, a null id, null and empty texts."""
    return frame(spark, [(1, "one two three four five six seven eight", "en", "s", 5), (1, "one two three four five six seven eight", "en", "s", 5), (None, "one two three", None, None, None), (2, None, None, None, None), (3, "", "en", None, 0)])


def jaccard_components(docs, n, percent):
    sets = {}
    for i, t, *_ in docs:
        w = WORD.findall((t or "").translate(FOLD))
        k = min(n, len(w))
        sets[i] = frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if w else frozenset()
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                a, b = find(x), find(y)
                up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}
