"""URL filtering by stated host/path rules first, then by association rules mined with FP-growth.

Labelled URLs become transactions of URL tokens plus a label item; Spark's FP-growth mines frequent sets, and
rules towards the label are kept by support and confidence, less those that a shorter rule of at least the same
confidence covers. Nothing but the labels says which URLs are unwanted: without a rule that they support, nothing is mined. Tokens come from the whole URL; frequent ones that come in the same labelled URLs are one item, so URLs with many
tokens in common do not give a set for each choice of them. Each kept rule hangs in an inverted index under its
rarest token; a URL looks up its own tokens only.

Defined cases: a null URL or one without ``://`` has an empty host and path, no rule and is allowed; very long URLs are
read whole; repeated rows are judged each by itself; of stated rules of the same length the one that sorts first wins, of mined rules the
surest, then the best supported, then the one that sorts first; extra columns are ignored; null ids are carried along; without labels nothing is
mined and the stated rules alone decide; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.runtime import giving_back

#: Labelled URLs learned from (expected, picked by hash), least share and number of URLs with a rule's tokens and label, least confidence.
LABELLED_ROWS, LEAST_SUPPORT, LEAST_ROWS, LEAST_CONFIDENCE = 50_000, 0.002, 20, 0.8
BLOCK = "label=block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def stated_rule(h: Column, p: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Struct ``verdict, rule`` of the longest rule ``(verdict, host/path)`` that fits the host or a parent of it, or null."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        at, tail = rule.split("/", 1)
        fits = ((h == at) | F.endswith(h, F.lit("." + at))) & F.startswith(p, F.lit("/" + tail))
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def tokens(url: str | None) -> list[str]:
    """Distinct tokens of a URL: scheme, top domain, host labels and their words, folders, words and ending of the last segment, query names, fragment."""
    m = re.match(r"(?s)(.*?)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?", url or "")
    if not m:
        return []
    scheme, h, p, q, frag = (x or "" for x in m.groups())
    labels = h.translate(str.maketrans(_UPPER, _LOWER)).split(":")[0].split(".")
    out = {f"scheme={scheme}", f"top={labels[-1]}"} | {f"host={x}" for x in labels[:-1]}
    out |= {f"word={w}" for x in labels[:-1] if "-" in x for w in x.split("-") if w}
    folders = [x for x in p.split("/") if x]
    out |= {f"folder={x}" for x in folders[:-1] if not x.isdigit()}
    if folders:
        name, dot, end = folders[-1].rpartition(".")
        if dot:
            out.add("end=" + end)
        out |= {f"name={w}" for w in re.split(r"[\W_]+", name if dot else end) if w and not w.isdigit()}
    out |= {"query=" + x.split("=", 1)[0] for x in q[1:].split("&") if x}
    return sorted(out | ({"fragment"} if frag else set()))


@dataclass
class Index:
    """Rules by their rarest token: ``(tokens, confidence, support)``; ``same`` has the token that stands for another one that comes with it."""

    by_token: dict[str, list[tuple[frozenset, float, int]]]
    same: dict[str, str] = field(default_factory=dict)

    def match(self, own: list[str]) -> tuple[str, float] | None:
        have, best = {self.same.get(t, t) for t in own}, None
        for t in have:
            for items, confidence, support in self.by_token.get(t, ()):
                if items <= have and (best is None or (-confidence, -support, sorted(items)) < best[0]):
                    best = ((-confidence, -support, sorted(items)), confidence)
        return best and (" & ".join(best[0][2]), best[1])


def mine(labelled: DataFrame, rows: int = LABELLED_ROWS) -> Index:
    """Rules from rows ``(url, blocked boolean)``."""
    known = labelled.where("url is not null and blocked is not null")
    n = known.count()
    if not n:
        return Index({})
    picked = known.where(F.pmod(F.xxhash64("url"), F.lit(1_000_000)) < min(1.0, rows / n) * 1_000_000)

    def baskets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            items = [tokens(u) + [BLOCK] * bool(x) for u, x in zip(b.column("url").to_pylist(), b.column("blocked").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.list_(pa.string()))], names=["items"])

    sets = picked.select("url", "blocked").mapInArrow(giving_back(baskets), "items array<string>").where(F.size("items") > 0).withColumn("nth", F.monotonically_increasing_id()).persist()
    total = sets.count()
    if not total:
        return Index({})
    least = max(LEAST_SUPPORT, LEAST_ROWS / total)
    same = _same(sets, least * total)

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            items = [sorted({same.get(t, t) for t in x}) for x in b.column("items").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.list_(pa.string()))], names=["items"])

    whole, sets = sets, sets.select("items").mapInArrow(giving_back(folded), "items array<string>").persist()
    frequent = FPGrowth(itemsCol="items", minSupport=min(1.0, least), minConfidence=LEAST_CONFIDENCE).fit(sets).freqItemsets.persist()
    with_label = frequent.where(F.array_contains("items", BLOCK) & (F.size("items") > 1))
    with_label = with_label.select(F.array_sort(F.array_remove("items", BLOCK)).alias("ante"), F.col("freq").alias("both"))
    alone = frequent.select(F.array_sort("items").alias("ante"), F.col("freq").alias("n"))
    rules = with_label.join(alone, "ante").select("ante", "both", (F.col("both") / F.col("n")).alias("confidence")).where(F.col("confidence") >= LEAST_CONFIDENCE)
    found = rules.orderBy(F.size("ante"), F.desc("confidence"), F.desc("both"), "ante")
    # every token here is in a share LEAST_SUPPORT of the sample's URLs, so there are no more than the sample's rows and URL lengths allow
    single = {r["items"][0]: r["freq"] for r in frequent.where(F.size("items") == 1).collect()}
    by_token: dict[str, list[tuple[frozenset, float, int]]] = {}
    for r in found.toLocalIterator():  # shorter rules first: a longer one must be surer than every rule inside it
        items = frozenset(r.ante)
        inside = (x for t in items for x in by_token.get(t, ()) if x[0] < items)
        if all(r.confidence > c for _, c, _ in inside):
            by_token.setdefault(min(items, key=lambda t: (single.get(t, 0), t)), []).append((items, r.confidence, r.both))
    for x in (frequent, sets, whole):
        x.unpersist()
    return Index(by_token, same)


def _same(sets: DataFrame, least: float) -> dict[str, str]:
    """For tokens in ``least`` rows and more that come in the same rows as one that sorts before them, the first of these."""
    rows = sets.select(F.explode("items").alias("t"), F.xxhash64("nth").alias("h")).where(F.col("t") != BLOCK)
    often = rows.groupBy("t").agg(F.count("*").alias("n"), F.bit_xor("h").alias("h")).where(F.col("n") >= least)
    classes = often.groupBy("n", "h").agg(F.array_sort(F.collect_list("t")).alias("ts")).where(F.size("ts") > 1).collect()
    return {t: r.ts[0] for r in classes for t in r.ts[1:]}


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``url, blocked``: a page is blocked if its document (the number that ends its path) is labelled toxic or of low quality; pages
    without a labelled document are left out."""
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.coalesce((F.col("toxic") == 1) | (F.col("quality") == 0), F.lit(False))).alias("blocked"))
    urls = pages.where("url is not null").select("url", F.regexp_extract(path(F.col("url")), r"/(\d{1,18})(?:\.\w+)?/?$", 1).try_cast("bigint").alias("doc_id"))
    return urls.join(marks, "doc_id").select("url", "blocked")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], index: Index) -> DataFrame:
    """``page_id, host, path, rule, verdict, mined_rule, confidence`` of every row."""
    shared = pages.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idx = shared.value
        for b in batches:
            hits = [idx.match(tokens(u)) for u in b.column("url").to_pylist()]
            cols = [b.column("page_id"), b.column("url"), pa.array([h and h[0] for h in hits], pa.string()), pa.array([h and h[1] for h in hits], pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, names=["page_id", "url", "mined_rule", "confidence"])

    found = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"))
    found = found.mapInArrow(giving_back(run), "page_id bigint, url string, mined_rule string, confidence double")
    found = found.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), "mined_rule", "confidence")
    stated = stated_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")
    return found.select("page_id", "host", "path", stated.alias("s"), own.alias("own"), "mined_rule", "confidence").select(
        "page_id", "host", "path", F.col("s.rule").alias("rule"), F.coalesce("s.verdict", "own").alias("verdict"), "mined_rule", "confidence"
    )
