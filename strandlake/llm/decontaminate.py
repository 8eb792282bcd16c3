"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

Every item is cut into windows of consecutive words, and every window is a set of word shingles. The shingles
are ordered by rarity in the corpus; as a window must be contained whole, its rarest shingle alone is a
sufficient prefix. Documents are joined with the windows on that shingle; its place in the window fixes where
an occurrence would start, which the length bound (start and end within the document) and then the
words themselves must meet, so what is left is exact. Case folding by ``lower`` only serves the candidate join (equal
words stay equal under it); the verification folds A-Z alone.

The corpus is read twice: once for the places of all benchmark shingles, which give both their rarity and the
candidates, and once to verify. Sides are broadcast only if counted to be small, else joined by shuffle.

Defined cases: null and empty texts have no words, no hits and are not contaminated; very long texts are read whole; repeated documents, and
rows of one id with different texts, are judged each by itself; of equally rare shingles the one with the smaller hash is the prefix, which changes no
result; repeated items are items of their own if their ids differ; items with no words have no
window; empty tables on either side give no hits; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.runtime import cut, hinted, release

#: Everything that is not a word character: ASCII other than digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a shingle.
SHINGLE = 3


def pieces(text: Column) -> Column:
    """Words of the lower-cased text; the first and the last may be empty where the text begins or ends with separators."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS)


def number_of_words(p: Column) -> Column:
    ends = F.when(p[0] == "", 1).otherwise(0) + F.when((F.size(p) > 1) & (F.element_at(p, -1) == ""), 1).otherwise(0)
    return F.size(p) - ends


def fold(word: Column) -> Column:
    return F.translate(word, _UPPER, _LOWER)


def windows_of(items: DataFrame, width: int) -> DataFrame:
    """``ws`` (exactly folded words), ``low`` (lower-cased words), ``items`` (sorted ids) of every distinct window."""
    words = F.filter(F.split(fold(F.coalesce(F.col("text").cast("string"), F.lit(""))), SEPARATORS), lambda w: w != "")
    own = items.select(F.col("item_id").alias("item_id"), words.alias("w")).where(F.size("w") > 0)
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - width + 1)))
    cutout = own.select("item_id", "w", starts.alias("s")).select("item_id", F.slice("w", F.col("s"), F.lit(width)).alias("ws"))
    return cutout.groupBy("ws").agg(F.sort_array(F.collect_set("item_id")).alias("items"))


def _shingles(over: Column, words: Column, size: int) -> Column:
    """Hashes of the ``size`` words from each place of ``over`` on, which is ``words`` or a beginning of it."""
    return F.transform(over, lambda w, i: F.xxhash64(w, *[F.get(words, i + j) for j in range(1, size)]))


def find(docs: DataFrame, items: DataFrame, width: int = 8, least_items: int = 2) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every document row."""
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    windows = hinted(windows_of(items, width).select("ws", "items", F.transform("ws", F.lower).alias("low"), F.least(F.size("ws"), F.lit(SHINGLE)).alias("q")))
    placed = spots = None
    for q in range(1, SHINGLE + 1):  # windows of fewer words than a shingle are shingles of their own size
        own = windows.where(F.col("q") == q)
        if not own.limit(1).count():
            continue
        of_window = _shingles(F.slice("low", F.lit(1), F.size("low") - q + 1), F.col("low"), q)
        p = own.select("ws", "items", F.posexplode(of_window).alias("place", "shingle"))
        of_doc = _shingles(F.col("p"), F.col("p"), q)
        s = base.select("doc_id", pieces(F.col("text")).alias("p")).select("doc_id", F.posexplode(of_doc).alias("at", "shingle"))
        s = s.join(hinted(p.select("shingle").distinct()), "shingle")
        placed, spots = (p, s) if placed is None else (placed.union(p), spots.union(s))
    if placed is None:
        n = number_of_words(pieces(F.col("text"))).cast("bigint")
        none = F.lit(0).cast("bigint")
        return base.select("doc_id", n.alias("n_words"), none.alias("n_hit"), none.alias("n_items"), F.sha2(F.lit(""), 256).alias("items_sha256"), F.lit(least_items <= 0).alias("contaminated"))
    spots = cut(spots)
    release(docs.sparkSession)  # the driver holds large plans of the steps before, and in a pipeline of the stages before
    rarity = spots.groupBy("shingle").agg(F.count("*").alias("n"))
    ranked = placed.join(hinted(rarity), "shingle")  # a window with a shingle that no document has is nowhere
    rarest = ranked.groupBy("ws", "items").agg(F.count("*").alias("known"), F.min(F.struct("n", "shingle", "place")).alias("prefix"))
    whole = F.col("known") == F.size("ws") - F.least(F.size("ws"), F.lit(SHINGLE)) + 1
    prefix = hinted(rarest.where(whole).select(F.col("prefix.shingle").alias("shingle"), F.col("prefix.place").alias("place"), "ws", "items"))
    slim = prefix.select("shingle", "place", F.xxhash64("ws").alias("window"), F.size("ws").alias("length"))
    candidates = spots.join(slim, "shingle").where(F.col("at") >= F.col("place"))
    starts = candidates.select("doc_id", F.struct((F.col("at") - F.col("place") + 1).alias("s"), "length", "window").alias("c"))
    per_doc = hinted(starts.groupBy("doc_id").agg(F.collect_set("c").alias("cs")))
    p = F.col("p")
    cut_out = lambda c: F.transform(F.slice(p, c["s"], c["length"]), fold)
    seen = F.filter(
        F.transform("cs", lambda c: F.struct(c["s"].alias("s"), c["window"].alias("window"), cut_out(c).alias("ws"))),
        lambda c: F.xxhash64(c["ws"]) == c["window"],
    )
    joined = base.withColumnRenamed("doc_id", "id").join(per_doc, F.col("id").eqNullSafe(F.col("doc_id")), "left")
    joined = joined.select(F.col("id").alias("doc_id"), F.split(F.coalesce("text", F.lit("")), SEPARATORS).alias("p"), "cs")
    found = F.when(F.col("cs").isNotNull(), F.transform(seen, lambda c: F.struct(c["s"].alias("s"), c["ws"].alias("ws"))))
    rows = cut(joined.select("doc_id", number_of_words(p).cast("bigint").alias("n_words"), found.alias("found")))
    release(docs.sparkSession)
    rows = rows.withColumn("row", F.monotonically_increasing_id())  # of a checkpoint, so the same whenever it is read
    hits = rows.where(F.size("found") > 0).select("row", F.explode("found").alias("f")).select("row", "f.s", "f.ws")
    hits = hits.join(prefix.select("ws", "items"), "ws")  # equal as whole lists of words
    places = hits.select("row", F.explode(F.sequence(F.col("s"), F.col("s") + F.size("ws") - 1)).alias("at"))
    n_hit = places.distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    named = hits.select("row", F.explode("items").alias("item")).distinct().groupBy("row").agg(F.collect_list(F.col("item").cast("string")).alias("names"))
    names = F.array_sort(F.coalesce("names", F.array().cast("array<string>")))
    out = rows.select("row", "doc_id", "n_words").join(n_hit, "row", "left").join(named, "row", "left")
    return out.select(
        "doc_id", "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.size(names).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.size(names) >= least_items).alias("contaminated"),
    )


def rows_without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents whose id is not among ``ids`` (those without an id stay); the ids are broadcast only if counted to be few."""
    return docs.join(hinted(ids.where("doc_id is not null").distinct()), "doc_id", "left_anti")
