"""Documents to training tokens: language, near-duplicates, repeated passages, benchmark leaks, encoding.

Each stage takes the documents that its predecessor kept, whole, and its decisions take effect. All stages
but the last return the columns of ``documents``.

Defined cases of all stages: every row is a document of its own, also where ids are missing or repeated; of documents that
are compared, those with smaller ids are the earlier ones, those without an id the last; columns beyond those of ``documents`` are left out;
null and empty texts are texts without words; very long texts are taken whole; an empty table gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm import byte_bpe, decontaminate, jaccard_join, language_id, substring_dedup
from strandlake.runtime import cut, rows_with, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Bits of a byte without a model, and bits by which the shortest code of a text exceeds these if it is in none of the learned languages.
PLAIN, BEYOND = 8.0, 64.0


def _with_own_ids(docs: DataFrame) -> DataFrame:
    """The documents with an id of its own for each row as ``doc_id``, in the order of the given ids, which stay as ``given_id``.

    Where the given ids are one for each row they are these; else the rows are numbered along them, those without an id last.
    """
    docs = docs.select(*COLUMNS)
    odd = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null").limit(1).count()
    if not odd:
        return docs.withColumn("given_id", F.col("doc_id"))
    order = docs.orderBy(F.col("doc_id").asc_nulls_last(), F.xxhash64("text", "lang", "source"))
    return cut(order.withColumnRenamed("doc_id", "given_id").withColumn("doc_id", F.monotonically_increasing_id()))  # written once, so an id stays


def _given(docs: DataFrame) -> DataFrame:
    return docs.drop("doc_id").withColumnRenamed("given_id", "doc_id").select(*COLUMNS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no language: null texts, texts without a letter, and texts whose code is longer than plain bytes under every learned language,
    by a margin that a few odd characters of a short text do not reach.

    Documents that stay and have no ``lang`` get the one found. Without any learned language, texts without a letter go and the others stay as they are.
    """
    docs = docs.select(*COLUMNS)
    models = language_id.train(docs)
    if not models:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language_id.predict(docs, models, keep=COLUMNS)
    excess = (F.col("bits") - PLAIN) * F.octet_length("text")
    stay = found.where((F.col("lang_pred") != language_id.UNKNOWN) & (excess < BEYOND))
    return stay.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each group linked by 0.8 Jaccard similarity of five-word shingles; texts without words are no copies of each other."""
    own = _with_own_ids(docs)
    groups = jaccard_join.components(own, 5, 80)
    return _given(rows_with(own, groups.where("doc_id = component_id").select("doc_id"), "doc_id"))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out passages of 50 words and more that an earlier document has too; documents of which nothing is left go, ``n_chars`` follows the text."""
    return _given(substring_dedup.without_repeats(_with_own_ids(docs)))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a whole window of eight words, or all words of a shorter item, of the benchmark."""
    own = _with_own_ids(docs)
    found = decontaminate.find(own, table(spark, sf_dir, "benchmark"), 8, 1)
    return _given(decontaminate.rows_without(own, found.where("contaminated").select("doc_id")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row's text, with their digest and that of the bytes they decode to; a null text has none."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encode_documents(docs, path, public_tokenizers.PATTERN, with_ids=True, keep=["lang", "source", "n_chars"])


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("substring dedup", drop_repeated_passages),
    ("benchmark decontamination", drop_leaks),
    ("byte-level BPE", encode),
]

#: Language models, passages and tokens are beyond SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
