"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm import byte_bpe, decontaminate, embedding_dups, html_text, jaccard_join, language_id, lm_score, substring_dedup, toxicity, url_filter
from strandlake.llm.language_id import bucket
from strandlake.runtime import table

RANKS = "byte_bpe_multi_50k.tiktoken"


#: Stated rules: hosts with all their subdomains, and the beginning of a path.
URL_RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page by the stated rules, else by mined association rules."""
    pages, labels = table(spark, sf_dir, "pages").select("page_id", "url"), table(spark, sf_dir, "labels")
    return url_filter.judge(pages, URL_RULES, url_filter.mine(url_filter.labelled_urls(pages, labels)))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, learned from labelled rows whose bucket of 5 is not 0."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    grammar = toxicity.train(docs.where(bucket("doc_id", 5) != 0), labels.where(bucket("doc_id", 5) != 0))
    return toxicity.score(docs, grammar).select("doc_id", (bucket("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, learned from pages whose document is known and from generated layouts."""
    pages, docs = table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents")
    return html_text.extract(pages, html_text.train(pages, docs))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes of every whole text."""
    docs = table(spark, sf_dir, "documents")
    return byte_bpe.encode_documents(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of three-word shingles have a Jaccard similarity of 0.9."""
    return jaccard_join.components(table(spark, sf_dir, "documents"), 3, 90)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of 8 words in every whole text."""
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 8, 2)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learned from labelled rows whose bucket of 4 is not 2."""
    docs = table(spark, sf_dir, "documents")
    found = language_id.predict(docs, language_id.train(docs.where(bucket("doc_id", 4) != 2)))
    return found.select("doc_id", (bucket("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every whole text, learned from all texts whose bucket of 10 is not 0."""
    docs = table(spark, sf_dir, "documents")
    found = lm_score.score(docs, docs.where(bucket("doc_id", 10) != 0))
    return found.select("doc_id", (bucket("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that an earlier document has too."""
    return substring_dedup.passages(table(spark, sf_dir, "documents"))


def op10_embedding_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and classes of all vectors at a cosine of 0.9."""
    return embedding_dups.near_duplicates(table(spark, sf_dir, "embeddings"), 0.9)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filter": op1_url_filter,
        "op2_toxicity": op2_toxicity,
        "op3_html_text": op3_html_text,
        "op4_byte_bpe": op4_byte_bpe,
        "op5_jaccard_join": op5_jaccard_join,
        "op6_decontaminate": op6_decontaminate,
        "op7_language_id": op7_language_id,
        "op8_lm_score": op8_lm_score,
        "op9_substring_dedup": op9_substring_dedup,
        "op10_embedding_dups": op10_embedding_dups,
    }


#: The same windows by brute force: every window of every document, of each length that items have.
OP6_SQL = r"""
with folded as (
  select 'd' as side, doc_id as id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as w from documents
  union all
  select 'b', item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') from benchmark
), win as (
  select distinct id as item_id, least(8, len(w)) as k, array_to_string(list_slice(w, s, s + least(8, len(w)) - 1), ' ') as t
  from (select id, w, unnest(generate_series(1, greatest(1, len(w) - 7))) as s from folded where side = 'b' and len(w) > 0)
), docwin as (
  select id as doc_id, k, s, array_to_string(list_slice(w, s, s + k - 1), ' ') as t
  from (select id, w, k, unnest(generate_series(1, len(w) - k + 1)) as s from folded cross join (select distinct k from win) where side = 'd' and len(w) >= k)
), hit as (
  select doc_id, item_id, d.k, s from docwin d join win using (k, t)
), places as (
  select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(generate_series(s, s + k - 1)) as p from hit) group by doc_id
), named as (
  select doc_id, count(*) as n_items, string_agg(i, ',' order by i) as names from (select distinct doc_id, cast(item_id as varchar) as i from hit) group by doc_id
)
select f.id as doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_items, 0) >= 2 as contaminated
from folded f left join places on f.id = places.doc_id left join named on f.id = named.doc_id where side = 'd'
"""


#: Links by brute force: shared shingles of every pair of documents that has any.
OP5_SQL = r"""
with recursive words as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents
), sets as (
  select distinct doc_id, array_to_string(list_slice(w, s, s + least(3, len(w)) - 1), ' ') as t
  from (select doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 2))) as s from words where len(w) > 0)
), sizes as (
  select doc_id, count(*) as n from sets group by doc_id
), links as (
  select a, b from (select x.doc_id as a, y.doc_id as b, count(*) as k from sets x join sets y on x.t = y.t and x.doc_id <> y.doc_id group by 1, 2) p
  join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * k >= 90 * (x.n + y.n - k)
), reach(node, other) as (
  select doc_id, doc_id from sizes union select r.node, l.b from reach r join links l on l.a = r.other
), least_ as (
  select node, min(other) as c from reach group by node
)
select w.doc_id, coalesce(n, 0) as n_shingles, coalesce(c, w.doc_id) as component_id from words w left join sizes s on s.doc_id = w.doc_id left join least_ l on l.node = w.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_jaccard_join": OP5_SQL, "op6_decontaminate": OP6_SQL}
