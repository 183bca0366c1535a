"""Registered queries of this subpackage, and DuckDB SQL where it can say the same."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pintulog.llm import bpe, byte_pairs, chat, language, minhash, negatives, packing, passages, prefix_trie, site_tree, topk, transducer, vectors

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
MULTI_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.document_digests(table(spark, sf_dir, "documents"), BYTE_BPE)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), BYTE_BPE))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries are the rows whose id is divisible by 50; candidates are all rows."""
    points = topk.fixed_point(table(spark, sf_dir, "embeddings"))
    return topk.top_k(points, points.filter(F.col("id") % 50 == 0), 5)


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_tree.page_texts(table(spark, sf_dir, "pages"))


def op5_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"), 0.95)


def op6_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only stretches to remove, so documents without any are not in the result."""
    return passages.repeats(table(spark, sf_dir, "documents"))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.document_counts(table(spark, sf_dir, "documents"), WORD_BPE)


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and number -7, whose texts hold another template's control strings."""
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    strange = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", strange), (-7, 1, "assistant", strange)], told.schema)
    return chat.conversation_digests(told.union(extra))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.document_languages(table(spark, sf_dir, "documents"))


def op11_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_pairs.document_digests(table(spark, sf_dir, "documents"), MULTI_BPE)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose id is divisible by 100; positives and negatives come from all rows."""
    points = negatives.labelled_points(table(spark, sf_dir, "embeddings"))
    return negatives.hard_negatives(points, points.filter(F.col("id") % 100 == 0))


def page_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.page_languages(table(spark, sf_dir, "pages"))


TOPK_SQL = """
with points as (
  select distinct vec_id, [floor(256 * cast(x as double)) for x in embedding] as v from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
  from points q join points c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0
), ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_packing": op2_packing,
    "op3_topk": op3_topk,
    "op4_main_text": op4_main_text,
    "op5_vector_dedup": op5_vector_dedup,
    "op6_passage_dedup": op6_passage_dedup,
    "op7_minhash_dedup": op7_minhash_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_chat_format": op9_chat_format,
    "op10_language_id": op10_language_id,
    "op11_byte_pairs": op11_byte_pairs,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_hard_negatives": op13_hard_negatives,
    "page_language_id": page_language_id,
}

ORACLE: dict[str, str] = {
    "op3_topk": TOPK_SQL,
    "op9_chat_format": chat.CONVERSATIONS_SQL,
    "op12_prefix_trie": prefix_trie.TRIE_SQL,
    "op13_hard_negatives": negatives.NEGATIVES_SQL,
}
