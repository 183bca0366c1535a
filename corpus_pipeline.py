"""The corpus pipeline: language, near copies, repeated passages, packing."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pintulog.llm import language, minhash, packing, passages
from pintulog.shared import settle

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _with_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id, null included, is among ``ids``."""
    chosen = ids.select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(chosen, docs["doc_id"].eqNullSafe(chosen["__id"]), "left_semi")


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; an id is kept if any of its rows is."""
    return _with_ids(docs, language.document_languages(docs).filter("kept"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies; rows without an id all stay.

    An id stands for one document: of rows that share it, the one with the smallest digest of its
    text, then with the smallest other columns, stays, the same in every run.
    """
    kept = _with_ids(docs, minhash.near_duplicates(docs).filter("kept"))
    named = kept.filter("doc_id is not null")
    row = F.struct(F.sha2(F.coalesce("text", F.lit("")), 256).alias("__digest"), *[named[c] for c in named.columns])
    one = named.groupBy("doc_id").agg(F.min(row).alias("row")).select("row.*").select(*docs.columns)
    return one.unionByName(kept.filter("doc_id is null"))


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that another keeps; one of which nothing is left goes."""
    cut = passages.remove(docs, passages.repeats(docs))
    return cut.filter(F.trim("text") != "").withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def into_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into windows of 2048 tokens."""
    return packing.pack(packing.pieces(docs, VOCABULARY))


STAGES = [
    ("language_id", by_language),
    ("minhash_near_dedup", without_near_copies),
    ("substring_dedup", without_repeated_passages),
    ("packing", into_sequences),
]

# No SQL: the language model is fitted, and MinHash and BPE are no SQL functions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of what the stages keep of ``documents``; each stage reads what the last one wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = settle(docs)
    return docs
