"""Registered queries against their SQL, and the pipeline stage by stage."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pintulog.llm import minhash, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "conversations"):
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query_equals_its_sql(spark, duck, name):
    frame = queries.QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    expected = duck.execute(queries.ORACLE[name]).df()[columns]
    assert sorted(map(tuple, frame.select(*columns).collect())) == sorted(expected.itertuples(index=False, name=None))


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    base = docs.filter("doc_id < 60")
    odd = spark.createDataFrame([(9001, None, "en", "s", 0), (9002, "", None, None, 0), (9003, "7 7 % ## " * 9, "en", "s", 81), (None, "no id at all", "en", "s", 12)], docs.schema)
    copy = base.filter("doc_id = 0").withColumn("doc_id", F.lit(9004).cast("long"))
    frame = base.union(odd).union(copy).union(base.filter("doc_id = 1"))
    ids = lambda df: sorted(r.doc_id for r in df.filter("doc_id is not null").collect())
    first = corpus_pipeline.by_language(spark, frame, SF)
    assert first.columns == docs.columns and not {9001, 9002, 9003} & set(ids(first)) and 9004 in ids(first)
    second = corpus_pipeline.without_near_copies(spark, first, SF)
    expected = sorted({r.doc_id for r in minhash.near_duplicates(first).filter("kept and doc_id is not null").collect()})
    assert second.columns == docs.columns and ids(second) == expected and 9004 not in expected
    third = corpus_pipeline.without_repeated_passages(spark, second, SF)
    assert third.columns == docs.columns and third.filter("n_chars <> length(text)").count() == 0
    packed = corpus_pipeline.into_sequences(spark, third, SF)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in third.collect()}
    empty = frame.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_of_two_texts_under_one_id_the_same_stays_in_every_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 6")
    other = docs.filter("doc_id = 3").withColumn("text", F.lit("quite another text with some words of its own under one number"))
    kept = [
        {r.doc_id: r.text for r in corpus_pipeline.without_near_copies(spark, docs.unionByName(part).repartition(n), SF).collect()}
        for part, n in ((other, 1), (other.unionByName(other), 7))
    ]
    assert kept[0] == kept[1] and len(kept[0]) == 6


def test_pipeline_stages_are_the_ones_dealt():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "minhash_near_dedup", "substring_dedup", "packing"]
