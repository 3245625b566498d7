import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vialis.llm import decontaminate, mixing, ngram_join, queries, sharding

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")


def test_stages_over_all_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    kept = corpus_pipeline.known_language(spark, docs, DATA)
    assert kept.count() == docs.filter(docs["text"].rlike(r"\p{L}")).count()
    once = corpus_pipeline.one_of_each(spark, kept, DATA)
    assert once.columns == columns and ngram_join.near_copies(once).filter("n_links > 0").count() == 0
    clean = corpus_pipeline.without_benchmarks(spark, once, DATA)
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet")
    assert decontaminate.with_leaks(clean, bench).filter(F.size("leaks") > 0).count() == 0
    mixed = corpus_pipeline.mix_sources(spark, clean, DATA)
    assert mixed.columns == columns
    words = lambda df: df.agg(F.sum(mixing.n_words(F.col("text")))).first()[0]
    assert abs(words(mixed) - 1.5 * words(clean)) < 0.1 * words(clean)
    last = corpus_pipeline.assign_shards(spark, mixed, DATA)
    assert last.columns == [*columns, "shard"] and last.filter(f"shard between 0 and {sharding.SHARDS - 1}").count() == mixed.count()


def test_run_is_the_same_again(spark):
    rows = lambda: sorted(map(str, corpus_pipeline.run(spark, DATA).select("doc_id", "shard").collect()))
    assert rows() == rows()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    found, told = queries.QUERIES[name](spark, DATA), con.sql(queries.SQL[name])
    columns = sorted(told.columns)
    assert sorted(found.columns) == columns
    # Rows as Python values: a data frame would make fractions of whole numbers beside nulls.
    rows = lambda names, values: sorted(str([dict(zip(names, v, strict=True))[c] for c in columns]) for v in values)
    assert rows(found.columns, map(tuple, found.collect())) == rows(told.columns, told.fetchall())
