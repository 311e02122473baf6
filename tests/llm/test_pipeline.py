"""The pipeline's stages, each against its own input, and the queries with SQL against DuckDB."""

import duckdb
import pytest

import corpus_pipeline
from quarry.llm import decontaminate, ngramjoin, registry

SF = "/root/testdata/sf0.001"


def test_stages_follow_their_decisions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        done = stage(spark, docs, SF).cache()
        assert done.columns == columns and 0 < done.count() <= docs.count(), name
        if name == "near_duplicates":
            classes = ngramjoin.near_duplicates(docs)
            assert done.count() == classes.select("class_id").distinct().count()
        if name == "benchmark":
            assert decontaminate.leaks(done, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
        docs = done
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert mixed.count() == docs.count() and mixed.where("taken > 3 * size").count() == 0


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = registry.QUERIES[name](spark, SF)
    res = con.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in res.description]
    assert sorted(map(str, (tuple(r[n] for n in names) for r in got.collect()))) == sorted(map(str, res.fetchall()))
