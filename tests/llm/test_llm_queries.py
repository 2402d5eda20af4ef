"""The registered queries against their SQL, and the pipeline against its operators."""

from __future__ import annotations

import os

import duckdb
import pytest

import corpus_pipeline
from vitrina.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    found = QUERIES[name](spark, FOLDER)
    columns = ", ".join(sorted(found.columns))
    expected = con.execute(f"SELECT {columns} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(tuple, found.select(sorted(found.columns)).collect()), key=repr) == sorted(expected, key=repr)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept, sizes = docs, []
    for _, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, FOLDER)
        assert kept.schema.names == docs.columns
        ids = [row.doc_id for row in kept.select("doc_id").collect()]
        assert len(ids) == len(set(ids))
        sizes.append(len(ids))
    assert docs.count() > sizes[0] > sizes[1] >= sizes[2] > 0
    found = corpus_pipeline.run(spark, FOLDER).collect()
    assert {row.doc_id for row in found} <= set(ids)
    assert all(row.n_tokens == len(row.ids) for row in found)
