"""Every registered query against its SQL in DuckDB, over the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from vitrina.plans import oracle, registry
from vitrina.sources.schemas import TABLES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) or (math.isnan(a) and math.isnan(b))
    return a == b


@pytest.mark.parametrize("key", sorted(oracle.oracle_sql()))
def test_query_equals_its_sql(spark, duck, key):
    df = registry.QUERIES[key](spark, FOLDER)
    columns = sorted(df.columns)
    found = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    result = duck.execute(f"SELECT {', '.join(columns)} FROM ({oracle.oracle_sql()[key]})")
    types = {d[0]: str(d[1]) for d in result.description}
    expected = sorted(result.fetchall(), key=repr)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == types
    assert len(found) == len(expected)
    different = [(a, b) for a, b in zip(found, expected, strict=True) if not all(map(same, a, b))]
    assert not different, different[:3]


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0


def test_only_model_fits_lack_sql():
    without = set(registry.QUERIES) - set(oracle.oracle_sql())
    assert without == {
        "kmeans_elbow", "kmeans_best_k", "kmeans_segments", "cluster_profile", "churn_forest", "churn_importance", "churn_report",
        "churn_tree", "churn_cv",
    }
