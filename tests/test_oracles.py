"""Every registered query of the library's own operators against its DuckDB oracle, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from tessera.plans import corpus_queries, evidence_queries, fact_queries, import_queries, inventory_queries, matching_queries, more_queries, packet_queries, relational_queries, repair_queries, text_queries  # noqa: F401
from tessera.plans.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(rows):
    show = lambda v: None if v is None or v != v else round(float(v), 6) if isinstance(v, float) else v
    return sorted((tuple(map(show, r)) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(columns).collect()]
    if name in ORACLES:
        oracle = con.sql(ORACLES[name])
        assert sorted(oracle.columns) == columns
        assert plain(got) == plain(oracle.select(", ".join(f'"{c}"' for c in columns)).fetchall())
    else:
        assert got
