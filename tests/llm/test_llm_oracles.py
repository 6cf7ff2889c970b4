"""Queries that SQL can express, on the small tables, against that SQL."""

import duckdb
import pytest
from llm_fixtures import SMALL

from carelens.llm.queries import llm_oracles, llm_queries


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    want = con.execute(llm_oracles()[name])
    columns = [c[0] for c in want.description]
    got = llm_queries()[name](spark, SMALL).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())
