"""Registered queries against their DuckDB SQL."""

import duckdb
import pytest

from brindle.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_matches_sql(spark, name):
    folder, con = "/root/testdata/sf0.01", duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    found = con.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in found.description]
    df = queries.QUERIES[name](spark, folder)
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*names).collect()), key=repr) == sorted(found.fetchall(), key=repr)
