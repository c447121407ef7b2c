"""The operators that SQL can express, against their DuckDB SQL on the whole tables of sf0.01."""

import duckdb
import pytest

from costframe.llm import queries
from tools.oracle_check import TABLES, rows_of

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    want = duck.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert len(got) == 1000 and got == rows_of(columns, want.fetchall())
