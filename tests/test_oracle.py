"""Every registered query with SQL against DuckDB, on the smallest tables."""

import importlib
import os

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
plans = importlib.import_module("evidencelake.plans.queries")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(found):
    return sorted([tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in found], key=repr)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_query(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = plans.queries()[name](spark, SF)
    columns = sorted(df.columns)
    cursor = con.execute(plans.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert rows(tuple(r[c] for c in columns) for r in df.collect()) == rows(tuple(r[i] for i in at) for r in cursor.fetchall())
