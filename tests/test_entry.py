import os

import duckdb
import pytest

import __spark_entry__ as entry
from folioforge.plans import queries as plan

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations".split()
def rows(found):
    return sorted(repr(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in found)


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(plan.QUERIES) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", sorted(plan.ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = entry.queries()[name](spark, SF)
    names = sorted(df.columns)
    assert rows(tuple(r) for r in df.select(*names).collect()) == rows(con.sql(f"SELECT {', '.join(names)} FROM ({entry.oracle_sql()[name]})").fetchall())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_flagship(spark):
    assert entry.entry(spark).count() > 0
