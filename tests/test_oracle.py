"""Every registered query against its DuckDB statement on the smallest
generated tables (the driver's gate runs the same comparison at sf0.01)."""
import os
import sys

import duckdb
import pytest

import __spark_entry__ as E

from conftest import SF001

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "tools"))
import oracle_check as OC  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in OC.TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF001)
    mine = OC.canon(df.columns, [tuple(r) for r in df.collect()])
    r = OC.as_view(duck, key, E.oracle_sql()[key])
    assert sorted(df.columns) == sorted(r.columns)
    assert not OC.type_differences(df, r)
    assert mine == OC.canon(r.columns, r.fetchall())
