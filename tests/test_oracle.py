"""Every registered query against its DuckDB oracle on sf0.001 (the driver's gate runs sf0.01)."""
import os

import duckdb
import pytest

from tests.conftest import SF_SMALL

from tools.check_oracle import TABLES, frame_key  # noqa: E402

from marginflow.plans import all_queries

QUERIES, ORACLE = all_queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL).toPandas()
    if name not in ORACLE:
        pytest.skip("no SQL oracle for this operator")
    odf = con.execute(ORACLE[name]).df()
    sc, sr = frame_key(sdf)
    oc, orows = frame_key(odf)
    assert sc == oc
    assert len(sr) == len(orows)
    assert sr == orows


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
