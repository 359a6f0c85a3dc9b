"""Every registered query against its SQL counterpart on the smallest driver tables."""

import os

import pytest

from oracle_sql import ORACLES
from premia.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    got = sorted((tuple(r[c] for c in order) for r in df.collect()), key=repr)
    expected = sorted((tuple(r[names.index(c)] for c in order) for r in cursor.fetchall()), key=repr)
    assert got == expected
