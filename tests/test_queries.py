"""Every query of the library against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from spanlink.plans.queries import ORACLE_SQL, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.10g}")
    return float(v) if isinstance(v, int) and not isinstance(v, bool) else v


def rows(names, values):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(r[k]) for k in order) for r in values), key=str)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL) and len(QUERIES) >= 50


@pytest.mark.parametrize("name", QUERIES)
def test_equals_sql(spark, db, name):
    got = QUERIES[name](spark, SF)
    want = db.execute(ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(names, want.fetchall())
