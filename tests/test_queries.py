"""Every registered query against its SQL twin, over the whole smallest tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

import __spark_entry__ as entry  # noqa: E402
from tools.compare import TABLES, normal, same  # noqa: E402


@pytest.fixture(scope="module")
def con():
    import duckdb
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    if name not in entry.oracle_sql():
        assert len(got) > 0
        return
    (c1, r1), (c2, r2) = normal(got), normal(con.execute(entry.oracle_sql()[name]).df())
    assert c1 == c2
    assert len(r1) == len(r2)
    assert all(same(a, b) for x, y in zip(r1, r2) for a, b in zip(x, y))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
