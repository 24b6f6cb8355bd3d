"""The driver's contract: names, flagship, and that the queries match their SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from wickworks.plans import registry

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.queries()) <= set(entry.queries())


def test_flagship(spark):
    out = entry.entry(spark)
    assert len(out.columns) == 130 and out.count() > 0


def plain(rows):
    return sorted(str([None if v is None or isinstance(v, float) and math.isnan(v) else v for v in r]) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(spark, duck, name):
    got = registry.queries()[name](spark, SMALL)
    cols = sorted(got.columns)
    cursor = duck.execute(registry.oracle_sql()[name])
    found = [d[0] for d in cursor.description]
    assert sorted(found) == cols
    want = [tuple(r[found.index(c)] for c in cols) for r in cursor.fetchall()]
    assert plain(tuple(r[c] for c in cols) for r in got.collect()) == plain(want)
