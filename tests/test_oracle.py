"""Every catalog query against its DuckDB oracle on the sf0.001 tables."""
import math

import duckdb
import pytest

from logscope.plans.catalog import QUERIES
from logscope.plans.oracle import ORACLE

from conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _key(row):
    return tuple((v is None, str(v)) for v in row)


def _same(a, b):
    if isinstance(a, float) or isinstance(b, float):
        if a is None or b is None:
            return a is b
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)
    return a == b


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    scols = df.columns
    srows = [tuple(r) for r in df.collect()]
    rel = con.execute(ORACLE[name])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(scols) == sorted(dcols)
    si = sorted(range(len(scols)), key=lambda i: scols[i])
    di = sorted(range(len(dcols)), key=lambda i: dcols[i])
    s = sorted((tuple(r[i] for i in si) for r in srows), key=_key)
    d = sorted((tuple(r[i] for i in di) for r in drows), key=_key)
    assert len(s) == len(d)
    for x, y in zip(s, d):
        assert all(_same(a, b) for a, b in zip(x, y)), (x, y)


def test_every_query_but_random_draws_has_an_oracle():
    assert set(QUERIES) - set(ORACLE) == {"sample_lines_random"}
