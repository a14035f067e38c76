"""Every registered query against its independent DuckDB SQL (sf0.001):
same row count, same column names, same multiset of (normalised) rows."""

from collections import Counter

import pytest

from ledgerline.checks.compare import duck_connect, norm
from ledgerline.registry import oracle_sql, queries

QUERIES = queries()
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return duck_connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(name, spark, sf_dir, duck):
    df = QUERIES[name](spark, sf_dir)
    s_cols = df.columns
    s_rows = Counter(tuple(norm(r[c]) for c in sorted(s_cols)) for r in df.collect())
    cur = duck.execute(ORACLES[name])
    d_cols = [c[0] for c in cur.description]
    assert sorted(s_cols) == sorted(d_cols)
    idx = [d_cols.index(c) for c in sorted(s_cols)]
    d_rows = Counter(tuple(norm(r[i]) for i in idx) for r in cur.fetchall())
    assert sum(s_rows.values()) == sum(d_rows.values())
    assert s_rows == d_rows
