"""Every query with SQL equals DuckDB's answer on the smallest tables."""

import math
import os

import duckdb
import pytest

from palimpsest.catalogue import ORACLES, QUERIES
from palimpsest.session import prepared

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = prepared(QUERIES[name])(spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*columns).collect()), key=repr)
    if name not in ORACLES:
        assert got
        return
    with duckdb.connect() as c:
        for t in TABLES:
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
        found = c.execute(ORACLES[name])
        names = [d[0] for d in found.description]
        rows = [tuple(plain(r[names.index(k)]) for k in columns) for r in found.fetchall()]
    assert sorted(names) == columns
    assert got == sorted(rows, key=repr)
