"""Every registered query of the engine against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

from captionloom.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path if os.path.isfile(path) else path + '/*.parquet'}')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if v is not None and not isinstance(v, (bool, int, str)):
        return plain(float(v)) if hasattr(v, "as_tuple") else str(v)
    return v


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_its_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    got = sorted(repr(tuple(plain(x) for x in r)) for r in df.select(*sorted(df.columns)).collect())
    assert got
    found = duck.execute(registry.oracle_sql()[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(range(len(names)), key=lambda k: names[k])
    assert got == sorted(repr(tuple(plain(r[k]) for k in order)) for r in found.fetchall())
