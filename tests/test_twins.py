"""Every query with SQL against DuckDB on the smallest tables."""

import glob
import math
import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def rows(data, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in data), key=repr)


def same(a, b):
    return a == b or isinstance(a, float) and isinstance(b, float) and (math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) or a != a and b != b)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_against_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = rows(map(tuple, df.collect()), df.columns)
    rel = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    want = rows(rel.fetchall(), names)
    assert sorted(names) == sorted(df.columns) and len(got) == len(want)
    assert all(same(x, y) for g, w in zip(got, want) for x, y in zip(g, w))


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs(spark, name):
    df = entry.queries()[name](spark, SF)
    assert df.schema == entry.queries()[name](spark, SF).schema
    df.write.format("noop").mode("overwrite").save()
