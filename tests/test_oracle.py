"""Every query with SQL against DuckDB, the rest for rows, at two small scales."""

import math

import duckdb
import pytest

from tallyquill.plans.catalogue import ORACLE, QUERIES
from tests.cases import analysis_cases, fixture_cases, registry  # noqa: F401  cases register themselves

SCALES = ["/root/testdata/sf0.001", "/root/testdata/sf0.01"]
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    def at(sf):
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
        return con

    return {sf: at(sf) for sf in SCALES}


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("sf", SCALES, ids=lambda sf: sf.rsplit("/", 1)[1])
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name, sf):
    compare(spark, duck, QUERIES[name], ORACLE.get(name), sf)


@pytest.mark.parametrize("name", sorted(registry.CASES))
def test_case(spark, duck, name):
    compare(spark, duck, registry.CASES[name], registry.ORACLE.get(name), SCALES[0])


def compare(spark, duck, query, sql, sf):
    df = query(spark, sf)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is not None:
        cur = duck[sf].execute(sql)
        columns = [d[0] for d in cur.description]
        want = rows(columns, cur.fetchall())
        assert sorted(df.columns) == sorted(columns)
        assert len(got) == len(want) and got == want
    assert got  # nothing on both sides would prove nothing
