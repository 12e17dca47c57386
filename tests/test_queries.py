"""Every core query runs on the smallest data and equals its SQL in DuckDB, where there is one."""

import datetime
import decimal
import glob
import math
import os

import pytest

from loamstone.plans import catalogue

QUERIES, ORACLE = catalogue.queries(), catalogue.oracle_sql()


def norm(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "N"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.6g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.fixture(scope="module")
def duck(sf_dir):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    rows = sorted("|".join(norm(r[c]) for c in cols) for r in df.collect())
    if name not in ORACLE:
        return
    r = duck.execute(ORACLE[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert sorted("|".join(norm(x[k]) for k in at) for x in r.fetchall()) == rows


def test_every_oracle_has_its_query():
    assert set(ORACLE) <= set(QUERIES)
