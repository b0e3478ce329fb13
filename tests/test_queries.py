"""Every registered query on the smallest tables, against its SQL."""

import math
from pathlib import Path

import pytest

from tidemark.plans import catalogue

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="the driver's tables are not here")


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    return f"{v:.5f}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for p in DATA.iterdir():
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", catalogue.QUERIES)
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, str(DATA))
    rows = df.collect()
    if name not in catalogue.SQL:
        assert df.columns
        return
    got = duck.execute(catalogue.SQL[name])
    names = [d[0] for d in got.description]
    want = [dict(zip(names, r, strict=True)) for r in got.fetchall()]
    assert sorted(names) == sorted(df.columns)
    key = sorted(names)
    assert sorted([cell(r[k]) for k in key] for r in rows) == sorted([cell(r[k]) for k in key] for r in want)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["media", "first_ord", "speaker", "start_ms", "end_ms", "n"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
