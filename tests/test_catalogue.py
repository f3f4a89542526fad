"""Every registered query of the engine against its SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from tidemark.plans import catalogue, client_queries, live_queries, star_queries, state_queries, venue_queries  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}')")
    return c


def plain(v):
    if v is None or str(v) in ('<NA>', 'nan', 'NaT'):
        return None
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return bool(v)
    return round(float(v), 9) if isinstance(v, (int, float)) or hasattr(v, "dtype") else str(v)


def rows(frame):
    return sorted((tuple(plain(v) for v in row) for row in frame[sorted(frame.columns)].itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_same_rows(spark, duck, name):
    got = catalogue.QUERIES[name](spark, SF).toPandas()
    if name not in catalogue.ORACLE_SQL:
        assert len(got)
        return
    want = duck.execute(catalogue.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
