"""Every registered query of the engine against its SQL twin in DuckDB."""

import math
import os

import duckdb
import pytest

from winnow import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "as_tuple"):
        return round(float(v), 6)
    return v


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(sf_dir, t)}.parquet'")
    return c


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(spark, sf_dir, con, name):
    got = catalog.queries()[name](spark, sf_dir)
    if name not in catalog.oracle_sql():
        assert got.count() >= 0
        return
    want = con.sql(catalog.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    rows = [tuple(plain(v) for v in r) for r in got.select(*[f"`{c}`" for c in want.columns]).collect()]
    assert sorted(map(repr, rows)) == sorted(repr(tuple(plain(v) for v in r)) for r in want.fetchall())


def test_flagship(spark, sf_dir):
    assert catalog.flagship(spark, sf_dir).count() > 0


@pytest.mark.parametrize("name", ["x17_news_date", "x12_x15_page_dates", "s31_x46_detail_page", "x10_retry_after", "f6_x16_job_date", "f5_early_reject", "x9_x11_dates"])
def test_costly_rows_are_dealt(spark, name):
    """A table whose file is one split is worked on by all shuffle partitions."""
    df = catalog.queries()[name](spark, "/root/testdata/sf0.001")
    assert df.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1
