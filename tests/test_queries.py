"""Every query against its SQL, side by side on the smallest tables."""

import math
import os

import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return round(v, 6) if isinstance(v, float) else str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(str([plain(r[k]) for k in order]) for r in rows)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for name in os.listdir(SF):
        c.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return c


from freightlens.plans.queries import QUERIES, SQL  # noqa: E402


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df, want = QUERIES[name](spark, SF), duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(want.columns, want.fetchall())


def test_null_safe_join_has_every_shipment(spark, duck):
    keys = SQL["null_safe_join"].replace(" WHERE CNOTE_NO IS NULL OR CNOTE_NO < 'C2'", "")
    df, want = QUERIES["null_safe_join"](spark, SF), duck.sql(keys)
    assert rows_of(df.columns, df.collect()) == rows_of(want.columns, want.fetchall())
    assert df.count() == spark.read.parquet(f"{SF}/orders.parquet").count()


def test_entry_works(spark):
    import __spark_entry__ as entry

    assert set(SQL) <= set(entry.oracle_sql()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
