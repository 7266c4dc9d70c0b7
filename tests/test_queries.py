"""Every registered query runs, and agrees with its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from kinfold.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: Queries that this size is too small for.
OWN: set[str] = set()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(rows, columns, order):
    return sorted(tuple(repr(r[columns.index(c)]) for c in order) for r in rows)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - OWN))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name in registry.oracle_sql():
        got = con.execute(registry.oracle_sql()[name])
        columns = [x[0] for x in got.description]
        assert sorted(columns) == sorted(df.columns)
        order = sorted(columns)
        assert plain(rows, df.columns, order) == plain(got.fetchall(), columns, order)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_series_stationary_asks_every_user(spark):
    users = spark.read.parquet(f"{SF}/events.parquet").select("user_id").distinct().count()
    assert entry.queries()["series_stationary"](spark, SF).count() == users


def test_infinite_sentinels_round_as_their_sql(spark, tmp_path, con):
    """Prices of many decimals, some nearly halfway: Spark's round took the other side of 131501.5492735."""
    values = [(1, 131501.5492735), (2, 250000.5), (3, None), (4, 0.1234565), (5, -1.2345675), (6, 199999.99999949999)]
    df = spark.createDataFrame(values, "o_orderkey bigint, o_totalprice double")
    df.write.parquet(str(tmp_path / "orders.parquet"))
    got = sorted(map(tuple, entry.queries()["infinite_sentinels"](spark, str(tmp_path)).collect()))
    sql = entry.oracle_sql()["infinite_sentinels"].replace("FROM orders", f"FROM '{tmp_path}/orders.parquet/*.parquet'")
    assert got == sorted(con.execute(sql).fetchall())


def test_infinite_sentinels_of_odd_prices_equal_their_sql(spark, tmp_path, con):
    """To the sign of a zero, and the least double is a price."""
    inf, most = float("inf"), 1.7976931348623157e308
    values = list(enumerate([None, float("nan"), inf, -inf, most, -most, 0.0, -0.0, -1e-7, -5e-7, 5e-7, 4.9999999e-7, -1e300, -1e303, 200000.0, 200000.00000000003, -5e-324, -4503599627.3704965]))
    spark.createDataFrame(values, "o_orderkey bigint, o_totalprice double").write.parquet(str(tmp_path / "orders.parquet"))
    got = sorted(map(repr, map(tuple, entry.queries()["infinite_sentinels"](spark, str(tmp_path)).collect())))
    sql = entry.oracle_sql()["infinite_sentinels"].replace("FROM orders", f"FROM '{tmp_path}/orders.parquet/*.parquet'")
    assert got == sorted(map(repr, con.execute(sql).fetchall()))
