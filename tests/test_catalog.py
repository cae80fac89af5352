"""Every query with SQL against DuckDB over the smallest tables, where they are there."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__
from trailforge.plans import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return "nan" if math.isnan(v) else float(f"{float(v):.9g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return tuple(plain(x) for x in v) if isinstance(v, (list, tuple)) else v


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=str)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, db, name):
    df = catalog.QUERIES[name](spark, SF)
    result = db.execute(catalog.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, df.collect()) == rows(names, result.fetchall())


def test_queries_without_sql_run(spark):
    for name in set(catalog.QUERIES) - set(catalog.ORACLES):
        assert catalog.QUERIES[name](spark, SF).count() > 0


def test_sketches_are_near_the_exact_counts(spark):
    near = {r["part"]: r["users"] for r in catalog.QUERIES["unique_users"](spark, SF).collect()}
    for r in catalog.QUERIES["unique_users_exact"](spark, SF).collect():
        assert abs(near[r["part"]] - r["users"]) <= 0.05 * r["users"] + 1


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(__spark_entry__.queries()) and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_every_line_is_tokenised(spark, db):
    found = catalog.QUERIES["log_tokens_all"](spark, SF)
    want = db.execute("SELECT count(*) + count(*) FILTER (event_type = 'error') FROM events").fetchone()[0]
    assert found.count() == want and found.where("file = 'error_log' and tokens like '%001:caused%'").count() > 0


@pytest.mark.parametrize("by", ["hour", "day", "entity"])
def test_every_event_is_partitioned(spark, db, by):
    want = db.execute("SELECT count(*) FROM events").fetchone()[0]
    assert catalog.QUERIES[f"log_partition_{by}_all"](spark, SF).count() == want
