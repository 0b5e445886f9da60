"""Every query equals its SQL on the driver's tables: columns, rows and values."""

import os
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry
from wardbook.plans.driver_tables import QUERIES
from wardbook.plans.oracles import ORACLES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()
SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not there")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLES[name])
    sql_columns = [c[0] for c in cursor.description]
    want = cursor.fetchall()
    assert sorted(got.columns) == sorted(sql_columns)
    rows = Counter(tuple(r) for r in got.select(*[f"`{c}`" for c in sql_columns]).collect())
    assert rows == Counter(want)
    assert rows, "a query without rows checks nothing"


def test_value_types_agree(spark, duck):
    families = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                "BOOLEAN": "boolean"}
    for name, query in QUERIES.items():
        relation = duck.sql(ORACLES[name])
        sql_types = {c: families.get(str(t)) for c, t in zip(relation.columns, relation.types)}
        assert dict(query(spark, SF_DIR).dtypes) == sql_types, name


def test_entry_runs(spark):
    assert entry(spark).count() > 0


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
