"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return connection


def plain(value):
    return float(value) if isinstance(value, Decimal) else value


def rows(columns, data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in data)


KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
    "TIMESTAMP": ("timestamp", "timestamp_ntz"),
}


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    relation = duck.sql(contract.oracle_sql()[name])
    assert sorted(df.columns) == sorted(relation.columns)
    kinds = dict(df.dtypes)
    for column, kind in zip(relation.columns, relation.types, strict=True):
        assert kinds[column] in KINDS[str(kind)], column
    expected = relation.fetchall()
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(expected)
    assert rows(df.columns, got) == rows(relation.columns, expected)


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
