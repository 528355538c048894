"""Every registered query against DuckDB on the smallest supplied tables."""

import datetime as dt
import decimal
import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from harness import registry
from harness.layers import _history

FOLDER = contract.SMOKE_DIR
QUERIES = {name: build for name, build in contract.queries().items() if name in registry.QUERIES}
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def plain(value):
    if isinstance(value, decimal.Decimal):
        return format(value.normalize(), "f")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def canonical(names, data):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(plain(row[i]) for i in order) for row in data)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_oracle(spark, oracle, name):
    frame = QUERIES[name](spark, FOLDER)
    result = oracle.execute(ORACLES[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(frame.columns)
    assert canonical(frame.columns, frame.collect()) == canonical(names, result.fetchall())


def test_entry_returns_rows(spark):
    frame = contract.entry(spark)
    assert frame.columns[0] == "ProductKey" and not frame.isEmpty()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLES)


def test_a_history_evaluates_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(number):
        seen.add(1)
        return number

    columns = ("id", "CAST(id AS STRING) AS Name", "CAST(id AS DECIMAL(9, 2)) AS Price", "TIMESTAMP'2020-01-05 00:00:00' AS ModifiedDate")
    frame = spark.range(50).withColumn("id", F.udf(counted, "long").asNondeterministic()("id")).selectExpr(*columns)
    got = _history(frame, ("id",))
    assert got.dtypes == frame.dtypes
    want = [(i, f"{i} v{n}" if n else f"{i}", decimal.Decimal(i + n), dt.datetime(2020, 1, 5 - n)) for i in range(50) for n in (2, 0, 1)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert seen.value == 50
