from decimal import Decimal
from statistics import median

import pytest
from pyspark.sql import functions as F

from cairn.operators import hot_keys
from cairn.operators.hot_keys import salted_join
from tests.conftest import rows

KINDS = ["decimal(10,2)", "int", "string", "boolean", "binary", "double", "date", "timestamp"]


def value(kind, expression):
    if kind in ("date", "timestamp"):
        return f"CAST(date_add(DATE'2020-01-01', CAST({expression} AS INT)) AS {kind})"
    text = f"CAST(CAST({expression} AS STRING) AS BINARY)"
    return text if kind == "binary" else f"CAST({expression} % 2 = 0 AS BOOLEAN)" if kind == "boolean" else f"CAST({expression} AS {kind})"


def sides(spark, kind, n=900):
    key = "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 10 = 1 THEN NULL ELSE id % 50 END"
    facts = spark.range(n).selectExpr(f"{value(kind, f'({key})')} AS `k.k`", "id AS v")
    lookup = spark.range(5, 60).selectExpr(f"{value(kind, 'id')} AS code", "id AS name")
    return facts, lookup.dropDuplicates(["code"])


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("kind", KINDS)
def test_salted_joins_equal_plain_ones(spark, conf, kind, how):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    facts, lookup = sides(spark, kind)
    lookup = lookup.cache()  # one row per code, the same in both joins
    plain = facts.join(lookup, F.col("`k.k`") == F.col("code"), how)
    salted = salted_join(facts, lookup, {"k.k": "code"}, how, tasks=8)
    assert salted.columns == plain.columns and rows(salted) == rows(plain)


def test_zeros_of_both_signs_and_several_key_columns(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    facts = spark.range(100).selectExpr("IF(id % 2 = 0, -0.0D, 0.0D) AS a", "CAST(1 AS DECIMAL(5, 1)) AS b", "id")
    lookup = spark.createDataFrame([(0.0, Decimal("1.00")), (1.0, Decimal("1.00"))], "x double, y decimal(9,2)")
    assert salted_join(facts, lookup, {"a": "x", "b": "y"}, "inner", tasks=10).count() == 100


def test_only_hot_keys_are_salted(spark):
    facts, _ = sides(spark, "decimal(10,2)", 9000)
    hot, many_null = hot_keys.hot_keys(facts, ["k.k"], 12)
    assert len(hot) == 1 and not many_null and 4 <= next(iter(hot.values())) <= 6
    assert hot_keys.hot_keys(facts, ["k.k"], 2) == ({}, False)
    assert hot_keys.hot_keys(facts.where("false"), ["k.k"], 4) == ({}, False)
    assert hot_keys.hot_keys(facts.where("`k.k` is null"), ["k.k"], 4) == ({}, True)
    even = spark.range(1000).selectExpr("CAST(id AS DECIMAL(10, 2)) AS k")
    joined = salted_join(even, even.selectExpr("k AS code"), {"k": "code"}, tasks=8)
    assert "explode" not in joined._jdf.queryExecution().logical().toString()


def test_a_hot_decimal_key_is_shared_by_tasks(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "16")
    key = "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id END"
    facts = spark.range(60_000).selectExpr(f"CAST({key} AS DECIMAL(12, 2)) AS k", "id AS v")
    lookup = spark.range(60_000).selectExpr("CAST(id AS DECIMAL(12, 2)) AS code", "id AS name")
    joined = salted_join(facts, lookup, {"k": "code"})
    per_task = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(per_task) == 60_000 and len(per_task) == 16 and max(per_task) <= 3 * median(per_task)
    plain = facts.join(lookup, F.col("k") == F.col("code"), "left")
    per_task = [r["count"] for r in plain.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(per_task) > 3 * median(per_task)
