import pytest
from pyspark.sql import functions as F

from cairn.operators.compare import COPIES_PER_TASK, except_all, frames_equal, row_differences
from cairn.operators.quality import Rule, apply_rules, rejected_rows, validate
from cairn.operators.schema import (
    SchemaMismatch,
    column_problems,
    has_columns,
    has_layout,
    layout_problems,
    require_columns,
    require_layout,
)
from cairn.plans.types import INT, MONEY, TEXT, columns
from tests.conftest import rows

RULES = (Rule("amount", "amount >= 0"), Rule("limit", "cap >= 0 OR cap IS NULL"))


def test_null_breaks_a_rule_unless_it_is_allowed(spark):
    df = spark.createDataFrame([(1, 5, None), (2, None, 1), (3, -1, -1), (4, 0, 0)], "k int, amount int, cap int")
    valid, rejected = validate(df, RULES)
    assert rows(valid) == [(1, 5, None), (4, 0, 0)]
    assert rows(rejected.select("k", "failed_rules")) == [(2, ["amount"]), (3, ["amount", "limit"])]
    assert valid.count() + rejected.count() == df.count()


def test_without_rules_nothing_is_rejected(spark):
    df = spark.range(3)
    assert apply_rules(df, ()).count() == 3 and rejected_rows(df, ()).count() == 0


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("CAST(id AS DECIMAL(19,4)) AS amount", "id AS other").write.parquet(path)
    plan = apply_rules(spark.read.parquet(path), [Rule("a", "amount >= 0")]).select("amount")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(amount,0.0000)" in text and "ReadSchema: struct<amount:decimal(19,4)>" in text


def test_layout_check_ignores_precision_and_nullability(spark):
    df = spark.sql("SELECT 1 AS a, CAST(1 AS DECIMAL(38,6)) AS b")
    assert has_layout(df, columns(a=INT, b=MONEY))
    assert not has_layout(df, columns(b=MONEY, a=INT))
    assert not has_layout(df, columns(a=INT))
    assert not has_layout(df, columns(a=TEXT, b=MONEY))
    assert layout_problems(df, columns(a=TEXT, b=MONEY)) == ["expected a string, found a integer"]
    with pytest.raises(SchemaMismatch):
        require_layout(df, columns(a=INT))


def test_check_by_name_wants_exact_types_and_accepts_more_columns(spark):
    df = spark.sql("SELECT 1 AS a, CAST(1 AS DECIMAL(38,6)) AS b, 'x' AS c")
    assert has_columns(df, columns(c=TEXT, a=INT))
    assert not has_columns(df, columns(b=MONEY))
    assert column_problems(df, columns(d=INT)) == ["expected d int, found no such column"]
    assert require_columns(df, columns(a=INT)) is df
    with pytest.raises(SchemaMismatch):
        require_columns(df, columns(b=MONEY))


def test_comparison_counts_copies(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, "b")], "a int, b string")
    right = spark.createDataFrame([(1, None), (2, "b"), (2, "b")], "a int, b string")
    assert rows(except_all(left, right)) == [(1, None)]
    assert rows(except_all(right, left)) == [(2, "b")]
    assert rows(row_differences(left, right)) == [(1, None, 2, 1), (2, "b", 1, 2)]
    assert not frames_equal(left, right)
    assert frames_equal(left, left.repartition(3))


def test_a_row_with_very_many_copies_is_written_by_several_tasks(spark, conf):
    conf("spark.sql.adaptive.enabled", "false")
    copies = 3 * COPIES_PER_TASK + 7
    left = spark.range(copies + 2).selectExpr("CAST(NULL AS INT) AS a", "IF(id < 2, 'x', 'hot') AS b")
    right = spark.createDataFrame([(None, "hot"), (None, "x"), (None, "other")], "a int, b string")
    out = except_all(left, right)
    assert out.columns == ["a", "b"]
    assert rows(out.groupBy("a", "b").count()) == [(None, "hot", copies - 1), (None, "x", 1)]
    per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(per_task) < copies - 1


def test_comparison_wants_equal_schemas(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert not frames_equal(df, df.selectExpr("CAST(a AS LONG) AS a"))
    assert not frames_equal(df, df.selectExpr("coalesce(a, 0) AS a"))
