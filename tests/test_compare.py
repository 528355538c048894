import pytest

from cairn.operators import compare
from cairn.operators.compare import (
    comparison,
    differing_ranges,
    except_all,
    frames_equal,
    large_row_differences,
    row_differences,
)
from cairn.operators.preview import preview
from tests.conftest import rows, shuffled_rows


@pytest.fixture
def odd(spark):
    """A frame whose columns have the names of what is computed."""
    return spark.createDataFrame([(1, 2, 3), (1, 2, 3), (4, 5, None)], "left_rows int, copy int, `a.b` int")


def test_any_column_names_can_be_compared(odd):
    assert rows(except_all(odd, odd.distinct())) == [(1, 2, 3)]
    assert rows(row_differences(odd, odd.distinct(), "n", "m")) == [(1, 2, 3, 2, 1)]
    assert frames_equal(odd, odd) and not frames_equal(odd, odd.distinct())


def test_a_comparison_is_a_plan(spark, odd):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("compare", "")
    flags = comparison(odd, odd.distinct())
    assert len(tracker.getJobIdsForGroup("compare")) == 0
    assert flags.first().asDict() == {"same_schema": True, "same_rows": False}
    assert comparison(odd, odd.drop("copy")).first().asDict() == {"same_schema": False, "same_rows": False}


def test_preview_decides_ties_and_sorts_no_more_than_it_shows(spark):
    df = spark.createDataFrame([(1, "b", {}), (1, "a", {}), (0, "z", {})], "k int, v string, m map<int,int>")
    top = preview(df, ["k"], 2)
    assert [(r.k, r.v) for r in top.collect()] == [(0, "z"), (1, "a")]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_large_frames_are_compared_by_fingerprints(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    names = "id AS `a.b`, CAST(id % 7 AS DOUBLE) AS d, CASE WHEN id % 5 = 0 THEN NULL ELSE 'x' END AS s"
    left = spark.range(20_000).selectExpr(*names.split(", "))
    left = left.union(left.where("`a.b` < 40"))
    same = left.repartition(3)
    assert large_row_differences(left, same).count() == 0
    right = left.where("`a.b` <> 77").union(left.where("`a.b` = 5 AND d = 5")).union(left.limit(1).selectExpr("-1L", "0D", "'new'"))
    found = large_row_differences(left, right, "l", "r")
    assert rows(found) == rows(row_differences(left, right, "l", "r")) and found.count() == 3
    # Both sides send the rows of ranges that differ, and no others.
    assert 0 < shuffled_rows(found)[0] < 100
    assert shuffled_rows(large_row_differences(left, same))[0] == 0


def test_fingerprints_count_copies_and_ignore_order(spark):
    one = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    assert rows(compare.fingerprints(one)) == rows(compare.fingerprints(one.orderBy("v")))
    assert differing_ranges(one, one.distinct()).count() == 1
    assert large_row_differences(one, one.distinct()).collect() == [(1, "a", 2, 1)]
    empty = one.where("false")
    assert large_row_differences(empty, empty).count() == 0 and large_row_differences(one, empty).count() == 2
    with pytest.raises(ValueError, match="differ in their types"):
        large_row_differences(one, one.selectExpr("CAST(k AS LONG) AS k", "v"))
