import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cairn.operators.dedup import current_rows, keep_latest
from tests.conftest import rows


def test_newest_row_wins_and_undated_rows_lose(spark):
    df = spark.createDataFrame(
        [(1, "old", 1), (1, "new", 2), (2, "undated", None), (2, "dated", 1), (3, "only", None)],
        "k int, v string, ModifiedDate int",
    )
    assert rows(keep_latest(df, "k")) == [(1, "new", 2), (2, "dated", 1), (3, "only", None)]


def test_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, "a", 1), (None, "b", 2)], "k int, v string, ModifiedDate int")
    assert rows(keep_latest(df, ["k"])) == [(None, "b", 2)]


def test_ties_are_decided_by_the_other_columns(spark):
    data = [(1, v, w, 5) for v in ("b", "a", None) for w in (2, 1)]
    for _ in range(3):
        random.shuffle(data)
        df = spark.createDataFrame(data, "k int, v string, w int, ModifiedDate int").repartition(3)
        assert rows(keep_latest(df, "k")) == [(1, None, 1, 5)]
        assert rows(keep_latest(df, "k", tie_break=["w", "v"])) == [(1, None, 1, 5)]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2), st.integers(0, 4), st.integers(0, 3)), max_size=30))
def test_against_brute_force(spark, data):
    best = {}
    for a, b, v, when in data:
        rank = (-when, v)
        if (a, b) not in best or rank < best[a, b][0]:
            best[a, b] = (rank, (a, b, v, when))
    df = spark.createDataFrame(data, "a int, b int, v int, ModifiedDate int")
    assert rows(keep_latest(df, ["a", "b"])) == sorted((r for _, r in best.values()), key=repr)


def test_current_rows_keeps_only_what_is_asked_for(spark):
    df = spark.createDataFrame(
        [(1, "x", 1.0, 1), (1, "y", 2.0, 2), (2, "z", 3.0, 1)], "k int, v string, w double, ModifiedDate int"
    )
    assert rows(current_rows(df, ["k"], ["v"])) == [(1, "y"), (2, "z")]
    keys = current_rows(df, ["k"])
    assert rows(keys) == [(1,), (2,)]
    assert "Window" not in keys._jdf.queryExecution().executedPlan().toString()
    assert current_rows(df, ["k"], ["v"], unique=True).count() == 3


def test_hot_keys_are_cut_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 2 AS k", "id AS v", "id AS ModifiedDate")
    plan = keep_latest(df, "k")._jdf.queryExecution().executedPlan().toString()
    below_shuffle = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below_shuffle
