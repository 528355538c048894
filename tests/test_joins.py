import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cairn.operators.dedup import current_rows, keep_latest
from cairn.operators.joins import SPREAD, anti_join, lookup_join
from tests.conftest import rows


@pytest.fixture
def small(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (1, "d")], "k int, v string")
    lookup = spark.createDataFrame([(1, "one"), (3, "three"), (None, "none")], "key int, name string")
    return facts, lookup


@pytest.mark.parametrize("limit", ["10485760", "-1"])
def test_lookup_join_by_either_strategy(small, conf, limit):
    conf("spark.sql.autoBroadcastJoinThreshold", limit)
    facts, lookup = small
    expected = [(1, "a", 1, "one"), (1, "d", 1, "one"), (2, "b", None, None), (None, "c", None, None)]
    assert rows(lookup_join(facts, lookup, {"k": "key"})) == sorted(expected, key=repr)
    assert rows(lookup_join(facts, lookup, {"k": "key"}, "inner")) == sorted(expected[:2], key=repr)


def test_keys_of_different_width_still_match(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    facts = spark.createDataFrame([(1,), (2,)], "k int")
    lookup = spark.createDataFrame([(1,), (5,)], "key long")
    joined = lookup_join(facts, lookup, {"k": "key"}, "inner")
    assert rows(joined) == [(1, 1)]
    assert "xxhash64" in joined._jdf.queryExecution().executedPlan().toString()


def test_equal_values_with_different_bits_match(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    facts = spark.sql("SELECT CAST(-0.0 AS DOUBLE) AS k")
    lookup = spark.sql("SELECT CAST(0.0 AS DOUBLE) AS key")
    assert lookup_join(facts, lookup, {"k": "key"}, "inner").count() == 1


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 9)), max_size=20),
    st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.sampled_from("ab")), max_size=6),
    st.sampled_from(["left", "inner", "left_semi", "left_anti"]),
    st.sampled_from(["10485760", "-1"]),
)
def test_against_brute_force(spark, facts, lookup, how, limit):
    expected = []
    for k, v in facts:
        partners = [(key, name) for key, name in lookup if k is not None and key == k]
        if how in ("left", "inner"):
            expected += [(k, v, *p) for p in partners or ([(None, None)] if how == "left" else [])]
        elif bool(partners) == (how == "left_semi"):
            expected.append((k, v))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        joined = lookup_join(
            spark.createDataFrame(facts, "k int, v int"),
            spark.createDataFrame(lookup, "key long, name string"),
            {"k": "key"},
            how,
        )
        assert rows(joined) == sorted(expected, key=repr)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_side_is_forced_to_be_broadcast(spark, conf):
    df = spark.range(1000)
    conf("spark.sql.autoBroadcastJoinThreshold", "1000")
    joined = lookup_join(
        df.selectExpr("id AS k"), keep_latest(df.selectExpr("id AS key", "id AS ModifiedDate"), "key"), {"k": "key"}
    )
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_anti_join_reads_the_left_side_once_and_spreads_null_keys(spark, conf, tmp_path):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.range(10).selectExpr("nullif(id % 3, 0) AS k", "id AS v").write.parquet(str(tmp_path / "left"))
    left = spark.read.parquet(str(tmp_path / "left"))
    kept = anti_join(left, spark.createDataFrame([(1,)], "k int"), ["k"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    exchange = next(line for line in plan.split("\n") if "hashpartitioning(k#" in line)
    assert SPREAD in exchange
    assert kept.columns == ["k", "v"] and sorted(r.v for r in kept.collect()) == [0, 2, 3, 5, 6, 8, 9]


@pytest.mark.parametrize("carry", [[], ["name"]])
def test_a_hot_key_is_split_although_the_lookup_is_deduplicated(spark, conf, carry):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    facts = spark.range(0, 60000, 1, 8).selectExpr("IF(id % 3 = 0, 7, id) AS k", "id AS v")
    history = spark.range(0, 60000, 1, 4).selectExpr(
        "id % 30000 AS key", "concat('n', id) AS name", "id AS ModifiedDate"
    )
    joined = lookup_join(facts, current_rows(history, ["key"], carry), {"k": "key"})
    assert joined.agg(F.count("v"), F.count("key"), F.sum("v")).first()[:] == (60000, 40000, 1799970000)
    joined.write.format("noop").mode("overwrite").save()
    listed = joined.collect()
    assert len(listed) == 60000
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_anti_join_keeps_null_keys_without_shuffling_them(spark):
    left = spark.createDataFrame([(1, 1), (2, 1), (None, 1), (3, None)], "a int, b int")
    right = spark.createDataFrame([(1, 1), (None, 1), (3, None)], "a int, b int")
    assert rows(anti_join(left, right, ["a", "b"])) == sorted([(2, 1), (None, 1), (3, None)], key=repr)
