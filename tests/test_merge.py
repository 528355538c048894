import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cairn.operators.merge import DuplicateKeys, Unmatched, duplicate_keys, merge_frames
from cairn.session import scratch_dir
from cairn.sources.tables import drop_old_versions, create_layers, read_table, table_exists, upsert_table, write_table
from tests.conftest import rows

SCHEMA = "k int, v string, s string"
TARGET = [(1, "t1", "F"), (2, "t2", "F"), (3, "t3", "O"), (None, "t0", "F")]
SOURCE = [(2, "s2", "O"), (4, "s4", "O"), (None, "s0", "O")]


@pytest.fixture
def sides(spark):
    return spark.createDataFrame(TARGET, SCHEMA), spark.createDataFrame(SOURCE, SCHEMA)


def ordered(*expected):
    return sorted(expected, key=repr)


def test_upsert_keeps_unmatched_rows(sides):
    assert rows(merge_frames(*sides, ["k"])) == ordered(*SOURCE, TARGET[0], TARGET[2], TARGET[3])


def test_delete_spares_null_keys_and_needs_no_join(sides):
    merged = merge_frames(*sides, ["k"], Unmatched.DELETE)
    assert rows(merged) == ordered(*SOURCE, TARGET[3])
    assert "Join" not in merged._jdf.queryExecution().executedPlan().toString()


def test_conditional_delete(sides):
    merged = merge_frames(*sides, ["k"], Unmatched.DELETE, "s = 'F'")
    assert rows(merged) == ordered(*SOURCE, TARGET[2], TARGET[3])


def test_new_and_missing_columns(spark, sides):
    target, _ = sides
    source = spark.createDataFrame([(2, "s2", 20), (4, "s4", 40), (None, "s0", 0)], "k int, v string, n int")
    merged = merge_frames(target, source, ["k"])
    assert merged.columns == ["k", "v", "s", "n"]
    assert rows(merged) == ordered(
        (2, "s2", "F", 20),
        (4, "s4", None, 40),
        (None, "s0", None, 0),
        (1, "t1", "F", None),
        (3, "t3", "O", None),
        (None, "t0", "F", None),
    )


key = st.one_of(st.none(), st.integers(0, 6))
table = st.lists(st.tuples(key, key, st.integers(0, 3)), max_size=12, unique_by=lambda r: (r[0], r[1]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(table, table, st.sampled_from(["keep", "delete", "delete if"]))
def test_against_brute_force(spark, target, source, mode):
    given_keys = {(a, b) for a, b, _ in source if a is not None and b is not None}
    expected = list(source)
    for a, b, v in target:
        if (a, b) in given_keys:
            continue
        null_key = a is None or b is None
        if mode == "keep" or null_key or (mode == "delete if" and not v >= 2):
            expected.append((a, b, v))
    schema = "a int, b int, v int"
    merged = merge_frames(
        spark.createDataFrame(target, schema),
        spark.createDataFrame(source, schema),
        ["a", "b"],
        Unmatched.KEEP if mode == "keep" else Unmatched.DELETE,
        "v >= 2" if mode == "delete if" else None,
    )
    assert rows(merged) == sorted(expected, key=repr)


def test_duplicate_keys_ignore_nulls(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (None, 1), (None, 1), (2, 1)], "a int, b int")
    assert rows(duplicate_keys(df, ["a", "b"])) == [(1, 1, 2)]


@pytest.fixture
def database(spark, request):
    name = request.node.name.split("[")[0][:40]
    create_layers(spark, {name: scratch_dir(spark, "db")})
    return name


def test_upsert_creates_then_merges_a_table(spark, sides, database):
    target, source = sides
    table = f"{database}.orders"
    assert not table_exists(spark, table)
    assert upsert_table(target, table, ["k"]) == 4
    assert table_exists(spark, table)
    assert upsert_table(source, table, ["k"], Unmatched.DELETE, "s = 'F'") == 3
    assert rows(read_table(spark, table)) == ordered(*SOURCE, TARGET[2], TARGET[3])
    # A NULL key never matches: the same source inserts its row again.
    upsert_table(source, table, ["k"], Unmatched.DELETE)
    assert rows(read_table(spark, table)) == ordered(*SOURCE, SOURCE[2], TARGET[3])


def test_upsert_evolves_the_table_schema(spark, sides, database):
    target, _ = sides
    table = f"{database}.orders"
    upsert_table(target, table, ["k"])
    source = spark.createDataFrame([(2, "s2", 20)], "k int, v string, n int")
    upsert_table(source, table, ["k"])
    held = read_table(spark, table)
    assert held.columns == ["k", "v", "s", "n"]
    assert (2, "s2", "F", 20) in rows(held) and (1, "t1", "F", None) in rows(held)


def test_duplicate_source_keys_leave_the_table_as_it_was(spark, sides, database):
    target, source = sides
    table = f"{database}.orders"
    upsert_table(target, table, ["k"])
    with pytest.raises(DuplicateKeys):
        upsert_table(source.union(source), table, ["k"])
    assert rows(read_table(spark, table)) == ordered(*TARGET)


def test_a_failed_write_leaves_the_table_as_it_was(spark, sides, database):
    target, source = sides
    table = f"{database}.orders"
    write_table(target, table)
    broken = source.withColumn("v", F.when(F.col("k") == 4, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    for attempt in (lambda: upsert_table(broken, table, ["k"]), lambda: write_table(broken, table)):
        with pytest.raises(Exception, match="lost"):
            attempt()
        assert rows(read_table(spark, table)) == ordered(*TARGET)


def test_a_target_of_only_null_keys_is_kept_whole(spark):
    target = spark.range(1000).selectExpr("CAST(NULL AS INT) AS k", "CAST(id AS STRING) AS v")
    source = spark.createDataFrame([(1, "s", 5)], "k int, v string, n int")
    for unmatched in Unmatched:
        merged = merge_frames(target, source, ["k"], unmatched)
        assert merged.count() == 1001 and merged.where("n = 5").count() == 1


def test_a_table_can_be_replaced_from_itself_with_another_schema(spark, sides, database):
    table = f"{database}.orders"
    write_table(sides[0], table)
    assert write_table(read_table(spark, table).selectExpr("s", "k * 2 AS double_k").where("k > 1"), table) == 2
    assert rows(read_table(spark, table)) == [("F", 4), ("O", 6)]


def test_a_repeated_key_is_found_on_create_and_in_frames(spark, sides, database):
    target, source = sides
    with pytest.raises(DuplicateKeys):
        upsert_table(source.union(source), f"{database}.orders", ["k"])
    assert not table_exists(spark, f"{database}.orders")
    for unmatched in Unmatched:
        with pytest.raises(Exception, match="repeats a value of k"):
            merge_frames(target, source.union(source), ["k"], unmatched).collect()


def test_names_match_without_regard_to_case(spark, conf):
    target = spark.createDataFrame([(1, "t", 7)], "k int, v string, old int")
    source = spark.createDataFrame([(1, "s"), (2, "n")], "K int, V string")
    merged = merge_frames(target, source, ["K"])
    assert merged.columns == ["k", "v", "old"] and rows(merged) == [(1, "s", 7), (2, "n", None)]


def test_old_versions_go_when_asked_to(spark, sides, database):
    table = f"{database}.orders"
    for _ in range(4):
        write_table(sides[0], table)
    assert drop_old_versions(spark, table, keep=2) == 2 and drop_old_versions(spark, table, keep=2) == 0
    assert rows(read_table(spark, table)) == ordered(*TARGET)
    with pytest.raises(ValueError):
        drop_old_versions(spark, table, keep=0)
