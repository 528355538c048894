"""Tables that are published in one step, and partitioned tables."""

import os
import threading
from datetime import date
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from cairn.operators import bitmap
from cairn.operators.merge import DuplicateKeys, Unmatched, merge_frames, merge_in_place
from cairn.session import scratch_dir
from cairn.sources.tables import (
    create_layers,
    drop_old_versions,
    drop_replaced_partitions,
    read_table,
    table_exists,
    upsert_table,
    write_table,
)
from tests.conftest import rows, shuffled_rows

SCHEMA = "k int, p string, d date, v string"
DAY = date(2020, 1, 2)
TARGET = [
    (1, "a", DAY, "t1"),
    (2, "a", DAY, "t2"),
    (3, "b/c=d'e", DAY, "t3"),
    (4, None, DAY, "t4"),
    (5, "z", None, "t5"),
    (None, "a", DAY, "t0"),
    (None, "y", None, "t9"),
]


@pytest.fixture
def table(spark, request):
    name = "tables_" + request.node.name.split("[")[0][5:35] + f"_{abs(hash(request.node.name)) % 10_000}"
    create_layers(spark, {name: scratch_dir(spark, "db")})
    return f"{name}.orders"


def files(spark, table):
    """Path to time of change of the files that the table reads."""
    paths = {unquote(p).removeprefix("file://").removeprefix("file:") for p in read_table(spark, table).inputFiles()}
    return {p: os.stat(p).st_mtime_ns for p in paths}


def ordered(*expected):
    return sorted(expected, key=repr)


@pytest.fixture
def target(spark, table):
    write_table(spark.createDataFrame(TARGET, SCHEMA).coalesce(1), table, partition_by=["p", "D"])
    return table


def test_partitioned_table_reads_as_written(spark, target):
    held = read_table(spark, target)
    assert held.columns == ["k", "p", "d", "v"] and rows(held) == ordered(*TARGET)
    assert len(files(spark, target)) == 5
    plan = held.where("p = 'a'")._jdf.queryExecution().executedPlan()
    assert held.where("p = 'a'").count() == 3 and "PartitionFilters" in plan.toString()
    assert len(held.where("p = 'a'").inputFiles()) == 1


def test_merge_touches_only_partitions_of_matched_rows(spark, target):
    before = files(spark, target)
    source = spark.createDataFrame([(3, "b/c=d'e", DAY, "s3"), (4, "q", None, "s4"), (7, "z", None, "s7")], SCHEMA).coalesce(1)
    assert upsert_table(source, target, ["k"]) == 3
    assert rows(read_table(spark, target)) == ordered(
        TARGET[0], TARGET[1], TARGET[4], TARGET[5], TARGET[6], (3, "b/c=d'e", DAY, "s3"), (4, "q", None, "s4"), (7, "z", None, "s7")
    )
    after = files(spark, target)
    # Partition z got a file more, a and y stay, b and NULL were rewritten or left.
    kept = {p: t for p, t in before.items() if any(x in p for x in ("p=a/", "p=z/", "p=y/"))}
    assert len(kept) == 3 and kept.items() <= after.items() and len(after) == 6, (sorted(before), sorted(after))
    assert all(os.path.exists(p) for p in before)
    assert drop_replaced_partitions(spark, target) == 2 and drop_replaced_partitions(spark, target) == 0
    assert len(rows(read_table(spark, target))) == 8
    assert [os.path.exists(p) for p in before].count(False) == 2


@pytest.mark.parametrize("filtered", [False, True])
@pytest.mark.parametrize("mode", [(Unmatched.KEEP, None), (Unmatched.DELETE, None), (Unmatched.DELETE, "v > 't2'")])
def test_partitioned_merges_equal_merged_frames(spark, target, mode, filtered, conf):
    if filtered:
        conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    source = spark.createDataFrame(
        [(2, None, None, "s2"), (5, "z", None, "s5"), (8, "new", DAY, "s8"), (None, "a", DAY, "s0")], SCHEMA
    )
    want = rows(merge_frames(read_table(spark, target), source, ["k"], *mode))
    upsert_table(source, target, ["k"], *mode)
    assert rows(read_table(spark, target)) == want
    # Once more: the same keys match, the NULL key is inserted again.
    want = rows(merge_frames(read_table(spark, target), source, ["k"], *mode))
    upsert_table(source, target, ["k"], *mode)
    assert rows(read_table(spark, target)) == want


def test_partitioned_table_evolves_and_empties(spark, target):
    source = spark.createDataFrame([(1, "a", DAY, 10)], "K int, p string, d date, extra int")
    upsert_table(source, target, ["k"])
    held = read_table(spark, target)
    assert held.columns == ["k", "p", "d", "v", "extra"]
    assert (1, "a", DAY, "t1", 10) in rows(held) and (2, "a", DAY, "t2", None) in rows(held)
    none = spark.createDataFrame([], "k int, p string, d date, v string, extra int")
    upsert_table(none, target, ["k"], Unmatched.DELETE, "k is not null")
    assert [r[0] for r in rows(read_table(spark, target))] == [None, None]
    upsert_table(none.where("false"), target, ["k"])
    write_table(none, target, partition_by=["d"])
    assert read_table(spark, target).count() == 0
    upsert_table(none.union(spark.createDataFrame([(1, "a", DAY, "x", 1)], none.schema)), target, ["k"])
    assert rows(read_table(spark, target)) == [(1, "a", DAY, "x", 1)]


def test_failed_partitioned_merge_changes_nothing(spark, target):
    source = spark.createDataFrame([(1, "a", DAY, "s1"), (1, "b", DAY, "s1")], SCHEMA)
    before = files(spark, target)
    with pytest.raises(DuplicateKeys):
        upsert_table(source, target, ["k"])
    broken = source.limit(1).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        upsert_table(broken, target, ["k"])
    assert files(spark, target) == before and rows(read_table(spark, target)) == ordered(*TARGET)


def test_partition_columns_are_checked(spark, table):
    frame = spark.createDataFrame([(1, 0.5)], "k int, x double")
    with pytest.raises(ValueError, match="x is no partition column"):
        write_table(frame, table, partition_by=["x"])
    assert not table_exists(spark, table)
    upsert_table(frame, table, ["x"], partition_by=["k"])
    with pytest.raises(DuplicateKeys):
        upsert_table(frame.union(frame), f"{table}2", ["x"], partition_by=["k"])
    assert rows(read_table(spark, table)) == [(1, 0.5)] and not table_exists(spark, f"{table}2")
    with pytest.raises(ValueError, match="no partitions"):
        write_table(frame, f"{table}3")
        drop_replaced_partitions(spark, f"{table}3")


def test_many_partitions_in_few_statements(spark, table):
    frame = spark.range(1200).selectExpr("id AS k", "id AS p", "'v' AS v").repartition(2)
    write_table(frame, table, partition_by=["p"])
    changes = spark.createDataFrame([(7, 7, "new"), (1300, 1300, "new")], frame.schema)
    upsert_table(changes, table, ["k"])
    held = read_table(spark, table)
    assert held.count() == 1201 and held.where("v = 'new'").count() == 2


def test_old_versions_of_partitioned_and_plain_tables(spark, table):
    frame = spark.createDataFrame(TARGET, SCHEMA)
    write_table(frame, table, partition_by=["p"])
    write_table(frame, table)
    write_table(frame.drop("v"), table, partition_by=["d", "p"])
    assert drop_old_versions(spark, table, keep=1) == 2
    assert len(rows(read_table(spark, table))) == len(TARGET)
    names = {t.name for t in spark.catalog.listTables(table.split(".")[0])}
    assert len(names) == 2


def test_readers_never_miss_a_table_whose_schema_changes(spark, table):
    write_table(spark.range(3).selectExpr("id AS c0"), table)
    seen, errors, done = set(), [], threading.Event()

    def poll():
        session = spark.newSession()
        while not done.is_set():
            try:
                held = read_table(session, table)
                assert held.count() == 3
                seen.add(tuple(held.columns))
            except Exception as error:  # noqa: BLE001
                errors.append(error)

    reader = threading.Thread(target=poll)
    reader.start()
    for i in range(1, 21):
        kind = ("int", "string", "double")[i % 3]
        write_table(spark.range(3).selectExpr(f"CAST(id AS {kind}) AS c{i % 4}", f"'x' AS extra{i}"), table)
    done.set()
    reader.join()
    assert not errors and len(seen) > 1


def test_plain_tables_are_still_written(spark, table):
    spark.range(3).write.saveAsTable(table)
    write_table(spark.range(4).selectExpr("id", "id AS more"), table)
    assert spark.catalog.getTable(table).tableType != "VIEW" and read_table(spark, table).count() == 4
    write_table(spark.range(5).selectExpr("'a' AS id"), table)
    assert spark.catalog.getTable(table).tableType == "VIEW" and read_table(spark, table).count() == 5


# -- bitmaps of keys -------------------------------------------------------


@pytest.mark.parametrize("kind", ["int", "string", "decimal(12,2)", "date", "boolean", "binary"])
@pytest.mark.parametrize("bits", [bitmap.PART_BITS, 8])
def test_rows_past_the_bitmap_have_no_partner(spark, monkeypatch, kind, bits):
    monkeypatch.setattr(bitmap, "filter_bits", lambda keys: bits)
    value = {"boolean": "id % 2 = 0", "date": "date_add(DATE'2020-01-01', CAST(id AS INT))"}.get(kind, "id")
    value = "CAST(CAST(id AS STRING) AS BINARY)" if kind == "binary" else f"CAST({value} AS {kind})"
    left = spark.range(2000).selectExpr(f"IF(id % 5 = 0, NULL, {value}) AS `k.x`", "id")
    right = spark.range(1, 2000, 97).selectExpr(f"{value} AS `k.x`")
    possible, alone = bitmap.split_by_keys(left, right, ["k.x"], 20)
    assert possible.columns == left.columns and possible.count() + alone.count() == 2000
    keys = {r[0] for r in right.collect()}
    assert not keys & {r[0] for r in alone.collect()}
    assert possible.where("`k.x` is null").isEmpty()
    if kind == "int" and bits > 8:
        assert possible.count() < 40


def test_small_merge_shuffles_few_target_rows(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    folder = scratch_dir(spark, "big")
    spark.range(200_000).selectExpr("id AS k", "id * 2 AS v").write.parquet(folder)
    target = spark.read.parquet(folder)
    source = spark.range(0, 200_000, 1000).selectExpr("id AS k", "-1L AS v")
    merged = merge_frames(target, source, ["k"], source_rows=200)  # no key is broadcast: a bitmap is
    assert merged.where("v = -1").count() == 200 and merged.count() == 200_000
    written = [n for n in shuffled_rows(merged) if n]
    # Source keys for the check, the bitmap's parts and both sides of the join.
    assert written and max(written) <= 400


def test_which_merges_use_a_bitmap(spark, conf):
    left = spark.createDataFrame([(1, 1.0, "x")], "i int, d double, s string")
    right = spark.createDataFrame([(1, 1.0, "x")], "i int, d double, s string")
    assert not bitmap.worth_filtering(left, right, ["i"], 1000)  # the keys are broadcast
    assert bitmap.worth_filtering(left, right, ["i", "s"], 10_000_000)
    assert not bitmap.worth_filtering(left, right, ["d"], 10_000_000)  # 0.0 and -0.0
    assert not bitmap.worth_filtering(left, right, ["i"], bitmap.MOST_BITS)  # it would be full
    conf("spark.sql.autoBroadcastJoinThreshold", "64k")
    assert bitmap.worth_filtering(left, right, ["i"], 5000)
    assert bitmap.filter_bits(1) == bitmap.LEAST_BITS and bitmap.filter_bits(10**12) == bitmap.MOST_BITS


# -- bucketed tables -------------------------------------------------------


def bucketed(spark, table, rows_, schema="k int, v string, s string"):
    write_table(spark.createDataFrame(rows_, schema), table, bucket_by=["K"], buckets=4)


@pytest.mark.parametrize("mode", [(Unmatched.KEEP, None), (Unmatched.DELETE, None), (Unmatched.DELETE, "s = 'F'")])
def test_bucketed_merges_equal_merged_frames(spark, table, mode):
    bucketed(spark, table, [(1, "t1", "F"), (2, "t2", "F"), (3, "t3", "O"), (None, "t0", "F"), (None, None, None)])
    for source in (
        spark.createDataFrame([(2, "s2", "O"), (4, "s4", "O"), (None, "s0", "O")], "k long, v string, s string"),
        spark.createDataFrame([(2, 7), (5, 8)], "k int, extra int"),  # a new column, and two that are missing
    ):
        want = merge_frames(read_table(spark, table), source, ["k"], *mode)
        want, columns = rows(want), want.columns
        assert upsert_table(source, table, ["k"], *mode) == source.count()
        held = read_table(spark, table)
        assert held.columns == columns and rows(held) == want
    names = {t.name for t in spark.catalog.listTables(table.split(".")[0])}
    assert len(names) == 4  # the view and three versions


def exchanges(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange")


def test_buckets_need_no_exchange(spark, table, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    many = [(i, f"v{i}", "F") for i in range(500)]
    bucketed(spark, table, many)
    bucketed(spark, f"{table}_lines", [(i % 500, f"line{i}", "x") for i in range(2000)])
    upsert_table(spark.createDataFrame([(7, "new", "O"), (900, "new", "O")], "k int, v string, s string"), table, ["k"])
    orders, lines = read_table(spark, table), read_table(spark, f"{table}_lines").toDF("order", "text", "flag")
    assert len(orders.inputFiles()) == 4
    joined = lines.join(orders, lines["order"] == orders["k"])
    assert exchanges(joined) == 0 and joined.count() == 2000
    assert exchanges(orders.groupBy("k").count()) == 0 and exchanges(lines.select("order").distinct()) == 0
    merged = merge_in_place(orders, orders.where("k < 10"), ["k"])
    assert exchanges(merged) == 0 and merged.count() == 501


def test_bucketed_tables_are_checked(spark, table):
    bucketed(spark, table, [(1, "a", "F")])
    source = spark.createDataFrame([(1, "b", "O"), (1, "c", "O")], "k int, v string, s string")
    with pytest.raises(DuplicateKeys):
        upsert_table(source, table, ["k"])
    with pytest.raises(ValueError, match="not the keys"):
        upsert_table(source.limit(1), table, ["v"])
    with pytest.raises(ValueError, match="number of buckets"):
        write_table(source, table, bucket_by=["k"])
    assert rows(read_table(spark, table)) == [(1, "a", "F")]
    write_table(source, table)
    upsert_table(source.limit(1), table, ["v"])
    assert read_table(spark, table).count() == 2
