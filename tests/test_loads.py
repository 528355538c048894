"""Loads that skip what is loaded, text with rejects, and validation in one job."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.operators.quality import Rule, apply_rules, broken_bits, rejected_rows, rule_names
from cairn.session import scratch_dir
from cairn.sources.files import FILE_COLUMN, LOAD_COLUMN, ingest_new, list_files, read_checked
from cairn.sources.tables import create_layers, read_table, replace_rows, table_exists, write_table
from cairn.sources.validated import validated, write_validated
from tests.conftest import rows


@pytest.fixture
def table(spark, request):
    name = f"loads_{abs(hash(request.node.name)) % 10**8}"
    create_layers(spark, {name: scratch_dir(spark, "db")})
    return f"{name}.orders"


def put(spark, folder, name, *ids, extra=False):
    columns = ["id", "id * 2 AS v"] + (["'x' AS extra"] if extra else [])
    spark.createDataFrame([(i,) for i in ids], "id long").coalesce(1).selectExpr(*columns).write.mode("overwrite").parquet(
        str(folder / name)
    )


def ids(spark, table):
    return sorted(r.id for r in read_table(spark, table).select("id").collect())


def paths(spark, table):
    return {p.rpartition("/versions/")[2] for p in read_table(spark, table).inputFiles()}


def test_only_new_and_changed_files_are_loaded(spark, tmp_path, table):
    put(spark, tmp_path, "a b", 1, 2)
    put(spark, tmp_path, "b", 3)
    assert ingest_new(spark, str(tmp_path), table) == (2, 3)
    before = paths(spark, table)
    assert ingest_new(spark, str(tmp_path), table) == (0, 0) and paths(spark, table) == before
    put(spark, tmp_path, "c", 4, 5)
    assert ingest_new(spark, str(tmp_path), table) == (1, 2)
    assert before < paths(spark, table) and ids(spark, table) == [1, 2, 3, 4, 5]
    # A file that changes in place replaces its rows; the load that only brought others keeps its files.
    (changed,) = (tmp_path / "c").glob("part-*.parquet")
    put(spark, tmp_path, "other", 40, 50, 60)
    (content,) = (tmp_path / "other").glob("part-*.parquet")
    changed.write_bytes(content.read_bytes())
    (changed.parent / f".{changed.name}.crc").unlink()
    for leftover in (tmp_path / "other").iterdir():
        leftover.unlink()
    os.utime(changed, (2_000_000_000, 2_000_000_000))
    assert ingest_new(spark, str(tmp_path), table) == (1, 3)
    assert ids(spark, table) == [1, 2, 3, 40, 50, 60] and before < paths(spark, table)
    held = read_table(spark, table)
    assert held.select(LOAD_COLUMN).distinct().count() == 2 and held.select(FILE_COLUMN).distinct().count() == 3


def test_a_load_that_fails_behind_the_table_doubles_nothing(spark, tmp_path, table):
    put(spark, tmp_path, "a", 1, 2)
    ingest_new(spark, str(tmp_path), table)
    put(spark, tmp_path, "b", 3)
    # As if the job had ended after the table was written and before its ledger was.
    ledger = read_table(spark, f"{table}__ledger")
    ingest_new(spark, str(tmp_path), table)
    write_table(ledger, f"{table}__ledger")
    assert ingest_new(spark, str(tmp_path), table) == (1, 1) and ids(spark, table) == [1, 2, 3]


def test_new_files_may_have_more_columns(spark, tmp_path, table):
    put(spark, tmp_path, "a", 1)
    ingest_new(spark, str(tmp_path), table)
    put(spark, tmp_path, "b", 2, extra=True)
    ingest_new(spark, str(tmp_path), table)
    assert rows(read_table(spark, table).select("id", "extra")) == [(1, None), (2, "x")]
    listed = list_files(spark, str(tmp_path))
    assert listed.count() == 2 and "content" not in listed.columns


def test_rows_are_replaced_by_condition(spark, table):
    frame = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (None, "c")], "k int, p string").coalesce(1)
    write_table(frame, table, partition_by=["p"])
    before = paths(spark, table)
    new = spark.createDataFrame([(9, "z")], "K int, p string")
    assert replace_rows(new, table, F.col("k") < 2) == 1
    assert rows(read_table(spark, table)) == sorted([(2, "a"), (3, "b"), (4, None), (None, "c"), (9, "z")], key=repr)
    assert len(before & paths(spark, table)) == len(before) - 1
    assert replace_rows(new.where("false"), table, None) == 0 and replace_rows(new.where("false"), table, F.lit(None).cast("boolean")) == 0
    assert replace_rows(new.where("false"), table, F.lit(True)) == 0 and read_table(spark, table).count() == 0
    write_table(frame, f"{table}2")
    with pytest.raises(ValueError, match="no partitions"):
        replace_rows(new, f"{table}2", None)
    assert not table_exists(spark, f"{table}3")


SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("a.b", T.DoubleType()),
        T.StructField("day", T.DateType()),
        T.StructField("name", T.StringType()),
    ]
)
LINES = [
    "id|a.b|day|name",
    "1|1.5|2020-01-02|one",
    "2|x|2020-01-02|bad number",
    "3||NULL|nulls",
    "4|2.5|2020-13-02|bad day",
    "five|y||two bad",
    "6|1|2020-01-02",
    "7|1|2020-01-02|g|h",
    '8|"4.5"|2020-01-02|"a|b"',
    "99999999999|1|2020-01-02|too large",
]


def test_malformed_rows_become_rejects(spark, tmp_path):
    Path(tmp_path / "t.csv").write_text("\n".join(LINES) + "\n")
    typed, rejects = read_checked(spark, str(tmp_path), SCHEMA, sep="|", null_text="NULL")
    assert typed.columns == ["id", "a.b", "day", "name"]
    assert sorted(r.id for r in typed.select("id").collect()) == [1, 3, 8]
    got = {r.line.split("|")[0]: (r.line, r.failed_columns) for r in rejects.collect()}
    assert {k: v[1] for k, v in got.items()} == {
        "2": ["a.b"], "4": ["day"], "five": ["id", "a.b"], "6": [], "7": [], "99999999999": ["id"],
    }
    assert all(line in LINES for line, _ in got.values())
    (file,) = {r.file for r in rejects.select("file").collect()}
    assert file.endswith("/t.csv")
    # What is selected changes no verdict.
    assert typed.select("name").count() == 3 and rejects.select("file").count() == 6
    typed, rejects = read_checked(spark, str(tmp_path), SCHEMA, sep="|")
    assert {r[0] for r in typed.select("id").collect()} == {1, 8}


def test_empty_text_has_neither_rows_nor_rejects(spark, tmp_path):
    Path(tmp_path / "t.csv").write_text("id|a.b|day|name\n")
    typed, rejects = read_checked(spark, str(tmp_path), SCHEMA, sep="|")
    assert typed.count() == 0 and rejects.count() == 0


RULES = [Rule("positive", "amount > 0"), Rule("dated", "day IS NOT NULL"), Rule("small", "amount < 100")]


def test_rows_are_validated_in_one_scan(spark, table, tmp_path):
    data = [(1, 5, "d"), (2, -1, None), (3, 500, "d"), (4, None, "d"), (5, 99, "d")]
    spark.createDataFrame(data, "id int, amount int, day string").write.parquet(str(tmp_path / "in"))
    frame = spark.read.parquet(str(tmp_path / "in"))
    # Each evaluation of the input writes a random id; one evaluation gives each row one.
    counted = frame.withColumn("drawn", F.expr("uuid()"))
    assert write_validated(counted, RULES, table) == (2, 3)
    assert read_table(spark, table).select("drawn").distinct().count() == 5
    valid, rejected = validated(spark, table, RULES)
    assert rows(valid.drop("drawn")) == rows(apply_rules(frame, RULES))
    assert rows(rejected.drop("drawn")) == rows(rejected_rows(frame, RULES))
    for part in (valid, rejected):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Scan parquet") == 1 and len(part.inputFiles()) < len(read_table(spark, table).inputFiles())


def test_bits_of_many_rules(spark):
    rules = [Rule(f"r{i}", f"id <> {i}") for i in range(63)]
    got = spark.range(64).select("id", rule_names(broken_bits(rules), rules).alias("names")).collect()
    assert all(r.names == ([f"r{r.id}"] if r.id < 63 else []) for r in got)
    assert spark.range(1).select(rule_names(broken_bits([]), [])).first()[0] == []
    with pytest.raises(ValueError):
        broken_bits([*rules, rules[0]])
