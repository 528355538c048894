import pytest
import json

from pyspark.sql import functions as F

from cairn.operators.schema import has_layout
from cairn.plans.types import INT, TEXT, Optional, columns
from cairn.session import scratch_dir
from cairn.sources.files import (
    LINEAGE_COLUMN,
    PlannedLoad,
    active_loads,
    discover,
    ingest_all,
    load_plan,
    read_delimited,
    read_delimited_lines,
    read_files,
)
from cairn.sources.tables import create_layers, read_table
from tests.conftest import rows


def landing(spark, root):
    spark.range(3).write.parquet(str(root / "sales" / "orders.parquet"))
    spark.range(5).write.parquet(str(root / "people" / "person.parquet"))
    (root / "people" / "_SUCCESS").write_text("")
    (root / "loose.parquet").write_text("a file beside the folders")


def test_discover_lists_one_level_of_folders(spark, tmp_path):
    landing(spark, tmp_path)
    found = discover(spark, str(tmp_path))
    assert sorted(found) == ["orders", "person"]
    assert found["orders"].file_path.endswith("sales/orders.parquet")


def test_equal_stems_are_told_apart_by_their_folder(spark, tmp_path):
    for folder in ("a", "b"):
        spark.range(1).write.parquet(str(tmp_path / folder / "t.parquet"))
    found = discover(spark, str(tmp_path))
    assert sorted(found) == ["a_t", "b_t"] and found["b_t"].file_path.endswith("b/t.parquet")
    assert discover(spark, str(tmp_path), repeated="last")["t"].file_path.endswith("b/t.parquet")
    spark.range(1).write.parquet(str(tmp_path / "c" / "a_t.parquet"))
    with pytest.raises(ValueError, match="a_t"):
        discover(spark, str(tmp_path))


def test_ingest_reports_failures_and_goes_on(spark, tmp_path):
    landing(spark, tmp_path)
    create_layers(spark, {"ingest_db": scratch_dir(spark, "db")})
    plan = [*discover(spark, str(tmp_path)).values(), PlannedLoad("gone", str(tmp_path / "gone"))]
    report = {r.table_name: r for r in ingest_all(spark, plan, "ingest_db").collect()}
    assert report["orders"].status == "loaded" and report["orders"].row_count == 3
    assert report["person"].row_count == 5
    assert report["gone"].status == "failed" and "gone" in report["gone"].error
    held = read_table(spark, "ingest_db.orders")
    assert held.columns == ["id", LINEAGE_COLUMN] and held.where(F.col(LINEAGE_COLUMN).isNull()).isEmpty()


def test_control_table_selects_loads(spark):
    plan = load_plan(spark, {n: PlannedLoad(n, f"/x/{n}") for n in ("a", "b", "c")})
    control = spark.createDataFrame([("a", 1), ("b", 0), ("z", 1)], "table_name string, active int")
    assert rows(active_loads(plan, control)) == [("a", "/x/a")]


def test_json_documents_may_span_lines(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps([{"a": 1}, {"a": 2}], indent=2))
    (tmp_path / "two.json").write_text(json.dumps({"a": 3}, indent=2))
    assert rows(read_files(spark, str(tmp_path), "json")) == [(1,), (2,), (3,)]


LINES = ["id|name|rate", "1|x|4", "2|NULL|NULL", "3||7"]


def test_delimited_text_inferred_and_typed(spark, tmp_path):
    inferred = read_delimited_lines(spark, LINES, sep="|")
    assert [f.dataType.simpleString() for f in inferred.schema] == ["int", "string", "string"]
    declared = columns(id=INT, name=TEXT, rate=Optional(INT))
    typed = read_delimited_lines(spark, LINES, sep="|", schema=declared)
    assert rows(typed) == sorted([(1, "x", 4), (2, "NULL", None), (3, None, 7)], key=repr)
    assert has_layout(typed, declared) and all(f.nullable for f in typed.schema.fields)
    (tmp_path / "t.csv").write_text("\n".join(LINES))
    assert rows(read_delimited(spark, str(tmp_path / "t.csv"), "|", declared)) == rows(typed)
