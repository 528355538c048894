import pytest
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from cairn.functions import columns as C
from cairn.plans.types import columns as schema
from cairn.plans.types import INT, LONG, MONEY, TEXT, widen_ids
from tests.conftest import rows


def test_cast_projection_orders_columns_and_nulls_bad_text(spark):
    df = spark.createDataFrame([("NULL", "7.25", "x"), ("3", "bad", None)], "a string, b string, Group string")
    out = C.cast_projection(df, schema(Group=TEXT, b=MONEY, a=INT))
    assert out.columns == ["Group", "b", "a"]
    assert rows(out) == [("x", Decimal("7.2500"), None), (None, None, 3)]


def test_cast_projection_keeps_large_ids_if_they_are_wide(spark):
    df = spark.createDataFrame([(2**40,)], "OrderID long")
    narrow = schema(OrderID=INT)
    assert rows(C.cast_projection(df, widen_ids(narrow))) == [(2**40,)]
    assert widen_ids(narrow)["OrderID"].dataType == LONG


def test_project_may_use_a_column_twice(spark):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    out = C.project(df, {"Key": "id", "AlternateKey": "id", "Name": "name"})
    assert rows(out) == [(1, 1, "a")]


def test_random_ids_fill_only_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "kept")], "k int, rowguid string")
    filled = {k: v for k, v in df.select("k", C.default_random_id("rowguid")).collect()}
    assert filled[3] == "kept"
    assert filled[1] != filled[2] and len(filled[1]) == 36


def test_key_ids_are_stable_and_differ_per_key_and_label(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "kept")], "k int, rowguid string")
    first = rows(df.select("k", C.default_key_id("rowguid", "t", ["k"])))
    assert first == rows(df.select("k", C.default_key_id("rowguid", "t", ["k"])))
    assert first[2] == (3, "kept")
    assert len({v for _, v in first}) == 3 and [len(p) for p in first[0][1].split("-")] == [8, 4, 4, 4, 12]
    assert first[0] != rows(df.select("k", C.default_key_id("rowguid", "u", ["k"])))[0]


def test_load_time_default(spark):
    day = dt.datetime(2020, 1, 2)
    df = spark.createDataFrame([(day,), (None,)], "d timestamp")
    fixed = F.lit("2030-01-01").cast("timestamp")
    assert rows(df.select(C.default_load_time("d", fixed))) == sorted(
        [(day,), (dt.datetime(2030, 1, 1),)], key=repr
    )
    assert df.select(C.default_load_time("d").alias("d")).where("d IS NULL").isEmpty()


def test_account_number_is_padded_to_nine_digits(spark):
    df = spark.createDataFrame([(42, None), (7, "X1")], "id int, n string")
    assert rows(df.select(C.default_account_number("n", "id"))) == [("AW000000042",), ("X1",)]


def test_null_if_before(spark):
    a, b = dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2)
    df = spark.createDataFrame([(1, a, b), (2, b, a), (3, a, None), (4, a, a)], "k int, s timestamp, e timestamp")
    assert rows(df.select("k", C.null_if_before("e", "s"))) == [(1, b), (2, None), (3, None), (4, a)]


def test_guarded_total_is_zero_with_a_null_part(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 1.5BD, 2.25BD), (2, NULL, 2.25BD) AS t(k, a, b)")
    assert rows(df.select("k", C.guarded_total("a", "b"))) == [(1, Decimal("3.75")), (2, Decimal(0))]


def test_line_amounts_differ_between_silver_and_fact(spark):
    df = spark.sql(
        "SELECT CAST(10 AS DECIMAL(19,4)) AS price, CAST(0.1 AS DECIMAL(19,4)) AS off, CAST(3 AS SMALLINT) AS qty"
    )
    fact = C.fact_measures("qty", "price", "off", F.lit(4))
    out = df.select(C.line_total("price", "off", "qty").alias("silver"), *[v.alias(k) for k, v in fact.items()])
    row = out.first().asDict()
    assert row == {
        "silver": Decimal("27.000000"),
        "ExtendedAmount": Decimal(30),
        "DiscountAmount": Decimal(1),
        "LineTotal": Decimal("29.000000"),
        "TotalProductCost": 12,
    }
    assert out.schema["silver"].dataType.simpleString() == "decimal(38,6)"
    assert out.schema["LineTotal"].dataType.simpleString() == "decimal(38,6)"


def test_full_name_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([("A", "B"), ("A", None)], "f string, l string")
    assert rows(df.select(C.full_name("f", "l"))) == [("A B",), (None,)]


def test_calendar(spark):
    sunday, july = dt.datetime(2023, 1, 1), dt.datetime(2024, 7, 1, 15)
    df = spark.createDataFrame([(sunday,), (july,)], "d timestamp")
    out = rows(C.project(df, C.calendar("d")))
    assert out == [
        (1, "Monday", 1, 183, 27, "July", 7, 3, 2024, 2),
        (7, "Sunday", 1, 1, 52, "January", 1, 1, 2023, 1),
    ]


def test_numeric_text_becomes_numbers(spark):
    declared = schema(n=INT, m=MONEY, t=TEXT)
    amount = "123456789012345.6789"
    given = [("12", "1.5", "9"), ("NULL", "x", "NULL"), (" 5.0 ", amount, ""), ("4e3", "-.5", "5d"), ("5d", "NaN", None)]
    df = spark.createDataFrame(given, "n string, m string, t string")
    out = C.numeric_text_as_numbers(df, declared)
    assert [f.dataType.simpleString() for f in out.schema] == ["bigint", "decimal(19,4)", "string"]
    assert [(r.n, None if r.m is None else str(r.m)) for r in out.collect()] == [
        (12, "1.5000"),
        (None, None),
        (5, amount),
        (4000, "-0.5000"),
        (None, None),
    ]


@pytest.mark.parametrize("value, kind", [(1 << 31, "long"), (3e9, "double"), ("3000000000", "string")])
def test_a_number_that_does_not_fit_fails(spark, value, kind):
    df = spark.createDataFrame([(value,)], f"n {kind}")
    with pytest.raises(Exception, match="OVERFLOW"):
        C.cast_projection(df, schema(n=INT)).collect()


def test_keys_that_look_alike_have_different_ids(spark):
    keys = [("a|b", "c"), ("a", "b|c"), ("", None), (None, "")]
    df = spark.createDataFrame([(*k, None) for k in keys], "a string, b string, rowguid string")
    ids = df.select(C.default_key_id("rowguid", "t", ["a", "b"])).collect()
    assert len(set(ids)) == 4
