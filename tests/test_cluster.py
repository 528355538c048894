from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from cairn.operators.cluster import band, clustered, interleaved
from cairn.session import scratch_dir
from cairn.sources.clustered import needed_files, read_clustered, write_clustered
from cairn.sources.tables import create_layers, read_table, write_table
from tests.conftest import rows

DAYS = 400


def facts(spark, n=20_000, hot=0.0):
    product = f"IF(id % 100 < {int(hot * 100)}, 7L, pmod(xxhash64(id), 1000))"
    day = f"date_add(DATE'2020-01-01', CAST(pmod(xxhash64(id, 5), {DAYS}) AS INT))"
    return spark.range(n).selectExpr(f"{day} AS `order.day`", f"{product} AS product", "id", "CAST(id AS DECIMAL(10, 2)) AS price")


@pytest.fixture
def table(spark, request):
    name = f"clustered_{abs(hash(request.node.name)) % 10**8}"
    create_layers(spark, {name: scratch_dir(spark, "db")})
    return f"{name}.facts"


def test_bands_and_bits(spark):
    frame = spark.createDataFrame([(None,), (-1.0,), (1.0,), (1.5,), (3.0,), (99.0,)], "x double")
    assert [r[0] for r in frame.select(band(F.col("x"), [1.0, 2.0, 3.0])).collect()] == [0, 0, 0, 1, 2, 3]
    pair = spark.createDataFrame([(0b101, 0b011), (0, 7), (63, 0)], "a int, b int")
    got = [r[0] for r in pair.select(interleaved([F.col("a"), F.col("b")])).collect()]
    assert got == [0b100111, 0b010101, 0b101010101010]


@pytest.mark.parametrize("hot", [0.0, 0.33])
def test_a_filter_on_either_column_opens_few_files(spark, table, hot):
    frame = facts(spark, hot=hot)
    assert write_clustered(frame, table, ["order.day", "product"], files=64) == 20_000
    assert rows(read_table(spark, table)) == rows(frame)
    total = len(needed_files(spark, table, {}))
    assert total >= 60
    day = date(2020, 1, 1) + timedelta(days=123)
    for wanted in ({"order.day": (day, day)}, {"product": (500, 500)}, {"product": (None, 20)} if not hot else {"product": (990, None)}):
        files = needed_files(spark, table, wanted)
        assert len(files) <= total / 4
        (name, (low, high)), = wanted.items()
        column = F.col(f"`{name}`")
        kept = (column >= low if low is not None else F.lit(True)) & (column <= high if high is not None else F.lit(True))
        found = read_clustered(spark, table, wanted)
        assert rows(found) == rows(frame.where(kept)) and len(found.inputFiles()) == len(files)
    both = {"order.day": (day, day), "product": (400, 600)}
    assert len(needed_files(spark, table, both)) <= total / 8


def test_rows_are_evaluated_once(spark, table):
    seen = spark.sparkContext.accumulator(0)

    def counted(number):
        seen.add(1)
        return number

    frame = facts(spark, 500).withColumn("product", F.udf(counted, "long")("product"))
    assert write_clustered(frame, table, ["product"], files=4) == 500
    assert seen.value == 500


def test_hot_rows_are_shared_by_files(spark):
    frame = facts(spark).withColumn("product", F.lit(3)).withColumn("order.day", F.lit(date(2020, 1, 1)))
    sizes = [r["count"] for r in clustered(frame, ["order.day", "product"], 10).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 10 and max(sizes) < 3 * min(sizes)


def test_odd_tables(spark, table):
    frame = facts(spark, 50).withColumn("product", F.when(F.col("id") % 2 == 0, F.col("product")))
    write_clustered(frame, table, ["product"])
    assert read_table(spark, table).count() == 50
    assert read_clustered(spark, table, {"product": (None, 10**6)}).count() == 25
    write_clustered(frame.where("false"), table, ["product", "price"])
    assert read_clustered(spark, table, {"product": (1, 2)}).count() == 0
    write_clustered(frame.select(F.col("id"), F.lit(None).cast("double").alias("none")), table, ["none", "id"], files=4)
    assert read_clustered(spark, table, {"id": (3, 5)}).count() == 3
    with pytest.raises(ValueError, match="not clustered by"):
        read_clustered(spark, table, {"day": (1, 2)})
    with pytest.raises(ValueError, match="numbers, dates and times"):
        write_clustered(spark.createDataFrame([("a",)], "t string"), table, ["t"])
    with pytest.raises(ValueError, match="do not fit"):
        clustered(frame, ["id"] * 11, 2)
    write_table(frame, table, partition_by=["product"])
    assert read_table(spark, table).count() == 50
