"""The daily aggregate, kept up to date from the changes of the fact.

The state is a table of sums per product and day, with the number of sales, in
partitions by month. A change of the fact is a set of rows that were removed and
one of rows that were added; an updated row is in both. Their signed sums per
product and day are added to the state of the months they touch, and only these
partitions are read and written. Names are joined when the aggregate is read, so a change
of the product dimension changes no state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.plans.gold import with_product_names
from cairn.sources.tables import read_table, replace_rows, write_table

_GROUP = ("ProductKey", "OrderDate")
# Year and month of the day, as the partition column.
MONTH = "OrderMonth"
_SUMS = {"Sales": "long", "Qty": "long", "Amount": "decimal(38,6)"}


def signed_sums(rows: DataFrame, sign: int = 1) -> DataFrame:
    """Number, quantity and amount of fact rows per product and day, all with that sign."""
    grouped = rows.groupBy("ProductKey", F.to_date("OrderDateKey").alias("OrderDate"))
    sums = {"Sales": F.count(F.lit(1)), "Qty": F.sum("OrderQty"), "Amount": F.sum("LineTotal")}
    return grouped.agg(*[(F.lit(sign) * v).cast(_SUMS[n]).alias(n) for n, v in sums.items()])


def _added_up(parts: DataFrame) -> DataFrame:
    """Sums of equal groups; a NULL product or day is a group like others, and groups without sales go."""
    totals = parts.groupBy(*_GROUP).agg(*[F.sum(n).cast(kind).alias(n) for n, kind in _SUMS.items()])
    return totals.where("Sales <> 0")


def _with_month(sums: DataFrame) -> DataFrame:
    return sums.withColumn(MONTH, (F.year("OrderDate") * 100 + F.month("OrderDate")).cast("int"))


def create_daily(fact: DataFrame, table: str) -> int:
    """Write the state from the whole fact. Returns the number of products and days."""
    return write_table(_with_month(signed_sums(fact)), table, partition_by=[MONTH])


def change_daily(spark: SparkSession, table: str, removed: DataFrame, added: DataFrame) -> int:
    """Bring the state up to date; both frames have the fact's columns. Returns the months that were touched.

    A row that never was in the fact must not be removed: the state cannot tell.
    """
    deltas = signed_sums(added).unionByName(signed_sums(removed, -1)).groupBy(*_GROUP)
    deltas = deltas.agg(*[F.sum(n).cast(kind).alias(n) for n, kind in _SUMS.items()])
    # The driver gets the months that changed, which are partitions of the table.
    months = [row[0] for row in _with_month(deltas).select(MONTH).distinct().collect()]
    if not months:
        return 0
    touched = F.col(MONTH).isin([m for m in months if m is not None])
    if None in months:
        touched = touched | F.col(MONTH).isNull()
    state = read_table(spark, table).where(touched).drop(MONTH)
    replace_rows(_with_month(_added_up(state.unionByName(deltas))), table, touched)
    return len(months)


def read_daily(spark: SparkSession, table: str, product: DataFrame) -> DataFrame:
    """The daily aggregate, as :func:`cairn.plans.gold.ft_agg_product_day` gives it."""
    state = read_table(spark, table).select(F.col("ProductKey").alias("FactKey"), "OrderDate", "Qty", "Amount")
    return with_product_names(state, product)
