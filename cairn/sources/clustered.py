"""Clustered tables: rows in Z-order, and an index of what each file holds.

The index is a table of its own, ``<table>__files``: a row per file with the
least and greatest value of each clustering column. :func:`read_clustered` looks
up which files a filter needs and opens no others; any other reader sees a plain
table, whose row groups are narrow for Parquet's own statistics.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators.cluster import _quoted, clustered
from cairn.session import PARTITION_BYTES, scratch_dir
from cairn.sources.tables import read_table, table_files, write_table


def write_clustered(df: DataFrame, table: str, columns: Sequence[str], files: int | None = None, fmt: str = "parquet") -> int:
    """Replace the table by these rows in Z-order of some columns. Returns their number.

    ``files`` is how many files are written; by default as many as Spark's
    estimate of the data asks for. The rows are evaluated once and kept in the
    scratch folder: quantiles, ranges and the table are taken from there.
    """
    spark = df.sparkSession
    if files is None:
        files = max(1, -(-int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) // PARTITION_BYTES))
    index = f"{table}__files"
    folder = scratch_dir(spark, "clustered")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    try:
        df.write.format(fmt).save(folder)
        held = spark.read.format(fmt).schema(df.schema).load(folder)
        rows = write_table(clustered(held, columns, files), table, fmt)
    finally:
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
    bounds = [
        bound(F.col(_quoted(c))).alias(f"{side}_{i}")
        for i, c in enumerate(columns)
        for side, bound in (("least", F.min), ("greatest", F.max))
    ]
    nulls = [F.count_if(F.col(_quoted(c)).isNull()).alias(f"nulls_{i}") for i, c in enumerate(columns)]
    held = table_files(spark, table).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), *bounds, *nulls
    )
    names = F.array(*[F.lit(c) for c in columns])
    write_table(held.withColumn("columns", names), index, fmt)
    return rows


def needed_files(spark: SparkSession, table: str, wanted: Mapping[str, tuple[Any, Any]]) -> list[str]:
    """Files that may hold rows with each column within its bounds, both included; None is no bound."""
    index = read_table(spark, f"{table}__files")
    first = index.first()
    if first is None:
        return []
    tests = [F.lit(True)]
    for name, (low, high) in wanted.items():
        if name not in first["columns"]:
            raise ValueError(f"{table} is not clustered by {name}")
        i = first["columns"].index(name)
        tests += [F.col(f"greatest_{i}") >= F.lit(low)] if low is not None else []
        tests += [F.col(f"least_{i}") <= F.lit(high)] if high is not None else []
    return sorted(row.file for row in index.where(reduce(and_, tests)).select("file").collect())


def read_clustered(spark: SparkSession, table: str, wanted: Mapping[str, tuple[Any, Any]], fmt: str = "parquet") -> DataFrame:
    """Rows of a clustered table with each named column within its bounds, both included."""
    held = read_table(spark, table)
    files = needed_files(spark, table, wanted)
    found = spark.read.format(fmt).schema(held.schema).load(files) if files else held.where(F.lit(False))
    for name, (low, high) in wanted.items():
        found = found.where(F.col(_quoted(name)) >= F.lit(low)) if low is not None else found
        found = found.where(F.col(_quoted(name)) <= F.lit(high)) if high is not None else found
    return found
