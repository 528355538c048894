"""Reading a table twice in the same partitions."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SPLITS = "spark.sql.files.minPartitionNum"


@contextmanager
def fixed_splits(spark: SparkSession) -> Iterator[None]:
    """Split files alike while this lasts, whatever executors come and go."""
    before = spark.conf.get(SPLITS, None)
    spark.conf.set(SPLITS, before or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SPLITS)
