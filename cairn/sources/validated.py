"""Valid and rejected rows, written by one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators.quality import Rule, broken_bits, rule_names
from cairn.sources.tables import read_table, write_table

VERDICT, BITS = "cairn_valid", "cairn_broken"


def write_validated(df: DataFrame, rules: Sequence[Rule], table: str, fmt: str = "parquet") -> tuple[int, int]:
    """Write all rows with the bits of their broken rules, in partitions by verdict. Returns valid and rejected rows.

    The rows are evaluated once, every rule once for each; :func:`validated`
    reads either partition alone.
    """
    marked = df.withColumn(BITS, broken_bits(rules)).withColumn(VERDICT, F.col(BITS) == 0)
    rows = write_table(marked, table, fmt, partition_by=[VERDICT])
    rejected = read_table(df.sparkSession, table).where(~F.col(VERDICT)).count()
    return rows - rejected, rejected


def validated(spark: SparkSession, table: str, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """The valid rows, and the rejected ones with the names of the rules in ``failed_rules``."""
    held = read_table(spark, table)
    valid = held.where(F.col(VERDICT)).drop(VERDICT, BITS)
    rejected = held.where(~F.col(VERDICT)).withColumn("failed_rules", rule_names(F.col(BITS), rules))
    return valid, rejected.drop(VERDICT, BITS)
