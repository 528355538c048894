"""Equality of DataFrames as multisets of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# A row with more surplus copies than this is written out by several tasks.
COPIES_PER_TASK = 100_000

# Columns that are added on the way; input columns may have any other name.
_SURPLUS, _CHUNK, _COPY = "__cairn_surplus", "__cairn_chunk", "__cairn_copy"
_LEFT, _RIGHT = "__cairn_left", "__cairn_right"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` that ``right`` lacks, counting copies.

    Copies are counted before the shuffle and written out after it. A row that
    occurs very often is cut into chunks of copies, which are spread over the
    tasks.
    """
    names = [_quoted(c) for c in left.columns]
    surplus = _counted(left, right).withColumn(_SURPLUS, F.col(_LEFT) - F.col(_RIGHT))
    last_chunk = F.floor((F.col(_SURPLUS) - 1) / F.lit(COPIES_PER_TASK))
    chunks = surplus.where(F.col(_SURPLUS) > 0).select(
        *names, _SURPLUS, F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)).alias(_CHUNK)
    )
    open_copies = F.col(_SURPLUS) - F.col(_CHUNK) * F.lit(COPIES_PER_TASK)
    size = F.least(F.lit(COPIES_PER_TASK).cast("long"), open_copies)
    spread = chunks.repartition(*names, _CHUNK)
    return spread.select(*names, F.explode(F.sequence(F.lit(1).cast("long"), size)).alias(_COPY)).drop(_COPY)


def row_differences(
    left: DataFrame, right: DataFrame, left_rows: str = "left_rows", right_rows: str = "right_rows"
) -> DataFrame:
    """Distinct rows whose number of copies differs, with that number on either
    side.

    Both directions come out of one aggregation: each side is read once and
    copies are counted before the shuffle. Name the counts differently if the
    frames have columns of these names.
    """
    names = [_quoted(c) for c in left.columns]
    counts = [F.col(_LEFT).alias(left_rows), F.col(_RIGHT).alias(right_rows)]
    return _counted(left, right).where(F.col(_LEFT) != F.col(_RIGHT)).select(*names, *counts)


def _counted(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every distinct row with its number of copies on either side."""
    names = [_quoted(c) for c in left.columns]
    there, not_there = F.lit(1), F.lit(0)
    tagged = left.select(*names, there.alias(_LEFT), not_there.alias(_RIGHT)).union(
        right.select(*[_quoted(c) for c in right.columns], not_there.alias(_LEFT), there.alias(_RIGHT))
    )
    return tagged.groupBy(*names).agg(F.sum(_LEFT).alias(_LEFT), F.sum(_RIGHT).alias(_RIGHT))


# Ranges of row hashes that are compared as wholes.
RANGE_BITS = 12
_RANGE, _ROWS, _FIRST, _SECOND = "__cairn_range", "__cairn_rows", "__cairn_first", "__cairn_second"


def _hash_range(df: DataFrame, bits: int) -> Column:
    """The range of hashes that a row falls into."""
    return F.shiftrightunsigned(F.xxhash64(*[F.col(_quoted(c)) for c in df.columns]), 64 - bits)


def fingerprints(df: DataFrame, bits: int = RANGE_BITS) -> DataFrame:
    """Per range of row hashes: the number of rows and two sums of other hashes of them.

    Sums count every copy of a row and do not depend on the order, so equal
    multisets have equal fingerprints. Different ones agree by chance in one of
    2**62 cases. Tasks send one row per range.
    """
    columns = [F.col(_quoted(c)) for c in df.columns]
    low = F.lit((1 << 31) - 1).cast("long")
    sums = [
        F.sum(F.xxhash64(*columns, F.lit(seed)).bitwiseAND(low)).alias(name) for seed, name in ((1, _FIRST), (2, _SECOND))
    ]
    return df.groupBy(_hash_range(df, bits).alias(_RANGE)).agg(F.count(F.lit(1)).alias(_ROWS), *sums)


def differing_ranges(left: DataFrame, right: DataFrame, bits: int = RANGE_BITS) -> DataFrame:
    """The ranges of row hashes in which two frames differ: at most ``2**bits`` rows."""
    both = fingerprints(left, bits).unionByName(fingerprints(right, bits))
    # Fingerprints of a range that both sides have alike come as two equal rows.
    ways = both.groupBy(_RANGE, _ROWS, _FIRST, _SECOND).agg(F.count(F.lit(1)).alias("n"))
    return ways.where("n = 1").select(_RANGE).distinct()


def large_row_differences(
    left: DataFrame,
    right: DataFrame,
    left_rows: str = "left_rows",
    right_rows: str = "right_rows",
    bits: int = RANGE_BITS,
) -> DataFrame:
    """:func:`row_differences` of large frames that are nearly equal.

    Fingerprints are compared first; only rows of ranges that differ are
    shuffled and compared one by one. Each side is read twice. The frames have
    the same columns in the same order and of the same types.
    """
    if [f.dataType for f in left.schema.fields] != [f.dataType for f in right.schema.fields]:
        raise ValueError("the frames' columns differ in their types")
    differing = F.broadcast(differing_ranges(left, right, bits))

    def suspect(df: DataFrame) -> DataFrame:
        known = F.col(_RANGE) == F.col(f"{_RANGE}_2")
        marked = df.withColumn(_RANGE, _hash_range(df, bits))
        return marked.join(differing.withColumnRenamed(_RANGE, f"{_RANGE}_2"), known, "left_semi").drop(_RANGE)

    return row_differences(suspect(left), suspect(right), left_rows, right_rows)


def comparison(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: ``same_schema`` (nullability included) and ``same_rows``.

    A plan like any other: nothing runs before the result is asked for.
    """
    unequal = F.count_if(F.col(_LEFT) != F.col(_RIGHT))
    same_rows = (
        _counted(left, right).agg((unequal == 0).alias("same_rows"))
        if len(left.columns) == len(right.columns)
        else left.sparkSession.sql("SELECT false AS same_rows")
    )
    return same_rows.select(F.lit(left.schema == right.schema).alias("same_schema"), "same_rows")


def frames_equal(left: DataFrame, right: DataFrame) -> bool:
    """Equal schemas (nullability included) and equal multisets of rows."""
    return left.schema == right.schema and comparison(left, right).first().same_rows
