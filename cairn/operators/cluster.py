"""Rows laid out so that files hold narrow ranges of several columns at once (Z-order).

Each column is cut into equally full bands at its quantiles. The bits of a row's
band numbers are interleaved to one number, whose neighbours are near in all
columns, and rows are dealt to files by ranges of it. Quantiles, bands and bits
are built-in expressions. A value that many rows share fills one band; rows that
agree in all bands are told apart by a hash, so that ranges can cut between them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bits of a band number: 64 bands for each column.
BAND_BITS = 6
# Accuracy of the quantiles: ranks are right within a ten-thousandth of the rows.
ACCURACY = 10_000

_PLACE = "__cairn_place"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _number(df: DataFrame, name: str) -> Column:
    """A column's values as numbers in the same order."""
    kind, column = df.schema[name].dataType, F.col(_quoted(name))
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("double")
    if isinstance(kind, T.NumericType):
        return column.cast("double")
    raise ValueError(f"{name} is {kind.simpleString()}; rows are laid out by numbers, dates and times")


def band(value: Column, cuts: Sequence[float]) -> Column:
    """How many of the ascending cuts lie below a value, by halving; NULL counts as lowest."""
    if not cuts:
        return F.lit(0)
    middle = len(cuts) // 2
    above = F.lit(middle + 1) + band(value, cuts[middle + 1 :])
    return F.when(value > F.lit(cuts[middle]), above).otherwise(band(value, cuts[:middle]))


def interleaved(bands: Sequence[Column], bits: int = BAND_BITS) -> Column:
    """The bits of all band numbers in turn, highest first."""
    out = []
    for i in range(bits):
        for j, number in enumerate(bands):
            bit = F.shiftright(number, i).bitwiseAND(F.lit(1)).cast("long")
            out.append(F.call_function("shiftleft", bit, F.lit(i * len(bands) + len(bands) - 1 - j)))
    return reduce(lambda a, b: a.bitwiseOR(b), out)


def z_value(df: DataFrame, columns: Sequence[str], bits: int = BAND_BITS) -> Column:
    """The interleaved bands of some columns, whose quantiles one pass finds."""
    shares = F.array(*[F.lit(i / 2**bits) for i in range(1, 2**bits)])
    numbers = [_number(df, c) for c in columns]
    found = df.agg(*[F.percentile_approx(n, shares, F.lit(ACCURACY)).alias(f"q{i}") for i, n in enumerate(numbers)]).first()
    cuts = [sorted(set(q or [])) for q in found]
    return interleaved([band(n, c) for n, c in zip(numbers, cuts, strict=True)], bits)


def clustered(df: DataFrame, columns: Sequence[str], files: int, bits: int = BAND_BITS) -> DataFrame:
    """The same rows in ``files`` partitions, each a range of the Z-order of ``columns``."""
    if bits * len(columns) > 62:
        raise ValueError("the bits of all columns do not fit one number")
    spread = F.xxhash64(*[F.col(_quoted(c)) for c in df.columns])
    placed = df.withColumn(_PLACE, z_value(df, columns, bits))
    dealt = placed.repartitionByRange(files, F.col(_PLACE), spread)
    return dealt.sortWithinPartitions(_PLACE, *[F.col(_quoted(c)) for c in columns]).drop(_PLACE)
