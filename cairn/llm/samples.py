"""Bounded samples of rows that depend on nothing but the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.scratch import stored

# A sample is a list on the driver, and is broadcast to fetch its rows.
MOST = 100_000


def unit(value: Column) -> Column:
    """A 64-bit hash as a number from 0 up to 1."""
    return F.shiftrightunsigned(value, 11) / F.lit(float(1 << 53))


def sample(
    rows: DataFrame,
    value: Column,
    also: Sequence[Column],
    limit: int,
    copies: bool,
    among: Callable[[DataFrame], DataFrame] = lambda hashed: hashed,
) -> DataFrame:
    """At most ``limit`` rows, one per different row: ``place`` from 0, ``weight`` and ``value``.

    Rows are different if ``value`` or one of ``also`` is, told apart by hashes.
    With ``copies`` equal rows weigh in the sample as they do in the table, and
    the weights' sum is bounded; else each different row counts once. The choice
    is by a hash of the row, so neither splits nor cluster change it. Only hashes
    and counts are shuffled, never values but those chosen. ``among`` narrows the
    hashed rows, in which ``also`` is there as ``also0`` and so on; it must keep
    or drop all equal rows.
    """
    if limit > MOST:
        raise ValueError(f"a sample has at most {MOST} rows")
    hashes = F.xxhash64(value, *also).alias("k"), F.xxhash64(value, *also, F.lit(1)).alias("l")
    hashed = among(rows.select(*[c.alias(f"also{i}") for i, c in enumerate(also)], *hashes))
    groups = stored(hashed.groupBy("k", "l").agg(F.count(F.lit(1)).alias("n")), "sample-rows")
    total = groups.agg(F.sum("n") if copies else F.count(F.lit(1))).first()[0] or 0
    drawn = unit(F.xxhash64("k", "l"))
    expected = F.least(F.lit(1.0), F.lit(limit / max(1, total))) * (F.col("n") if copies else F.lit(1))
    whole = F.floor(expected)
    weighed = groups.select("k", "l", drawn.alias("u"), (whole + (drawn < expected - whole).cast("long")).alias("weight"))
    found = weighed.where("weight > 0").orderBy("u", "k", "l").limit(limit).collect()
    chosen, left = [], limit
    for row in found:
        weight = min(left, row.weight)
        if weight:
            chosen.append((len(chosen), weight, row.k, row.l))
        left -= weight
    listed = rows.sparkSession.createDataFrame(chosen, "place int, weight long, ck long, cl long")
    same = (F.col("k") == F.col("ck")) & (F.col("l") == F.col("cl"))
    return rows.select(value.alias("value"), *hashes).join(F.broadcast(listed), same).groupBy("place", "weight").agg(F.first("value").alias("value"))
