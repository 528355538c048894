"""Joins of a big table to lookup tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPREAD, NO_SPREAD = "__cairn_spread", "__cairn_no_spread"

_HASHED_ALIKE = (T.StringType(), T.DateType(), T.TimestampType(), T.TimestampNTZType())


def lookup_join(
    facts: DataFrame, lookup: DataFrame, keys: Mapping[str, str], how: str = "left", hot_keys: bool = True
) -> DataFrame:
    """Join ``facts`` to ``lookup`` on ``{facts column: lookup column}``.

    The two sides must not share column names. ``how`` is any join type that
    keeps or drops rows of ``facts``: left, inner, left_semi, left_anti. No
    side is forced to be broadcast: Spark does it for a lookup below its size
    threshold.

    A lookup above the threshold is joined by sort-merge, where one fact key
    may hold a third of all rows. Spark splits such a partition at run time,
    but only when both inputs are shuffled for this join. A lookup that comes
    out of a dedup on the same key is not: its old partitioning is reused. With
    ``hot_keys``, a hash of the key is a second join key (it matches exactly
    when the key does), which makes that partitioning unusable: one more shuffle
    of the lookup, and the hot partition is splittable. Turn it off for sides
    whose keys are spread evenly.
    """
    equal = [F.col(_quoted(left)) == F.col(_quoted(right)) for left, right in keys.items()]
    if hot_keys:
        equal.extend(_equal_hashes(facts, lookup, keys))
    return facts.join(lookup, reduce(and_, equal), how)


def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str], unique: bool = False) -> DataFrame:
    """Rows of ``left`` without a partner in ``right``; NULL matches nothing.

    ``left`` is read once. Its rows with a NULL key cannot match, so they get a
    second join key that spreads them over all tasks; else they would meet in
    one. Copies of a key in ``right`` are removed before the shuffle, unless
    ``unique`` states that there are none.
    """
    known = right.select(*[F.col(_quoted(k)).alias(f"__partner_{k}") for k in keys])
    known = known if unique else known.distinct()
    return spread_join(left, known, {k: f"__partner_{k}" for k in keys}, "left_anti")


def spread_join(left: DataFrame, right: DataFrame, keys: Mapping[str, str], how: str) -> DataFrame:
    """:func:`lookup_join` with the NULL keys of ``left`` spread over the tasks."""
    spread = F.when(any_null(list(keys)), F.xxhash64(*[F.col(_quoted(c)) for c in left.columns])).otherwise(0)
    # Zero for every row, in a form that the optimizer does not take for a constant.
    none = F.xxhash64(*[F.col(_quoted(k)) for k in keys.values()]).bitwiseAND(F.lit(0).cast("long"))
    joined = lookup_join(
        left.withColumn(SPREAD, spread), right.withColumn(NO_SPREAD, none), {**keys, SPREAD: NO_SPREAD}, how
    )
    return joined.drop(SPREAD, NO_SPREAD)


def any_null(columns: Sequence[str]) -> Column:
    """True when at least one of the columns is NULL."""
    return reduce(lambda a, b: a | b, [F.col(_quoted(c)).isNull() for c in columns])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _equal_hashes(facts: DataFrame, lookup: DataFrame, keys: Mapping[str, str]) -> list[Column]:
    """The comparison of the keys' hashes, if equal keys have equal hashes.

    Whole numbers are hashed as 64-bit numbers, whatever their width. Types
    whose equal values may differ in their bits have no comparison.
    """
    left, right = [], []
    for a, b in keys.items():
        kinds = (facts.schema[a].dataType, lookup.schema[b].dataType)
        if all(isinstance(kind, T.IntegralType) for kind in kinds):
            left.append(F.col(_quoted(a)).cast("long"))
            right.append(F.col(_quoted(b)).cast("long"))
        elif kinds[0] == kinds[1] and kinds[0] in _HASHED_ALIKE:
            left.append(F.col(_quoted(a)))
            right.append(F.col(_quoted(b)))
        else:
            return []
    return [F.xxhash64(*left) == F.xxhash64(*right)]
