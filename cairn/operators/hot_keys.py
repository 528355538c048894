"""Joins on keys of any type, some of which hold very many rows.

A frequent-items sketch of the key hashes, one small value per map task, finds
the keys that hold more rows than a task should get. Their rows are dealt to
several tasks by a salt, and only their lookup rows are copied, once per salt.
All other keys go as in a plain join, and without hot keys the join is plain.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.operators.joins import _quoted, lookup_join

# Items that a sketch keeps; a key with more than about 1 / TRACKED of all rows is always found.
TRACKED = 4096
# Keys that are salted at most: each holds more rows than a task should get, so there are fewer than tasks.
MOST_HOT = 512
MOST_SALTS = 4096

_SALT, _OTHER_SALT = "__cairn_salt", "__cairn_other_salt"


def key_hash(columns: list[Column], kinds: list[T.DataType]) -> Column:
    """A hash that equal keys share; both zeros of a floating-point key are one."""
    return F.xxhash64(
        *[c + F.lit(0.0) if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType) else c
          for c, kind in zip(columns, kinds, strict=True)]
    )


def hot_keys(facts: DataFrame, keys: list[str], tasks: int) -> tuple[dict[int, int], bool]:
    """Hash of each key with more rows than a task's share and how many tasks it needs; whether NULL keys are that many.

    The counts are estimates; a wrong one costs balance, never a row.
    """
    kinds = [facts.schema[k].dataType for k in keys]
    columns = [F.col(_quoted(k)) for k in keys]
    hashed = facts.select(F.when(~_some_null(columns), key_hash(columns, kinds)).alias("h"))
    found = hashed.agg(
        F.count(F.lit(1)).alias("n"), F.count("h").alias("known"), F.call_function("approx_top_k", F.col("h"), F.lit(MOST_HOT), F.lit(TRACKED)).alias("top")
    ).first()
    share = max(1, found.n // tasks)
    top = found.top if found.known else []
    hot = {t.item: min(MOST_SALTS, -(-t["count"] // share)) for t in top if t.item is not None and t["count"] > share}
    return hot, found.n - found.known > share


def _some_null(columns: list[Column]) -> Column:
    found = columns[0].isNull()
    for column in columns[1:]:
        found = found | column.isNull()
    return found


def salted_join(
    facts: DataFrame, lookup: DataFrame, keys: Mapping[str, str], how: str = "left", tasks: int | None = None
) -> DataFrame:
    """Join ``facts`` to ``lookup`` on ``{facts column: lookup column}``.

    As :func:`cairn.operators.joins.lookup_join`, for keys of any type; ``how``
    keeps or drops rows of ``facts``. ``facts`` is read twice, once for its key
    columns only. Rows of a hot key are dealt by a hash of all their columns.
    ``tasks`` is the number of tasks that share the work, that of a shuffle by
    default.
    """
    spark = facts.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    own, others = list(keys), list(keys.values())
    hot, many_null = hot_keys(facts, own, tasks)
    if not hot and not many_null:
        return lookup_join(facts, lookup, keys, how, hot_keys=False)
    kinds = [facts.schema[k].dataType for k in own]
    left = [F.col(_quoted(k)) for k in own]
    right = [F.col(_quoted(k)).cast(kind) for k, kind in zip(others, kinds, strict=True)]
    # Only hashes that are listed are looked up: a map is searched from end to end.
    salts = F.create_map(*[F.lit(x) for pair in hot.items() for x in pair]) if hot else None
    count = lambda h: F.when(h.isin(list(hot)), F.element_at(salts, h)).otherwise(1) if hot else F.lit(1)
    spread = F.xxhash64(*[F.col(_quoted(c)) for c in facts.columns], F.lit(1))
    # A NULL key has no partner, so its rows may go anywhere.
    dealt = F.when(_some_null(left), F.lit(tasks)).otherwise(count(key_hash(left, kinds)))
    salted = facts.withColumn(_SALT, F.pmod(spread, dealt).cast("int"))
    copied = lookup.withColumn(_OTHER_SALT, F.explode_outer(F.sequence(F.lit(0), count(key_hash(right, kinds)) - 1)))
    joined = lookup_join(salted, copied, {**keys, _SALT: _OTHER_SALT}, how, hot_keys=False)
    return joined.drop(_SALT, _OTHER_SALT)
