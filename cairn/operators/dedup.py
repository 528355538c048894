"""Keep-latest deduplication.

``row_number() = 1`` lets Spark plan a group limit on both sides of the
shuffle: each map task sends at most one row per key, so a key that holds a
third of all rows costs one row per map task, not one giant group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

_RANK = "__cairn_rank"


def keep_latest(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str = "ModifiedDate",
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the one with the greatest ``order`` value.

    Undated rows lose against dated ones. Equal dates are decided by
    ``tie_break``, ascending with NULLs first; by default these are all other
    columns, so rows that still tie are identical and a task that is run again
    keeps the same row.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in keys and c != order]
    newest_first = ", ".join(
        [f"`{order}` DESC NULLS LAST", *[f"`{c}` ASC NULLS FIRST" for c in tie_break]]
    )
    per_key = ", ".join(f"`{k}`" for k in keys)
    rank = f"row_number() OVER (PARTITION BY {per_key} ORDER BY {newest_first}) AS {_RANK}"
    return df.selectExpr("*", rank).where(f"{_RANK} = 1").drop(_RANK)


def current_rows(
    df: DataFrame,
    keys: Sequence[str],
    carry: Sequence[str] = (),
    order: str = "ModifiedDate",
    unique: bool = False,
) -> DataFrame:
    """``keys`` and ``carry`` of the latest row per key, nothing else.

    Columns are cut before the shuffle. With nothing to carry, every row of a
    key is equal, so a hash-aggregated distinct replaces the sort and window.
    ``unique`` states that the keys are unique already and skips the work.
    """
    wanted = [*keys, *carry]
    if unique:
        return df.select(*wanted)
    if not carry:
        return df.select(*wanted).distinct()
    needed = list(dict.fromkeys([*wanted, order]))
    return keep_latest(df.select(*needed), keys, order).select(*wanted)
