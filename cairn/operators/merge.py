"""Upsert as a DataFrame: the state of a table after a merge."""

from __future__ import annotations

from collections.abc import Sequence
from enum import Enum
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators.bitmap import split_by_keys, worth_filtering
from cairn.operators.joins import any_null, anti_join, lookup_join, spread_join


class Unmatched(Enum):
    """What happens to target rows without a source row."""

    KEEP = "keep"
    DELETE = "delete"


class DuplicateKeys(ValueError):
    """The source holds a key more than once."""


def merge_frames(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    unmatched: Unmatched = Unmatched.KEEP,
    delete_where: str | None = None,
    source_rows: int | None = None,
    key_filter: bool | None = None,
) -> DataFrame:
    """The rows of ``target`` after merging ``source`` into it.

    Keys are compared with ``=``: a source row with a NULL key is always
    inserted, a target row with one is never touched. Columns only the source
    has are added. Columns only the target has keep their value in updated
    rows and are NULL in inserted ones. ``delete_where`` narrows
    ``Unmatched.DELETE`` to target rows that satisfy it.

    A source key that comes twice fails the job. Target keys are taken to be
    unique. Names are matched as Spark matches them: without regard to case
    unless the session says otherwise.

    Given the number of source rows, a bitmap of the source's keys sends target
    rows that cannot match past the join. ``key_filter`` says whether to use it;
    by default that is decided by whether it saves a shuffle.
    """
    source, keys = as_in_target(target, source), spelled(target, keys)
    written = written_rows(target, source, keys)
    kept = kept_rows(target, source, keys, unmatched, delete_where, source_rows, key_filter)
    merged = written.unionByName(kept, allowMissingColumns=True)
    return merged.unionByName(_no_rows_unless_repeated(source, keys), allowMissingColumns=True)


def spelled(target: DataFrame, names: Sequence[str]) -> list[str]:
    """The names as the target spells them."""
    if target.sparkSession.conf.get("spark.sql.caseSensitive") == "true":
        return list(names)
    known = {c.lower(): c for c in target.columns}
    return [known.get(name.lower(), name) for name in names]


def as_in_target(target: DataFrame, source: DataFrame) -> DataFrame:
    """The source with the target's spelling of common columns."""
    return source.toDF(*spelled(target, source.columns))


def _no_rows_unless_repeated(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """An empty frame whose evaluation fails if a key of the source repeats."""
    message = f"the source repeats a value of {', '.join(keys)}"
    failing = F.when(F.col("copies") > 1, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(False))
    return duplicate_keys(source, keys).where(failing).drop("copies")


def written_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Updated and inserted rows: the source in the target's layout.

    The target is read only when it has columns that the source lacks. Source
    rows with a NULL key are spread over the tasks of that join.
    """
    types = {f.name: f.dataType for f in target.schema.fields}
    aligned = typed_as(target, source)
    carried = [c for c in target.columns if c not in source.columns]
    if carried:
        partner = {k: f"__partner_{k}" for k in keys}
        old = target.select(*[_column(k).alias(name) for k, name in partner.items()], *map(_column, carried))
        aligned = spread_join(aligned, old, partner, "left").drop(*partner.values())
    return aligned.select(*map(_column, target.columns), *[_column(c) for c in source.columns if c not in types])


def typed_as(target: DataFrame, source: DataFrame) -> DataFrame:
    """The source with the target's types of common columns."""
    types = {f.name: f.dataType for f in target.schema.fields}
    return source.select(*[_column(c).cast(types[c]).alias(c) if c in types else _column(c) for c in source.columns])


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def kept_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    unmatched: Unmatched = Unmatched.KEEP,
    delete_where: str | None = None,
    source_rows: int | None = None,
    key_filter: bool | None = None,
) -> DataFrame:
    """Target rows that stay as they are.

    An unconditional delete leaves only rows with a NULL key, which needs no
    join at all.
    """
    if unmatched is Unmatched.KEEP:
        return _unmatched(target, source, keys, source_rows, key_filter)
    if delete_where is None:
        return target.where(any_null(keys))
    spared = any_null(keys) | ~F.coalesce(F.expr(delete_where), F.lit(False))
    return _unmatched(target.where(spared), source, keys, source_rows, key_filter)


def matched_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], source_rows: int | None = None) -> DataFrame:
    """Target rows with a partner in the source, whose keys are unique."""
    known = source.select(*[_column(k).cast(target.schema[k].dataType).alias(k) for k in keys])
    if source_rows is not None and worth_filtering(target, known, keys, source_rows):
        target, _ = split_by_keys(target, known, keys, source_rows)
    return lookup_join(target, known.toDF(*[f"__partner_{k}" for k in keys]), {k: f"__partner_{k}" for k in keys}, "left_semi")


def merge_in_place(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    unmatched: Unmatched = Unmatched.KEEP,
    delete_where: str | None = None,
) -> DataFrame:
    """The merged rows by one full join on the keys alone.

    For sides that are dealt alike by the keys, such as tables in equal buckets:
    neither is shuffled. The source has the target's names and types, and unique
    keys. NULL keys match nothing, so both sides' rows with one stay.
    """
    doomed = F.lit(unmatched is Unmatched.DELETE)
    if delete_where is not None:
        doomed = doomed & F.coalesce(F.expr(delete_where), F.lit(False))
    marked = target.select("*", (doomed & ~any_null(keys)).alias("__doomed"))
    left = marked.toDF(*[f"t{i}" for i in range(len(target.columns))], "doomed")
    right = source.toDF(*[f"s{i}" for i in range(len(source.columns))]).withColumn("given", F.lit(True))
    old = {c: F.col(f"t{i}") for i, c in enumerate(target.columns)}
    new = {c: F.col(f"s{i}") for i, c in enumerate(source.columns)}
    joined = left.join(right, reduce(and_, [old[k] == new[k] for k in keys]), "full")
    given = F.coalesce("given", F.lit(False))
    both = {c: F.when(given, new[c]).otherwise(old[c]) if c in new else old[c] for c in old}
    more = [v.alias(c) for c, v in new.items() if c not in old]
    return joined.where(given | ~F.col("doomed")).select(*[v.alias(c) for c, v in both.items()], *more)


def _unmatched(
    target: DataFrame, source: DataFrame, keys: Sequence[str], source_rows: int | None, key_filter: bool | None
) -> DataFrame:
    if source_rows is None or key_filter is False:
        return anti_join(target, source, keys, unique=True)
    known = source.select(*[_column(k).cast(target.schema[k].dataType).alias(k) for k in keys])
    if not (key_filter or worth_filtering(target, known, keys, source_rows)):
        return anti_join(target, source, keys, unique=True)
    possible, alone = split_by_keys(target, known, keys, source_rows)
    return alone.union(anti_join(possible, known, keys, unique=True))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys without NULLs that occur more than once, with their row count."""
    return (
        df.where(~any_null(keys))
        .groupBy(*map(_column, keys))
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )
