"""Catalog tables: creating layers, replacing tables and upserting into them.

A table is a view over one version: a catalog entry ``<table>__<version>`` with
a folder of its own. Each write goes to a new folder and becomes visible when
the view is replaced, which is one catalog call whatever changes: rows, columns
or their types. So readers never see half-written rows or no table, a failed job
leaves the table as it was, and a table can be rewritten from itself.

A table with partition columns keeps the folders of several writes below one
version, each with the partitions it wrote; the view names those that hold. A
merge rewrites only the partitions that hold a row to be replaced or deleted,
and adds files for the rest; see :func:`upsert_table`.

A bucketed table keeps its rows dealt and sorted by the hash of key columns, also
through merges, so that joins, merges and sums by these keys shuffle only the
other side, or nothing if that is bucketed alike.

Old versions and replaced partitions stay until :func:`drop_old_versions` and
:func:`drop_replaced_partitions` are called. Plain catalog tables that were made
otherwise are written too: their pointer is moved, and only a change of existing
columns replaces their entry, by a view.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.operators.merge import (
    DuplicateKeys,
    Unmatched,
    any_null,
    as_in_target,
    duplicate_keys,
    kept_rows,
    matched_rows,
    merge_in_place,
    spelled,
    typed_as,
    written_rows,
)


def create_layers(spark: SparkSession, locations: Mapping[str, str]) -> None:
    """Create one database per layer at its location, unless it exists."""
    for database, location in locations.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")


def table_exists(spark: SparkSession, table: str) -> bool:
    """Whether the catalog has the table."""
    return spark.catalog.tableExists(table)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """Scan a table by name."""
    return spark.read.table(table)


def table_files(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a table with Spark's ``_metadata`` of the files they come from, which a view does not show."""
    properties = _properties(spark, table) if not _is_plain(spark, table) else {}
    if "cairn.partitions" in properties:
        raise ValueError(f"{table} is partitioned; its folders tell what files hold")
    return read_table(spark, properties.get("cairn.entry", table))


def write_table(
    df: DataFrame,
    table: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
) -> int:
    """Replace the table's rows and schema. Returns the number of rows.

    With ``bucket_by``, rows are dealt to ``buckets`` by the hash of these
    columns and sorted by them. Partition columns are whole numbers, dates, flags or texts; as in all Spark
    tables an empty text is read back as NULL from one.
    """
    spark = df.sparkSession
    version = _new_version(spark, table)
    if bucket_by:
        if partition_by or buckets < 1:
            raise ValueError("a bucketed table has a number of buckets and no partitions")
        layout = _Buckets(fmt, tuple(spelled(df, bucket_by)), buckets)
        rows = _save_buckets(df, table, version, layout)
        _replace_view(spark, table, _entry(table, version), df.columns, layout.properties(_entry(table, version)))
        return rows
    if not partition_by:
        rows = _save_counted(df, version, fmt)
        _publish(spark, table, version, fmt, df.schema)
        return rows
    parts = _Partitions(table, _entry(table, version), fmt, tuple(spelled(df, partition_by)), ())
    rows, written = _save_partitions(df, version, parts)
    _create_partitioned(spark, parts, version, df.schema)
    _publish_partitions(spark, parts, df.columns, written)
    return rows


def upsert_table(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    unmatched: Unmatched = Unmatched.KEEP,
    delete_where: str | None = None,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> int:
    """Merge ``source`` into the table, or create it. Returns the rows written
    from the source.

    Semantics are those of :func:`cairn.operators.merge.merge_frames`. The
    source is evaluated once: it is written first, and the uniqueness check and
    the search for unmatched rows read the key columns of what was written.

    ``partition_by`` is used when the table is created. In a partitioned table
    the key columns of the target tell which partitions hold rows to replace or
    delete; only their other rows are written again. Source rows add files to
    their partitions, also when a row moves to another one.
    """
    spark = source.sparkSession
    target = read_table(spark, table) if table_exists(spark, table) else None
    parts = _partitions(spark, table) if target is not None else None
    if parts is not None:
        return _upsert_partitions(source, target, parts, keys, unmatched, delete_where)
    layout = _bucket_layout(spark, table) if target is not None else None
    if layout is not None:
        return _upsert_buckets(source, target, table, layout, keys, unmatched, delete_where)
    if target is None and partition_by:
        if not duplicate_keys(source, keys).isEmpty():
            raise DuplicateKeys(f"the source for {table} repeats a value of {', '.join(keys)}")
        return write_table(source, table, fmt, partition_by)
    version = _new_version(spark, table)
    written = source
    if target is not None:
        source, keys = as_in_target(target, source), spelled(target, keys)
        written = written_rows(target, source, keys)
    rows = _save_counted(written, version, fmt)
    staged = spark.read.format(fmt).schema(written.schema).load(version)
    _require_unique(staged, table, keys)
    if target is not None:
        kept = kept_rows(target, staged, keys, unmatched, delete_where, rows)
        _save(_padded(kept, written.schema), version, fmt, mode="append")
    _publish(spark, table, version, fmt, written.schema)
    return rows


def replace_rows(source: DataFrame, table: str, where: Column | None) -> int:
    """Delete the rows of a partitioned table that fulfil a condition and add those of ``source``, in one step.

    Only partitions that hold such a row are rewritten. A NULL condition deletes
    nothing; None deletes no row at all. Returns the rows added.
    """
    spark = source.sparkSession
    target = read_table(spark, table)
    parts = _partitions(spark, table)
    if parts is None:
        raise ValueError(f"{table} has no partitions")
    source = as_in_target(target, source)
    added = _padded(source, _evolved(target.schema, source.schema))
    root, write = _location(spark, parts.entry), uuid.uuid4().hex
    _add_rows(added, root, write, parts)
    rows = _staged(added, root, write, parts).count()
    changed = set()
    if where is not None:
        doomed = F.coalesce(where, F.lit(False))
        changed = {tuple(row) for row in target.where(doomed).select(*_values(parts.columns)).distinct().collect()}
        if changed:
            held = target.where(F.expr(_key_sql(parts.columns)).isin([_key(values) for values in changed]))
            _add_rows(_padded(held.where(~doomed), added.schema), root, write, parts)
    _show_write(spark, parts, added, target, write, changed)
    return rows


def _evolved(target: T.StructType, source: T.StructType) -> T.StructType:
    """The target's columns, and behind them those that only the source has."""
    return T.StructType([*target.fields, *[f for f in source.fields if f.name not in target.names]])


def _require_unique(staged: DataFrame, table: str, keys: Sequence[str]) -> None:
    if not duplicate_keys(staged, keys).isEmpty():
        raise DuplicateKeys(f"the source for {table} repeats a value of {', '.join(keys)}")


# -- partitioned tables ----------------------------------------------------

# The partition column that tells which write a file belongs to.
WRITE = "cairn_write"
# Partitions in one ADD PARTITION statement, and characters in one view property.
_PER_STATEMENT, _PER_PROPERTY = 500, 3000

# A write and the values of the partition columns, as text.
Part = tuple[str, tuple[str | None, ...]]


@dataclass(frozen=True)
class _Partitions:
    """A partitioned table: the catalog entry behind its view, and the partitions that hold."""

    table: str
    entry: str
    fmt: str
    columns: tuple[str, ...]
    live: tuple[Part, ...]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    """A SQL text literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _values(columns: Sequence[str]) -> list[Column]:
    return [F.col(_quoted(c)).cast("string") for c in columns]


def _key_sql(columns: Sequence[str]) -> str:
    """Write and partition values as one text; NULL differs from all texts."""
    values = [f"coalesce(concat('=', CAST({_quoted(c)} AS STRING)), '')" for c in columns]
    return f"concat_ws('\n', {', '.join(values)})"


def _key(values: Iterable[str | None]) -> str:
    return "\n".join("" if v is None else f"={v}" for v in values)


def _partitions(spark: SparkSession, table: str) -> _Partitions | None:
    """What is known about a partitioned table; None for other tables."""
    properties = _properties(spark, table)
    if "cairn.partitions" not in properties:
        return None
    pieces = int(properties["cairn.pieces"])
    state = json.loads("".join(properties[f"cairn.live.{i}"] for i in range(pieces)))
    live = tuple((write, tuple(values)) for write, values in state)
    columns = tuple(json.loads(properties["cairn.partitions"]))
    return _Partitions(table, properties["cairn.entry"], properties["cairn.format"], columns, live)


def _save_partitions(df: DataFrame, root: str, parts: _Partitions) -> tuple[int, list[Part]]:
    """Write rows as a new write below the root; their number and partitions."""
    write = uuid.uuid4().hex
    _add_rows(df, root, write, parts)
    return _staged(df, root, write, parts).count(), _written(df, root, write, parts)


def _add_rows(df: DataFrame, root: str, write: str, parts: _Partitions) -> None:
    """Rows as files of a write. Those of a partition meet in few tasks; large partitions are split."""
    dealt = df.hint("rebalance", *[F.col(_quoted(c)) for c in parts.columns])
    dealt.write.format(parts.fmt).mode("append").partitionBy(*parts.columns).save(f"{root}/{WRITE}={write}")


def _staged(df: DataFrame, root: str, write: str, parts: _Partitions) -> DataFrame:
    """The rows of one write, with the columns of ``df``."""
    staged = df.sparkSession.read.format(parts.fmt).schema(df.schema).load(f"{root}/{WRITE}={write}")
    return staged.select(*[_quoted(c) for c in df.columns])


def _written(df: DataFrame, root: str, write: str, parts: _Partitions) -> list[Part]:
    """The partitions of one write; there are as many rows of them as folders."""
    found = _staged(df, root, write, parts).select(*_values(parts.columns)).distinct().collect()
    return sorted(((write, tuple(row)) for row in found), key=repr)


def _create_partitioned(spark: SparkSession, parts: _Partitions, root: str, schema: T.StructType) -> None:
    """The catalog entry of a partitioned table."""
    for field in schema.fields:
        if field.name in parts.columns and not isinstance(
            field.dataType, (T.IntegralType, T.DateType, T.BooleanType, T.StringType)
        ):
            raise ValueError(f"{field.name} is no partition column: its type is {field.dataType.simpleString()}")
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(map(_quoted, (WRITE, *parts.columns)))
    spark.sql(
        f"CREATE TABLE {parts.entry} ({columns}, {WRITE} STRING) USING {parts.fmt} "
        f"PARTITIONED BY ({by}) LOCATION {_text(root)}"
    )


def _publish_partitions(spark: SparkSession, parts: _Partitions, columns: Sequence[str], added: Sequence[Part]) -> None:
    """Show the live and the added partitions, in one replacement of the view."""
    for start in range(0, len(added), _PER_STATEMENT):
        specs = []
        for write, values in added[start : start + _PER_STATEMENT]:
            pairs = [f"{_quoted(c)}={'NULL' if v is None else _text(v)}" for c, v in zip(parts.columns, values, strict=True)]
            specs.append(f"PARTITION ({WRITE}={_text(write)}, {', '.join(pairs)})")
        spark.sql(f"ALTER TABLE {parts.entry} ADD IF NOT EXISTS {' '.join(specs)}")
    spark.catalog.refreshTable(parts.entry)
    live = [*parts.live, *added]
    state = json.dumps(live)
    pieces = [state[i : i + _PER_PROPERTY] for i in range(0, len(state), _PER_PROPERTY)]
    properties = {
        "cairn.entry": parts.entry,
        "cairn.format": parts.fmt,
        "cairn.partitions": json.dumps(parts.columns),
        "cairn.pieces": str(len(pieces)),
        **{f"cairn.live.{i}": piece for i, piece in enumerate(pieces)},
    }
    shown = ", ".join(_text(_key((write, *values))) for write, values in live) or "NULL"
    where = f"{_key_sql((WRITE, *parts.columns))} IN ({shown})"
    _replace_view(spark, parts.table, parts.entry, columns, properties, where)


def _upsert_partitions(
    source: DataFrame,
    target: DataFrame,
    parts: _Partitions,
    keys: Sequence[str],
    unmatched: Unmatched,
    delete_where: str | None,
) -> int:
    """Merge into a partitioned table; untouched partitions keep their files."""
    spark = source.sparkSession
    source, keys = as_in_target(target, source), spelled(target, keys)
    rows_written = written_rows(target, source, keys)
    root = _location(spark, parts.entry)
    write = uuid.uuid4().hex
    _add_rows(rows_written, root, write, parts)
    staged = _staged(rows_written, root, write, parts)
    rows = staged.count()
    _require_unique(staged, parts.table, keys)
    by = _values(parts.columns)
    if unmatched is Unmatched.DELETE and delete_where is None:
        touched = target.where(~any_null(keys)).select(*by)
    else:
        touched = matched_rows(target, staged, keys, rows).select(*by)
        if unmatched is Unmatched.DELETE:
            doomed = ~any_null(keys) & F.coalesce(F.expr(delete_where), F.lit(False))
            touched = touched.union(target.where(doomed).select(*by))
    changed = {tuple(row) for row in touched.distinct().collect()}
    if changed:
        held = target.where(F.expr(_key_sql(parts.columns)).isin([_key(values) for values in changed]))
        kept = kept_rows(held, staged, keys, unmatched, delete_where, rows)
        _add_rows(_padded(kept, rows_written.schema), root, write, parts)
    _show_write(spark, parts, rows_written, target, write, changed)
    return rows


def _show_write(
    spark: SparkSession, parts: _Partitions, written: DataFrame, target: DataFrame, write: str, changed: set[tuple]
) -> None:
    """Show one more write of a table in place of its partitions that changed."""
    added = _written(written, _location(spark, parts.entry), write, parts)
    new = written.schema.fields[len(target.columns) :]
    if new:
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {parts.entry} ADD COLUMNS ({columns})")
    live = tuple(part for part in parts.live if part[1] not in changed)
    left = _Partitions(parts.table, parts.entry, parts.fmt, parts.columns, live)
    _publish_partitions(spark, left, written.columns, added)


def drop_replaced_partitions(spark: SparkSession, table: str) -> int:
    """Delete the files of partitions that the table no longer shows; how many went.

    Readers that began before the last merge may fail, and so may a merge that
    is at work, so call it between merges.
    """
    parts = _partitions(spark, table)
    if parts is None:
        raise ValueError(f"{table} has no partitions")
    live = {_key((write, *values)) for write, values in parts.live}
    names = (WRITE, *parts.columns)
    known = {row.partition: _spec(row.partition) for row in spark.sql(f"SHOW PARTITIONS {parts.entry}").collect()}
    gone = {folder: spec for folder, spec in known.items() if _key([spec[n] for n in names]) not in live}
    path = spark._jvm.org.apache.hadoop.fs.Path(_location(spark, parts.entry))
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for folder, spec in gone.items():
        pairs = ", ".join(f"{_quoted(n)}={'NULL' if spec[n] is None else _text(spec[n])}" for n in names)
        spark.sql(f"ALTER TABLE {parts.entry} DROP IF EXISTS PARTITION ({pairs})")
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(path, folder), True)
    return len(gone)


def _spec(partition: str) -> dict[str, str | None]:
    """The values of a partition as Spark shows it."""
    pairs = (piece.split("=", 1) for piece in partition.split("/"))
    return {unquote(name): None if value == "__HIVE_DEFAULT_PARTITION__" else unquote(value) for name, value in pairs}


# -- bucketed tables -------------------------------------------------------


@dataclass(frozen=True)
class _Buckets:
    """How the rows of a bucketed table are dealt."""

    fmt: str
    columns: tuple[str, ...]
    number: int

    def properties(self, entry: str) -> dict[str, str]:
        return {
            "cairn.entry": entry,
            "cairn.format": self.fmt,
            "cairn.buckets": str(self.number),
            "cairn.bucket_by": json.dumps(self.columns),
        }


def _bucket_layout(spark: SparkSession, table: str) -> _Buckets | None:
    properties = _properties(spark, table)
    if "cairn.buckets" not in properties:
        return None
    columns = tuple(json.loads(properties["cairn.bucket_by"]))
    return _Buckets(properties["cairn.format"], columns, int(properties["cairn.buckets"]))


def _save_buckets(df: DataFrame, table: str, version: str, layout: _Buckets) -> int:
    """Write rows as a catalog entry with buckets, each of one file; their number."""
    # Dealt like the buckets, so that a task writes one of them.
    dealt = df.repartition(layout.number, *[F.col(_quoted(c)) for c in layout.columns])
    _write_buckets(dealt, table, version, layout)
    return read_table(df.sparkSession, _entry(table, version)).count()


def _write_buckets(df: DataFrame, table: str, version: str, layout: _Buckets) -> None:
    writer = df.write.format(layout.fmt).bucketBy(layout.number, *layout.columns).sortBy(*layout.columns)
    writer.option("path", version).saveAsTable(_entry(table, version))


def _upsert_buckets(
    source: DataFrame,
    target: DataFrame,
    table: str,
    layout: _Buckets,
    keys: Sequence[str],
    unmatched: Unmatched,
    delete_where: str | None,
) -> int:
    """Merge into a bucketed table: the source is written in the same buckets, the target stays where it is.

    Both are joined bucket by bucket and written as the next version; no row of
    the target is shuffled.
    """
    spark = source.sparkSession
    source, keys = as_in_target(target, source), spelled(target, keys)
    if set(layout.columns) != set(keys):
        raise ValueError(f"{table} is bucketed by {', '.join(layout.columns)}, which are not the keys of the merge")
    staged_version, version = _new_version(spark, table), _new_version(spark, table)
    rows = _save_buckets(typed_as(target, source), table, staged_version, layout)
    try:
        staged = read_table(spark, _entry(table, staged_version))
        _require_unique(staged, table, keys)
        merged = merge_in_place(target, staged, keys, unmatched, delete_where)
        _write_buckets(merged, table, version, layout)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {_entry(table, staged_version)}")
    _replace_view(spark, table, _entry(table, version), merged.columns, layout.properties(_entry(table, version)))
    return rows


# -- versions --------------------------------------------------------------


def drop_old_versions(spark: SparkSession, table: str, keep: int) -> int:
    """Delete all but the newest ``keep`` versions of a table; how many went.

    The current version always stays, and so does whatever is newer, since a
    writer may be at work on it. Readers of a deleted version fail, so keep
    enough for the longest of them.
    """
    if keep < 1:
        raise ValueError("at least the current version is kept")
    entry = _properties(spark, table).get("cairn.entry")
    current = _location(spark, entry or table)
    path = spark._jvm.org.apache.hadoop.fs.Path(current)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if path.getParent().getParent().getName() != "versions":
        raise ValueError(f"{table} has no versions")
    age = {s.getPath().getName(): s.getModificationTime() for s in files.listStatus(path.getParent())}
    older = sorted((n for n in age if age[n] < age[path.getName()]), key=age.__getitem__, reverse=True)
    for name in older[keep - 1 :]:
        spark.sql(f"DROP TABLE IF EXISTS {_entry(table, name)}")
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(path.getParent(), name), True)
    return len(older[keep - 1 :])


def _location(spark: SparkSession, table: str) -> str:
    """The folder of a catalog table."""
    detail = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'").first()
    if detail is None:
        raise ValueError(f"{table} has no versions")
    return detail.data_type.rstrip("/")


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    """The properties of a table or view, by name."""
    return {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _padded(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def _save(df: DataFrame, path: str, fmt: str, mode: str = "errorifexists") -> None:
    df.write.format(fmt).mode(mode).save(path)


def _save_counted(df: DataFrame, path: str, fmt: str) -> int:
    counter = Observation()
    _save(df.observe(counter, F.count(F.lit(1)).alias("rows")), path, fmt)
    return counter.get["rows"]


def _new_version(spark: SparkSession, table: str) -> str:
    database, _, name = table.rpartition(".")
    database = database or spark.catalog.currentDatabase()
    location = spark.catalog.getDatabase(database).locationUri
    return f"{location.rstrip('/')}/versions/{name.lower()}/{uuid.uuid4().hex}"


def _entry(table: str, version: str) -> str:
    """The catalog entry of a version folder."""
    return f"{table}__{version.rstrip('/').rpartition('/')[2]}"


def _publish(spark: SparkSession, table: str, version: str, fmt: str, schema: T.StructType) -> None:
    """Let the table show a version folder with the given schema."""
    if _is_plain(spark, table):
        added = _appended_columns(read_table(spark, table).schema, schema)
        if added is not None:
            if added:
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
                spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
            spark.catalog.refreshTable(table)
            return
    entry = _entry(table, version)
    spark.catalog.createTable(entry, path=version, source=fmt, schema=schema)
    _replace_view(spark, table, entry, schema.names, {"cairn.entry": entry})


def _is_plain(spark: SparkSession, table: str) -> bool:
    """Whether there is a catalog table of that name that is no view."""
    return table_exists(spark, table) and spark.catalog.getTable(table).tableType != "VIEW"


def _replace_view(
    spark: SparkSession,
    table: str,
    entry: str,
    columns: Sequence[str],
    properties: Mapping[str, str],
    where: str | None = None,
) -> None:
    """Let the table show columns and rows of a catalog entry, in one call."""
    if _is_plain(spark, table):
        spark.sql(f"DROP TABLE {table}")
    given = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in properties.items())
    shown = ", ".join(map(_quoted, columns))
    condition = "" if where is None else f" WHERE {where}"
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ({given}) AS SELECT {shown} FROM {entry}{condition}")


def _appended_columns(current: T.StructType, new: T.StructType) -> list[T.StructField] | None:
    """Columns added behind those of ``current``; None for any other change."""
    layout = [(f.name, f.dataType) for f in new.fields]
    known = [(f.name, f.dataType) for f in current.fields]
    if layout[: len(known)] != known:
        return None
    return new.fields[len(known) :]
