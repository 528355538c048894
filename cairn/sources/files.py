"""File scans, folder discovery and the raw load."""

from __future__ import annotations

import posixpath
import uuid
from collections import Counter
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.sources.tables import read_table, replace_rows, table_exists, write_table

LINEAGE_COLUMN = "bronze_ingestion_timestamp"
# Columns of tables that are loaded file by file: the file of a row, and the load that brought it.
FILE_COLUMN, LOAD_COLUMN = "bronze_file", "bronze_load"


class PlannedLoad(NamedTuple):
    """One file (or dataset folder) and the table it is loaded into."""

    table_name: str
    file_path: str


def read_files(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None, **options
) -> DataFrame:
    """Scan files of any format Spark knows by name.

    JSON files hold one document each, which may span lines.
    """
    reader = spark.read.format(fmt)
    if fmt == "json":
        reader = reader.option("multiLine", True)
    reader = reader.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_delimited(
    spark: SparkSession, path: str, sep: str = ",", schema: T.StructType | None = None
) -> DataFrame:
    """Scan delimited text with a header row.

    Without a schema the types are inferred, which reads the data twice. With
    one, a field that does not fit its type becomes NULL.
    """
    options = {"sep": sep, "header": True, "inferSchema": schema is None}
    return read_files(spark, path, "csv", schema, **options)


def read_delimited_lines(
    spark: SparkSession, lines: Iterable[str], sep: str = ",", schema: T.StructType | None = None
) -> DataFrame:
    """As :func:`read_delimited`, for a few lines held in memory."""
    held = spark.sparkContext.parallelize(list(lines))
    return spark.read.csv(held, sep=sep, header=True, inferSchema=schema is None, schema=schema)


def with_lineage(df: DataFrame) -> DataFrame:
    """Add the time of the load."""
    return df.withColumn(LINEAGE_COLUMN, F.current_timestamp())


def discover(spark: SparkSession, root: str, repeated: str = "qualify") -> dict[str, PlannedLoad]:
    """What lies in the folders directly below ``root``, by table name.

    A table is named after its file's stem. Stems that several entries share
    would overwrite each other, so these tables are named ``folder_stem``; with
    ``repeated="last"`` the entry listed last is kept instead. Files beside
    those folders and hidden entries are skipped.
    """
    if repeated not in ("qualify", "last"):
        raise ValueError(f"repeated is qualify or last, not {repeated}")
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = [
        (folder.getPath().getName(), posixpath.splitext(entry.getPath().getName())[0], entry.getPath().toString())
        for folder in _listed(fs, path)
        if folder.isDirectory()
        for entry in _listed(fs, folder.getPath())
    ]
    times = Counter(stem for _, stem, _ in found)
    plan = {}
    for folder, stem, location in found:
        name = f"{folder}_{stem}" if times[stem] > 1 and repeated == "qualify" else stem
        if name in plan and repeated == "qualify":
            raise ValueError(f"{location} and {plan[name].file_path} would both be loaded as {name}")
        plan[name] = PlannedLoad(name, location)
    return plan


def _listed(fs, path) -> list:
    """Visible entries of a folder, by name."""
    entries = {status.getPath().getName(): status for status in fs.listStatus(path)}
    return [entries[name] for name in sorted(entries) if not name.startswith(("_", "."))]


def load_plan(spark: SparkSession, plan: dict[str, PlannedLoad]) -> DataFrame:
    """The plan as a DataFrame, one row per table to load."""
    return spark.createDataFrame(list(plan.values()), "table_name string, file_path string")


def active_loads(plan: DataFrame, control: DataFrame) -> DataFrame:
    """Planned loads that the control table (``table_name``, ``active``)
    switches on."""
    active = control.where("active = 1").select("table_name")
    return plan.join(active, "table_name", "left_semi")


def ingest_file(
    spark: SparkSession, path: str, table: str, fmt: str = "parquet", output_fmt: str = "parquet"
) -> int:
    """Load one file into a table, replacing its rows and schema. Returns the
    number of rows, counted while writing."""
    return write_table(with_lineage(read_files(spark, path, fmt)), table, output_fmt)


def ingest_all(
    spark: SparkSession,
    plan: Iterable[PlannedLoad],
    database: str,
    fmt: str = "parquet",
    output_fmt: str = "parquet",
) -> DataFrame:
    """Load every planned file; one status row per table.

    A table that fails does not stop the others and is reported as ``failed``
    with its error.
    """
    report = []
    for load in plan:
        table = f"{database}.{load.table_name}"
        try:
            rows = ingest_file(spark, load.file_path, table, fmt, output_fmt)
            report.append((load.table_name, "loaded", rows, None))
        except Exception as error:
            report.append((load.table_name, "failed", None, str(error)))
    return spark.createDataFrame(report, "table_name string, status string, row_count long, error string")


# -- loads that skip what is loaded already --------------------------------


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``length`` and ``modified`` of the files below a path; their contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return found.select(_plain_path(F.col("path")).alias("file"), "length", F.col("modificationTime").alias("modified"))


def _plain_path(path: Column) -> Column:
    """A path with one slash behind its scheme, as all parts of Spark spell it after that."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def ingest_new(spark: SparkSession, path: str, table: str, fmt: str = "parquet", output_fmt: str = "parquet") -> tuple[int, int]:
    """Load the files below a path that are new or have changed. Returns files and rows loaded.

    A ledger, ``<table>__ledger``, knows path, length and time of change of each
    file that was loaded. A changed file's rows replace those it brought before;
    rows of files that are gone stay. Rows carry their file and load, and the
    table is partitioned by load, so a load writes its own rows and again only
    the loads that brought a changed file. The ledger follows the table: a load
    that fails between them is repeated without doubling a row.
    """
    ledger = f"{table}__ledger"
    listed = list_files(spark, path)
    known = read_table(spark, ledger) if table_exists(spark, ledger) else listed.where(F.lit(False))
    fresh = listed.join(known, ["file", "length", "modified"], "left_anti")
    # The driver plans scans of these files anyway.
    files = sorted(row.file for row in fresh.select("file").collect())
    if not files:
        return 0, 0
    options = {"multiLine": True} if fmt == "json" else {}
    read = spark.read.format(fmt).options(**options).load(files)
    rows = with_lineage(read).withColumn(FILE_COLUMN, _plain_path(F.col("_metadata.file_path")))
    rows = rows.withColumn(LOAD_COLUMN, F.lit(uuid.uuid4().hex))
    if table_exists(spark, table):
        loaded = replace_rows(rows, table, F.col(FILE_COLUMN).isin(files))
    else:
        loaded = write_table(rows, table, output_fmt, partition_by=[LOAD_COLUMN])
    write_table(known.join(fresh.select("file"), "file", "left_anti").unionByName(fresh), ledger, output_fmt)
    return len(files), loaded


# -- delimited text with rejects -------------------------------------------

_RAW = "__cairn_raw"


def read_checked(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", null_text: str = "", header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Delimited text as typed rows and as rejects.

    A row with a field that does not fit its type, or with too few or too many
    fields, is no typed row but a reject: its ``file``, the raw ``line`` and the
    ``failed_columns``, empty if the number of fields is wrong. ``null_text`` is
    a text that stands for NULL, as an empty field does. Both come from a reading of all columns, so
    what is selected later changes no verdict.
    """
    kept = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    reader = spark.read.schema(T.StructType([*kept.fields, T.StructField(_RAW, T.StringType())]))
    options = {"sep": sep, "header": header, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RAW}
    rows = reader.options(**options, nullValue=null_text).csv(path)
    names = [F.col(_quoted(n)) for n in kept.names]
    # Spark looks only at fields that are used: a test that holds for all rows uses every one.
    rows = rows.where(F.xxhash64(*names).bitwiseOR(F.lit(1).cast("long")) != 0)
    typed = rows.where(F.col(_RAW).isNull()).select(*names)
    # Each field of a bad line as text, beside its typed value.
    texts = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    fields = F.from_csv(F.col(_RAW), texts.simpleString()[7:-1].replace(":", " "), {"sep": sep, "nullValue": null_text})
    broken = [
        F.when(F.col("fields")[f"c{i}"].isNotNull() & column.isNull(), F.lit(name))
        for i, (name, column) in enumerate(zip(kept.names, names, strict=True))
    ]
    bad = rows.where(F.col(_RAW).isNotNull()).select("*", _plain_path(F.col("_metadata.file_path")).alias("file"), fields.alias("fields"))
    rejects = bad.select("file", F.col(_RAW).alias("line"), F.array_compact(F.array(*broken)).alias("failed_columns"))
    return typed, rejects


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
