"""Tables between the steps of an operator, in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cairn.session import scratch_dir


def stored(frame: DataFrame, label: str, **options) -> DataFrame:
    """The frame, written to the shared folder and read back."""
    path = scratch_dir(frame.sparkSession, label)
    frame.write.options(**options).parquet(path)
    table = frame.sparkSession.read.schema(frame.schema).parquet(path)
    table.stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete the files of stored tables that nothing will read again."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def stored_as(frame: DataFrame, label: str) -> DataFrame:
    """:func:`stored` for column names that Parquet would not take."""
    names = frame.columns
    return stored(frame.toDF(*[f"c{i}" for i in range(len(names))]), label).toDF(*names)
