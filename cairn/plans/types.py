"""Short forms to declare table schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

BIT = T.BooleanType()
DATE_TIME = T.TimestampType()
DAY = T.DateType()
INT = T.IntegerType()
LONG = T.LongType()
SHORT = T.ShortType()
TEXT = T.StringType()
MONEY = T.DecimalType(19, 4)
SMALL_MONEY = T.DecimalType(10, 4)
WEIGHT = T.DecimalType(8, 2)
TOTAL = T.DecimalType(38, 6)


@dataclass(frozen=True)
class Optional:
    """A column that may be NULL by declaration."""

    type: T.DataType


def columns(**declared: T.DataType | Optional) -> T.StructType:
    """A schema from ``name=type`` in order."""
    return T.StructType(
        [
            T.StructField(name, kind.type, True)
            if isinstance(kind, Optional)
            else T.StructField(name, kind, False)
            for name, kind in declared.items()
        ]
    )


def widen_ids(schema: T.StructType) -> T.StructType:
    """The same schema with 64-bit ids.

    Ids are declared as 32-bit integers. Beyond 2**31 they would all become
    NULL, so sources with 64-bit ids need this layout.
    """
    return T.StructType(
        [
            T.StructField(f.name, LONG, f.nullable) if _is_int_id(f) else f
            for f in schema.fields
        ]
    )


def _is_int_id(field: T.StructField) -> bool:
    return field.name.endswith(("ID", "Key", "LineNumber")) and isinstance(field.dataType, T.IntegerType)
