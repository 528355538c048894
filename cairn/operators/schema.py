"""Schema checks. They read the analysed schema only and start no job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


class SchemaMismatch(ValueError):
    """The DataFrame does not have the declared schema."""


def layout_problems(df: DataFrame, expected: T.StructType) -> list[str]:
    """Differences in column count, names, order and type class.

    Nullability and decimal precision are not compared.
    """
    actual = df.schema.fields
    if len(actual) != len(expected.fields):
        return [f"expected {len(expected.fields)} columns, found {len(actual)}"]
    return [
        f"expected {want.name} {want.dataType.typeName()}, found {have.name} {have.dataType.typeName()}"
        for have, want in zip(actual, expected.fields)
        if have.name != want.name or not isinstance(have.dataType, type(want.dataType))
    ]


def has_layout(df: DataFrame, expected: T.StructType) -> bool:
    """Same columns, same order, same type classes."""
    return not layout_problems(df, expected)


def column_problems(df: DataFrame, expected: T.StructType) -> list[str]:
    """Expected columns that are absent or have another exact type.

    Further columns, another order and nullability are accepted.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    return [
        f"expected {f.name} {f.dataType.simpleString()}, found "
        f"{have[f.name].simpleString() if f.name in have else 'no such column'}"
        for f in expected.fields
        if have.get(f.name) != f.dataType
    ]


def has_columns(df: DataFrame, expected: T.StructType) -> bool:
    """Every expected column is there with its exact type."""
    return not column_problems(df, expected)


def require_layout(df: DataFrame, expected: T.StructType) -> DataFrame:
    """``df`` itself, or :class:`SchemaMismatch`."""
    return _require(df, layout_problems(df, expected))


def require_columns(df: DataFrame, expected: T.StructType) -> DataFrame:
    """``df`` itself, or :class:`SchemaMismatch`."""
    return _require(df, column_problems(df, expected))


def _require(df: DataFrame, problems: list[str]) -> DataFrame:
    if problems:
        raise SchemaMismatch("; ".join(problems))
    return df
