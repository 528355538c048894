"""Column expressions shared by the silver and gold plans.

Every function takes and returns ``Column`` objects (or column names), so the
results compose inside one projection and never leave the JVM.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str

_ZERO = "CAST(0 AS DECIMAL(38,6))"


def _col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


# -- projections -----------------------------------------------------------


def cast_projection(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` to ``schema``: its columns, its order, its types.

    Text that is no number, date or flag becomes NULL where one is declared. A
    number that exceeds its declared whole-number type fails the job: an id must
    not become NULL in silence.
    """
    return df.selectExpr(*cast_expressions(schema, df.schema))


def cast_expressions(schema: T.StructType, source: T.StructType | None = None) -> list[str]:
    """The columns of :func:`cast_projection` as SQL.

    ``source`` tells text from numbers; without it all inputs are taken to be
    no text.
    """
    text = {f.name for f in source.fields if isinstance(f.dataType, T.StringType)} if source else set()
    return [f"{_cast(f, f.name in text)} AS {_quoted(f.name)}" for f in schema.fields]


# Fixed value: how a decimal number is written.
_NUMBER = r"^\\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\\s*$"


def _cast(field: T.StructField, text: bool) -> str:
    name, kind = _quoted(field.name), field.dataType.simpleString()
    if not isinstance(field.dataType, T.IntegralType):
        return f"try_cast({name} AS {kind})"
    if not text:
        return f"CAST({name} AS {kind})"
    # Text such as 5.0 is a whole number too.
    return f"CAST(CASE WHEN {name} RLIKE '{_NUMBER}' THEN CAST({name} AS DECIMAL(38,6)) END AS {kind})"


def project(df: DataFrame, mapping: Mapping[str, ColumnLike]) -> DataFrame:
    """Select ``{output name: input column}``; one input may appear twice."""
    return df.select(*[_col(source).alias(name) for name, source in mapping.items()])


def _quoted(name: str) -> str:
    escaped = name.replace("`", "``")
    return f"`{escaped}`"


# -- defaults for NULLs ----------------------------------------------------


def _filled(column: ColumnLike, default: Column) -> Column:
    """``coalesce``, except that the result stays nullable like all columns of
    a table, so that equal tables have equal schemas."""
    return F.nvl2(_col(column), _col(column), default)


def default_random_id(column: ColumnLike) -> Column:
    """NULL becomes a random UUID, a new one on each execution."""
    return _filled(column, F.expr("uuid()"))


def default_key_id(column: str, label: str, keys: Sequence[str]) -> Column:
    """NULL becomes a UUID-shaped hash of ``label`` and the key.

    The value is the same on each execution, so a recomputed task or a second
    run of the job yields the same row. Each part of the key carries its length,
    so that no two keys are hashed alike, NULL and empty text included.
    """
    texts = [f"CAST({_quoted(k)} AS STRING)" for k in keys]
    parts = ", ".join(f"coalesce(concat(length({t}), ':', {t}), '-')" for t in texts)
    digest = f"md5(concat_ws('|', '{label}', {parts}))"
    return _filled(column, F.regexp_replace(F.expr(digest), *_HEX_TO_UUID))


_HEX_TO_UUID = (r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def default_load_time(column: ColumnLike, load_time: Column | None = None) -> Column:
    """NULL becomes the load time (the current timestamp unless given)."""
    return _filled(column, F.current_timestamp() if load_time is None else load_time)


def default_account_number(column: ColumnLike, customer_id: ColumnLike) -> Column:
    """NULL becomes ``AW`` and the customer id, zero-padded to nine digits."""
    return _filled(column, F.concat(F.lit("AW"), F.format_string("%09d", _col(customer_id))))


# -- derivations -----------------------------------------------------------


def null_if_before(end: ColumnLike, start: ColumnLike) -> Column:
    """``end``, or NULL when it lies before ``start``."""
    end = _col(end)
    return F.when(end < _col(start), F.lit(None)).otherwise(end)


def guarded_total(*parts: ColumnLike) -> Column:
    """Sum of the parts, or 0 as soon as one of them is NULL."""
    total = _col(parts[0])
    for part in parts[1:]:
        total = total + _col(part)
    return F.coalesce(total, F.expr(_ZERO))


def line_total(price: ColumnLike, discount: ColumnLike, quantity: ColumnLike) -> Column:
    """Discounted line amount as decimal(38,6): price * (1 - discount) * quantity."""
    net = _col(price) * (F.lit(1.0).cast("decimal(2,1)") - _col(discount))
    return (net * _col(quantity)).cast("decimal(38,6)")


def fact_measures(
    quantity: ColumnLike, price: ColumnLike, discount: ColumnLike, cost: ColumnLike | None = None
) -> dict[str, Column]:
    """Amounts of a sales line.

    The discount is taken off once per line, not once per unit, so
    ``LineTotal`` here differs from :func:`line_total` on purpose.
    """
    quantity, price, discount = _col(quantity), _col(price), _col(discount)
    extended, reduction = quantity * price, price * discount
    measures = {
        "ExtendedAmount": extended,
        "DiscountAmount": reduction,
        "LineTotal": (extended - reduction).cast("decimal(38,6)"),
    }
    if cost is not None:
        measures["TotalProductCost"] = quantity * _col(cost)
    return measures


def full_name(first: ColumnLike, last: ColumnLike) -> Column:
    """``first last``; NULL when either part is NULL."""
    return F.concat(_col(first), F.lit(" "), _col(last))


def monday_weekday(day: ColumnLike) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(_col(day)) + F.lit(1)


def semester(day: ColumnLike) -> Column:
    """1 for January to June, 2 for July to December."""
    return F.when(F.month(_col(day)) <= 6, 1).otherwise(2)


def calendar(day: ColumnLike) -> dict[str, Column]:
    """Calendar attributes of a date or timestamp; weeks follow ISO 8601."""
    day = _col(day)
    return {
        "DayNumberOfWeek": monday_weekday(day),
        "EnglishDayNameOfWeek": F.date_format(day, "EEEE"),
        "DayNumberOfMonth": F.dayofmonth(day),
        "DayNumberOfYear": F.dayofyear(day),
        "WeekNumberOfYear": F.weekofyear(day),
        "EnglishMonthName": F.date_format(day, "MMMM"),
        "MonthNumberOfYear": F.month(day),
        "CalendarQuarter": F.quarter(day),
        "CalendarYear": F.year(day),
        "CalendarSemester": semester(day),
    }


def numeric_text_as_numbers(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Read text columns that ``schema`` declares as numbers as numbers.

    Text that is no number becomes NULL. Whole numbers become 64-bit (a larger
    one fails), decimals take their declared type digit by digit.
    """
    declared = {f.name: f.dataType for f in schema.fields}
    changes = {}
    for f in df.schema.fields:
        kind = declared.get(f.name)
        if not isinstance(f.dataType, T.StringType) or not isinstance(kind, T.NumericType):
            continue
        wanted = T.StructField(f.name, T.LongType() if isinstance(kind, T.IntegralType) else kind)
        changes[f.name] = F.expr(_cast(wanted, True))
    return df.withColumns(changes) if changes else df
