"""A look at the first rows of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def preview(df: DataFrame, order: Sequence[str | Column], rows: int = 10) -> DataFrame:
    """The first ``rows`` rows in an order.

    Every task keeps only its own first rows, so no full sort is planned. Rows
    that tie in ``order`` are decided by all other sortable columns, so that a
    preview shows the same rows each time.
    """
    named = {c for c in order if isinstance(c, str)}
    ties = [F.col(f"`{f.name}`") for f in df.schema.fields if f.name not in named and f.dataType.typeName() not in _UNSORTED]
    return df.orderBy(*order, *ties).limit(rows)


_UNSORTED = ("map", "variant")
