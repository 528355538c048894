"""Column expressions on raw text that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """All words of a text, in order; NULL counts as no text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    """Number of words; NULL counts as no text."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def fresh(name: str, taken: list[str]) -> str:
    """A column name like ``name`` that none of the taken ones equals."""
    used = {column.lower() for column in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def quoted(name: str) -> str:
    """A column name as a reference, dots and back-ticks included."""
    return "`" + name.replace("`", "``") + "`"


def hash_share(value: Column, share: float) -> Column:
    """True for about that share of all values, by their hash."""
    if share >= 1:
        return F.lit(True)
    return F.shiftrightunsigned(F.xxhash64(value), 1) <= int(share * 2**62) * 2


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts of a frame."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
