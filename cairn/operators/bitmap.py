"""Bitmaps of key hashes: rows that cannot match are told apart without a shuffle.

The keys of the smaller side set bits in a bitmap that Spark's bitmap functions
build in parts of 4 KB. Broadcast to the larger side, it sends the rows whose
bit is not set past the join: an equal key would have set it. Other rows may
match, so the join still decides about them, at any fill of the bitmap.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bits for each key, and in all: what is broadcast never exceeds 16 MB.
KEY_BITS, LEAST_BITS, MOST_BITS = 64, 1 << 20, 1 << 27
# About what a key takes when it is broadcast.
KEY_BYTES = 16
# Bits in one value of Spark's bitmap functions.
PART_BITS = 1 << 15
# Keys whose equal values have equal hashes when both sides have the same type.
_HASHED_ALIKE = (T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)

_PLACE, _PART, _BITMAP = "__cairn_place", "__cairn_part", "__cairn_bitmap"


def filter_bits(keys: int) -> int:
    """Bits of a bitmap for that many keys: a power of two."""
    return max(LEAST_BITS, min(MOST_BITS, 1 << (KEY_BITS * keys).bit_length()))


def worth_filtering(left: DataFrame, right: DataFrame, keys: Sequence[str], rows: int) -> bool:
    """Whether a bitmap of ``rows`` keys of ``right`` saves work on ``left``.

    Key types must hash alike. Keys below Spark's broadcast threshold are
    broadcast themselves; so many that the bitmap would be full save nothing.
    """
    for key in keys:
        kinds = left.schema[key].dataType, right.schema[key].dataType
        alike = kinds[0] == kinds[1] and (isinstance(kinds[0], (T.IntegralType, *_HASHED_ALIKE)))
        if not alike or (isinstance(kinds[0], T.StringType) and kinds[0] != T.StringType()):
            return False
    threshold = left.sparkSession.sql("SET spark.sql.autoBroadcastJoinThreshold").first().value
    return rows * KEY_BYTES * len(keys) > _bytes(threshold) and rows <= MOST_BITS // 2


def _bytes(text: str) -> int:
    """A size setting, such as ``10485760b`` or ``10MB``."""
    digits = text.rstrip("bBkKmMgG")
    unit = text[len(digits) :].lower().rstrip("b")
    return int(digits) << {"": 0, "k": 10, "m": 20, "g": 30}[unit]


def split_by_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], rows: int) -> tuple[DataFrame, DataFrame]:
    """``left`` in two parts: rows that may have a partner in ``right``, and rows that have none.

    Rows with a NULL key have no partner. ``rows`` is about the number of rows
    of ``right``. Each part scans ``left`` by itself.
    """
    bits = filter_bits(rows)
    columns = [F.col("`" + k.replace("`", "``") + "`") for k in keys]
    place = F.pmod(F.xxhash64(*columns), F.lit(bits)) + 1
    some_null = reduce(or_, [c.isNull() for c in columns])
    bitmaps = (
        right.where(~some_null)
        .select(place.alias(_PLACE))
        .groupBy(F.bitmap_bucket_number(_PLACE).alias(_PART))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(_PLACE)).alias(_BITMAP))
    )
    marked = left.withColumn(_PLACE, F.when(~some_null, place))
    joined = marked.join(F.broadcast(bitmaps), F.bitmap_bucket_number(_PLACE) == F.col(_PART), "left")
    hit = F.coalesce(bit_is_set(F.col(_BITMAP), F.bitmap_bit_position(_PLACE)), F.lit(False))
    return joined.where(hit).drop(_PLACE, _PART, _BITMAP), joined.where(~hit).drop(_PLACE, _PART, _BITMAP)


def bit_is_set(bitmap: Column, position: Column) -> Column:
    """A bit of a binary value, from 0; NULL if there is no bitmap."""
    byte = F.substring(bitmap, F.floor(position / 8).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.call_function("getbit", value, (position % 8).cast("int")) == 1
