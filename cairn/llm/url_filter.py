"""URL rules by a Bloom filter cascade: exact membership without joins.

A rule names a host and the beginning of a path and allows or blocks; it fits
its host, all subdomains and all paths that begin so, and the longest fitting
rule wins. The keys a URL could match are its host suffixes combined with the
path beginnings that are as long as some rule's; together, those of all URLs
are the key universe.

Each list of rules becomes a cascade. Level 0 is a Bloom filter of the listed
keys. Level 1 holds the universe's keys that level 0 takes for listed by
mistake, level 2 the listed keys that level 1 takes for mistakes, and so on,
until a level makes none. A key's verdict is the parity of the first level that
lacks it, which is exact for every key of the universe.

False positives of level 0 are found in one pass over the URLs, made distinct
by Spark and are few. Only filter bits reach the driver and are broadcast. Their
size is checked against ``MAX_FILTER_BYTES`` before they are built; a list that
exceeds it must be split over several calls.

Edge cases: NULL URLs and URLs without ``://`` have an empty host and path and
no rule fits. A key that is listed with both verdicts is blocked. Long, repeated
and empty URLs are rows like others, an empty table gives an empty result, and
new columns whose name is taken get underscores in front.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.llm.arrow import mapped
from cairn.llm.scratch import stored
from cairn.llm.text import fresh, quoted
from cairn.operators.bitmap import PART_BITS

MAX_FILTER_BYTES = 256 << 20
# Chance of a mistake at level 0 and at all later levels.
FIRST_RATE, LATER_RATE = 0.01, 0.5
# Stretches of 4 KB that the driver fetches at once.
FETCHED = 4096

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, lower-cased in A-Z, and path of a URL; both empty without ``://``."""
    whole = F.coalesce(url, F.lit(""))
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(whole, parts, 1), UPPER, LOWER), F.regexp_extract(whole, parts, 2)


def candidates(host: str, path: str, lengths: Sequence[int]) -> list[str]:
    """Keys that could be listed for a URL, the longest first.

    ``lengths`` are those of the listed paths. Keys of equal length are ordered
    by the longer host.
    """
    if not host:
        return []
    starts = [0, *[i + 1 for i, c in enumerate(host) if c == "."]]
    heads = [path[:n] for n in lengths if n <= len(path)]
    keys = [(len(host) - s + len(h), len(host) - s, host[s:] + h) for s in starts for h in heads]
    return [key for _, _, key in sorted(keys, reverse=True)]


@dataclass
class Bloom:
    """A Bloom filter; ``level`` salts its hashes."""

    bits: np.ndarray
    size: int
    hashes: int
    level: int

    def __contains__(self, key: str) -> bool:
        return all(self.bits[p >> 3] >> (p & 7) & 1 for p in places(key, self.size, self.hashes, self.level))


def places(key: str, size: int, hashes: int, level: int) -> list[int]:
    """Bit positions of a key."""
    both = xxhash.xxh3_128_intdigest(key.encode(), seed=level)
    first, step = both & (2**64 - 1), (both >> 64) | 1
    return [(first + i * step) % size for i in range(hashes)]


def bloom(keys: DataFrame, level: int, rate: float) -> Bloom | None:
    """The filter of a one-column frame of distinct keys; None if it is empty.

    Tasks compute bit positions, Spark merges them byte by byte, and the driver
    gets the bytes that are set.
    """
    count = keys.count()
    if not count:
        return None
    size = 8 * math.ceil(max(64, -count * math.log(rate) / math.log(2) ** 2) / 8)
    if size // 8 > MAX_FILTER_BYTES:
        raise ValueError(f"{count} keys need a filter of {size // 8} bytes; split the list")
    hashes = max(1, round(size / count * math.log(2))) if rate < 0.5 else 1

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [p for key in batch.column(0).to_pylist() for p in places(key, size, hashes, level)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["p"])

    # Spark assembles stretches of 4 KB; the driver gets a row for each, and runs a job for some thousands of them.
    found = keys.mapInArrow(positions, "p long")
    bitmap, stretches = F.bitmap_construct_agg(F.col("p") % PART_BITS), -(-size // PART_BITS)
    if stretches == 1:
        merged = found.agg(F.lit(0).alias("part"), bitmap)
    else:
        merged = found.groupBy(F.floor(F.col("p") / PART_BITS).alias("part")).agg(bitmap).coalesce(-(-stretches // FETCHED))
    width = PART_BITS // 8
    bits = np.zeros(stretches * width, np.uint8)
    for part, bitmap in merged.toLocalIterator():
        bits[part * width : (part + 1) * width] = np.frombuffer(bitmap, np.uint8)
    bits = bits[: size // 8]
    return Bloom(bits, size, hashes, level)


class Cascade:
    """Filters whose parity tells listed keys of the universe from all others."""

    def __init__(self, levels: list[Bloom]):
        self.levels = levels

    def __contains__(self, key: str) -> bool:
        for depth, level in enumerate(self.levels):
            if key not in level:
                return depth % 2 == 1
        return len(self.levels) % 2 == 1


def mistakes(keys: DataFrame, level: Bloom) -> DataFrame:
    """The keys that the filter takes for its own."""
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [key for key in batch.column(0).to_pylist() if key in shared.value]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["key"])

    return keys.mapInArrow(taken, "key string")


def universe(urls: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """All keys that the URLs could match, repeats included.

    ``urls`` has the columns ``host`` and ``path``.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            found = {key for host, path in pairs for key in candidates(host, path, lengths)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], names=["key"])

    return urls.mapInArrow(keys, "key string")


def cascade(listed: DataFrame, seen: DataFrame) -> Cascade:
    """The cascade of the listed keys over the keys that occur in the corpus."""
    levels: list[Bloom] = []
    inside, outside = stored(listed.distinct(), "url-listed"), seen
    while True:
        depth = len(levels)
        level = bloom(inside, depth, FIRST_RATE if depth == 0 else LATER_RATE)
        if level is None:
            return Cascade(levels)
        levels.append(level)
        wrong = mistakes(outside, level)
        if depth == 0:  # later on, both sides are distinct and apart
            wrong = wrong.distinct().join(inside, "key", "left_anti")
        inside, outside = stored(wrong, "url-mistakes"), inside


def classify(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow"
) -> tuple[DataFrame, dict[str, str]]:
    """The input with ``host``, ``path``, ``rule`` and ``verdict``; also their names.

    ``rules`` has the columns host, path and verdict (``allow`` or ``block``).
    A URL that no rule fits gets the default.
    """
    keyed = rules.select(F.concat("host", "path").alias("key"), F.length("path").alias("n"), "verdict")
    keyed = stored(keyed.groupBy("key").agg(F.max("verdict").alias("verdict"), F.collect_set("n").alias("n")), "url-rules")
    lengths = sorted(keyed.select(F.explode("n").alias("n")).agg(F.collect_set("n")).first()[0])
    host, path = host_and_path(F.col(quoted(url)))
    seen = universe(pages.select(host.alias("host"), path.alias("path")), lengths)
    lists = [cascade(keyed.where(F.col("verdict") == v).select("key"), seen) for v in ("block", "allow")]
    shared = pages.sparkSession.sparkContext.broadcast(lists)

    names = {n: fresh(n, pages.columns) for n in ("host", "path", "rule", "verdict")}
    split = pages.withColumn(names["host"], host).withColumn(names["path"], path)
    fields = [*split.schema.fields, *[T.StructField(names[n], T.StringType()) for n in ("rule", "verdict")]]
    schema = T.StructType(fields)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocked, allowed = shared.value
        known: dict[str, str | None] = {}

        def listed(key: str) -> str | None:
            if key not in known:
                known[key] = "block" if key in blocked else "allow" if key in allowed else None
            return known[key]

        for batch in batches:
            known.clear()
            hosts, paths = (batch.column(names[n]).to_pylist() for n in ("host", "path"))
            found = []
            for h, p in zip(hosts, paths, strict=True):
                fits = ((key, listed(key)) for key in candidates(h, p, lengths))
                found.append(next(((key, v) for key, v in fits if v), (None, default)))
            columns = [pa.array([f[i] for f in found], pa.string()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=schema.names)

    return mapped(split, judge, schema), names
