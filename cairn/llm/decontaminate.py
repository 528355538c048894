"""Benchmark decontamination with one FM-index per training shard.

Test items are cut into windows of consecutive words. Each shard of training
texts is indexed, every window is looked up by backward search, occurrences are
located, and the words they cover are merged into removal spans.

The index of a shard covers all its words with one exact reduction: a word that
no test item has ends a stretch, and a stretch shorter than the shortest window
cannot hold one, so it is left out.

Test items are the query set. They are read in blocks of ``BLOCK_BYTES`` (a
longer item is a block of its own); a block is all that the driver's and a
task's Python hold of them at a time. All blocks are broadcast: each executor
keeps them, pickled, and a task reads them in turn for each slice of texts (a
single block once). More than ``MOST_BLOCKS`` blocks, half a gigabyte of items,
are refused with an error; split such a benchmark. Texts need no shuffle.

Edge cases: NULL and empty texts have no words and no hits; items without words
are ignored; an item with fewer words than a window is one window. Items that
share an id count once; an item without id counts as an empty id. Repeated
texts are judged each for itself, empty tables give no hits. Input columns keep
their names; new names that are taken get underscores in front.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.llm.arrow import mapped, raw_texts, slices
from cairn.llm.fm_index import FMIndex
from cairn.llm.text import fresh, quoted

WINDOW = 13
BLOCK_BYTES, MOST_BLOCKS = 8 << 20, 64
# A document is contaminated if windows cover one in that many of its words.
RARE = 20

_KEPT = re.compile(rb"[0-9a-z\x80-\xff]+")
_OTHERS = bytes(b for b in range(128) if not chr(b).isdigit() and not chr(b).islower())
_SPACED = bytes.maketrans(_OTHERS, b" " * len(_OTHERS))

RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("cleaned", T.StringType()),
    ]
)


def split_words(text: bytes) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters, digits and all beyond ASCII."""
    return text.lower().translate(_SPACED).split()


class Phrases:
    """The windows of a block of test items, as numbers."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.ids: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for item, text in items:
            # 1 separates stretches of text, words count from 2.
            numbers = [self.ids.setdefault(w, len(self.ids) + 2) for w in split_words(text.encode())]
            width = min(window, len(numbers))
            for i in range(len(numbers) - width + 1 if numbers else 0):
                owners[tuple(numbers[i : i + width])].add(item)
        self.windows = list(owners)
        self.items = [sorted(owners[w]) for w in self.windows]
        self.lengths = np.array([len(w) for w in self.windows], np.int64)
        self.table = np.zeros((len(self.windows), window), np.int64)
        for row, w in zip(self.table, self.windows, strict=True):
            row[window - len(w) :] = w

    @property
    def shortest(self) -> int:
        return int(self.lengths.min(initial=WINDOW))


def blocks(benchmark: DataFrame, item: str, text: str, window: int) -> Iterator[Phrases]:
    """The test items, a bounded block at a time."""
    rows = benchmark.where(F.col(quoted(text)).isNotNull()).select(
        F.coalesce(F.col(quoted(item)).cast("string"), F.lit("")), F.col(quoted(text))
    )
    held, size = [], 0
    for name, content in rows.toLocalIterator():
        if held and size + len(content) > BLOCK_BYTES:
            yield Phrases(held, window)
            held, size = [], 0
        held.append((name, content))
        size += len(content)
    yield Phrases(held, window)


def stretches(numbers: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of known words that can hold a window."""
    known = np.concatenate(([0], numbers > 0, [0]))
    edges = np.flatnonzero(np.diff(known))
    starts, ends = edges[::2], edges[1::2]
    enough = ends - starts >= shortest
    return starts[enough], ends[enough]


def shard_hits(texts: list[list[bytes]], phrases: Phrases) -> tuple[list[np.ndarray], list[set[str]]]:
    """Per text the covered words and the items found, through one index."""
    get, hit, found = phrases.ids.get, [np.zeros(len(w), bool) for w in texts], [set() for _ in texts]
    pieces, places, owners = [], [], []
    for doc, words in enumerate(texts):
        numbers = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        for start, end in zip(*stretches(numbers, phrases.shortest), strict=True):
            pieces += [numbers[start:end], np.ones(1, np.int64)]
            places.append(np.arange(start, end + 1))
            owners.append(np.full(end + 1 - start, doc))
    if not pieces or not phrases.windows:
        return hit, found
    index = FMIndex(np.concatenate(pieces))
    place, owner = np.concatenate(places), np.concatenate(owners)
    low, high = index.search(phrases.table, phrases.lengths)
    present = np.flatnonzero(high > low)
    counts = (high - low)[present]
    which = np.repeat(present, counts)
    rows = np.repeat(low[present], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = index.locate(rows)
    change = np.zeros(len(place) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + phrases.lengths[which], -1)
    covered = np.flatnonzero(np.cumsum(change[:-1]) > 0)
    for doc, position in zip(owner[covered].tolist(), place[covered].tolist(), strict=True):
        hit[doc][position] = True
    for pair in np.unique(owner[at] * len(phrases.windows) + which).tolist():
        doc, window = divmod(pair, len(phrases.windows))
        found[doc].update(phrases.items[window])
    return hit, found


def merged(hit: np.ndarray) -> list[list[int]]:
    """Covered words as spans, first to one past last."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit, [0]))))
    return edges.reshape(-1, 2).tolist()


def without(text: bytes, spans: list[list[int]]) -> str:
    """The text without the words of the spans and what lies between them."""
    ends = [m.span() for m in _KEPT.finditer(text.lower())]
    kept, last = [], 0
    for first, stop in spans:
        kept.append(text[last : ends[first][0]])
        last = ends[stop - 1][1]
    return b"".join([*kept, text[last:]]).decode()


def release(block: Broadcast) -> None:
    """Drop a broadcast's value from this process; it is read again from its file if asked for."""
    if getattr(block, "_path", None) is not None and hasattr(block, "_value"):
        del block._value


def annotate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    clean: bool = False,
) -> tuple[DataFrame, dict[str, str]]:
    """The input with the findings per row, and the names these columns got.

    ``n_words``, ``n_hit`` (covered words), ``spans`` (word ranges to remove),
    ``items`` (ids found, sorted as text) and, with ``clean``, ``cleaned``: the
    text without the spans.
    """
    context = docs.sparkSession.sparkContext
    shared = []
    for phrases in blocks(benchmark, item, item_text, window):
        if len(shared) == MOST_BLOCKS:
            raise ValueError(f"the test items exceed {MOST_BLOCKS} blocks of {BLOCK_BYTES} bytes; split them")
        shared.append(context.broadcast(phrases))
    names = {f.name: fresh(f.name, docs.columns) for f in RESULT.fields}
    schema = T.StructType([*docs.schema.fields, *[T.StructField(names[f.name], f.dataType) for f in RESULT.fields]])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                raws = raw_texts(part.column(text))
                texts = [split_words(raw) for raw in raws]
                hit, found = [np.zeros(len(w), bool) for w in texts], [set() for _ in texts]
                for block in shared:
                    more, items = shard_hits(texts, block.value)
                    if len(shared) > 1:
                        release(block)
                    hit = [a | b for a, b in zip(hit, more, strict=True)]
                    found = [a | b for a, b in zip(found, items, strict=True)]
                spans = [merged(h) for h in hit]
                cleaned = [without(r, s) if clean and s else None for r, s in zip(raws, spans, strict=True)]
                columns = [
                    pa.array([len(w) for w in texts], pa.int64()),
                    pa.array([int(h.sum()) for h in hit], pa.int64()),
                    pa.array(spans, pa.list_(pa.list_(pa.int32()))),
                    pa.array([sorted(f) for f in found], pa.list_(pa.string())),
                    pa.array(cleaned, pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=schema.names)

    return mapped(docs, search, schema), names


def contaminated(n_hit, n_words):
    """Windows cover at least one word in twenty."""
    return (n_hit > 0) & (n_hit * RARE >= n_words)


def keep_clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows that are not contaminated, unchanged."""
    found, name = annotate(docs, benchmark, **options)
    bad = contaminated(F.col(quoted(name["n_hit"])), F.col(quoted(name["n_words"])))
    return found.where(~bad).select(*[F.col(quoted(c)) for c in docs.columns])
