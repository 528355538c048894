"""Periodic runs of words: stretches that repeat a period, found and collapsed.

A run is a longest stretch of words in which words a period apart are equal, at
least ``MIN_LENGTH`` words and ``MIN_PERIODS`` periods long; its period is the
smallest there is. All texts of a batch are searched together.

1. Grid. A run of period p is at least ``max(MIN_LENGTH, 3 p)`` long, so among
   the places at every ``max(MIN_LENGTH, 3 p) - p`` words one lies in it, and so
   does the word p further on. For all periods these are n log n pairs of places
   in a text of n words. Most pairs fall away at once: the stretch in which both
   sides agree, backwards and forwards, must be as long as the grid's step, so
   one side must agree on half of the least step.
2. Longest common extension of the pairs that are left, forwards and, on the
   reversed words, backwards (``Extensions``). A difference cover of the numbers
   below a modulus v has for any two places a shift below v that takes both to
   covered places; words up to there are compared one by one, the rest is the
   least common prefix between two suffixes that begin at covered places. Only
   these suffixes are sorted, by v words and then by doubling, and only those of
   texts that still have pairs; a sparse table answers range minima.
3. A stretch that two periods fit is reported with the smaller one: as it is
   three times as long as the longer period, that is a multiple of the smaller.

Work is n log n in the words of a text, whatever repeats. A task holds the words
of ``SLICE_BYTES`` of text, or of one longer text, and a bounded number of pairs.

Collapsing a text keeps the first period of each run and drops the rest of it,
and joins the words that stay with one space.

Edge cases: NULL and empty texts have no words and no runs; their collapsed text
is empty. Repeated rows have equal results. A text that is one run from end to
end is searched like any other. An empty table gives an empty result. Input
columns keep their names, extra ones included; new names that are taken get
underscores in front.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cairn.llm.arrow import mapped, raw_texts, slices
from cairn.llm.text import fresh

MIN_LENGTH, MIN_PERIODS = 24, 3
SLICE_BYTES = 1 << 20
# Pairs of places that are compared at once.
PAIRS = 1 << 20

# Perfect difference sets. Any number is a difference of two
# members modulo the first number. Longer texts take the sparser cover.
COVERS = {31: (0, 1, 3, 8, 12, 18), 57: (0, 1, 3, 13, 32, 36, 43, 52)}
SPARSE_FROM = 1 << 20

RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])
RUN_KIND = pa.list_(pa.struct([pa.field(n, pa.int64(), False) for n in RUN.names]))


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and number within the row, for rows with that many entries each."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


class Extensions:
    """Longest common extensions between places of the same text.

    ``words`` are positive numbers with a 0 before and after every text, and
    ``text_of`` numbers the text of each place in ascending order.
    """

    def __init__(self, words: np.ndarray, text_of: np.ndarray):
        self.modulus = 31 if len(words) < SPARSE_FROM else 57
        cover = np.array(COVERS[self.modulus])
        self.words = np.concatenate((words, np.zeros(2 * self.modulus, words.dtype)))
        self.column = np.full(self.modulus, -1)
        self.column[cover] = np.arange(len(cover))
        self.width = len(cover)
        self.shift = self._shifts(cover)
        places = (np.arange(0, len(words), self.modulus)[:, None] + cover).ravel()
        places = places[places < len(words)]
        self._sort(places, text_of[places])

    def _shifts(self, cover: np.ndarray) -> np.ndarray:
        """The least shift that takes two remainders into the cover."""
        member = np.isin((np.arange(self.modulus)[:, None] + np.arange(self.modulus)) % self.modulus, cover)
        both = member[:, None, :] & member[None, :, :]
        return both.argmax(2).astype(np.int64)

    def _index(self, places: np.ndarray) -> np.ndarray:
        return places // self.modulus * self.width + self.column[places % self.modulus]

    def _sort(self, places: np.ndarray, text_of: np.ndarray) -> None:
        """Ranks of the suffixes at covered places, and minima of common prefixes."""
        # Suffixes of one text stay together, so ties are repeats within a text.
        rank = np.searchsorted(text_of, text_of)
        bits = int(self.words.max(initial=1)).bit_length()
        step = max(1, 62 // bits)
        for at in range(0, self.modulus, step):
            tied = self._tied(rank)
            if not len(tied):
                break
            key = np.zeros(len(tied), np.int64)
            for i in range(at, min(at + step, self.modulus)):
                key = key << bits | self.words[places[tied] + i]
            self._refine(rank, tied, key)
        # Names of the first ``modulus * 2**k`` words.
        names = [rank]
        while len(tied := self._tied(rank)):
            ahead = self._index(places[tied] + (self.modulus << len(names) - 1))
            rank = rank.copy()
            self._refine(rank, tied, names[-1][ahead])
            names.append(rank)
        self.rank = rank
        order = np.empty(len(rank), np.int64)
        order[rank] = np.arange(len(rank))
        self._minima(places[order], text_of[order], names[:-1])

    @staticmethod
    def _tied(rank: np.ndarray) -> np.ndarray:
        """Suffixes whose rank others have too."""
        return np.flatnonzero(np.bincount(rank, minlength=len(rank))[rank] > 1)

    @staticmethod
    def _refine(rank: np.ndarray, tied: np.ndarray, key: np.ndarray) -> None:
        """Tell suffixes of equal rank apart by a key; a rank is its group's first place."""
        order = np.lexsort((key, rank[tied]))
        old, key = rank[tied][order], key[order]
        new_group = np.concatenate(([True], old[1:] != old[:-1]))
        new = new_group | np.concatenate(([True], key[1:] != key[:-1]))
        at = np.arange(len(old))
        first = np.maximum.accumulate(np.where(new_group, at, 0))
        own = np.maximum.accumulate(np.where(new, at, 0))
        rank[tied[order]] = old + own - first

    def _minima(self, sorted_places: np.ndarray, text_of: np.ndarray, names: list[np.ndarray]) -> None:
        """Sparse table over the common prefixes of neighbours in the order."""
        common = np.zeros(len(sorted_places), np.int64)
        pair = np.flatnonzero(text_of[1:] == text_of[:-1]) + 1
        a, b = sorted_places[pair - 1], sorted_places[pair]
        length = np.zeros(len(pair), np.int64)
        for k in reversed(range(len(names))):
            same = names[k][self._index(a + length)] == names[k][self._index(b + length)]
            length[same] += self.modulus << k
        common[pair] = length + self._compared(a + length, b + length, np.full(len(pair), self.modulus))
        self.table = [common.astype(np.int32)]
        while (half := 1 << len(self.table) - 1) * 2 <= len(common):
            last = self.table[-1]
            self.table.append(np.minimum(last[: len(last) - half], last[half:]))

    def _compared(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Equal words from two places on, up to a limit for each pair."""
        length = np.zeros(len(a), np.int64)
        going = np.flatnonzero(limit > 0)
        while len(going):
            x, y = self.words[a[going] + length[going]], self.words[b[going] + length[going]]
            going = going[(x == y) & (x > 0)]
            length[going] += 1
            going = going[length[going] < limit[going]]
        return length

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from two different places of a text on are equal."""
        shift = self.shift[a % self.modulus, b % self.modulus]
        length = self._compared(a, b, shift)
        far = np.flatnonzero(length == shift)
        x, y = self.rank[self._index((a + shift)[far])], self.rank[self._index((b + shift)[far])]
        low, high = np.minimum(x, y) + 1, np.maximum(x, y)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        found = np.empty(len(far), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            found[at] = np.minimum(self.table[k][low[at]], self.table[k][high[at] - (1 << k) + 1])
        length[far] += found
        return length


def agreeing(words: np.ndarray, a: np.ndarray, b: np.ndarray, step: int, limit: int) -> np.ndarray:
    """Whether ``limit`` words from two places on, in steps of 1 or -1, are equal."""
    going = np.arange(len(a))
    for i in range(limit):
        x = words[a[going] + i * step]
        going = going[(x > 0) & (x == words[b[going] + i * step])]
    out = np.zeros(len(a), bool)
    out[going] = True
    return out


def grid(begins: np.ndarray, lengths: np.ndarray, words: np.ndarray, min_length: int, min_periods: int) -> np.ndarray:
    """Pairs of places (first place, period) that may lie in a run, as two rows."""
    # As many words must agree in a row, forwards from the grid's place or backwards from the one before.
    least = max(1, min((max(min_length, min_periods * p) - p for p in range(1, min_length + 1))) // 2)
    text, number = spread(np.where(lengths >= min_length, lengths // min_periods, 0))
    period = number + 1
    step = np.maximum(min_length, min_periods * period) - period
    counts = np.maximum(0, (lengths[text] - period - 1) // step + 1)
    total, found = np.cumsum(counts), []
    low = 0
    while low < len(counts):
        # At least one period of one text at a time; its places are fewer than the text's words.
        high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + PAIRS, "right")))
        row, place = spread(counts[low:high])
        a = begins[text[low:high]][row] + place * step[low:high][row]
        p = period[low:high][row]
        hit = agreeing(words, a, a + p, 1, least)
        rest = np.flatnonzero(~hit)
        hit[rest] = agreeing(words, a[rest] - 1, a[rest] + p[rest] - 1, -1, least)
        found.append(np.stack((a[hit], p[hit])))
        low = high
    return np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)


def runs_of(texts: list[np.ndarray], min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[np.ndarray]:
    """Start, length and period of the runs of each text, by start and period.

    Texts are arrays of positive word numbers.
    """
    lengths = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(lengths + 1) - lengths
    words = joined(texts)
    a, p = grid(begins, lengths, words, min_length, min_periods)
    none = np.zeros((0, 3), np.int64)
    if not len(a):
        return [none] * len(texts)
    # From here on only texts with pairs matter.
    text = np.searchsorted(begins, a, "right") - 1
    some = np.unique(text)
    words = joined([texts[i] for i in some])
    size = lengths[some]
    starts = np.cumsum(size + 1) - size
    which = np.searchsorted(some, text)
    a = a - begins[text] + starts[which]
    owner = np.repeat(np.arange(len(some)), size + 1)
    owner = np.append(owner, len(some) - 1)
    forth = Extensions(words, owner)
    right = forth.of(a, a + p)
    del forth
    back = Extensions(words[::-1], owner[-1] - owner[::-1])
    last = len(words) - 1
    left = back.of(last - (a + p - 1), last - (a - 1))
    length = left + p + right
    keep = length >= np.maximum(min_length, min_periods * p)
    rows = np.stack((which, a - left - starts[which], length, p))[:, keep]
    rows = rows[:, np.lexsort((rows[3], rows[2], rows[1], rows[0]))]
    first = np.ones(rows.shape[1], bool)
    first[1:] = (rows[:3, 1:] != rows[:3, :-1]).any(0)
    rows = rows[:, first]
    rows = rows[:, np.lexsort((rows[3], rows[1], rows[0]))]
    out = [none] * len(texts)
    cuts = np.searchsorted(rows[0], np.arange(len(some) + 1))
    for i, low, high in zip(some, cuts[:-1], cuts[1:], strict=True):
        out[i] = rows[1:, low:high].T
    return out


def joined(texts: list[np.ndarray]) -> np.ndarray:
    """All texts in a row, with a 0 before and after each."""
    gap = np.zeros(1, np.int64)
    return np.concatenate([gap, *[part for t in texts for part in (t, gap)]])


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which words stay when all but the first period of each run is dropped."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def collapse_runs(
    docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS
) -> tuple[DataFrame, str, str]:
    """The rows with their runs and collapsed texts, and the names of these two columns."""
    if min_periods < 2 or min_length < 2:
        raise ValueError("a run has at least two words and two periods")
    runs_name = fresh("runs", docs.columns)
    collapsed = fresh("collapsed", [*docs.columns, runs_name])
    place = docs.columns.index(text)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, SLICE_BYTES):
                words = [t.split() for t in raw_texts(part.column(place))]
                numbers: dict[bytes, int] = {}
                coded = [np.array([numbers.setdefault(w, len(numbers) + 1) for w in t], np.int64) for t in words]
                found = runs_of(coded, min_length, min_periods)
                short = []
                for t, r in zip(words, found, strict=True):
                    kept = [t[i] for i in np.flatnonzero(kept_words(len(t), r))] if len(r) else t
                    short.append(b" ".join(kept).decode())
                names = RUN.names
                lists = [[dict(zip(names, x, strict=True)) for x in r.tolist()] for r in found]
                columns = [*part.columns, pa.array(lists, RUN_KIND), pa.array(short, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, runs_name, collapsed])

    added = [T.StructField(runs_name, T.ArrayType(RUN, False), False), T.StructField(collapsed, T.StringType(), False)]
    return mapped(docs, search, T.StructType([*docs.schema.fields, *added])), runs_name, collapsed
