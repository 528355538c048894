"""Spelling variants: frequent words that differ by one inserted, deleted or replaced code point.

1. Vocabulary. Runs of letters, with A-Z in lower case, are counted by Spark;
   words of at least ``MIN_CHARS`` code points and ``MIN_COUNT`` occurrences stay.
2. Letter counts. A word becomes a vector: how often each letter a-z occurs, and
   in ``OTHERS`` more places the other letters by their code point. An inserted
   letter adds 1 to one count, a replaced one moves 1 from a count to another or
   to itself: L1 distance 1 (lengths l and l + 1) or at most 2 (equal lengths),
   at most 1 of it upwards and at most 1 downwards.
3. K-d trees. For each length a tree cuts the vectors at medians of the widest
   coordinate into boxes. Its upper levels, the cells, are fitted to a bounded
   sample of words; every word then goes to the cell whose box holds it, and
   asks in all cells whose box may hold a near word. Of two cells, the words of
   the first ask in the second. A task builds the rest of the tree over all words
   of one cell, sends all that ask there down at once, and leaves a box that is
   too far up or down from a word.
4. Letter order. What the leaves let through is compared letter by letter: at
   most one place differs, or beginning and end in common cover the shorter word.
   Equal lengths are searched for pairs once; the pairs are then turned round.
5. A word's form is its most frequent near word, if that is ``RATIO`` times as
   frequent. Counts grow with every step to a form, so paths are short: roots
   come from joins that double the steps.

The sample only decides how evenly words are dealt: each cell has its words, so
no pair is lost. Words with one and the same vector (anagrams) cannot be cut and
share a leaf. A word is sent to the few cells near its vector, never to all.

Edge cases: NULL and empty texts have no words. Words are counted over repeated
rows as often as these occur. A NULL id counts as empty text where ids matter.
Ties in frequency go to the word that comes first in code-point order. A long
text is counted whole; an empty table gives an empty result. Only id and text
are read, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.scratch import stored
from cairn.llm.text import hash_share, quoted

LETTERS = r"A-Za-zÀ-ÿ"
MIN_CHARS, MIN_COUNT, RATIO = 6, 5, 5
OTHERS = 6
DIMENSIONS = 26 + OTHERS
# Words of a cell, aimed at; words of the sample that cells are cut by; words of a leaf.
CELL, SAMPLE, LEAF = 1024, 50_000, 12
# Words that one task deals to cells, and that it sends down the trees at once.
DEALT, TOGETHER = 20_000, 10_000
# Bytes of letter counts that are compared at once in a task.
COMPARED = 1 << 21
# Larger counts are taken for this one, which brings no two words further apart.
MOST_ALIKE = 120
# A path of forms multiplies its count by RATIO at each step: 2**5 steps pass any 64-bit count.
DOUBLINGS = 5


# --- vocabulary -----------------------------------------------------------------------------------------------------


def lowered(text: Column) -> Column:
    """The text with A-Z in lower case and all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def letter_runs(text: Column, least: int = MIN_CHARS) -> Column:
    """All runs of at least that many letters; a longer run is found whole."""
    return F.regexp_extract_all(lowered(F.coalesce(text, F.lit(""))), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))


def vocabulary(words: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word`` and ``n`` of the words that are long and frequent enough."""
    (column,) = words.columns  # NULLs are no words
    counted = words.select(F.col(quoted(column)).alias("word")).where(F.length("word") >= min_chars)
    return counted.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


# --- vectors and letters --------------------------------------------------------------------------------------------


def codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def vectors(words: list[str]) -> np.ndarray:
    """Letter counts of words of one length, a row of small numbers each."""
    c = codes(words).astype(np.int64)
    plain = (c >= 97) & (c <= 122)
    place = np.where(plain, c - 97, 26 + c % OTHERS)
    flat = (np.arange(len(words))[:, None] * DIMENSIONS + place).ravel()
    counts = np.bincount(flat, minlength=len(words) * DIMENSIONS)
    return np.minimum(counts, MOST_ALIKE).astype(np.int8).reshape(len(words), DIMENSIONS)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of code points differ by one edit; ``b`` has as many letters or one more."""
    length = a.shape[1]
    if b.shape[1] == length:
        return (a != b).sum(1) == 1
    before = np.cumprod(a == b[:, :-1], axis=1).sum(1)
    behind = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return before + behind >= length


# --- k-d trees ------------------------------------------------------------------------------------------------------


@dataclass
class Box:
    """A node: the bounds of its region, and either a cut or the number of a leaf."""

    low: np.ndarray
    high: np.ndarray
    dimension: int = -1
    cut: int = 0  # the lower side holds values up to it
    sides: tuple = ()
    leaf: int = -1


def split(points: np.ndarray) -> tuple[int, int] | None:
    """Dimension and value that halve the points best, among the widest; None if all are equal."""
    if not len(points):
        return None
    best = None
    for d in np.argsort(-(points.var(0)), kind="stable")[:4]:
        below = np.cumsum(np.bincount(points[:, d]))[:-1]
        below = np.where((below > 0) & (below < len(points)), np.abs(2 * below - len(points)), len(points))
        if len(below) and (off := int(below.min())) < len(points) and (best is None or off < best[0]):
            best = (off, int(d), int(below.argmin()))
    return best[1:] if best else None


def tree(points: np.ndarray, most: int, tight: bool) -> tuple[Box, list[np.ndarray]]:
    """A k-d tree with at most that many points in a leaf, and each leaf's points.

    Tight bounds are those of a node's points, for a search among them. Loose
    ones cover the whole space, so that any point belongs to a leaf.
    """
    everywhere = (np.zeros(points.shape[1], np.int8), np.full(points.shape[1], 127, np.int8))
    leaves: list[np.ndarray] = []
    root = Box(*everywhere)
    todo = [(root, np.arange(len(points)))]
    while todo:
        box, inside = todo.pop()
        own = points[inside]
        if tight and len(own):
            box.low, box.high = own.min(0), own.max(0)
        found = split(own) if len(inside) > most else None
        if found is None:
            box.leaf = len(leaves)
            leaves.append(inside)
            continue
        box.dimension, box.cut = found
        lower, upper = Box(box.low, box.high.copy()), Box(box.low.copy(), box.high)
        lower.high[box.dimension], upper.low[box.dimension] = box.cut, box.cut + 1
        box.sides = (lower, upper)
        below = own[:, box.dimension] <= box.cut
        todo += [(upper, inside[~below]), (lower, inside[below])]
    return root, leaves


def reached(root: Box, points: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
    """Leaves and the points that counts raised by ``up`` and lowered by ``down`` may take there."""
    todo = [(root, np.arange(len(points)))]
    while todo:
        box, inside = todo.pop()
        own = points[inside]
        above = np.maximum(box.low - own, 0).sum(1, dtype=np.int32)
        below = np.maximum(own - box.high, 0).sum(1, dtype=np.int32)
        inside = inside[(above <= up) & (below <= down)]
        if not len(inside):
            continue
        if box.leaf >= 0:
            yield box.leaf, inside
        else:
            todo += [(side, inside) for side in box.sides]


def near_pairs(held: list[str], asked: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of asked and held words that are one edit apart; held ones are as long or longer by one."""
    if not held or not asked:
        return
    space, questions = vectors(held), vectors(asked)
    letters, others = codes(held), codes(asked)
    down = int(letters.shape[1] == others.shape[1])
    points = space.astype(np.float32), questions.astype(np.float32)  # whole numbers far below 2**24
    lengths = [(p * p).sum(1) for p in points]
    root, leaves = tree(space, LEAF, tight=True)
    for leaf, who in reached(root, questions, 1, down):
        members = leaves[leaf]
        # Equal vectors may share a leaf without bound, so its words are taken in parts.
        most = COMPARED // DIMENSIONS
        for first in range(0, len(members), most):
            block = members[first : first + most]
            part = max(1, most // len(block))
            for start in range(0, len(who), part):
                some = who[start : start + part]
                # Counts that differ by 1 at most twice: the squared distance is the L1 distance.
                gap = lengths[1][some][:, None] + lengths[0][block] - 2 * (points[1][some] @ points[0][block].T)
                q, m = np.nonzero(gap <= 1 + down)
                q, m = some[q], block[m]
                ok = one_edit(others[q], letters[m])
                yield q[ok], m[ok]


# --- cells ----------------------------------------------------------------------------------------------------------


def cell_trees(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> tuple[dict[int, Box], int]:
    """Per length the upper levels of its tree, fitted to at most ``sample`` words; the number of all words."""
    sizes = words.groupBy(F.length("word").alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()
    total = sum(r.n for r in sizes)
    share = min(1.0, sample / max(1, total))
    chosen = words.select("word").where(hash_share(F.col("word"), share)).orderBy(F.xxhash64("word"), "word").limit(sample)
    by_length: dict[int, list[str]] = {}
    for row in chosen.collect():
        by_length.setdefault(len(row.word), []).append(row.word)
    trees = {}
    for r in sizes:
        points = vectors(by_length[r.size]) if r.size in by_length else np.zeros((0, DIMENSIONS), np.int8)
        trees[r.size] = tree(points, max(LEAF, int(cell * share)), tight=False)[0]
    return trees, total


def dealt(words: DataFrame, trees: dict[int, Box]) -> DataFrame:
    """Each word in its own cell (``held``) and in all cells where it asks."""
    shared = words.sparkSession.sparkContext.broadcast(trees)
    schema = "size int, cell int, word string, held boolean"

    def placed(length: int, members: list[str]) -> Iterator[pa.RecordBatch]:
        points, names = vectors(members), pa.array(members, pa.string())
        own = np.zeros(len(members), np.int64)
        for size, up, down, held in ((length, 0, 0, True), (length, 1, 1, False), (length + 1, 1, 0, False)):
            cells, rows = [], []
            for cell, who in reached(shared.value[size], points, up, down) if size in shared.value else ():
                if held:
                    own[who] = cell
                elif size == length:
                    who = who[own[who] <= cell]
                cells.append(np.full(len(who), cell, np.int32))
                rows.append(who)
            if rows:
                who = np.concatenate(rows)
                columns = [
                    pa.array(np.full(len(who), size, np.int32)),
                    pa.array(np.concatenate(cells)),
                    names.take(pa.array(who)),
                    pa.array(np.full(len(who), held)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["size", "cell", "word", "held"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[int, list[str]] = {}
        for batch in batches:
            for word in batch.column(0).to_pylist():
                groups.setdefault(len(word), []).append(word)
            if sum(map(len, groups.values())) >= TOGETHER:
                for length, members in groups.items():
                    yield from placed(length, members)
                groups.clear()
        for length, members in groups.items():
            yield from placed(length, members)

    return words.select("word").mapInArrow(run, schema)


def _search(group: pa.Table) -> pa.Table:
    """Pairs of near words in a cell, each once."""
    held, same, shorter = [], [], []
    size = group.column("size")[0].as_py()
    for word, own in zip(group.column("word").to_pylist(), group.column("held").to_pylist(), strict=True):
        (held if own else same if len(word) == size else shorter).append(word)
    left, right, here = [], [], set(held)
    for asked in (same, shorter):
        for q, m in near_pairs(held, asked):
            found = [(asked[i], held[j]) for i, j in zip(q, m, strict=True)]
            # Two words of this cell ask each other.
            found = [(a, b) for a, b in found if a < b or a not in here]
            left += [a for a, _ in found]
            right += [b for _, b in found]
    return pa.table({"a": pa.array(left, pa.string()), "b": pa.array(right, pa.string())})


def near_words(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """``word`` and ``near`` of all pairs of near words, in both directions."""
    trees, total = cell_trees(words, cell, sample)
    pairs = dealt(words.repartition(1 + total // DEALT, "word"), trees).groupBy("size", "cell").applyInArrow(_search, "a string, b string")
    both = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near")), F.struct(F.col("b").alias("word"), F.col("a").alias("near")))
    return pairs.select(F.inline(both))


# --- forms and roots ------------------------------------------------------------------------------------------------


def variants(words: DataFrame, ratio: int = RATIO, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a vocabulary (``word``, ``n``)."""
    words = stored(words.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = near_words(words, cell, sample).join(counts, "near")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("near"))).alias("best")
    known = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    joined = words.join(known, "word", "left")
    frequent = -F.col("best.n") >= ratio * F.col("n")
    formed = stored(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(frequent, F.col("best.near")).alias("form"),
            F.when(frequent, -F.col("best.n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = formed.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(DOUBLINGS):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("up"))
        roots = stored(
            roots.join(further, "root", "left").select("word", F.coalesce("up", "root").alias("root")), "spelling-roots"
        )
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
