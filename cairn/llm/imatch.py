"""I-Match fingerprints: what texts share of a lexicon's middle, hashed by random parts of it.

1. Lexicon. Spark counts in how many texts each term (a run of letters and
   digits in lower case) occurs. Terms within a band of inverse document
   frequency stay: those of more than ``MOST`` of all texts say nothing, those
   of less than ``LEAST`` (or of one text) are slips and names. A lexicon has at
   most (mean number of terms of a text) / ``LEAST`` terms, however many texts.
2. Subsets. Random hashes cut the lexicon into ``2**level`` parts. A text's level
   follows from its number of terms, so that a part keeps one or two of them;
   the ``LEVELS - 1`` next finer levels are taken too, so that texts share a level
   whose numbers of terms differ by up to eight times. Of long texts the first
   ``SUBSETS`` parts are enough.
3. Fingerprint. The sorted distinct terms that a part keeps are hashed. The
   fingerprint lists, per level, 24 bits of the hash of each part, and nothing
   for parts without a term.
4. Likeness of two fingerprints: of the parts that either text has terms in, on
   the levels that both have, the share with equal hashes. A text that changes
   keeps the hashes of all parts that none of the changed terms belongs to.

All steps are built-in expressions. Terms are joined with the lexicon as rows
and gathered again by the row's own key; if the rows are already dealt by it,
that needs no shuffle. A lexicon of up to ``BROADCAST_TERMS`` terms is broadcast,
a larger one joined by sort-merge.

Edge cases: NULL counts as empty text. A text without a term of the lexicon gets
the hash of its whole text, which only equal texts share. Equal texts have equal
fingerprints, and those have likeness 1. Rows that repeat in key and text are
one group and come out as often as they went in. A text of any length is read
whole. An empty table gives an empty result. Only the named columns are read, so
others cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.scratch import stored
from cairn.llm.text import quoted

TERM = r"[\p{L}\p{M}\p{N}]+"
# Shares of all texts that a term of the lexicon may occur in.
LEAST, MOST = 1e-4, 0.05
SUBSETS, LEVELS = 24, 4
# A row that every text has besides its terms, so that none is lost.
TEXT = -1
# Terms that are broadcast: 16 MB of hashes. A larger lexicon is joined by sort-merge.
BROADCAST_TERMS = 1 << 21
# Ids that one task orders.
ORDERED = 50_000


def terms(text: Column) -> Column:
    """The distinct terms of a text."""
    lower = F.lower(F.coalesce(text, F.lit("")))
    return F.array_distinct(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0)))


def lexicon(docs: DataFrame, text: str = "text", least: float = LEAST, most: float = MOST) -> DataFrame:
    """Hashes of the terms within the band, as a written table with one column ``term``."""
    texts = docs.select(F.col(quoted(text)).alias("text"))
    n = texts.count()
    low, high = max(2, -(-n * least // 1)), max(2, n * most)
    # An outer explode: Spark would make the terms twice to leave out texts without any.
    words = texts.select(F.explode_outer(terms(F.col("text"))).alias("word")).where("word is not null")
    found = words.groupBy(F.xxhash64("word").alias("term"))
    return stored(found.agg(F.count(F.lit(1)).alias("n")).where(F.col("n").between(low, high)).select("term"), "imatch-lexicon")


# The hash of no terms.
NOTHING = 42


def parts_of(level: Column) -> Column:
    """Into how many parts the lexicon is cut at a level."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), level.cast("int"))


def in_first_parts(drawn: Column, level: Column) -> Column:
    """The terms that belong to a part that is looked at; they are among those of the level before."""
    few = F.least(parts_of(level), F.lit(SUBSETS).cast("long"))
    return F.filter(drawn, lambda x: F.pmod(x["draw"], parts_of(level)) < few)


def subset_hashes(drawn: Column, level: Column) -> Column:
    """The hash of the sorted terms of each part at a level, as text."""
    parts = parts_of(level)
    last = F.least(parts, F.lit(SUBSETS).cast("long")) - 1
    own = lambda k: F.filter(drawn, lambda x: F.pmod(x["draw"], parts) == k)
    hashes = F.transform(F.sequence(F.lit(0).cast("long"), last), lambda k: F.xxhash64(own(k)["term"]))
    shown = lambda h: F.substring(F.base64(F.unhex(F.lpad(F.hex(h), 16, "0"))), 1, 4)
    return F.array_join(F.transform(hashes, lambda h: F.when(h == NOTHING, F.lit("")).otherwise(shown(h))), ",")


def fingerprints(texts: DataFrame, known: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """``keys``, ``copies`` and ``fingerprint`` of each different text under its keys.

    ``known`` is the lexicon. Rows with equal keys and texts are counted in
    ``copies``. The result is dealt by all keys if ``texts`` is dealt by one.
    """
    own = [F.col(quoted(k)).alias(f"k{i}") for i, k in enumerate(keys)]
    by = [f"k{i}" for i in range(len(keys))]
    content = F.coalesce(F.col(quoted(text)), F.lit(""))
    # What is exploded is made first: beside an explode, it would be made for each of its rows.
    whole = texts.select(*own, F.md5(content.cast("binary")).alias("body"), F.array_append(terms(content), F.lit(None)).alias("words"))
    rows = whole.select(*by, "body", F.explode_outer("words").alias("word"))
    hashed = rows.select(*by, "body", F.when(F.col("word").isNull(), F.lit(TEXT)).otherwise(F.xxhash64("word")).alias("term"))
    small = known.count() <= BROADCAST_TERMS
    wanted = known.union(known.sparkSession.range(1).select(F.lit(TEXT).cast("long")))
    kept = hashed.join(F.broadcast(wanted) if small else wanted, "term", "left_semi").groupBy(*by, "body")
    gathered = kept.agg(
        F.sum((F.col("term") == TEXT).cast("long")).alias("copies"),
        F.array_sort(F.collect_set(F.when(F.col("term") != TEXT, F.col("term")))).alias("held"),
    )
    n = F.size("held")
    level = F.floor(F.log2(F.greatest(n, F.lit(1)))).alias("level")
    # A term's part comes from other bits than its place in the order.
    drawn = F.transform("held", lambda term: F.struct(F.xxhash64(term, F.lit(7)).alias("draw"), term.alias("term")))
    found = gathered.select("*", n.alias("n"), level, drawn.alias("drawn"))
    # Columns of their own, so that each is made once.
    for i in range(LEVELS):
        found = found.withColumn("drawn", in_first_parts(F.col("drawn"), F.col("level") + i))
        found = found.withColumn(f"level{i}", subset_hashes(F.col("drawn"), F.col("level") + i))
    levels = [F.concat((F.col("level") + i).cast("string"), F.lit(":"), F.col(f"level{i}")) for i in range(LEVELS)]
    print_ = F.when(F.col("n") == 0, F.concat(F.lit("text:"), F.col("body"))).otherwise(F.concat_ws("|", *levels))
    return found.select(*[F.col(b).alias(k) for b, k in zip(by, keys, strict=True)], "copies", print_.alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """How alike two fingerprints are, from 0 to 1."""

    def hashes(print_: Column) -> Column:
        """Level to its list of hashes."""
        levels = F.transform(F.split(print_, r"\|"), lambda x: F.split(x, ":"))
        return F.map_from_entries(F.transform(levels, lambda x: F.struct(x[0], F.split(x[1], ","))))

    def counted(x: Column, y: Column) -> Column:
        pairs = F.zip_with(x, y, lambda p, q: F.when((p == "") & (q == ""), None).otherwise((p == q).cast("int")))
        return F.filter(pairs, lambda hit: hit.isNotNull())

    x, y = hashes(a), hashes(b)
    shared = F.array_intersect(F.map_keys(x), F.map_keys(y))
    hits = F.flatten(F.transform(shared, lambda level: counted(F.element_at(x, level), F.element_at(y, level))))
    share = F.aggregate(hits, F.lit(0), lambda s, h: s + h) / F.greatest(F.size(hits), F.lit(1))
    return F.when(a == b, F.lit(1.0)).otherwise(share.cast("double"))


def successors(ids: DataFrame, per_task: int = ORDERED) -> DataFrame:
    """``id`` and ``next`` of each id, in a ring: the last is followed by the first.

    ``ids`` has one column of distinct values. They are dealt by range; within a
    range a window looks ahead, and the last one's next is the first of the
    range behind it, of which there is one row per range.
    """
    (column,) = ids.columns
    plain = ids.select(F.col(quoted(column)).alias("id"))
    n = max(plain.sparkSession.sparkContext.defaultParallelism, 1 + plain.count() // per_task)
    ranged = stored(plain.repartitionByRange(n, "id").select("id", F.spark_partition_id().alias("part")), "ring")
    firsts = ranged.groupBy("part").agg(F.min("id").alias("first"))
    everything = Window.partitionBy(F.lit(0)).orderBy("part")
    behind = F.coalesce(F.lead("first").over(everything), F.first("first").over(everything))
    firsts = firsts.select("part", behind.alias("behind"))
    ahead = F.lead("id").over(Window.partitionBy("part").orderBy("id"))
    looked = ranged.repartition(n, "part").select("part", "id", ahead.alias("ahead"))
    return looked.join(firsts, "part").select("id", F.coalesce("ahead", "behind").alias("next"))
