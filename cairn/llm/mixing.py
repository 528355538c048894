"""Mix sources to target weights with hash-threshold histograms.

Every row gets a hash; a source takes all rows whose hash lies below its
threshold. The threshold is found without sorting: sizes are summed per source
and hash bucket, the bucket in which the budget is used up is cut into finer
buckets, and so on until one hash value is left in it. Thresholds for several
budgets come from the same hash, so a smaller mix is a part of a larger one.
A source whose target exceeds its size is taken whole as often as it fits, and
once more below the threshold.

Shuffled are sums per source and bucket, never rows: a source that holds most
rows adds as many of them as any other. Scratch tables (row sizes and hashes,
then a few rows per source) go to the shared folder, so that texts are read
once and lost executors do no harm.

Edge cases: a NULL source is a source of its own, last in order. NULL or empty
texts have size 0 and are taken if their hash lies below the threshold, which
shows as 0 words. Rows that repeat in id, source and text share a hash and are
taken together. An empty table gives an empty result. Input columns keep their
names; new names that are taken get underscores in front.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.scratch import stored
from cairn.llm.text import fresh, quoted, word_count

# Hash bits per refinement: 256 buckets for each source.
BITS = 8
HASH_BITS = 60
# Sources in code-point order weigh these, over and over.
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 2


def row_hash(id_column: Column, text: Column) -> Column:
    """A 60-bit hash of id and text, from the first 15 digits of their MD5."""
    joined = F.concat(F.coalesce(id_column.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, budgets: Sequence[float], weights: Sequence[float], most: float) -> DataFrame:
    """Per source and budget the words to take.

    ``sizes`` has ``source`` and ``size``. Shares follow the weights; no target
    exceeds ``most`` times the source's size, and the excess goes to the others
    by weight. Sorted by the budget at which they are full, sources that are
    full form a prefix, so running sums find the level of the rest. One row per
    source is sorted in one task.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    levels = F.array(*[F.lit(float(w)) for w in weights])
    place = (F.row_number().over(order) - 1) % len(weights)
    weighed = sizes.withColumn("weight", F.get(levels, place)).withColumn("most", F.lit(float(most)) * F.col("size"))
    full_at = F.col("most") / F.col("weight")
    up = Window.orderBy(full_at, F.col("source").asc_nulls_last())
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    running = weighed.select(
        "*",
        F.coalesce(F.sum("most").over(before), F.lit(0.0)).alias("full_before"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("weight_left"),
        F.sum("size").over(everything).alias("total"),
        full_at.alias("full_at"),
    )
    per_budget = running.withColumn(
        "budget", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(float(b)).alias("b")) for k, b in enumerate(budgets)]))
    ).withColumn("level", (F.col("budget.b") * F.col("total") - F.col("full_before")) / F.col("weight_left"))
    # The first source that is not full sets the level of all that follow.
    one = Window.partitionBy("budget.k")
    candidate = F.struct("full_at", F.col("source").isNull().alias("last"), "source", "level")
    level = F.min(F.when(F.col("level") < F.col("full_at"), candidate)).over(one)["level"]
    return (
        per_budget.withColumn("at", level)
        .select(
            "source",
            F.col("size").alias("source_size"),
            F.col("budget.k").alias("k"),
            F.when(F.col("at").isNull() | (F.col("full_at") <= F.col("at")), F.col("most"))
            .otherwise(F.col("weight") * F.col("at"))
            .alias("target"),
        )
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    )


def thresholds(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """Per source and budget the last hash to take, by refined histograms.

    ``rows`` has ``source``, ``size`` and ``hash``; ``goals`` comes from
    ``targets``. Each level sums the sizes within the boundary bucket of the
    level before, until every boundary bucket holds one hash value.
    """
    state = stored(goals.withColumn("bucket", F.lit(0).cast("long")).withColumn("below", F.lit(0.0)), "mix-goals")
    for used in range(BITS, HASH_BITS + BITS, BITS):
        parent = F.shiftright("hash", HASH_BITS - used + BITS) if used > BITS else F.lit(0).cast("long")
        bucket = F.shiftright("hash", max(HASH_BITS - used, 0))
        inside = rows.withColumn("parent", parent)
        if used > BITS:
            wanted = state.where("rest > 0").select(F.col("source").alias("s"), F.col("bucket").alias("b")).distinct()
            same = F.col("source").eqNullSafe(F.col("s")) & (F.col("parent") == F.col("b"))
            inside = inside.join(wanted, same, "left_semi")
        sums = inside.groupBy("source", "parent", bucket.alias("fine")).agg(
            F.sum("size").alias("words"), F.min("hash").alias("low"), F.max("hash").alias("high")
        )
        goal = state.select(F.col("source").alias("g"), *[c for c in state.columns if c not in ("source", "low", "high", "words")])
        run = Window.partitionBy("g", "k").orderBy("fine")
        reached = (
            goal.where("rest > 0")
            .join(sums, F.col("g").eqNullSafe(F.col("source")) & (F.col("bucket") == F.col("parent")))
            .withColumn("upto", F.col("below") + F.sum("words").over(run))
            .where("upto >= rest and upto - words < rest")
        )
        state = stored(
            reached.select(
                F.col("g").alias("source"), "source_size", "k", "target", "whole", "rest",
                F.col("fine").alias("bucket"), (F.col("upto") - F.col("words")).alias("below"), "words", "low", "high",
            ),
            "mix-level",
        )
        if state.where("low < high").isEmpty():
            break
    # The rows of the last hash are taken if that comes nearer to the target.
    last = F.when(F.col("rest") - F.col("below") > F.col("words") / 2, F.col("high")).otherwise(F.col("low") - 1)
    found = state.select(F.col("source").alias("s"), F.col("k").alias("n"), last.alias("last_hash"))
    return goals.join(found, F.col("source").eqNullSafe(F.col("s")) & (F.col("k") == F.col("n")), "left").drop("s", "n")


def sized(docs: DataFrame, id_column: str, source: str, text: str) -> DataFrame:
    """Id, source, size and hash of each row: all that the mix needs."""
    content = F.col(quoted(text))
    return docs.select(
        F.col(quoted(id_column)).alias("id"),
        F.col(quoted(source)).alias("source"),
        word_count(content).alias("size"),
        row_hash(F.col(quoted(id_column)), content).alias("hash"),
    )


def plan(rows: DataFrame, budgets: Sequence[float], weights=WEIGHTS, most=MOST_REPEATS) -> DataFrame:
    """Per source: its size and, per budget, target, whole takes and last hash."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("size"))
    goals = stored(targets(sizes, budgets, weights, most), "mix-targets")
    found = thresholds(rows, goals)
    entry = F.struct("k", "target", "whole", "last_hash")
    return stored(
        found.groupBy("source", "source_size").agg(F.sort_array(F.collect_list(entry)).alias("budgets")), "mix-plan"
    )


def copies(budget: Column, hash_column: Column) -> Column:
    """How often a row is taken under one budget."""
    return (budget["whole"] + F.coalesce(hash_column <= budget["last_hash"], F.lit(False)).cast("int")).cast("long")


def mix(
    docs: DataFrame,
    budgets: Sequence[float] = (1.5,),
    id_column: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[float] = WEIGHTS,
    most: float = MOST_REPEATS,
) -> DataFrame:
    """Size, target and words taken of every row.

    ``budgets`` are shares of all words; columns of the second and further ones
    are numbered from 2.
    """
    rows = stored(sized(docs, id_column, source, text), "mix-rows")
    found = plan(rows, budgets, weights, most).withColumnRenamed("source", "s")
    joined = rows.join(found, F.col("source").eqNullSafe(F.col("s")))
    out = [F.col("id").alias(id_column), F.col("size"), F.col("source_size")]
    for k in range(len(budgets)):
        budget, suffix = F.col("budgets")[k], "" if k == 0 else f"_{k + 1}"
        out += [
            budget["target"].alias(f"target{suffix}"),
            (F.col("size") * copies(budget, F.col("hash"))).alias(f"taken{suffix}"),
            copies(budget, F.col("hash")).alias(f"copies{suffix}"),
        ]
    return joined.select(*out)


def mixed_rows(docs: DataFrame, budget: float = 1.5, id_column="doc_id", source="source", text="text", weights=WEIGHTS, most=MOST_REPEATS) -> DataFrame:
    """The mix itself: each row as often as it is taken, with the input's columns."""
    rows = stored(sized(docs, id_column, source, text), "mix-rows")
    found = plan(rows, [budget], weights, most)
    names = {c: fresh(c, docs.columns) for c in ("mix_source", "mix_budgets", "mix_hash", "mix_copy")}
    found = found.select(F.col("source").alias(names["mix_source"]), F.col("budgets").alias(names["mix_budgets"]))
    hashed = docs.withColumn(names["mix_hash"], row_hash(F.col(quoted(id_column)), F.col(quoted(text))))
    joined = hashed.join(found, F.col(quoted(source)).eqNullSafe(F.col(names["mix_source"])))
    times = copies(F.col(names["mix_budgets"])[0], F.col(names["mix_hash"])).cast("int")
    return joined.withColumn(names["mix_copy"], F.explode(F.array_repeat(F.lit(1), times))).select(
        *[F.col(quoted(c)) for c in docs.columns]
    )


