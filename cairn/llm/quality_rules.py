"""Quality rules: a table of thresholds compiled into one Spark projection.

Each rule bounds one measure of a text. The measures (lengths, symbols, stop
words, lines, repeats) are built-in expressions over the word and line arrays,
so a text is read once, nothing is shuffled and no user function runs. Windows
of words are compared by 64-bit hashes within one text.

Stop words are known for English, German, French and Spanish, in any case. Texts
that the optional language column puts in another language need none. Without
that column, or where it is NULL or empty, every text needs stop words of these
languages, and texts in others are rejected.

Edge cases: NULL and empty texts have no words and every measure is 0. A text
of any length is measured whole. Repeated rows are judged each for itself, an
empty table gives an empty result, and the input's own columns keep their names
(a measure whose name is taken gets underscores in front).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.text import fresh, quoted, words

SYMBOLS = r"[#*$%&|<>]"

# Frequent function words of the four languages of the corpus, in lower case.
LANGUAGES = ("en", "de", "fr", "es")
STOP_WORDS = (
    "the of and to in a is that for it with as was on be by at this are or an from not have but "
    "der die das und ist nicht von zu mit den im ein eine sich auf für dem des als auch "
    "le la les de des et un une du est que qui dans en pour par sur pas au avec "
    "el los las y una por con para su al del se lo como más"
).split()


@dataclass(frozen=True)
class Rule:
    """``measure / per`` must lie within the bounds (both included).

    Without ``per`` the measure itself is bounded. A ratio whose divisor is 0
    counts as 0. A ``listed`` rule holds only for texts in ``LANGUAGES``.
    """

    name: str
    measure: str
    per: str | None = None
    at_least: float | None = None
    at_most: float | None = None
    listed: bool = False


# The production table. ``base`` rules decide on their own in ``base_failed``.
BASE = (
    Rule("few_words", "n_words", at_least=50),
    Rule("repeated_words", "n_repeat_words", "n_words", at_most=0.5),
)
RULES = (
    Rule("word_length", "word_chars", "n_words", at_least=3, at_most=10),
    Rule("symbols", "n_symbols", "n_words", at_most=0.1),
    Rule("shouting", "n_marks", "n_words", at_most=0.25),
    Rule("stop_words", "n_stop_words", "n_words", at_least=0.02, listed=True),
    Rule("repeated_lines", "n_dup_lines", "n_lines", at_most=0.35),
)
MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_marks",
    "n_stop_words",
    "n_lines",
)


def compiled(rule: Rule, measures: dict[str, Column]) -> Column:
    """True where the rule is broken; whole numbers are compared by products."""
    value, per = measures[rule.measure], measures[rule.per] if rule.per else None

    def bound(limit: float) -> Column:
        return F.lit(limit) if per is None else F.lit(limit) * per

    broken = [value < bound(rule.at_least)] if rule.at_least is not None else []
    if rule.at_most is not None:
        broken.append(value > bound(rule.at_most))
    return reduce(lambda a, b: a | b, broken, F.lit(False))


def _repeated(windows: Column) -> Column:
    """Words covered by three-word windows that occur twice or more.

    ``windows`` holds a 64-bit hash per window. A text whose hashes are all
    distinct has none. Otherwise sorting puts equal windows side by side, and
    the places of those with an equal neighbour cover up to three words each.
    """

    def covered(run: Column) -> Column:
        following = F.greatest(F.size(run) - 1, F.lit(0))
        pairs = F.arrays_zip(
            run["h"].alias("h"),
            F.slice(run["h"], 2, following).alias("next_h"),
            run["i"].alias("i"),
            F.slice(run["i"], 2, following).alias("next_i"),
        )
        hits = F.filter(pairs, lambda p: p["h"] == p["next_h"])
        at = F.array_distinct(F.concat(hits["i"], hits["next_i"]))
        return F.size(F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(i, i + 1, i + 2)))))

    def counted(h: Column) -> Column:
        placed = F.arrays_zip(h.alias("h"), F.sequence(F.lit(0), F.size(h) - 1).alias("i"))
        return F.when(
            F.size(F.array_distinct(h)) < F.size(h),
            F.transform(F.array(F.sort_array(placed)), covered)[0],
        )

    # ``transform`` over one element names a value, so that it is computed once.
    return F.coalesce(F.transform(F.array(windows), counted)[0], F.lit(0))


def measured(docs: DataFrame, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """The input with one column per measure, and the names they got."""
    own = docs.columns
    name = {m: fresh(m, own) for m in MEASURES}
    w, lines = fresh("cairn_words", own), fresh("cairn_lines", own)
    grams = fresh("cairn_grams", own)
    raw = F.coalesce(F.col(quoted(text)), F.lit(""))
    split = docs.withColumn(w, words(raw)).withColumn(
        lines, F.filter(F.split(raw, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    )
    n, word = F.size(w), F.col(w)
    windows = F.arrays_zip(word.alias("a"), F.slice(word, 2, n).alias("b"), F.slice(word, 3, n).alias("c"))
    hashes = F.transform(F.slice(windows, 1, n - 2), lambda g: F.xxhash64(g["a"], g["b"], g["c"]))
    split = split.withColumn(grams, F.when(n >= 4, hashes))
    stop = list(dict.fromkeys(STOP_WORDS))
    values = {
        "n_words": n,
        "word_chars": F.length(F.array_join(word, "")),
        "n_symbols": F.regexp_count(raw, F.lit(SYMBOLS)),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeated(F.col(grams)),
        "n_marks": F.length(raw) - F.length(F.replace(raw, F.lit("!"), F.lit(""))),
        "n_stop_words": F.size(F.filter(word, lambda x: F.lower(x).isin(stop))),
        "n_lines": F.size(lines),
    }
    out = split.select(
        *[F.col(quoted(c)) for c in own], *[value.cast("long").alias(name[m]) for m, value in values.items()]
    )
    return out, name


def judge(docs: DataFrame, rules=RULES, base=BASE, text: str = "text", lang: str | None = None) -> DataFrame:
    """Measures and verdict of every row: ``base_failed`` and ``kept``.

    ``lang`` names the column with the language code of a text, if there is one.
    """
    frame, name = measured(docs, text)
    measures = {m: F.col(quoted(c)) for m, c in name.items()}
    listed = F.lit(True)
    if lang is not None:
        code = F.lower(F.substring_index(F.replace(F.trim(F.col(quoted(lang))), F.lit("_"), F.lit("-")), "-", 1))
        listed = F.coalesce(code.isin(*LANGUAGES, ""), F.lit(True))

    def broken(table) -> Column:
        found = (compiled(r, measures) & listed if r.listed else compiled(r, measures) for r in table)
        return reduce(lambda a, b: a | b, found, F.lit(False))

    failed = broken(base)
    return frame.select(
        "*",
        failed.alias(fresh("base_failed", frame.columns)),
        (~failed & ~broken(rules)).alias(fresh("kept", frame.columns)),
    )


def keep_good(docs: DataFrame, rules=RULES, base=BASE, text: str = "text", lang: str | None = None) -> DataFrame:
    """The rows that break no rule, with the input's columns."""
    judged = judge(docs, rules, base, text, lang)
    return judged.where(F.col(quoted(judged.columns[-1]))).select(*[F.col(quoted(c)) for c in docs.columns])
