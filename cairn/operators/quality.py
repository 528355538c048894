"""Row rules as data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named SQL condition that a row must fulfil; NULL counts as broken.

    Compare amounts with whole-number literals: a literal like ``0.00`` may
    turn the column into a double and keep the filter out of the scan.
    """

    name: str
    condition: str

    @property
    def holds(self) -> Column:
        return F.expr(self.condition)


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that fulfil all rules."""
    for rule in rules:
        df = df.where(rule.holds)
    return df


def rejected_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break a rule, with the names of the broken ones in
    ``failed_rules``."""
    broken = [F.when(~F.coalesce(rule.holds, F.lit(False)), F.lit(rule.name)) for rule in rules]
    if not broken:
        return df.withColumn("failed_rules", F.array().cast("array<string>")).where(F.lit(False))
    marked = df.withColumn("failed_rules", F.array_compact(F.array(*broken)))
    return marked.where(F.size("failed_rules") > 0)


def validate(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into its valid and its rejected rows."""
    return apply_rules(df, rules), rejected_rows(df, rules)


# Rules that fit the bits of one number.
MOST_RULES = 63


def broken_bits(rules: Sequence[Rule]) -> Column:
    """A number with bit i set for a row that breaks rule i; 0 for valid rows."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules do not fit the bits of a number; {MOST_RULES} do")
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        bits = bits + F.when(F.coalesce(rule.holds, F.lit(False)), F.lit(0)).otherwise(F.lit(1 << i)).cast("long")
    return bits


def rule_names(bits: Column, rules: Sequence[Rule]) -> Column:
    """The names of the rules whose bits are set."""
    named = [F.when(bits.bitwiseAND(F.lit(1 << i).cast("long")) != 0, F.lit(rule.name)) for i, rule in enumerate(rules)]
    return F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")
