"""Data-quality rules: one projection annotates a row with all its issues.

A rule whose condition is null does not fire. Issues are kept as an array in
the order of declaration; the ``|``-joined text form is made at the sink.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISSUES = "issues"


@dataclass(frozen=True)
class Rule:
    """A named condition; a ``hard`` issue rejects the row, a soft one stays."""

    name: str
    condition: Column
    hard: bool = True


def not_null(col: str, name: str, hard: bool = True) -> Rule:
    return Rule(name, F.col(col).isNull(), hard)


def non_negative(col: str, name: str | None = None, hard: bool = True) -> Rule:
    return Rule(name or f"negative_{col}", F.col(col) < 0, hard)


def in_range(col: str, low=None, high=None, name: str | None = None, hard: bool = True) -> Rule:
    """Outside ``[low, high]``; either end may be open."""
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(col) < F.lit(low))
    if high is not None:
        bad = bad | (F.col(col) > F.lit(high))
    return Rule(name or f"invalid_range_{col}", bad, hard)


def upper_limit(col: str, limit, hard: bool = True) -> Rule:
    return Rule(f"hard_limit_exceeded_{col}", F.col(col) > F.lit(limit), hard)


def time_order(start: str, end: str, name: str, hard: bool = True) -> Rule:
    return Rule(name, F.col(end) < F.col(start), hard)


def empty_text(col: str, name: str, hard: bool = True) -> Rule:
    return Rule(name, F.col(col).isNull() | (F.length(F.trim(F.col(col))) == 0), hard)


def all_empty(cols: Iterable[str], name: str, hard: bool = True) -> Rule:
    texts = [F.nullif(F.col(c), F.lit("")) for c in cols]
    return Rule(name, F.coalesce(*texts).isNull(), hard)


def invalid_boolean(col: str, hard: bool = True) -> Rule:
    """For a column already normalized: null there means not a boolean."""
    return Rule(f"invalid_boolean_{col}", F.col(col).isNull(), hard)


def earlier_than(col: str, cutoff: Column, name: str, hard: bool = True) -> Rule:
    return Rule(name, F.col(col) < cutoff, hard)


def too_far_ahead(col: str, as_of: date, days: int, name: str, hard: bool = True) -> Rule:
    return Rule(name, F.col(col) > F.lit(as_of + timedelta(days=days)), hard)


def column_exists(df: DataFrame, col: str, name: str | None = None) -> list[Rule]:
    """A rule that fires on every row when the column is not there at all."""
    return [] if col in df.columns else [Rule(name or f"missing_{col}_column", F.lit(True))]


def fired_names(conditions: Mapping[str, Column]) -> Column:
    """The names whose condition holds, in order.

    ``array_except`` drops the nulls inside generated code; ``array_compact`` and
    ``filter`` would take the projection out of it.
    """
    if not conditions:
        return F.array().cast("array<string>")
    names = F.array(*[F.when(condition, F.lit(name)) for name, condition in conditions.items()])
    return F.array_except(names, F.array(F.lit(None).cast("string")))


def issue_array(rules: Iterable[Rule]) -> Column:
    rules = list(rules)
    conditions = {r.name: r.condition for r in rules}
    if len(conditions) < len(rules):
        raise ValueError(f"rule names repeat: {[r.name for r in rules]}")
    return fired_names(conditions)


def first_issue(rules: Iterable[Rule]) -> Column:
    """Only the first rule that fires, as text; null if none does."""
    return F.coalesce(*[F.when(r.condition, F.lit(r.name)) for r in rules], F.lit(None).cast("string"))


def annotate(df: DataFrame, rules: Iterable[Rule], mode: str = "all", column: str = ISSUES) -> DataFrame:
    """Add the issue array; ``mode="first"`` keeps element 0 only."""
    issues = issue_array(rules)
    return df.withColumn(column, F.slice(issues, 1, 1) if mode == "first" else issues)


def as_text(issues: Column) -> Column:
    """``a|b`` for the sink, null for no issue."""
    return F.nullif(F.concat_ws("|", issues), F.lit(""))


def from_text(text: Column) -> Column:
    """The array of a ``|``-joined text; empty for null."""
    return F.coalesce(F.split(text, r"\|"), F.array().cast("array<string>"))


def is_valid(column: str = ISSUES) -> Column:
    return F.size(column) == 0


def is_rejected(rules: Iterable[Rule], column: str = ISSUES) -> Column:
    """True where one of the row's issues is hard (membership, not substring)."""
    hard = [F.lit(r.name) for r in rules if r.hard]
    return F.arrays_overlap(F.col(column), F.array(*hard)) if hard else F.lit(False)
