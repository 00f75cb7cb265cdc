"""Ordered rule tables compiled to one CASE expression: the first rule that holds wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str, "Column | str"]


def _holds(condition: Column | str) -> Column:
    return F.coalesce(F.expr(condition) if isinstance(condition, str) else condition, F.lit(False))


def first_match(rules: Sequence[Rule], default: str | None = None) -> Column:
    """The label of the first rule whose condition is true; unknown (null) counts as false."""
    out = None
    for label, condition in rules:
        out = F.when(_holds(condition), F.lit(label)) if out is None else out.when(_holds(condition), F.lit(label))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def first_match_no(rules: Sequence[Rule]) -> Column:
    """Which rule fired: its number from 1, or 0."""
    return F.coalesce(first_match([(str(k), c) for k, (_, c) in enumerate(rules, 1)]), F.lit("0")).cast("int")


def all_matches(rules: Sequence[Rule]) -> Column:
    """Labels of every rule that holds, in order."""
    return F.array_compact(F.array(*[F.when(_holds(c), F.lit(label)) for label, c in rules]))


def rank_of(column: Column | str, levels: Sequence[str]) -> Column:
    """1 for the first level, and so on; one more than the last for other values."""
    c = F.col(column) if isinstance(column, str) else column
    at = F.array_position(F.array(*[F.lit(x) for x in levels]), c)
    return F.when(at > 0, at).otherwise(F.lit(len(levels) + 1)).cast("int")


def weighted(points: Sequence[tuple[int, Column | str]]) -> Column:
    """The sum of the points whose conditions hold."""
    out = F.lit(0)
    for n, condition in points:
        out = out + F.when(_holds(condition), n).otherwise(0)
    return out
