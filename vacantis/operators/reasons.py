"""Classifiers that say why: ordered rules give the first reason that holds, scores add up what they find."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_reason(rules: list[tuple[str, Column]], otherwise: str = "") -> Column:
    """The reason of the first rule that holds; a rule that cannot be judged (null) does not hold."""
    return F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), F.lit(r)) for r, c in rules], F.lit(otherwise))


def score(parts: list[tuple[int, Column]], least: int | None = None, most: int | None = None) -> Column:
    """The sum of the points of the rules that hold, kept within bounds."""
    total = sum((F.when(F.coalesce(c, F.lit(False)), n).otherwise(0) for n, c in parts), F.lit(0))
    if most is not None:
        total = F.least(F.lit(most), total)
    if least is not None:
        total = F.greatest(F.lit(least), total)
    return total
