"""Banding and first-match rules, written as data."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(rules: Iterable[tuple[Column, Any]], otherwise: Any = None) -> Column:
    """The label of the first rule whose condition holds."""
    chain = None
    for condition, label in rules:
        value = label if isinstance(label, Column) else F.lit(label)
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    default = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return default if chain is None else chain.otherwise(default)


def below(value: Column, steps: Iterable[tuple[float, str]], otherwise: str,
          inclusive: bool = False) -> Column:
    """Band by upper limits in rising order (``inclusive`` keeps the limit inside)."""
    return first_match(
        [((value <= limit) if inclusive else (value < limit), label) for limit, label in steps],
        otherwise)


def at_least(value: Column, steps: Iterable[tuple[float, str]], otherwise: str) -> Column:
    """Band by lower limits in falling order."""
    return first_match([(value >= limit, label) for limit, label in steps], otherwise)


def points(rules: Iterable[tuple[Column, int]]) -> Column:
    """Additive score: the points of every rule that holds; NULL counts as not holding."""
    score = F.lit(0)
    for condition, value in rules:
        score = score + F.when(condition, value).otherwise(0)
    return score


# Band limits and labels of the reports.
AGE_GROUPS = ((18, "Minor"), (25, "Young Adult"), (35, "Adult"), (50, "Middle-aged"), (65, "Senior"))
LIFE_STAGES = ((18, "Minor"), (30, "Young Adult"), (50, "Adult"), (65, "Middle-aged"))
GENERATIONS = ((1997, "Gen Z"), (1981, "Millennial"), (1965, "Gen X"), (1946, "Baby Boomer"))
DISCOUNT_TIERS = ((0.1, "Low"), (0.2, "Medium"))
DISTANCE_GROUPS = ((500, "Short"), (1000, "Medium"))
ERROR_BANDS = ((10, "Excellent"), (20, "Good"), (30, "Fair"))


def age_group(age: Column) -> Column:
    """Age band of a number or of text that may not be a number."""
    years = age.try_cast("int")
    return first_match(
        [(years.isNull(), "Unknown")] + [(years < limit, label) for limit, label in AGE_GROUPS],
        "Elderly")


def life_stage(age_years: Column) -> Column:
    """Life stage; as in the report it follows, an unknown age falls to the last band."""
    return below(age_years, LIFE_STAGES, "Senior")


def generation(birth_year: Column) -> Column:
    """Generation by birth year; an unknown year falls to the last band."""
    return at_least(birth_year, GENERATIONS, "Silent Generation")
