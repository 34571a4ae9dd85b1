"""Scalar expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelkit import settings


def day_number(label: Column | str) -> Column:
    """`d_123` -> 123; null where there is no number."""
    text = F.col(label) if isinstance(label, str) else label
    return F.regexp_extract(text, r"(\d+)", 1).try_cast("int")


def safe_ratio(numerator: Column, denominator: Column, default: float) -> Column:
    """numerator / denominator, and `default` where that is null or divides by zero."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(float(default)))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def saturday_first(date: Column) -> Column:
    """Weekday number with Saturday = 1 ... Friday = 7."""
    return F.dayofweek(date) % 7 + 1


def cycle(value: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a position in a cycle."""
    angle = F.lit(2.0) * F.pi() * value / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def choose_by(key: Column, choices: Mapping[str, Column | str], default: object = 0) -> Column:
    """The column that `choices` assigns to the key's value."""
    picked = None
    for value, column in choices.items():
        column = F.col(column) if isinstance(column, str) else column
        picked = F.when(key == value, column) if picked is None else picked.when(key == value, column)
    return F.lit(default) if picked is None else F.coalesce(picked, F.lit(default))


def at_least_zero(value: Column) -> Column:
    """Clip below at zero."""
    return F.greatest(F.lit(0.0), value)


def half_even(value: Column, digits: int) -> Column:
    """Round half to even."""
    return F.bround(value, digits)


def shorten(text: Column, limit: int = 25, keep: int = 22) -> Column:
    """Cut long labels and mark the cut with three dots."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, keep), F.lit("..."))).otherwise(text)


def numbers_in(text: Column) -> Column:
    """Every unsigned number in a text, in order."""
    return F.transform(
        F.regexp_extract_all(text, F.lit(r"(\d+\.?\d*)"), F.lit(1)), lambda x: x.cast("double")
    )


def fixed_text(value: Column, digits: int) -> Column:
    """A number as text with exactly `digits` decimals, half to even."""
    return F.bround(value, digits).cast(f"decimal(28,{digits})").cast("string")


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """Whether the text holds at least one of the words as a substring."""
    found = F.lit(False)
    for word in words:
        found = found | F.contains(text, F.lit(word))
    return found


# Fixed values: (label, substrings) tested in this order; the first that matches names the group.
FEATURE_GROUPS = (
    ("Lag", ("lag",)),
    ("Rolling Stats", ("r7_", "r14_", "r28_", "r56_")),
    ("Price", ("price", "discount")),
    ("Calendar Event", ("event",)),
    ("Embedding", ("enc",)),
    ("SNAP", ("snap",)),
    ("Cyclical", ("sin", "cos")),
    ("Calendar", ("month", "wday", "week", "quarter")),
    ("Zero Sales", ("streak", "since")),
    ("Contextual", ("vs_", "avg_sales")),
)
OTHER_GROUP = "Other"


def feature_group(name: Column) -> Column:
    """The label of the first group with a substring of the feature's name."""
    return first_match(name, FEATURE_GROUPS, OTHER_GROUP)


def first_match(text: Column, rules: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """Label of the first rule with a word in the text."""
    return F.coalesce(
        *[F.when(contains_any(text, words), F.lit(label)) for label, words in rules], F.lit(default)
    )


def event_flag(event_type: str, slots: Sequence[str] = ("event_type_1", "event_type_2")) -> Column:
    """1 where any event slot holds the type."""
    hit = F.lit(False)
    for slot in slots:
        hit = hit | F.coalesce(F.col(slot) == event_type, F.lit(False))
    return hit.cast("int")


def has_event(slot: str) -> Column:
    return flag(F.col(slot) != settings.NO_EVENT)
