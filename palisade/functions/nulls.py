"""Missing-value rules and safe coercions.

Two rules live side by side. ``first_present`` skips null and the empty string only. ``coalesce_truthy``
also skips zero and false, but keeps the texts ``[]`` and ``{}``. A cast always happens after the choice,
so an unparsable first candidate gives null instead of falling through to the next one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
INTEGER = r"^\s*[+-]?\d+\s*$"


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def first_present(*texts: Column) -> Column:
    return F.coalesce(*[blank_to_null(text) for text in texts])


def coalesce_truthy(*values: Column, kind: str = "string") -> Column:
    if kind == "string":
        return first_present(*values)
    if kind == "boolean":
        return F.coalesce(*[F.when(value, value) for value in values])
    return F.coalesce(*[F.when(value != 0, value) for value in values])


def to_double(text: Column) -> Column:
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def to_bigint(text: Column) -> Column:
    return F.when(text.rlike(INTEGER), F.trim(text).try_cast("bigint"))


def to_boolean(text: Column) -> Column:
    word = F.lower(F.trim(text))
    return F.when(word.isin("true", "1", "yes"), True).when(word.isin("false", "0", "no"), False)


def zero_if_null(number: Column) -> Column:
    return F.coalesce(number, F.lit(0.0))


def is_filled(value: Column) -> Column:
    """Counts as covered: not null and not one of the empty texts."""
    return value.isNotNull() & ~value.cast("string").isin("", "[]", "{}")
