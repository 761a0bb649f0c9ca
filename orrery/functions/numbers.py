"""Number parsing, missing-number tests and small arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from orrery.functions.text import strip

# Digit runs may carry single underscores between digits.
_DIGITS = r"[0-9](?:_?[0-9])*"
_NUMBER = rf"^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"
_SPECIAL = r"^(?i)[+-]?(?:inf|infinity|nan)$"


def parse_number(c: Column) -> Column:
    """Stripped text to double by the rules of Python's ``float``; NULL when it would raise.

    ``try_cast`` alone also accepts ``1.5d`` and ``3f`` and refuses ``1_000``.
    """
    text = strip(c)
    unsigned = F.lower(F.regexp_replace(text, r"^[+-]", ""))
    negative = text.startswith("-")
    infinity = F.when(negative, F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return (
        F.when(text.rlike(_NUMBER), F.regexp_replace(text, "_", "").try_cast("double"))
        .when(text.rlike(_SPECIAL) & (unsigned == "nan"), F.lit(float("nan")))
        .when(text.rlike(_SPECIAL), infinity)
    )


def parse_feature(c: Column) -> Column:
    """Number of a labelled row: empty text and ``nan`` in any case count as missing."""
    return F.when(F.lower(strip(c)) != "nan", parse_number(c))


def is_valid(c: Column) -> Column:
    """Neither NaN nor NULL; ``isnan(NULL)`` is false, so both tests are needed."""
    return ~F.isnan(c) & c.isNotNull()


def valid_or_null(c: Column) -> Column:
    """NaN becomes NULL, so that aggregates ignore both kinds of missing."""
    return F.when(~F.isnan(c), c)


def clamp(c: Column, low: int | Column, high: int | Column) -> Column:
    """``max(low, min(high, c))``: the lower limit wins when the limits cross."""
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return F.greatest(low, F.least(high, c))


def floor_div(c: Column, size: int) -> Column:
    """Integer division (long in, long out)."""
    return F.call_function("div", c.cast("bigint"), F.lit(size).cast("bigint"))


def steps(n: Column, batch_size: int) -> Column:
    """Steps per epoch: whole batches, at least one."""
    return F.greatest(F.lit(1).cast("bigint"), floor_div(n, batch_size))
