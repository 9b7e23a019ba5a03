"""Numeric, date and formatting column helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator, denominator) -> Column:
    """Double division that yields NULL (never NaN, never an error) for a zero denominator."""
    return F.try_divide(F.col(numerator) if isinstance(numerator, str) else numerator,
                        (F.col(denominator) if isinstance(denominator, str) else denominator).cast("double"))


def money(col) -> Column:
    """Two-decimal exact amount, so sums do not depend on the order of rows."""
    return F.round(col, 2).cast("decimal(18,2)")


def exact(col, scale: int = 4) -> Column:
    """Fixed-point view of a double: sums of it are identical for every partitioning."""
    return F.col(col).cast(f"decimal(18,{scale})") if isinstance(col, str) else col.cast(f"decimal(18,{scale})")


def week_ending_monday(col) -> Column:
    """Date of the Monday that closes the Tuesday-to-Monday week of ``col``."""
    return F.next_day(F.date_sub(F.to_date(col), 1), "Mon")


def grouped_number(col, digits: int = 0) -> Column:
    """``1,234.5`` rendering, rounded half to even."""
    return F.format_number(col, digits)


def plain_number(col, digits: int = 0) -> Column:
    """``1234.5`` rendering, rounded half to even."""
    return F.regexp_replace(F.format_number(col, digits), ",", "")


def title_label(col) -> Column:
    """``foot_traffic`` -> ``Foot Traffic``."""
    return F.initcap(F.replace(col, F.lit("_"), F.lit(" ")))


def by_class(col: Column, values: dict[str, float], default: float) -> Column:
    """Value looked up by class letter."""
    first, *rest = values.items()
    chain = F.when(col == first[0], F.lit(first[1]))
    return reduce(lambda c, kv: c.when(col == kv[0], F.lit(kv[1])), rest, chain).otherwise(F.lit(default))


def contains_any(col: Column, needles) -> Column:
    """True when one of the literal ``needles`` occurs in ``col``."""
    return reduce(lambda a, b: a | b, [F.contains(col, F.lit(n)) for n in needles])


def try_double(col) -> Column:
    """Number or NULL."""
    return (F.col(col) if isinstance(col, str) else col).try_cast("double")
