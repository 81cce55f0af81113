"""Column expressions shared by loads, facts, checks and queries. All run inside codegen."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"
RATIO = "decimal(18,4)"
_WIDE = "decimal(24,4)"
OPEN_END = "9999-12-31 23:59:59"


def as_col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def ts(value: str | Column) -> Column:
    """A timestamp without time zone from text."""
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp_ntz")


def day(value: str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def ratio(num, den) -> Column:
    """num / den in exact decimals; null when the denominator is 0 or null."""
    return F.try_divide(as_col(num).cast(_WIDE), as_col(den).cast(_WIDE))


def ratio_or_zero(num, den) -> Column:
    """num / den when den > 0, else 0: the guarded form the loads use."""
    return F.when(as_col(den) > 0, ratio(num, den)).otherwise(F.lit(Decimal(0)))


def percent(num, den) -> Column:
    return ratio(num, den) * F.lit(Decimal(100))


def percent_or_zero(num, den) -> Column:
    return ratio_or_zero(num, den) * F.lit(Decimal(100))


def mean(value) -> Column:
    """Average of decimals without the early rounding of avg(decimal)."""
    return ratio(F.sum(value), F.count(value))


def mean2(value) -> Column:
    return F.round(mean(value), 2)


def average_ratio(num, den) -> Column:
    """Unweighted mean of the row ratios num / den, 0 where den is 0."""
    total = F.sum(ratio_or_zero(num, den).cast("decimal(24,10)")).cast("decimal(28,10)")
    return F.try_divide(total, F.count(F.lit(1)).cast("decimal(20,0)"))


def count_when(condition: Column) -> Column:
    return F.count_if(condition)


def clean_id(value) -> Column:
    return F.upper(F.trim(as_col(value)))


def clean_email(value) -> Column:
    return F.lower(F.trim(as_col(value)))


EMAIL_PATTERN = r"^[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}$"
PHONE_PATTERN = r"^\+?[0-9][0-9 ()-]{6,}$"


def email_valid(value) -> Column:
    return F.coalesce(clean_email(value).rlike(EMAIL_PATTERN), F.lit(False))


def phone_valid(value) -> Column:
    return F.coalesce(as_col(value).rlike(PHONE_PATTERN), F.lit(False))


def fill(value, default) -> Column:
    return F.coalesce(as_col(value), F.lit(default))


def date_key(value) -> Column:
    """Date as the integer YYYYMMDD."""
    d = as_col(value)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def time_key(value) -> Column:
    """Time of day as the integer HHMMSS."""
    t = as_col(value)
    return F.hour(t) * 10000 + F.minute(t) * 100 + F.second(t)


def elapsed(unit: str, start, end) -> Column:
    """Whole elapsed units (59 minutes are 0 hours)."""
    return F.timestamp_diff(unit, as_col(start), as_col(end))


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def rank_of(value, labels: list[str]) -> Column:
    """Position of a label in a fixed order; unknown labels sort last."""
    expr = F.lit(len(labels) + 1)
    for i, label in reversed(list(enumerate(labels, 1))):
        expr = F.when(as_col(value) == label, i).otherwise(expr)
    return expr


_COMPARATORS = {
    "equal to": lambda c, v: c == v,
    "greater than": lambda c, v: c > v,
    "greater than or equal to": lambda c, v: c >= v,
    "less than": lambda c, v: c < v,
    "less than or equal to": lambda c, v: c <= v,
    "like": lambda c, v: c.like(v),
    "in": lambda c, v: c.isin(*(v if isinstance(v, (list, tuple)) else [v])),
    "null": lambda c, v: c.isNull(),
    "blank": lambda c, v: F.trim(c) == "",
}


def conditions(rows, combine: str = "and") -> Column:
    """Rows of (column, 'is' | 'is not', comparator, value) as one predicate."""
    parts = []
    for column, sense, comparator, value in rows:
        test = _COMPARATORS[comparator.lower()](F.col(column), value)
        parts.append(~test if sense.lower() == "is not" else test)
    return all_of(parts) if combine.lower() == "and" else any_of(parts)
