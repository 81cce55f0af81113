"""Row policies and column masks as projections and semi-joins.

Policies apply to the rows before any aggregate, so masked bands, not the
true amounts, reach the sums of a protected reader. User and role are
parameters.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.expressions import MONEY, as_col, day

# Roles of the policies (fixed values).
ADMIN, ENGINEER, AUDITOR = "ADMIN", "DATA_ENGINEER", "AUDITOR"
ANALYST, SCIENTIST, BUSINESS = "DATA_ANALYST", "DATA_SCIENTIST", "BUSINESS_USER"
SEES_ALL_ROWS = (ADMIN, ENGINEER, AUDITOR)

# Upper bounds and the figure shown instead (fixed values).
BANDS = [(1000, 500), (10000, 5000), (100000, 50000)]
TOP_BAND = 100000


def valid_mappings(mapping: DataFrame, user: str, allowed: str, as_of) -> DataFrame:
    """The values a user may see on the day, one row each."""
    return mapping.where((F.col("user_name") == user) & day(as_of).between(F.col("effective_date"), F.col("expiration_date"))).select(allowed).distinct()


def row_policy(df: DataFrame, column: str, mapping: DataFrame, allowed: str, user: str, role: str, as_of,
               exempt: Sequence[str] = SEES_ALL_ROWS) -> DataFrame:
    """Exempt roles see every row, others those whose value is mapped to the user on the day.

    The user's values are few, one per distinct value of the column at most,
    so the semi-join is planned as a broadcast from its measured size.
    """
    if role in exempt:
        return df
    seen = valid_mappings(mapping, user, allowed, as_of).withColumnRenamed(allowed, column)
    return df.join(seen, column, "left_semi")


def region_policy(df: DataFrame, column: str, role: str, role_values: Mapping[str, str], admin: str = ADMIN) -> DataFrame:
    """One value per role; unknown roles see nothing."""
    if role == admin:
        return df
    return df.where(F.col(column) == role_values[role]) if role in role_values else df.where(F.lit(False))


def classification_access(requests: DataFrame, grants: DataFrame) -> DataFrame:
    """May the role read the class? Anything not granted is denied."""
    g = grants.select("role_name", "data_classification", "can_access")
    return requests.join(g, ["role_name", "data_classification"], "left").withColumn("can_access", F.coalesce("can_access", F.lit(False)))


def mask_full(value, role: str) -> Column:
    if role in (ADMIN, AUDITOR):
        return as_col(value)
    return F.lit("***MASKED***" if role == ENGINEER else "***REDACTED***")


def mask_email(value, role: str) -> Column:
    """The address, its domain only, or a fixed text."""
    if role in SEES_ALL_ROWS:
        return as_col(value)
    if role in (ANALYST, SCIENTIST):
        return F.concat(F.lit("***@"), F.split_part(as_col(value), F.lit("@"), F.lit(2)))
    return F.lit("***@***.com")


def mask_email_prefix(value, role: str) -> Column:
    """The address, or its first three letters."""
    return as_col(value) if role in (ADMIN, ENGINEER) else F.concat(F.left(as_col(value), F.lit(3)), F.lit("***@***.com"))


def mask_hash(value, role: str) -> Column:
    """The value, or a digest that still joins."""
    return as_col(value) if role in (*SEES_ALL_ROWS, ANALYST) else F.sha2(as_col(value).cast("string"), 256)


def mask_banded(value, role: str) -> Column:
    """The amount, the figure of its band, or null; a null amount falls in the top band, as its comparisons all fail."""
    if role in (*SEES_ALL_ROWS, ANALYST):
        return as_col(value)
    if role != BUSINESS:
        return F.lit(None).cast(MONEY)
    expr = F.lit(TOP_BAND)
    for bound, shown in reversed(BANDS):
        expr = F.when(as_col(value) < bound, shown).otherwise(expr)
    return expr.cast(MONEY)


Mask = Callable[[str, str], Column]


def secured_view(df: DataFrame, masks: Mapping[str, Mask], role: str, policy: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The row policy first, then every masked column replaced in one projection."""
    rows = policy(df) if policy else df
    return rows.select(*[masks[c](c, role).alias(c) if c in masks else F.col(c) for c in df.columns])
