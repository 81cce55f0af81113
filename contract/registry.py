"""Registry of queries and their check SQL.

Both sides are brought to plain types before comparison: decimals become
doubles, dates and timestamps text, integers 64 bit.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark import session

from .ctes import CTES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

_WORD = re.compile(r"\b[a-z][a-z0-9_]*\b")


def _needed(sql: str, seen: list[str]) -> list[str]:
    for name in _WORD.findall(sql):
        if name in CTES and name not in seen:
            _needed(CTES[name], seen)
            if name not in seen:
                seen.append(name)
    return seen


def compose(sql: str) -> str:
    """Put the CTEs a statement refers to, in dependency order, before it."""
    names = _needed(sql, [])
    if not names:
        return sql
    listed = ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in names)
    return f"WITH {listed}\n{sql}"


def check_sql(body: str, double: str = "", text: str = "") -> str:
    """The check statement, with decimals cast to double and times to text."""
    casts = [f"CAST({c} AS DOUBLE) AS {c}" for c in double.split()]
    casts += [f"CAST({c} AS VARCHAR) AS {c}" for c in text.split()]
    inner = f"SELECT * REPLACE ({', '.join(casts)}) FROM ({body}) AS answer" if casts else body
    return compose(inner)


def plain(df: DataFrame) -> DataFrame:
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        out.append(c.alias(field.name))
    return df.select(*out)


def query(key: str, sql: str | None = None, double: str = "", text: str = ""):
    """Register a query under `key`; `sql` is its check statement, None where SQL cannot express it."""
    def register(fn):
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            session.tune(spark)
            return plain(fn(spark, sf_dir))

        run.__name__ = key
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = check_sql(sql, double, text)
        return fn
    return register
