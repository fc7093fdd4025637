"""Queries by name, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(f):
        if name in QUERIES:
            raise ValueError(name)
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


def r6(c: Column | str, name: str | None = None) -> Column:
    """Rounded to six places; infinities and nulls stay."""
    col = F.col(c) if isinstance(c, str) else c
    out = F.round(col, 6)
    return out.alias(name or c) if name or isinstance(c, str) else out


def rounded(df: DataFrame, keep: list[str]) -> DataFrame:
    """All doubles but those of ``keep`` rounded to six places."""
    return df.select(*[r6(c) if t == "double" and c not in keep else F.col(c) for c, t in df.dtypes])
