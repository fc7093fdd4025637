"""Conflict resolution: (column, resolved_value, resolution_method, confidence) for
each conflict, as column expressions over conflicts with source_value and
target_value."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.scalars import lookup

UNRANKED = 999


def _resolved(df: DataFrame, value: Column, method: Column | str, confidence: Column | float) -> DataFrame:
    c = confidence if isinstance(confidence, Column) else F.lit(confidence)
    m = method if isinstance(method, Column) else F.lit(method)
    return df.withColumns({"resolved_value": value, "resolution_method": m, "confidence": c.cast("double")})


def priority(df: DataFrame, priorities: dict[str, int], source: str = "source", target: str = "target") -> DataFrame:
    """The side whose name has the lower number; the source where they are equal."""
    mine, theirs = (lookup(priorities, F.col(c), F.lit(UNRANKED)) if priorities else F.lit(UNRANKED) for c in (source, target))
    first = mine <= theirs
    return _resolved(df, F.when(first, F.col("source_value")).otherwise(F.col("target_value")), F.concat(F.lit("priority "), F.when(first, F.col(source)).otherwise(F.col(target))), 0.9)


def timestamp(df: DataFrame, source: str = "source_time", target: str = "target_time") -> DataFrame:
    """The newer value; the source where both times are equal or unknown."""
    s, t = F.col(source), F.col(target)
    take_target = (s.isNull() & t.isNotNull()) | F.coalesce(t > s, F.lit(False))
    confidence = F.when(s.isNull() & t.isNull(), 0.5).when(s.isNull() | t.isNull(), 0.8).otherwise(0.95)
    return _resolved(df, F.when(take_target, F.col("target_value")).otherwise(F.col("source_value")), "timestamp", confidence)


def voting(df: DataFrame, additional: str | None = None) -> DataFrame:
    """The most frequent non-null value of source, target and ``additional`` (an
    array column); the one seen first where several are."""
    votes = F.array("source_value", "target_value")
    votes = F.filter(F.concat(votes, F.coalesce(F.col(additional), F.array().cast(df.schema[additional].dataType))) if additional else votes, lambda v: v.isNotNull())
    n = lambda v: F.size(F.filter("_votes", lambda x: x == v))
    df = df.withColumn("_votes", votes)
    best = F.aggregate("_votes", F.struct(F.lit(None).cast(df.schema["source_value"].dataType).alias("value"), F.lit(0).alias("n")), lambda a, v: F.when(n(v) > a["n"], F.struct(v.alias("value"), n(v).alias("n"))).otherwise(a))
    df = df.withColumn("_best", best)
    total = F.size("_votes")
    return _resolved(df, F.col("_best.value"), "voting", F.when(total > 0, F.col("_best.n") / F.when(total > 0, total)).otherwise(0.0)).drop("_votes", "_best")


def merge(df: DataFrame, rules: dict[str, Callable[[Column, Column], Column]] | None = None, column: str = "column") -> DataFrame:
    """A rule of the conflict's column; else unique texts joined by " | ", the first
    of other types."""
    s, t = F.col("source_value"), F.col("target_value")
    text = dict(df.dtypes)["source_value"] == "string"
    default = F.concat_ws(" | ", F.array_distinct(F.array(s, t))) if text else s
    value = F.when(s.isNull() & t.isNull(), F.lit(None)).when(s.isNull(), t).when(t.isNull(), s).otherwise(default)
    sure = F.when(s.isNull() & t.isNull(), 0.0).when(s.isNull() | t.isNull(), 1.0).otherwise(0.7)
    method = F.lit("merge")
    for name, rule in (rules or {}).items():
        hit = F.col(column) == name
        value, sure, method = F.when(hit, rule(s, t)).otherwise(value), F.when(hit, 0.85).otherwise(sure), F.when(hit, "merge custom").otherwise(method)
    return _resolved(df, value, method, sure)


def resolution_counts(resolved: DataFrame) -> DataFrame:
    """One row: total_conflicts, resolved_count, resolution_rate (1 without any). A
    strategy resolves whatever it is given."""
    one = resolved.agg(F.count(F.lit(1)).alias("total_conflicts"), F.count("resolution_method").alias("resolved_count"))
    n = F.col("total_conflicts")
    return one.withColumn("resolution_rate", F.when(n > 0, F.col("resolved_count") / F.when(n > 0, n)).otherwise(1.0))
