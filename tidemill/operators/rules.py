"""Validation rules. Each returns one row: rule, passed, violations, details (a
JSON text); a missing column gives passed = false without a job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLES = 10


def _missing(df: DataFrame, rule: str, columns: list[str]) -> DataFrame | None:
    gone = [c for c in columns if c not in df.columns]
    if not gone:
        return None
    return df.sparkSession.createDataFrame(
        [(rule, False, None, f"missing {', '.join(gone)}; available {', '.join(df.columns)}")], "rule string, passed boolean, violations bigint, details string"
    )


def _result(one: DataFrame, rule: str, violations: Column, details: Column) -> DataFrame:
    return one.select(F.lit(rule).alias("rule"), (violations == 0).alias("passed"), violations.cast("bigint").alias("violations"), details.alias("details"))


def _groups(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))


def _with_samples(one: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """``one`` (a row) with the first ``SAMPLES`` texts of ``found`` (value) as an array.
    Each task passes on so many rows, not all that it has."""
    first = found.select(F.col("value").cast("string").alias("value")).orderBy("value").limit(SAMPLES)
    return one.crossJoin(F.broadcast(first.agg(F.array_sort(F.collect_list("value")).alias(name))))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Rows beyond the first of each value; nulls are equal."""
    if (bad := _missing(df, "unique", [column])) is not None:
        return bad
    groups = _groups(df.select(F.col(column).alias("value")), ["value"])
    copies = groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("v"))
    copies = _with_samples(copies, groups.filter("_n > 1 and value is not null"), "samples")
    return _result(copies, "unique", F.col("v"), F.to_json(F.struct("samples")))


def duplicated(df: DataFrame, columns: list[str]) -> DataFrame:
    """The groups of rows that agree in ``columns``, with their number of rows."""
    return _groups(df, columns).filter("_n > 1").withColumnRenamed("_n", "rows")


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    """All rows of groups of more than one."""
    if (bad := _missing(df, "unique_combination", columns)) is not None:
        return bad
    one = _groups(df, columns).filter("_n > 1").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("v"), F.count(F.lit(1)).alias("groups"))
    return _result(one, "unique_combination", F.col("v"), F.to_json(F.struct("groups")))


def _nulls(df: DataFrame, rule: str, test: Column) -> DataFrame:
    one = df.agg(F.coalesce(F.sum(test.cast("int")), F.lit(0)).alias("v"), F.count(F.lit(1)).alias("n"))
    pct = F.when(F.col("n") > 0, F.round(100.0 * F.col("v") / F.when(F.col("n") > 0, F.col("n")), 2)).otherwise(0.0)
    return _result(one, rule, F.col("v"), F.to_json(F.struct(pct.alias("null_percentage"))))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return _missing(df, "not_null", [column]) or _nulls(df, "not_null", F.col(column).isNull())


def not_null_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    if (bad := _missing(df, "not_null_combination", columns)) is not None:
        return bad
    test = F.lit(False)
    for c in columns:
        test = test | F.col(c).isNull()
    return _nulls(df, "not_null_combination", test)


def in_range(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """Bounds are inclusive and nulls pass; details: below, above, min, max."""
    if (bad := _missing(df, "range", [column])) is not None:
        return bad
    x = F.col(column)
    count = lambda t: F.coalesce(F.sum(F.when(t, 1).otherwise(0)), F.lit(0))
    one = df.agg(
        count(x < low if low is not None else F.lit(False)).alias("below_min"), count(x > high if high is not None else F.lit(False)).alias("above_max"), F.min(x).alias("min"), F.max(x).alias("max")
    )
    return _result(one, "range", F.col("below_min") + F.col("above_max"), F.to_json(F.struct("below_min", "above_max", "min", "max")))


def accepted_values(df: DataFrame, column: str, accepted: list) -> DataFrame:
    """Distinct non-null values that aren't accepted."""
    if (bad := _missing(df, "accepted_values", [column])) is not None:
        return bad
    odd = df.select(F.col(column).alias("value")).filter(F.col("value").isNotNull() & ~F.col("value").isin(*accepted)).distinct()
    one = _with_samples(odd.agg(F.count(F.lit(1)).alias("v")), odd, "invalid")
    return _result(one, "accepted_values", F.col("v"), F.to_json(F.struct("invalid")))


def absent(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """Distinct non-null values of ``column`` that ``other`` doesn't have."""
    mine = df.select(F.col(column).alias("value")).filter("value is not null").distinct()
    theirs = other.select(F.col(other_column).alias("value")).distinct()
    return mine.join(theirs, "value", "left_anti")


def relationships(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    if (bad := _missing(df, "relationships", [column])) is not None:
        return bad
    if (bad := _missing(other, "relationships", [other_column])) is not None:
        return bad
    one = absent(df, column, other, other_column).agg(F.count(F.lit(1)).alias("v"), F.min(F.col("value").cast("string")).alias("first"))
    return _result(one, "relationships", F.col("v"), F.to_json(F.struct("first")))


def cross_reference(df: DataFrame, column: str, other: DataFrame, other_column: str, direction: str = "both") -> DataFrame:
    """``direction``: source_to_target, target_to_source or both."""
    if (bad := _missing(df, "cross_reference", [column])) is not None:
        return bad
    if (bad := _missing(other, "cross_reference", [other_column])) is not None:
        return bad
    none = df.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("v"))
    count = lambda d: d.agg(F.count(F.lit(1)).alias("v"))
    there = count(absent(df, column, other, other_column)) if direction != "target_to_source" else none
    back = count(absent(other, other_column, df, column)) if direction != "source_to_target" else none
    one = there.withColumnRenamed("v", "missing_in_target").crossJoin(back.withColumnRenamed("v", "missing_in_source"))
    return _result(one, "cross_reference", F.col("missing_in_target") + F.col("missing_in_source"), F.to_json(F.struct("missing_in_target", "missing_in_source")))
