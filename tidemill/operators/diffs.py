"""Differences between two frames in long form: diff_type, severity, key, column,
source_value, target_value, description."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.scalars import lookup

SCHEMA = "diff_type string, severity string, key string, column string, source_value string, target_value string, description string"
SEVERITIES = ("critical", "high", "medium", "low")
#: Severity by type, for differences that were left at medium.
BY_TYPE = {"structural": "high", "missing": "medium", "value": "medium", "temporal": "low", "granularity": "high"}
TOLERANCE = 1e-6


def _key(columns: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns])


def row_diff(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys that one side lacks. Both sides are reduced to their keys and
    meet once, grouped by them."""
    sides = source.select(*keys, F.lit(1).alias("_s"), F.lit(0).alias("_t")).union(target.select(*keys, F.lit(0), F.lit(1)))
    seen = sides.groupBy(*keys).agg(F.max("_s").alias("_s"), F.max("_t").alias("_t")).filter(F.col("_s") != F.col("_t"))
    side = F.when(F.col("_s") == 1, "target").otherwise("source")
    none = F.lit(None).cast("string")
    key = _key(keys)
    return seen.select(
        F.lit("missing").alias("diff_type"),
        F.lit("medium").alias("severity"),
        key.alias("key"),
        none.alias("column"),
        F.when(F.col("_s") == 1, key).alias("source_value"),
        F.when(F.col("_t") == 1, key).alias("target_value"),
        F.concat(F.lit("missing in "), side).alias("description"),
    )


def structural_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """Columns that one side lacks (high) and types that differ (medium), from the
    schemas alone."""
    a, b = ({f.name: f.dataType.simpleString() for f in d.schema} for d in (source, target))
    rows = [("structural", "high", None, c, a[c], None, "missing in target") for c in a if c not in b]
    rows += [("structural", "high", None, c, None, b[c], "missing in source") for c in b if c not in a]
    rows += [("structural", "medium", None, c, a[c], b[c], "types differ") for c in a if c in b and a[c] != b[c]]
    return source.sparkSession.createDataFrame(rows, SCHEMA)


def _first(df: DataFrame, keys: list[str], columns: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by a total order: an aggregate, which combines
    before the shuffle and bears hot keys."""
    first = F.min_by(F.struct(*[F.col(c) for c in columns]), F.struct(*[F.col(c) for c in order or columns]))
    return df.groupBy(*keys).agg(first.alias("_first"))


def field_diff(source: DataFrame, target: DataFrame, keys: list[str], columns: list[str] | None = None, tolerance: float = TOLERANCE, order: list[str] = ()) -> DataFrame:
    """Values that differ between the first rows of common keys."""
    columns = columns or [c for c in source.columns if c in target.columns and c not in keys]
    a = _first(source, keys, columns, list(order)).withColumnRenamed("_first", "_a")
    b = _first(target, keys, columns, list(order)).withColumnRenamed("_first", "_b")
    both = a.join(b, keys)
    found = []
    for c in columns:
        x, y = F.col("_a")[c], F.col("_b")[c]
        if isinstance(source.schema[c].dataType, T.NumericType) and isinstance(target.schema[c].dataType, T.NumericType):
            apart = F.abs(x.cast("double") - y.cast("double"))
            differs = ~(apart <= tolerance)
            severity = F.when(apart > 1000, "critical").when(apart > 100, "high").when(apart > 10, "medium").otherwise("low")
        elif isinstance(source.schema[c].dataType, T.StringType):
            strip = lambda v: F.lower(F.regexp_replace(v.cast("string"), r"^\s+|\s+$", ""))
            differs, severity = strip(x) != strip(y), F.lit("medium")
        else:
            differs, severity = x != y, F.lit("medium")
        one_null = x.isNull() != y.isNull()
        found.append(
            F.when(
                one_null | F.coalesce(differs, F.lit(False)),
                F.struct(F.lit(c).alias("column"), F.when(one_null, "medium").otherwise(severity).alias("severity"), x.cast("string").alias("source_value"), y.cast("string").alias("target_value")),
            )
        )
    long = both.select(*keys, F.explode(F.filter(F.array(*found), lambda d: d.isNotNull())).alias("d"))
    return long.select(
        F.lit("value").alias("diff_type"),
        F.col("d.severity").alias("severity"),
        _key(keys).alias("key"),
        F.col("d.column").alias("column"),
        F.col("d.source_value").alias("source_value"),
        F.col("d.target_value").alias("target_value"),
        F.lit("values differ").alias("description"),
    )


# --- classification ---------------------------------------------------------------------


def severity_rank(c: str = "severity") -> Column:
    return lookup({s: i for i, s in enumerate(SEVERITIES)}, F.col(c), F.lit(len(SEVERITIES)))


def classify(diffs: DataFrame) -> DataFrame:
    """An explicit severity other than medium stays; else the type's counts."""
    by_type = lookup(BY_TYPE, F.col("diff_type"), F.lit("medium"))
    return diffs.withColumn("severity", F.when(F.col("severity") != "medium", F.col("severity")).otherwise(by_type))


def prioritize(diffs: DataFrame) -> DataFrame:
    return diffs.orderBy(severity_rank(), "diff_type", F.col("key").asc_nulls_first(), F.col("column").asc_nulls_first())


def top_issues(diffs: DataFrame, n: int = 5) -> DataFrame:
    return prioritize(diffs).limit(n)


def by_column(diffs: DataFrame, n: int = 10) -> DataFrame:
    return diffs.filter("column is not null").groupBy("column").agg(F.count(F.lit(1)).alias("diffs")).orderBy(F.desc("diffs"), "column").limit(n)


def of_type(diffs: DataFrame, kind: str) -> DataFrame:
    return diffs.filter(F.col("diff_type") == kind)


def at_least(diffs: DataFrame, severity: str) -> DataFrame:
    return diffs.filter(severity_rank() <= SEVERITIES.index(severity))


@dataclass(frozen=True)
class DiffSummary:
    total: int
    structural: int
    value: int
    missing: int
    critical: int
    source_count: int
    target_count: int
    by_type: dict
    by_severity: dict

    @property
    def diff_rate(self) -> float:
        n = self.source_count + self.target_count
        return self.total / n if n else 0.0


def counts(diffs: DataFrame) -> DataFrame:
    """(diff_type, severity, diffs)."""
    return diffs.groupBy("diff_type", "severity").agg(F.count(F.lit(1)).alias("diffs"))


def summarize(diffs: DataFrame, source_count: int, target_count: int) -> DiffSummary:
    types: dict = {}
    levels: dict = {}
    for r in counts(diffs).collect():  # types times severities: 20 rows at most
        types[r.diff_type] = types.get(r.diff_type, 0) + r.diffs
        levels[r.severity] = levels.get(r.severity, 0) + r.diffs
    return DiffSummary(sum(types.values()), types.get("structural", 0), types.get("value", 0), types.get("missing", 0), levels.get("critical", 0), source_count, target_count, types, levels)


def first_by(df: DataFrame, keys: list[str], order: list[str], last: bool = False) -> DataFrame:
    """One row for each key: the first (or last) by ``order``."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) if last else F.asc(c) for c in order])
    return df.withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k")
