"""The cleaning chain: steps from DataFrame to DataFrame, in order, each with
checks of its result. Steps look at ``df.columns`` when the plan is built and never
start a job; all checks are collected in one aggregate."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions import scalars, series
from tidemill.functions.scalars import div

PRICES = ("open", "high", "low", "close")
#: Weights of completeness, consistency, timeliness and accuracy.
WEIGHTS = (0.30, 0.25, 0.20, 0.25)


def has(df: DataFrame, *columns: str) -> bool:
    return set(columns) <= set(df.columns)


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def universal(df: DataFrame) -> DataFrame:
    """Full-row duplicates and null keys go; codes get their exchange."""
    df = df.dropDuplicates()
    if has(df, "code", "trade_date"):
        df = df.dropna(subset=["code", "trade_date"])
    return df.withColumn("code", scalars.unify_code("code")) if has(df, "code") else df


def adjustment(df: DataFrame) -> DataFrame:
    """Prices times the adjustment factor, volume divided by it (truncated); a
    factor that is zero or null counts as one."""
    if not has(df, "adj_factor"):
        return df
    f = F.coalesce(F.when(F.col("adj_factor") != 0, F.col("adj_factor")), F.lit(1.0))
    out = {c: F.col(c) * f for c in PRICES if c in df.columns}
    if has(df, "volume"):
        out["volume"] = (F.col("volume") / f).try_cast("bigint")
    return df.withColumns({**out, "adj_factor": f})


def status(df: DataFrame) -> DataFrame:
    """is_st from the name, is_suspended from a zero volume."""
    if not has(df, "code"):
        return df
    st = _true(F.lower("name").contains("st")) if has(df, "name") else (F.col("is_st") if has(df, "is_st") else F.lit(False))
    idle = _true(F.col("volume") == 0) if has(df, "volume") else (F.col("is_suspended") if has(df, "is_suspended") else F.lit(False))
    return df.withColumns({"is_st": st, "is_suspended": idle})


def ohlc(df: DataFrame) -> DataFrame:
    """ohlc_valid flags rows; none is dropped."""
    bad = F.lit(False)
    for a, b in (("high", "low"), ("high", "open"), ("high", "close"), ("open", "low"), ("close", "low")):
        if has(df, a, b):
            bad = bad | _true(F.col(a) < F.col(b))
    for c in (*PRICES, "volume", "amount"):
        if has(df, c):
            bad = bad | _true(F.col(c) < 0)
    return df.withColumn("ohlc_valid", ~bad)


def _as_of(as_of) -> Column:
    return F.current_date() if as_of is None else F.to_date(F.lit(str(as_of)))


def convertible_bond(df: DataFrame, as_of=None) -> DataFrame:
    if not has(df, "conversion_value") and has(df, "close", "conversion_price"):
        df = df.withColumn("conversion_value", div("close", "conversion_price") * 100.0)
    if not has(df, "premium_rate") and has(df, "close", "conversion_value"):
        df = df.withColumn("premium_rate", div(F.col("close") - F.col("conversion_value"), "conversion_value") * 100.0)
    if has(df, "premium_rate"):
        df = df.withColumn("high_premium", _true(F.col("premium_rate") > 50))
    if has(df, "maturity_date"):
        df = df.withColumn("near_maturity", _true(F.col("maturity_date") <= F.date_add(_as_of(as_of), 365)))
    return df


def _change(column: str) -> Column:
    return F.coalesce(series.diff(column, series.by()), F.lit(0))


def futures(df: DataFrame, as_of=None, per_underlying: bool = False) -> DataFrame:
    """is_main_contract: the largest volume of the day (ties all), of all contracts
    unless ``per_underlying``."""
    if has(df, "code", "volume", "trade_date"):
        day = ["trade_date", *(["underlying"] if per_underlying else [])]
        # Largest volumes are combined before they are dealt out; a window would put all
        # rows of a day into one task.
        largest = df.groupBy(*[F.col(c).alias(f"_{c}") for c in day]).agg(F.max("volume").alias("_largest"))
        same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in day))
        df = df.join(largest, same, "left").withColumn("is_main_contract", _true(F.col("volume") == F.col("_largest")))
        df = df.drop("_largest", *[f"_{c}" for c in day])
    if has(df, "expiry_date"):
        df = df.withColumn("near_delivery", _true(F.col("expiry_date") <= F.date_add(_as_of(as_of), 30)))
    if has(df, "open_interest", "code", "trade_date"):
        df = df.withColumn("oi_change", _change("open_interest"))
    return df


def options(df: DataFrame, as_of=None) -> DataFrame:
    if has(df, "close", "strike_price", "option_type"):
        m, call, put = F.col("moneyness"), F.col("option_type") == "call", F.col("option_type") == "put"
        df = df.withColumn("moneyness", div("underlying_price" if has(df, "underlying_price") else "close", "strike_price"))
        inside = (call & (m > 1.05)) | (put & (m < 0.95))
        outside = (call & (m < 0.95)) | (put & (m > 1.05))
        df = df.withColumn("option_status", F.when(inside, "in_the_money").when(outside, "out_of_the_money").otherwise("at_the_money"))
    if has(df, "expiry_date"):
        df = df.withColumn("near_expiry", _true(F.col("expiry_date") <= F.date_add(_as_of(as_of), 7)))
    if has(df, "open_interest", "code", "trade_date"):
        df = df.withColumn("oi_change", _change("open_interest"))
    if has(df, "implied_volatility", "code", "trade_date"):
        df = df.withColumn("iv_change", _change("implied_volatility"))
    return df


# --- quality score ----------------------------------------------------------------------


def quality_parts(df: DataFrame, as_of=None) -> DataFrame:
    """One row: total_records, completeness, consistency, timeliness, accuracy,
    quality_score, grade. Rows are counted in groups of equal rows first, so that
    duplicates need one shuffle with partial sums and no distinct expansion."""
    columns = df.columns
    date = next((c for c in columns if "date" in c.lower()), None)
    nulls = sum((F.when(F.col(c).isNull(), 1).otherwise(0) for c in columns), F.lit(0))
    checks = [[F.col(c) < 0] + ([F.col("high") < F.col("low")] if c == "high" and "low" in columns else []) for c in (*PRICES, "settle", "volume", "open_interest") if c in columns]
    flags = [F.max(_true(t)).alias(f"q{i}") for i, t in enumerate(t for ts in checks for t in ts)]
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    one = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(nulls * F.col("_n")), F.lit(0)).alias("nulls"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("copies"),
        (F.max(F.col(date).cast("date")) if date else F.lit(None).cast("date")).alias("latest"),
        *flags,
    )
    n = F.col("n").cast("double")
    some = F.col("n") > 0
    late = F.datediff(_as_of(as_of), F.col("latest")).cast("double")
    issues = sum((F.col(f"q{i}").cast("int") for i in range(len(flags))), F.lit(0))
    timely = F.when(late.isNull() | (late <= 0), 100.0).when(late >= 60, 0.0).otherwise(100.0 - late / 60.0 * 100.0)
    accurate = F.greatest(F.lit(0.0), (1.0 - issues.cast("double") / float(len(checks))) * 100.0) if checks else F.lit(100.0)
    out = one.select(
        F.col("n").alias("total_records"),
        F.when(some, (1.0 - F.col("nulls").cast("double") / F.when(some, n * len(columns))) * 100.0).otherwise(100.0).alias("completeness"),
        F.when(some, (1.0 - F.col("copies").cast("double") / F.when(some, n)) * 100.0).otherwise(100.0).alias("consistency"),
        F.when(some, timely).otherwise(100.0).alias("timeliness"),
        F.when(some, accurate).otherwise(100.0).alias("accuracy"),
    )
    parts = ("completeness", "consistency", "timeliness", "accuracy")
    out = out.withColumn("quality_score", sum((F.col(p) * w for p, w in zip(parts[1:], WEIGHTS[1:], strict=True)), F.col(parts[0]) * WEIGHTS[0]))
    return out.withColumn("grade", grade(F.col("quality_score")))


def grade(score: Column) -> Column:
    return F.when(score >= 90, "A").when(score >= 70, "B").when(score >= 50, "C").otherwise("D")


def quality(df: DataFrame, as_of=None) -> DataFrame:
    """The frame's score on every row; the score is one row, which is broadcast."""
    return df.crossJoin(F.broadcast(quality_parts(df, as_of).select("quality_score")))


@dataclass(frozen=True)
class QualityIssue:
    dimension: str
    severity: str
    description: str
    affected_rows: int


def quality_report(df: DataFrame, table: str, partition: str, as_of=None) -> dict:
    """The score's parts and an issue for each part under 90."""
    row = quality_parts(df, as_of).first().asDict()
    issues = [
        QualityIssue(part, "warning" if row[part] >= 70 else "error", f"{part.capitalize()} score: {row[part]:.1f}%", 0 if part == "timeliness" else int((1 - row[part] / 100) * row["total_records"]))
        for part in ("completeness", "consistency", "timeliness", "accuracy")
        if row[part] < 90
    ]
    return {"schema_name": table, "partition_key": partition, **row, "issues": issues}


# --- checks of the steps' results -------------------------------------------------------


def _any(df: DataFrame, *tests: tuple[tuple[str, ...], str, Callable[[], Column]]) -> list[tuple[str, Column]]:
    return [(label, test()) for columns, label, test in tests if has(df, *columns)]


CHECKS: dict[str, Callable[[DataFrame], list[tuple[str, Column]]]] = {
    "universal": lambda df: _any(df, (("code",), "null code", lambda: F.col("code").isNull()), (("trade_date",), "null trade_date", lambda: F.col("trade_date").isNull())),
    "adjustment": lambda df: _any(
        df, (("adj_factor",), "non-positive adj_factor", lambda: F.col("adj_factor") <= 0), *((("adj_factor", c), f"negative adjusted {c}", lambda c=c: F.col(c) < 0) for c in PRICES)
    ),
    "ohlc": lambda df: _any(df, (("ohlc_valid",), "invalid OHLC", lambda: ~F.col("ohlc_valid"))),
    "convertible_bond": lambda df: _any(df, (("conversion_price",), "non-positive conversion_price", lambda: F.col("conversion_price") <= 0)),
    "futures": lambda df: _any(df, (("settle", "close"), "settle far from close", lambda: F.abs(div(F.col("settle") - F.col("close"), "close")) > 0.1)),
    "options": lambda df: _any(
        df,
        (("implied_volatility",), "implied_volatility out of range", lambda: (F.col("implied_volatility") < 0) | (F.col("implied_volatility") > 500)),
        (("delta",), "delta out of range", lambda: (F.col("delta") < -1) | (F.col("delta") > 1)),
        (("strike_price",), "non-positive strike_price", lambda: F.col("strike_price") <= 0),
    ),
    "quality": lambda df: _any(df, (("quality_score",), "quality_score out of range", lambda: (F.col("quality_score") < 0) | (F.col("quality_score") > 100))),
}

STEPS: dict[str, Callable[..., DataFrame]] = {
    "universal": universal,
    "adjustment": adjustment,
    "status": status,
    "ohlc": ohlc,
    "convertible_bond": convertible_bond,
    "futures": futures,
    "options": options,
    "quality": quality,
}
_DATED = {"convertible_bond", "futures", "options", "quality"}
PROFILES = {"baseline": tuple(STEPS), "advanced": tuple(STEPS)}


def clean(df: DataFrame, profile: str = "baseline", as_of=None) -> DataFrame:
    for name in PROFILES[profile]:
        df = STEPS[name](df, as_of) if name in _DATED else STEPS[name](df)
    return df


def issues(df: DataFrame, profile: str = "baseline") -> DataFrame:
    """(issue, violated) of a cleaned frame, as ``[step] label``; one job."""
    tests = [(f"[{step}] {label}", test) for step in PROFILES[profile] if step in CHECKS for label, test in CHECKS[step](df)]
    if not tests:
        return df.sparkSession.createDataFrame([], "issue string, violated boolean")
    wide = df.agg(*[F.coalesce(F.max(_true(t)), F.lit(False)).alias(f"c{i}") for i, (_, t) in enumerate(tests)])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(label).alias("issue"), F.col(f"c{i}").alias("violated")) for i, (label, _) in enumerate(tests)])))
