"""Normalisers and factor analysis. Scalars over a whole frame come from one
aggregate that is broadcast back, never from a window without a partition."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.scalars import div
from tidemill.functions.series import DAYS, rank_pct

RISK_FREE = 0.03


def _join_one(df: DataFrame, one: DataFrame, by: list[str]) -> DataFrame:
    """One row of scalars for all rows, or one for each group."""
    if not by:
        return df.crossJoin(F.broadcast(one))
    same = reduce(lambda a, b: a & b, (df[c].eqNullSafe(one[c]) for c in by))
    return df.join(one, same).drop(*(one[c] for c in by))


def zscore(df: DataFrame, column: str, out: str, by: list[str] = ()) -> DataFrame:
    """(x - mean) / std; 0 where there is no spread."""
    one = df.groupBy(*by).agg(F.avg(column).alias("_mean"), F.stddev_samp(column).alias("_std"))
    x = F.col(column)
    z = F.when(F.col("_std") > 0, (x - F.col("_mean")) / F.when(F.col("_std") > 0, F.col("_std"))).otherwise(F.when(x.isNotNull(), 0.0))
    return _join_one(df, one, list(by)).withColumn(out, z).drop("_mean", "_std")


def minmax(df: DataFrame, column: str, out: str, by: list[str] = ()) -> DataFrame:
    """(x - min) / (max - min); 0.5 where all are equal."""
    one = df.groupBy(*by).agg(F.min(column).alias("_min"), F.max(column).alias("_max"))
    x, width = F.col(column), F.col("_max") - F.col("_min")
    return _join_one(df, one, list(by)).withColumn(out, F.when(width > 0, (x - F.col("_min")) / F.when(width > 0, width)).otherwise(F.when(x.isNotNull(), 0.5))).drop("_min", "_max")


def rank(df: DataFrame, column: str, out: str, by: list[str] = ()) -> DataFrame:
    """Share of the values up to x, ties at their mean. By group a window; over a
    whole frame from counts of the distinct values, whose running sum needs an
    order but only a row a value."""
    if by:
        return df.withColumn(out, rank_pct(column, list(by)))
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    ranged = running_total(counts, column, "_n", "_before")
    total = counts.agg(F.sum("_n").alias("_all"))
    ranks = ranged.crossJoin(F.broadcast(total)).select(
        F.col(column).alias("_value"), ((F.col("_before").cast("double") + (F.col("_n").cast("double") + 1.0) / 2.0) / F.col("_all").cast("double")).alias(out)
    )
    return df.join(ranks, df[column] == ranks["_value"], "left").drop("_value")


def running_total(df: DataFrame, order: str, amount: str, out: str, ranges: int = 64) -> DataFrame:
    """``df`` with the sum of ``amount`` of all rows before it in ``order``, whose
    values are distinct: sums within ranges plus the sums of the ranges before. Range
    borders are approximate quantiles, so no task gets the whole frame."""
    cuts = df.agg(F.percentile_approx(order, [i / ranges for i in range(1, ranges)], 1000).alias("q")).withColumn("q", F.array_sort(F.array_distinct("q")))
    dealt = df.crossJoin(F.broadcast(cuts)).withColumn("_range", F.size(F.filter("q", lambda c: c < F.col(order)))).drop("q")
    sums = dealt.groupBy("_range").agg(F.sum(amount).alias("_sum"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("_range").alias("_r"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    dealt = dealt.withColumn("_in", F.coalesce(F.sum(amount).over(within), F.lit(0)))
    joined = dealt.join(F.broadcast(sums), F.col("_range") == F.col("_r"))
    return joined.withColumn(out, F.col("_base") + F.col("_in")).drop("_range", "_r", "_base", "_in")


def quantiles(df: DataFrame, column: str, shares: list[float]) -> DataFrame:
    """One row, _q: exact interpolated quantiles of a whole frame. Places come from the
    running counts of the distinct values, in ranges, so that no task holds them all."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_all"))
    placed = running_total(counts, "_value", "_n", "_before").crossJoin(F.broadcast(total))
    at = lambda place: F.max(F.when((F.col("_before") <= place) & (place < F.col("_before") + F.col("_n")), F.col("_value")))
    place = [F.lit(s) * (F.col("_all") - 1).cast("double") for s in shares]
    found = placed.agg(*[at(f(p)).alias(f"_{k}{i}") for i, p in enumerate(place) for k, f in (("low", F.floor), ("high", F.ceil))], F.max("_all").alias("_all"))
    weights = [p - F.floor(p) for p in place]
    return found.select(F.array(*[F.col(f"_low{i}") + (F.col(f"_high{i}") - F.col(f"_low{i}")) * w for i, w in enumerate(weights)]).alias("_q"))


def winsorize(df: DataFrame, column: str, out: str, low: float = 0.01, high: float = 0.99, by: list[str] = ()) -> DataFrame:
    """Clipped to interpolated quantiles."""
    one = df.groupBy(*by).agg(F.percentile(column, [low, high]).alias("_q")) if by else quantiles(df, column, [low, high])
    x = F.col(column)
    clipped = F.when(x.isNotNull(), F.least(F.greatest(x, F.col("_q")[0]), F.col("_q")[1]))
    return _join_one(df, one, list(by)).withColumn(out, clipped).drop("_q")


@dataclass
class Normalizer:
    """Fitted parameters by name of method and column, saved as JSON."""

    params: dict = field(default_factory=dict)

    def fit(self, df: DataFrame, column: str) -> Normalizer:
        row = df.agg(F.avg(column), F.stddev_samp(column), F.min(column), F.max(column)).first()
        low, high = quantiles(df, column, [0.01, 0.99]).first()[0]
        self.params[column] = {"mean": row[0], "std": row[1], "min": row[2], "max": row[3], "low": low, "high": high}
        return self

    def apply(self, df: DataFrame, column: str, method: str, out: str) -> DataFrame:
        p, x = self.params[column], F.col(column)
        if method == "zscore":
            c = (x - p["mean"]) / p["std"] if p["std"] else F.when(x.isNotNull(), 0.0)
        elif method == "minmax":
            c = (x - p["min"]) / (p["max"] - p["min"]) if p["max"] != p["min"] else F.when(x.isNotNull(), 0.5)
        elif method == "winsorize":
            c = F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(p["low"])), F.lit(p["high"])))
        else:
            raise ValueError(f"no method {method}")
        return df.withColumn(out, c)

    def save(self, path: str) -> None:
        with open(path, "w", encoding="utf-8") as f:
            json.dump(self.params, f)

    @classmethod
    def load(cls, path: str) -> Normalizer:
        with open(path, encoding="utf-8") as f:
            return cls(json.load(f))


# --- analysis ---------------------------------------------------------------------------


def daily_ic(df: DataFrame, factor: str = "factor", ret: str = "forward_return", date: str = "trade_date", by: list[str] = ()) -> DataFrame:
    """Pearson correlation of each day with two complete rows or more."""
    both = F.col(factor).isNotNull() & F.col(ret).isNotNull()
    ic = F.corr(F.when(both, F.col(factor)), F.when(both, F.col(ret)))
    days = df.groupBy(*by, date).agg(ic.alias("ic"), F.count(F.lit(1)).alias("n"))
    return days.filter((F.col("n") >= 2) & F.col("ic").isNotNull() & ~F.isnan("ic")).select(*by, date, "ic")


def ic(df: DataFrame, factor: str = "factor", ret: str = "forward_return", date: str | None = "trade_date", by: list[str] = ()) -> DataFrame:
    """ic_mean and ic_std (population) of the days; 0 where there is none. Without a
    date one correlation, and 0."""
    if date is None:
        one = df.groupBy(*by).agg(F.corr(factor, ret).alias("ic"))
        return one.select(*by, F.coalesce(F.when(~F.isnan("ic"), F.col("ic")), F.lit(0.0)).alias("ic_mean"), F.lit(0.0).alias("ic_std"))
    return daily_ic(df, factor, ret, date, by).groupBy(*by).agg(F.coalesce(F.avg("ic"), F.lit(0.0)).alias("ic_mean"), F.coalesce(F.stddev_pop("ic"), F.lit(0.0)).alias("ic_std"))


def turnover(df: DataFrame, factor: str = "factor", date: str = "trade_date", code: str = "code", by: list[str] = ()) -> DataFrame:
    """Mean absolute change of the percent rank, each code against its day before;
    0 where there is no pair."""
    ranked = rank(df, factor, "_rank", list(by))
    w = Window.partitionBy(*by, code).orderBy(date)
    change = F.abs(F.col("_rank") - F.lag("_rank").over(w))
    return ranked.withColumn("_change", change).groupBy(*by).agg(F.coalesce(F.avg("_change"), F.lit(0.0)).alias("turnover"))


def returns(df: DataFrame, ret: str = "forward_return", by: list[str] = ()) -> DataFrame:
    """return_mean, return_std and sharpe_ratio (252 days, risk-free 3%)."""
    one = df.groupBy(*by).agg(F.avg(ret).alias("return_mean"), F.stddev_samp(ret).alias("return_std"))
    sharpe = div(F.col("return_mean") - RISK_FREE / DAYS, "return_std") * DAYS**0.5
    return one.withColumn("sharpe_ratio", F.coalesce(sharpe, F.lit(0.0)))


def drawdown(df: DataFrame, ret: str = "forward_return", date: str = "trade_date", code: str = "code") -> DataFrame:
    """(code, max_drawdown): the lowest of cum / running maximum - 1, cum being the
    running product of 1 + r."""
    w = Window.partitionBy(code).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    cum = df.filter(F.col(ret).isNotNull()).withColumn("_cum", F.product(1.0 + F.col(ret)).over(w)).withColumn("_peak", F.max("_cum").over(w))
    return cum.groupBy(code).agg(F.min(div(F.col("_cum") - F.col("_peak"), "_peak")).alias("max_drawdown"))


def analyze(df: DataFrame, factor: str = "factor", ret: str = "forward_return", date: str = "trade_date", code: str = "code", by: list[str] = ()) -> DataFrame:
    """One row (a group): ic_mean, ic_std, ir, turnover, return_mean, return_std,
    sharpe_ratio, and max_drawdown, the lowest of the codes'."""
    by = list(by)
    rows = df.filter(F.col(factor).isNotNull() & F.col(ret).isNotNull())
    keys = Window.partitionBy(*by, code).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    cum = rows.withColumn("_cum", F.product(1.0 + F.col(ret)).over(keys)).withColumn("_peak", F.max("_cum").over(keys))
    down = cum.groupBy(*by).agg(F.min(div(F.col("_cum") - F.col("_peak"), "_peak")).alias("max_drawdown"))
    parts = [ic(rows, factor, ret, date, by), turnover(rows, factor, date, code, by), returns(rows, ret, by), down]
    if by:
        out = reduce(lambda a, b: a.join(b, by), parts)
    else:
        out = reduce(lambda a, b: a.crossJoin(b), parts)
    ir = F.when(F.col("ic_std") != 0, F.col("ic_mean") / F.when(F.col("ic_std") != 0, F.col("ic_std"))).otherwise(0.0)
    return out.select(*by, "ic_mean", "ic_std", ir.alias("ir"), "turnover", "return_mean", "return_std", "sharpe_ratio", "max_drawdown")

