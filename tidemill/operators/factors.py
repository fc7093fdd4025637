"""Factors as column expressions. A factor is a function of parameters that
returns its output columns; :func:`calculate` puts any number of them into one
``select``, so that their windows share one exchange and one sort."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from enum import Enum

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemill.functions import series
from tidemill.functions.scalars import div
from tidemill.functions.series import DAYS, roll


class Category(Enum):
    TECHNICAL = "technical"
    FUNDAMENTAL = "fundamental"
    ALTERNATIVE = "alternative"


class Frequency(Enum):
    DAILY = "daily"
    WEEKLY = "weekly"
    MONTHLY = "monthly"
    QUARTERLY = "quarterly"


@dataclass(frozen=True)
class Metadata:
    name: str
    category: Category
    frequency: Frequency = Frequency.DAILY
    description: str = ""
    required: tuple[str, ...] = ()
    params: dict = field(default_factory=dict)
    tags: tuple[str, ...] = ()


@dataclass(frozen=True)
class Factor:
    """``columns``: (window, parameters) to named columns. ``recursive``: named
    exponential means (input, alpha) that must exist first, from the parameters."""

    meta: Metadata
    columns: Callable[..., dict[str, Column]]
    recursive: Callable[..., list[tuple[dict[str, Column], dict[str, tuple[str, float]]]]] | None = None

    @property
    def name(self) -> str:
        return self.meta.name


@dataclass(frozen=True)
class Result:
    """A lazy result, or the reason for which no plan was built."""

    factor_name: str
    data: DataFrame | None
    metadata: Metadata
    success: bool = True
    error_message: str | None = None


class Registry:
    def __init__(self):
        self._factors: dict[str, Factor] = {}

    def register(self, factor: Factor) -> None:
        if factor.name in self._factors:
            raise ValueError(f"factor {factor.name} is registered already")
        self._factors[factor.name] = factor

    def unregister(self, name: str) -> None:
        self._factors.pop(name)

    def get(self, name: str) -> Factor:
        if name not in self._factors:
            raise KeyError(f"no factor {name}")
        return self._factors[name]

    def metadata(self, name: str) -> Metadata:
        return self.get(name).meta

    def names(self, category: Category | None = None) -> list[str]:
        return [n for n, f in self._factors.items() if category in (None, f.meta.category)]

    def list_metadata(self) -> list[Metadata]:
        return [f.meta for f in self._factors.values()]

    def by_tag(self, tag: str) -> list[str]:
        return [n for n, f in self._factors.items() if tag in f.meta.tags]

    def __len__(self) -> int:
        return len(self._factors)

    def __contains__(self, name: str) -> bool:
        return name in self._factors


REGISTRY = Registry()


def _add(name: str, category: Category, required: tuple[str, ...], columns, params: dict | None = None, tags: tuple[str, ...] = (), frequency: Frequency = Frequency.DAILY, recursive=None) -> None:
    REGISTRY.register(Factor(Metadata(name, category, frequency, (columns.__doc__ or "").strip(), required, params or {}, tags), columns, recursive))


# --- technical --------------------------------------------------------------------------


def _momentum(w, window):
    return {f"momentum_{window}d": series.momentum("close", window, w)}


def _volatility(w):
    return {"volatility_20d": roll(F.stddev_samp, series.pct_change("close", w), 20, w) * DAYS**0.5}


def _atr(w, period):
    before = series.lag("close", 1, w)
    spread = F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before))
    return {f"atr_{period}": roll(F.avg, spread, period, w)}


def _realized(w, window):
    ratio = div("close", series.lag("close", 1, w))
    return {f"realized_vol_{window}d": roll(F.stddev_samp, F.when(ratio > 0, F.ln(F.when(ratio > 0, ratio))), window, w) * DAYS**0.5}


def _turnover(w, source="turnover"):
    return {"turnover_rate": F.col("turnover").cast("double") if source == "turnover" else div("volume", "float_shares")}


def _amihud(w, window):
    return {f"amihud_{window}d": roll(F.avg, div(F.abs(series.pct_change("close", w)), "amount"), window, w)}


def _volume_momentum(w, window):
    return {f"volume_momentum_{window}d": div("volume", roll(F.avg, "volume", window, w))}


def _rsi(w, period):
    """Simple means of gains and losses, not Wilder's."""
    d = series.diff("close", w)
    gain = roll(F.avg, F.when(d > 0, d).otherwise(0.0), period, w)
    loss = roll(F.avg, F.when(d < 0, -d).otherwise(0.0), period, w)
    return {f"rsi_{period}": F.when(loss == 0, F.when(gain > 0, 100.0)).otherwise(100.0 - 100.0 / (1.0 + div(gain, loss)))}


def _macd_means(w, fast, slow, signal):
    return [
        ({}, {"_ema_fast": ("close", 2 / (fast + 1)), "_ema_slow": ("close", 2 / (slow + 1))}),
        ({"_dif": F.col("_ema_fast") - F.col("_ema_slow")}, {"_dea": ("_dif", 2 / (signal + 1))}),
    ]


def _macd(w, fast, slow, signal):
    return {"macd_dif": F.col("_dif"), "macd_dea": F.col("_dea"), "macd_hist": 2.0 * (F.col("_dif") - F.col("_dea"))}


def _bollinger(w, window, num_std):
    mean, std = roll(F.avg, "close", window, w), roll(F.stddev_samp, "close", window, w)
    up, low = mean + std * num_std, mean - std * num_std
    return {"bollinger_upper": up, "bollinger_middle": mean, "bollinger_lower": low, "bollinger_position": div(F.col("close") - low, up - low)}


def _kdj_means(w, n, m):
    low, high = roll(F.min, "low", n, w), roll(F.max, "high", n, w)
    return [({"_rsv": div(F.col("close") - low, high - low) * 100.0}, {"_k": ("_rsv", 1 / m)}), ({}, {"_d": ("_k", 1 / m)})]


def _kdj(w, n, m):
    return {"kdj_k": F.col("_k"), "kdj_d": F.col("_d"), "kdj_j": 3.0 * F.col("_k") - 2.0 * F.col("_d")}


for _n in (5, 20, 60):
    _add(f"momentum_{_n}d", Category.TECHNICAL, ("close",), lambda w, n=_n: _momentum(w, n), tags=("momentum",))
_add("momentum", Category.TECHNICAL, ("close",), _momentum, {"window": 10}, ("momentum",))
_add("volatility_20d", Category.TECHNICAL, ("close",), _volatility, tags=("volatility",))
_add("atr", Category.TECHNICAL, ("high", "low", "close"), _atr, {"period": 14}, ("volatility",))
_add("realized_vol", Category.TECHNICAL, ("close",), _realized, {"window": 20}, ("volatility",))
_add("turnover_rate", Category.TECHNICAL, (), _turnover, {"source": "turnover"}, ("liquidity",))
_add("amihud", Category.TECHNICAL, ("close", "amount"), _amihud, {"window": 20}, ("liquidity",))
_add("volume_momentum", Category.TECHNICAL, ("volume",), _volume_momentum, {"window": 20}, ("liquidity",))
_add("rsi", Category.TECHNICAL, ("close",), _rsi, {"period": 14}, ("indicator",))
_add("macd", Category.TECHNICAL, ("close",), _macd, {"fast": 12, "slow": 26, "signal": 9}, ("indicator",), recursive=_macd_means)
_add("bollinger", Category.TECHNICAL, ("close",), _bollinger, {"window": 20, "num_std": 2.0}, ("indicator",))
_add("kdj", Category.TECHNICAL, ("high", "low", "close"), _kdj, {"n": 9, "m": 3}, ("indicator",), recursive=_kdj_means)


# --- fundamental ------------------------------------------------------------------------

_RATIOS = {
    "pe": ("close", "eps"),
    "pb": ("close", "bps"),
    "ps": ("market_cap", "revenue"),
    "dividend_yield": ("dividend", "close"),
    "earnings_yield": ("eps", "close"),
    "roe": ("net_profit", "shareholders_equity"),
    "debt_to_equity": ("total_liabilities", "shareholders_equity"),
    "current_ratio": ("current_assets", "current_liabilities"),
    "asset_turnover": ("revenue", "total_assets"),
}
_GROWTH = {
    "revenue_growth": "revenue",
    "net_profit_growth": "net_profit",
    "eps_growth": "eps",
    "book_value_growth": "shareholders_equity",
    "operating_cash_flow_growth": "operating_cash_flow",
}
for _name, (_a, _b) in _RATIOS.items():
    _add(_name, Category.FUNDAMENTAL, (_a, _b), lambda w, n=_name, a=_a, b=_b: {n: div(a, b)}, tags=("ratio",), frequency=Frequency.QUARTERLY)
_add("gross_margin", Category.FUNDAMENTAL, ("revenue", "cost_of_goods_sold"), lambda w: {"gross_margin": div(F.col("revenue") - F.col("cost_of_goods_sold"), "revenue")}, tags=("ratio",), frequency=Frequency.QUARTERLY)
for _name, _a in _GROWTH.items():
    _add(
        _name,
        Category.FUNDAMENTAL,
        (_a,),
        lambda w, periods, n=_name, a=_a: {n: div(F.col(a) - series.lag(a, periods, w), series.lag(a, periods, w))},
        {"periods": 1},
        ("growth",),
        Frequency.QUARTERLY,
    )


# --- alternative ------------------------------------------------------------------------


def _net() -> Column:
    return F.col("buy_amount") - F.col("sell_amount")




_add("north_flow_net", Category.ALTERNATIVE, ("buy_amount", "sell_amount"), lambda w: {"north_flow_net": _net()}, tags=("flow",))
_add("north_flow_momentum", Category.ALTERNATIVE, ("buy_amount", "sell_amount"), lambda w, window: {f"north_flow_momentum_{window}d": div(_net(), roll(F.avg, _net(), window, w))}, {"window": 5}, ("flow",))
_add("margin_balance_change", Category.ALTERNATIVE, ("margin_balance",), lambda w: {"margin_balance_change": series.diff("margin_balance", w)}, tags=("flow",))
_add("margin_ratio", Category.ALTERNATIVE, ("margin_balance", "short_balance"), lambda w: {"margin_ratio": div("margin_balance", "short_balance")}, tags=("flow",))

LIMIT = 10.0


def breadth(df: DataFrame, by: str | None = "trade_date") -> DataFrame:
    """limit_up_count, limit_down_count, advance_decline_ratio and market_breadth
    of each day, or of the whole frame; partial aggregates combine before the
    shuffle."""
    up, down = F.sum(F.when(F.col("pct_change") > 0, 1).otherwise(0)), F.sum(F.when(F.col("pct_change") < 0, 1).otherwise(0))
    n = F.count(F.lit(1))
    ratio = F.when(down > 0, up.cast("double") / F.when(down > 0, down)).when(up > 0, float("inf")).otherwise(1.0)
    grouped = df.groupBy(by) if by else df.groupBy()
    return grouped.agg(
        F.coalesce(F.sum(F.when(F.col("pct_change") >= LIMIT, 1).otherwise(0)), F.lit(0)).cast("bigint").alias("limit_up_count"),
        F.coalesce(F.sum(F.when(F.col("pct_change") <= -LIMIT, 1).otherwise(0)), F.lit(0)).cast("bigint").alias("limit_down_count"),
        ratio.alias("advance_decline_ratio"),
        F.when(n > 0, up.cast("double") / F.when(n > 0, n)).otherwise(0.5).alias("market_breadth"),
    )


def volatility_index(df: DataFrame, window: int = 20, code: str | None = "code", time: str = "trade_date") -> DataFrame:
    """``df`` with volatility_index_{window}d: the rolling yearly deviation of
    pct_change as a z-score over its series; 0 where that doesn't vary."""
    w = series.by(code, time)
    name = f"volatility_index_{window}d"
    df = df.withColumn("_vol", roll(F.stddev_samp, "pct_change", window, w) * DAYS**0.5)
    if code:
        whole = Window.partitionBy(code)
        mean, std = F.avg("_vol").over(whole), F.stddev_samp("_vol").over(whole)
        score = F.when(std > 0, (F.col("_vol") - mean) / F.when(std > 0, std)).otherwise(F.when(F.col("_vol").isNotNull(), 0.0))
        return df.withColumn(name, score).drop("_vol")
    one = df.agg(F.avg("_vol").alias("_mean"), F.stddev_samp("_vol").alias("_std"))
    df = df.crossJoin(F.broadcast(one))
    return df.withColumn(name, F.when(F.col("_std") > 0, (F.col("_vol") - F.col("_mean")) / F.when(F.col("_std") > 0, F.col("_std"))).otherwise(0.0)).drop("_vol", "_mean", "_std")


def _by_breadth(name: str):
    _add(name, Category.ALTERNATIVE, ("pct_change",), lambda w, n=name: {n: F.col(n)}, tags=("sentiment", "breadth"))


for _name in ("limit_up_count", "limit_down_count", "advance_decline_ratio", "market_breadth"):
    _by_breadth(_name)
_add("volatility_index", Category.ALTERNATIVE, ("pct_change",), lambda w, window: {f"volatility_index_{window}d": F.col(f"volatility_index_{window}d")}, {"window": 20}, ("sentiment",))


# --- calculation ------------------------------------------------------------------------


def calculate(df: DataFrame, factors: list[str | tuple[str, dict]], code: str | None = "code", time: str = "trade_date", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (by default code and time) with the columns of all factors."""
    w: WindowSpec = series.by(code, time)
    wanted = [(REGISTRY.get(f), {}) if isinstance(f, str) else (REGISTRY.get(f[0]), f[1]) for f in factors]
    out: dict[str, Column] = {}
    for factor, params in wanted:
        params = {**factor.meta.params, **params}
        if missing := [c for c in factor.meta.required if c not in df.columns]:
            raise ValueError(f"Missing '{missing[0]}' column")
        if "breadth" in factor.meta.tags and factor.name not in df.columns:
            df = df.join(breadth(df, time), time, "left")
        if factor.name == "volatility_index":
            df = volatility_index(df, params["window"], code, time)
        if factor.recursive:
            for before, means in factor.recursive(w, **params):
                if before:
                    df = df.withColumns(before)
                df = series.with_ewm(df, means, code, time)
        out |= factor.columns(w, **params)
    kept = keep or [c for c in (code, time) if c]
    return df.select(*kept, *[c.alias(n) for n, c in out.items()])


def compute(name: str, df: DataFrame, **params) -> Result:
    """One factor as a result that says why there is none."""
    factor = REGISTRY.get(name)
    for c in factor.meta.required:
        if c not in df.columns:
            return Result(name, None, factor.meta, False, f"Missing '{c}' column")
    options = {k: params.pop(k) for k in ("code", "time", "keep") if k in params}
    return Result(name, calculate(df, [(name, params)], **options), factor.meta)
