"""Declared tables: schema, required columns, row checks, keys and partitions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.scalars import number

_TYPES = {"str": T.StringType(), "float": T.DoubleType(), "int": T.LongType(), "bool": T.BooleanType(), "date": T.DateType(), "time": T.TimestampNTZType()}
_PRICES = ("open", "high", "low", "close")


def _struct(text: str) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (x.split(":") for x in text.split())])


def _below(columns: tuple[str, ...], label: str) -> tuple[str, tuple[str, ...], Callable[[], Column]]:
    def test() -> Column:
        out = F.lit(False)
        for c in columns:
            out = out | F.coalesce(F.col(c) < 0, F.lit(False))
        return out

    return label, columns, test


def _check(label: str, columns: tuple[str, ...], test: Callable[[], Column]):
    return label, columns, test


HIGH_LOW = _check("high_below_low", ("high", "low"), lambda: F.col("high") < F.col("low"))
NEGATIVE_PRICE = _below(_PRICES, "negative_price")
NEGATIVE_VOLUME = _below(("volume",), "negative_volume")


def _outside(column: str, low: float, high: float):
    return _check(f"{column}_out_of_range", (column,), lambda: (F.col(column) < low) | (F.col(column) > high))


def _not_positive(column: str):
    return _check(f"non_positive_{column}", (column,), lambda: F.col(column) <= 0)


@dataclass(frozen=True)
class TableSpec:
    """A declared table. ``checks``: (label, columns, violating rows)."""

    name: str
    struct: T.StructType
    required: tuple[str, ...]
    checks: tuple = ()
    key: tuple[str, ...] = ("code", "trade_date")
    partitions: dict[str, Callable[[], Column]] = field(default_factory=dict)
    required_values: tuple[str, ...] = ()

    def missing(self, df: DataFrame) -> list[str]:
        return [c for c in self.required if c not in df.columns]

    def validate(self, df: DataFrame) -> DataFrame:
        """(issue, violated): one job for all checks. A missing required column is
        the only issue then, and needs no job."""
        if missing := self.missing(df):
            return df.sparkSession.createDataFrame([(f"missing:{c}", True) for c in missing], "issue string, violated boolean")
        flags = [F.coalesce(F.max(F.coalesce(test(), F.lit(False))), F.lit(False)).alias(label) for label, columns, test in self.checks if set(columns) <= set(df.columns)]
        if not flags:
            return df.sparkSession.createDataFrame([], "issue string, violated boolean")
        wide = df.agg(*flags)
        pairs = [F.struct(F.lit(c).alias("issue"), F.col(c).alias("violated")) for c in wide.columns]
        return wide.select(F.inline(F.array(*pairs)))

    def invalid(self, df: DataFrame) -> Column:
        out = F.lit(False)
        for _, columns, test in self.checks:
            if set(columns) <= set(df.columns):
                out = out | F.coalesce(test(), F.lit(False))
        return out

    def drop_invalid(self, df: DataFrame) -> DataFrame:
        """Rows that violate no check; none where a required column is missing."""
        return df.filter(F.lit(False)) if self.missing(df) else df.filter(~self.invalid(df))

    def with_partitions(self, df: DataFrame) -> DataFrame:
        """Partition columns of each row."""
        return df.withColumns({k: f() for k, f in self.partitions.items()})

    def conform(self, df: DataFrame) -> DataFrame:
        """Declared columns cast to their types, NaN and infinities as nulls."""
        out = {}
        for f in self.struct:
            if f.name in df.columns:
                c = F.col(f.name).try_cast(f.dataType)
                out[f.name] = number(c) if isinstance(f.dataType, T.DoubleType) else c
        return df.withColumns(out)


def _const(value: str) -> Callable[[], Column]:
    return lambda: F.lit(value)


def _same(column: str) -> Callable[[], Column]:
    return lambda: F.col(column)


def _year(column: str) -> Callable[[], Column]:
    return lambda: F.date_format(column, "yyyy")


def _month(column: str) -> Callable[[], Column]:
    return lambda: F.date_format(column, "MM")


_DAY = {"year": _year("trade_date"), "month": _month("trade_date")}
_BAR = ("code", "trade_date", "open", "high", "low", "close")

TABLES: dict[str, TableSpec] = {
    t.name: t
    for t in (
        TableSpec(
            "daily",
            _struct("asset_type:str code:str trade_date:date open:float high:float low:float close:float volume:int amount:float turnover:float adj_factor:float is_st:bool is_suspended:bool"),
            (*_BAR, "volume", "amount"),
            (HIGH_LOW, NEGATIVE_PRICE, NEGATIVE_VOLUME),
            partitions={"asset_type": lambda: F.col("asset_type"), **_DAY},
        ),
        TableSpec(
            "minute",
            _struct("asset_type:str code:str trade_time:time frequency:str open:float high:float low:float close:float volume:int amount:float"),
            ("code", "trade_time", "open", "high", "low", "close", "volume", "amount"),
            (HIGH_LOW, NEGATIVE_PRICE),
            ("code", "trade_time", "frequency"),
            {"asset_type": _same("asset_type"), "frequency": _same("frequency"), "year": _year("trade_time"), "month": _month("trade_time")},
        ),
        TableSpec(
            "finance",
            _struct("code:str report_period:str report_type:str pub_date:date total_assets:float total_liabilities:float shareholders_equity:float revenue:float net_profit:float eps:float bps:float roe:float pe_ttm:float pb:float"),
            ("code", "report_period", "report_type", "pub_date"),
            (_below(("total_assets",), "negative_total_assets"), _below(("revenue",), "negative_revenue"), _check("bad_report_period", ("report_period",), lambda: ~F.col("report_period").rlike(r"^\d{4}Q[1-4]$"))),
            ("code", "report_period"),
            {"asset_type": _const("stock"), "report_period": _same("report_period")},
        ),
        TableSpec("north_flow", _struct("code:str trade_date:date buy_amount:float sell_amount:float net_flow:float"), ("code", "trade_date", "buy_amount", "sell_amount", "net_flow"), partitions=_DAY),
        TableSpec(
            "margin_trade",
            _struct("code:str trade_date:date margin_buy:float margin_balance:float short_sell:float short_balance:float"),
            ("code", "trade_date", "margin_buy", "margin_balance", "short_sell", "short_balance"),
            partitions=_DAY,
        ),
        TableSpec("alternative", _struct("sub_type:str code:str trade_date:date data:str"), ("sub_type", "code", "trade_date", "data"), key=("sub_type", "code", "trade_date"), partitions={"sub_type": _same("sub_type"), **_DAY}),
        TableSpec("reference", _struct("code:str name:str industry:str list_date:date delist_date:date"), ("code", "name"), key=("code",), partitions={"asset_type": _const("reference")}),
        TableSpec(
            "convertible_bond",
            _struct("code:str bond_code:str stock_code:str trade_date:date open:float high:float low:float close:float volume:int amount:float conversion_price:float conversion_ratio:float conversion_value:float premium_rate:float maturity_date:date coupon_rate:float"),
            (*_BAR, "volume", "amount", "conversion_price"),
            (HIGH_LOW, NEGATIVE_PRICE, NEGATIVE_VOLUME, _not_positive("conversion_price"), _outside("premium_rate", -50, 500)),
            partitions={"asset_type": _const("cb"), **_DAY},
        ),
        TableSpec(
            "futures",
            _struct("code:str underlying:str exchange:str trade_date:date open:float high:float low:float close:float settle:float volume:int open_interest:int margin_rate:float contract_multiplier:float delivery_month:str expiry_date:date"),
            (*_BAR, "settle", "volume", "open_interest", "exchange"),
            (HIGH_LOW, _below((*_PRICES, "settle"), "negative_price"), NEGATIVE_VOLUME, _below(("open_interest",), "negative_open_interest"), _outside("margin_rate", 0, 100), _not_positive("contract_multiplier")),
            partitions={"asset_type": _const("future"), "exchange": _same("exchange"), **_DAY},
        ),
        TableSpec(
            "options",
            _struct("code:str underlying:str option_type:str strike_price:float expiry_date:date trade_date:date open:float high:float low:float close:float volume:int open_interest:int implied_volatility:float delta:float gamma:float theta:float vega:float"),
            (*_BAR, "volume", "open_interest", "strike_price", "option_type"),
            (
                HIGH_LOW,
                NEGATIVE_PRICE,
                NEGATIVE_VOLUME,
                _not_positive("strike_price"),
                _check("bad_option_type", ("option_type",), lambda: ~F.col("option_type").isin("call", "put")),
                _outside("implied_volatility", 0, 500),
                _outside("delta", -1, 1),
            ),
            partitions={"asset_type": _const("option"), "underlying": _same("underlying"), "option_type": _same("option_type"), **_DAY},
        ),
    )
}
#: The sub-types that an alternative table can hold.
ALTERNATIVE = {"north_flow": TABLES["north_flow"], "margin_trade": TABLES["margin_trade"]}
