"""Vendor frames to declared tables: column names, dates, codes, constants. Each
mapping is a lazy transformation of whatever columns there are."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions import scalars
from tidemill.operators.tables import TABLES

# The vendors' column names.
CHINESE_DAILY = {
    "日期": "trade_date",
    "开盘": "open",
    "收盘": "close",
    "最高": "high",
    "最低": "low",
    "成交量": "volume",
    "成交额": "amount",
    "振幅": "amplitude",
    "涨跌幅": "pct_change",
    "涨跌额": "change",
    "换手率": "turnover",
}
#: Names of index frames, which come in English.
ENGLISH_DAILY = {"date": "trade_date"}
CHINESE_MINUTE = {"时间": "trade_time", "开盘": "open", "收盘": "close", "最高": "high", "最低": "low", "成交量": "volume", "成交额": "amount"}
CHINESE_FINANCE = {"报告期": "period_end", "净利润": "net_profit", "营业总收入": "revenue", "基本每股收益": "eps", "每股净资产": "bps", "净资产收益率": "roe"}
#: Units of the amounts that statements hold as text.
CHINESE_UNITS = {"亿": 1e8, "万": 1e4}
CHINESE_NAMED = {"股票代码": "code", "股票名称": "name"}
CHINESE_BONDS = {
    "债券代码": "code",
    "债券简称": "name",
    "正股代码": "stock_code",
    "正股简称": "stock_name",
    "转股价": "conversion_price",
    "转股比例": "conversion_ratio",
    "转股价值": "conversion_value",
    "溢价率": "premium_rate",
    "到期日": "maturity_date",
    "票面利率": "coupon_rate",
    "最新价": "close",
    "涨跌幅": "pct_change",
    "成交量": "volume",
    "成交额": "amount",
}


@dataclass(frozen=True)
class Vendor:
    """How one vendor's frames become rows of ``table``."""

    name: str
    table: str
    asset_types: tuple[str, ...]
    rename: dict[str, str] = field(default_factory=dict)
    dates: dict[str, Callable[[str], Column]] = field(default_factory=dict)
    code: Callable[[Column], Column] | None = None
    constants: dict[str, str] = field(default_factory=dict)
    derive: Callable[[DataFrame], DataFrame] | None = None
    code_from: str = "code"
    module: str | None = None

    def supports(self, asset_type: str, table: str) -> bool:
        return asset_type in self.asset_types and table == self.table

    def map(self, df: DataFrame) -> DataFrame:
        df = df.withColumnsRenamed(self.rename)
        df = df.withColumns({c: f(c) for c, f in self.dates.items() if c in df.columns})
        if self.code and self.code_from in df.columns:
            df = df.withColumn("code", self.code(F.col(self.code_from)))
        df = df.withColumns({k: F.lit(v) for k, v in self.constants.items()})
        if self.derive:
            df = self.derive(df)
        return TABLES[self.table].conform(df)


_ISO = {"trade_date": scalars.iso_date}
_COMPACT = {"trade_date": scalars.compact_date}
_STOCK = {"asset_type": "stock"}


def _contract(df: DataFrame) -> DataFrame:
    parsed = scalars.parse_futures_code("code")
    df = df.withColumns({k: parsed[k] for k in ("underlying", "delivery_month", "expiry_date")})
    return df.withColumn("exchange", scalars.futures_exchange(F.upper("underlying")))


def _option(df: DataFrame) -> DataFrame:
    if "option_type" in df.columns:
        df = df.withColumn("option_type", scalars.option_type("option_type"))
    return df


def _snapshot(df: DataFrame) -> DataFrame:
    return df if "trade_date" in df.columns else df.withColumn("trade_date", F.current_date())


VENDORS: dict[str, Vendor] = {
    v.name: v
    for v in (
        Vendor("akshare", "daily", ("stock", "index", "etf"), {**CHINESE_DAILY, **ENGLISH_DAILY}, _ISO, scalars.unify_code, _STOCK, module="akshare"),
        Vendor("baostock", "daily", ("stock", "index"), {"date": "trade_date", "code": "raw_code", "turn": "turnover", "pctChg": "pct_change"}, _ISO, scalars.from_prefixed, _STOCK, code_from="raw_code", module="baostock"),
        Vendor("tushare", "daily", ("stock", "index"), {"ts_code": "raw_code", "vol": "volume", "pct_chg": "pct_change"}, _COMPACT, lambda c: c, _STOCK, code_from="raw_code", module="tushare"),
        Vendor("efinance", "daily", ("stock", "fund", "futures"), {**CHINESE_NAMED, **CHINESE_DAILY}, _ISO, lambda c: scalars.unify_code(c, "SZ"), _STOCK, module="efinance"),
        Vendor("mootdx", "daily", ("stock", "index"), {}, _ISO, lambda c: scalars.unify_code(c, "SZ"), _STOCK, module="mootdx"),
        Vendor("jqdata", "daily", ("stock", "index"), {"money": "amount"}, _ISO, scalars.from_vendor_suffix, _STOCK, module="jqdatasdk"),
        Vendor("akshare_cb", "convertible_bond", ("cb",), CHINESE_BONDS, {"maturity_date": scalars.lenient_date, **_ISO}, scalars.bond_code, {"asset_type": "cb"}, _snapshot, module="akshare"),
        Vendor("akshare_futures", "futures", ("future",), {"date": "trade_date", "hold": "open_interest"}, _ISO, None, {"asset_type": "future"}, _contract, module="akshare"),
        Vendor("akshare_options", "options", ("option",), {"date": "trade_date", "hold": "open_interest", "type": "option_type"}, _ISO, None, {"asset_type": "option"}, _option, module="akshare"),
        Vendor("tushare_futures", "futures", ("future",), {"ts_code": "raw_code", "vol": "volume", "oi": "open_interest"}, _COMPACT, scalars.strip_suffix, {"asset_type": "future"}, code_from="raw_code", module="tushare"),
        Vendor("tushare_options", "options", ("option",), {"ts_code": "raw_code", "vol": "volume", "oi": "open_interest"}, _COMPACT, scalars.strip_suffix, {"asset_type": "option"}, code_from="raw_code", module="tushare"),
    )
}


def amount(c: Column) -> Column:
    """A number, or text such as ``1.23亿`` or ``4.5%`` (its number), else null."""
    text = F.trim(c.cast("string"))
    number = F.regexp_extract(text, r"^(-?[0-9.]+)", 1).try_cast("double")
    return number * scalars.lookup(CHINESE_UNITS, F.substring(text, -1, 1), F.lit(1.0))


def _statement(df: DataFrame) -> DataFrame:
    """report_period (``2024Q3``) from the period's last day; report_type, where the
    vendor has none, from the quarter."""
    if "period_end" in df.columns:
        day = F.coalesce(F.try_to_timestamp("period_end", F.lit("yyyyMMdd")).cast("date"), scalars.lenient_date("period_end"))
        df = df.withColumn("report_period", F.when(day.isNotNull(), F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))))
    if "report_type" not in df.columns:
        quarter = F.substring("report_period", -1, 1)
        df = df.withColumn("report_type", F.when(quarter == "4", "annual").when(quarter == "2", "semiannual").otherwise("quarterly"))
    if "pub_date" not in df.columns:
        df = df.withColumn("pub_date", F.lit(None).cast("date"))
    texts = [c for c, kind in df.dtypes if kind == "string" and c in CHINESE_FINANCE.values() and c != "period_end"]
    return df.withColumns({c: amount(F.col(c)) for c in texts})


def _bar_time(df: DataFrame) -> DataFrame:
    return df.withColumn("trade_time", F.col("trade_time").cast("timestamp")) if "trade_time" in df.columns else df


#: Statements of these vendors are finance rows.
FINANCE = {
    v.name: v
    for v in (
        Vendor("akshare", "finance", ("stock",), CHINESE_FINANCE, {}, scalars.unify_code, derive=_statement, module="akshare"),
        Vendor("tushare", "finance", ("stock",), {"ts_code": "raw_code", "end_date": "period_end", "ann_date": "pub_date"}, {"pub_date": scalars.compact_date}, lambda c: c, derive=_statement, code_from="raw_code", module="tushare"),
        Vendor("jqdata", "finance", ("stock",), {"statDate": "period_end", "pubDate": "pub_date"}, {"pub_date": scalars.lenient_date}, scalars.from_vendor_suffix, derive=_statement, module="jqdatasdk"),
    )
}
#: Bars within a day; the request says their frequency.
MINUTE = {
    v.name: v
    for v in (
        Vendor("akshare", "minute", ("stock", "etf"), CHINESE_MINUTE, {}, scalars.unify_code, _STOCK, _bar_time, module="akshare"),
        Vendor("efinance", "minute", ("stock", "fund", "futures"), {**CHINESE_NAMED, **CHINESE_MINUTE, "日期": "trade_time"}, {}, lambda c: scalars.unify_code(c, "SZ"), _STOCK, _bar_time, module="efinance"),
        Vendor("baostock", "minute", ("stock",), {"code": "raw_code", "time": "trade_time"}, {"trade_time": lambda c: F.try_to_timestamp(F.substring(c, 1, 14), F.lit("yyyyMMddHHmmss"))}, scalars.from_prefixed, _STOCK, code_from="raw_code", module="baostock"),
        Vendor("mootdx", "minute", ("stock", "index"), {"datetime": "trade_time"}, {}, lambda c: scalars.unify_code(c, "SZ"), _STOCK, _bar_time, module="mootdx"),
        Vendor("jqdata", "minute", ("stock", "index"), {"money": "amount", "time": "trade_time"}, {}, scalars.from_vendor_suffix, _STOCK, _bar_time, module="jqdatasdk"),
    )
}


def vendor(name: str, table: str) -> Vendor | None:
    """The mapping of a vendor's frames to rows of ``table``."""
    return next((v[name] for v in (VENDORS, FINANCE, MINUTE) if name in v and v[name].table == table), None)


INSTRUMENT_TYPES = {"1": "Stock", "2": "Index", "3": "ETF", "4": "Bond"}
INSTRUMENT_STATUS = {"1": "Listed", "0": "Delisted"}


def search(instruments: DataFrame, keyword: str, limit: int = 20) -> DataFrame:
    """(code, name, type, status) of instruments whose name or code matches the
    regular expression ``keyword``, in any case."""
    pattern = "(?i)" + keyword
    code = scalars.from_prefixed("code")
    hits = instruments.filter(F.coalesce(F.col("code_name").rlike(pattern), F.lit(False)) | F.coalesce(code.rlike(pattern), F.lit(False)))
    kind, status = F.col("type").cast("string"), F.col("status").cast("string")
    return (
        hits.select(code.alias("code"), F.col("code_name").alias("name"), scalars.lookup(INSTRUMENT_TYPES, kind, kind).alias("type"), scalars.lookup(INSTRUMENT_STATUS, status, status).alias("status"))
        .orderBy("code", "name")
        .limit(limit)
    )
