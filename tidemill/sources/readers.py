"""Readers of vendors' clients: one call for each code, on executors.

A call names the client's module, how it is asked for one code, and the columns that
it answers with. Codes are the partitions of a Spark data source, so that a code
that fails is asked for again alone. Each call waits ``interval`` seconds before it
asks, and a rate limit waits longer each time; another failure is raised, and the
next vendor has its turn. The client's module is imported where the call is made."""

from __future__ import annotations

import importlib
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tidemill.sources.datasource import register
from tidemill.sources.fetch import FetchSpec, RateLimited, SourceUnavailable

#: Words by which clients say that they were asked too often.
LIMITED = ("rate", "limit", "exceed", "frequent")


# Exchanges as one vendor names them.
VENDOR_SUFFIXES = {"SZ": "XSHE", "SH": "XSHG", "BJ": "XBJ"}


@dataclass(frozen=True)
class Call:
    """``ask(module, code, start, end, frequency)`` gives a pandas frame, whose
    ``columns`` are read (texts, unless a type is given as ``name:type``)."""

    module: str
    ask: Callable
    columns: tuple[str, ...]
    code_form: Callable[[str], str] = str
    interval: float = 0.3

    def schema(self) -> str:
        return ", ".join(f"`{c.split(':')[0]}` {c.split(':')[1] if ':' in c else 'string'}" for c in ("code", *self.columns))


def digits(code: str) -> str:
    return code.split(".")[0]


def prefixed(code: str) -> str:
    """000001.SZ as sz.000001."""
    head, _, tail = code.partition(".")
    return f"{tail.lower()}.{head}" if tail else code


def suffixed(code: str) -> str:
    """000001.SZ as 000001.XSHE."""
    head, _, tail = code.partition(".")
    return f"{head}.{VENDOR_SUFFIXES.get(tail, tail)}" if tail else code


def _compact(day: date | None) -> str:
    return f"{day:%Y%m%d}" if day else ""


def _iso(day: date | None) -> str:
    return day.isoformat() if day else ""


def _rows_of(result):
    """A result set with ``next`` and ``get_row_data`` as a pandas frame."""
    import pandas as pd

    if result.error_code != "0":
        raise SourceUnavailable(result.error_msg)
    rows = []
    while result.next():
        rows.append(result.get_row_data())
    return pd.DataFrame(rows, columns=result.fields)


_BARS = ("日期", "开盘:double", "收盘:double", "最高:double", "最低:double", "成交量:bigint", "成交额:double")
_ENGLISH = ("open:double", "high:double", "low:double", "close:double")
_ADJUSTED = "open,high,low,close,volume,amount,turn,pctChg"

#: By (vendor, table, asset type).
CALLS: dict[tuple[str, str, str], Call] = {
    ("akshare", "daily", "stock"): Call("akshare", lambda m, c, s, e, f: m.stock_zh_a_hist(symbol=c, period="daily", start_date=_compact(s), end_date=_compact(e), adjust=""), _BARS, digits),
    ("akshare", "daily", "index"): Call("akshare", lambda m, c, s, e, f: m.stock_zh_index_daily_em(symbol=c, start_date=_compact(s), end_date=_compact(e)), ("date", *_ENGLISH, "volume:bigint", "amount:double"), lambda c: prefixed(c).replace(".", "")),
    ("akshare", "daily", "etf"): Call("akshare", lambda m, c, s, e, f: m.fund_etf_hist_em(symbol=c, period="daily", start_date=_compact(s), end_date=_compact(e)), _BARS, digits),
    ("akshare", "finance", "stock"): Call("akshare", lambda m, c, s, e, f: m.stock_financial_abstract_ths(symbol=c), ("报告期", "净利润", "营业总收入", "基本每股收益", "每股净资产", "净资产收益率"), digits),
    ("akshare", "minute", "stock"): Call("akshare", lambda m, c, s, e, f: m.stock_zh_a_hist_min_em(symbol=c, start_date=_iso(s), end_date=_iso(e), period=f.removesuffix("min")), ("时间", *_BARS[1:]), digits),
    ("baostock", "daily", "stock"): Call("baostock", lambda m, c, s, e, f: _rows_of(m.query_history_k_data_plus(c, f"date,code,{_ADJUSTED}", start_date=_iso(s), end_date=_iso(e), frequency="d", adjustflag="3")), ("date", *_ADJUSTED.split(",")), prefixed),
    ("baostock", "daily", "index"): Call("baostock", lambda m, c, s, e, f: _rows_of(m.query_history_k_data_plus(c, "date,code,open,high,low,close,volume,amount", start_date=_iso(s), end_date=_iso(e), frequency="d")), ("date", "open", "high", "low", "close", "volume", "amount"), prefixed),
    ("tushare", "daily", "stock"): Call("tushare", lambda m, c, s, e, f: m.pro_api().daily(ts_code=c, start_date=_compact(s), end_date=_compact(e)), ("ts_code", "trade_date", *_ENGLISH, "vol:double", "amount:double", "pct_chg:double")),
    ("tushare", "daily", "index"): Call("tushare", lambda m, c, s, e, f: m.pro_api().index_daily(ts_code=c, start_date=_compact(s), end_date=_compact(e)), ("ts_code", "trade_date", *_ENGLISH, "vol:double", "amount:double", "pct_chg:double")),
    ("tushare", "finance", "stock"): Call("tushare", lambda m, c, s, e, f: m.pro_api().fina_indicator(ts_code=c), ("ts_code", "ann_date", "end_date", "eps:double", "bps:double", "roe:double")),
    ("jqdata", "daily", "stock"): Call("jqdatasdk", lambda m, c, s, e, f: m.get_price(c, start_date=s, end_date=e, frequency="daily").rename_axis("trade_date").reset_index(), ("trade_date", *_ENGLISH, "volume:double", "money:double"), suffixed),
    ("akshare_futures", "futures", "future"): Call("akshare", lambda m, c, s, e, f: m.futures_zh_daily_sina(symbol=c), ("date", *_ENGLISH, "settle:double", "volume:bigint", "hold:bigint"), digits),
    ("akshare_options", "options", "option"): Call("akshare", lambda m, c, s, e, f: m.option_sse_daily(symbol=c), ("date", *_ENGLISH, "volume:bigint"), digits),
    ("tushare_futures", "futures", "future"): Call("tushare", lambda m, c, s, e, f: m.pro_api().fut_daily(ts_code=c, start_date=_compact(s), end_date=_compact(e)), ("ts_code", "trade_date", *_ENGLISH, "settle:double", "vol:double", "oi:double")),
    ("tushare_options", "options", "option"): Call("tushare", lambda m, c, s, e, f: m.pro_api().opt_daily(ts_code=c, start_date=_compact(s), end_date=_compact(e)), ("ts_code", "trade_date", *_ENGLISH, "settle:double", "vol:double", "oi:double")),
}


def _plain(value, kind: str):
    """A cell as Spark takes it; what no value stands for is null."""
    import pandas as pd

    if value is None or (pd.api.types.is_scalar(value) and pd.isna(value)):
        return None
    return {"double": float, "bigint": lambda v: int(float(v))}.get(kind, str)(value)


def ask(call: Call, code: str, start: date | None, end: date | None, frequency: str, attempts: int = 3, sleep: Callable[[float], None] = time.sleep) -> Iterator[tuple]:
    """The rows of one code: ``code`` and the columns, null where the answer lacks one."""
    module = importlib.import_module(call.module)
    for k in range(attempts):
        sleep(call.interval * (1 if k == 0 else 10 * 2**k))
        try:
            frame = call.ask(module, call.code_form(code), start, end, frequency)
            break
        except Exception as e:
            if not any(word in str(e).lower() for word in LIMITED):
                raise SourceUnavailable(f"{call.module}: {e}") from e
            if k == attempts - 1:
                raise RateLimited(f"{call.module}: {e}") from e
    if frame is None:
        return
    kinds = [(c.split(":")[0], c.split(":")[1] if ":" in c else "string") for c in call.columns]
    for row in frame.to_dict("records"):
        yield (call.code_form(code) if call.code_form is not digits else code, *(_plain(row.get(c), kind) for c, kind in kinds))


def reader(vendor: str, table: str, asset_type: str, call: Call | None = None) -> Callable[[SparkSession, FetchSpec], DataFrame]:
    """A reader for :class:`tidemill.sources.fetch.Source`."""
    call = call or CALLS[vendor, table, asset_type]

    def read(spark: SparkSession, spec: FetchSpec) -> DataFrame:
        name = f"{vendor}_{table}_{asset_type}"
        start, end, frequency = spec.start, spec.end, spec.frequency
        register(spark, name, call.schema(), lambda code, options: ask(call, code, start, end, frequency))
        # Codes become partitions, which the driver lists.
        codes = [r.code for r in spec.among.select("code").distinct().toLocalIterator()] if spec.among is not None else list(spec.codes)
        return spark.read.format(name).option("codes", ",".join(codes)).load()

    return read
