"""Codes, contracts, dates and series functions."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemill.functions import scalars, series


def one(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_unify_code(spark):
    codes = ["000001", "600000", "830001", "000001.SZ", "300750", "430001", "900001", None]
    got = one(spark, [(c,) for c in codes], "c string", scalars.unify_code("c"), scalars.unify_code("c", "sz"))
    assert [g[0] for g in got] == ["000001.SZ", "600000.SH", "830001.BJ", "000001.SZ", "300750.SZ", "430001.BJ", "900001.SH", None]
    assert got[6][1] == "900001.SZ"


def test_prefixed_and_vendor_codes(spark):
    got = one(spark, [("sh.600000",), ("600000.SH",), ("plain",)], "c string", scalars.from_prefixed("c"), scalars.to_prefixed("c"))
    assert got == [("600000.SH", "sh.600000"), ("600000.SH", "sh.600000"), ("plain", "plain")]
    got = one(spark, [("000001.XSHE",), ("600000.XSHG",), ("000001",)], "c string", scalars.from_vendor_suffix("c"), scalars.to_vendor_suffix(scalars.from_vendor_suffix("c")))
    assert got == [("000001.SZ", "000001.XSHE"), ("600000.SH", "600000.XSHG"), ("000001.SZ", "000001.XSHE")]


def test_futures_code(spark):
    p = scalars.parse_futures_code("c")
    got = one(spark, [("IF2501",), ("cu2512",), ("x",), ("IF2513",)], "c string", p["underlying"], p["delivery_month"], p["expiry_date"])
    assert got == [("IF", "202501", dt.date(2025, 1, 17)), ("cu", "202512", dt.date(2025, 12, 19)), ("x", "", None), ("IF", "202513", None)]


def test_option_code(spark):
    p = scalars.parse_option_code("c", 2025)
    got = one(spark, [("50ETF购3月2800",), ("50ETF沽3月280",), ("x",), ("IOPUT4000",)], "c string", p["option_type"], p["strike_price"], p["expiry_date"])
    assert got == [("call", 2.8, dt.date(2025, 3, 28)), ("put", 280.0, dt.date(2025, 3, 28)), ("call", 0.0, None), ("put", 4.0, None)]


def test_exchange_tables(spark):
    got = one(spark, [("CU", "cu2501", "10005867"), ("QQ", "zz9", "90003688"), ("IF", "IF2501.CFE", "1.X")], "u string, c string, o string", scalars.futures_exchange("u"), scalars.futures_suffix("c"), scalars.option_suffix("o"))
    assert got == [("SHFE", "cu2501.SHF", "10005867.SSE"), ("UNKNOWN", "zz9.SHF", "90003688.SZSE"), ("CFFEX", "IF2501.CFE", "1.X")]
    assert sum(map(len, scalars.FUTURES_EXCHANGES.values())) == 51


def test_dates_and_division(spark):
    got = one(spark, [("2025-01-02", "20250102", "junk")], "a string, b string, c string", scalars.iso_date("a"), scalars.compact_date("b"), scalars.lenient_date("c"))
    assert got == [(dt.date(2025, 1, 2), dt.date(2025, 1, 2), None)]
    assert one(spark, [(1.0, 0.0), (1.0, 4.0)], "a double, b double", scalars.div("a", "b")) == [(None,), (0.25,)]
    assert one(spark, [(math.nan,), (math.inf,), (2.0,)], "a double", scalars.number("a")) == [(None,), (None,), (2.0,)]


@pytest.mark.parametrize("alpha", [2 / 13, 1 / 3])
def test_ewm_is_the_recurrence_of_pandas(alpha):
    x = pd.Series([np.nan, 4, np.nan, 8, 8, 1, np.nan, np.nan, 3])
    np.testing.assert_allclose(series.ewm(x.to_numpy(), alpha), x.ewm(alpha=alpha, adjust=False).mean().to_numpy())


def test_series_functions_equal_pandas(spark):
    rng = np.random.default_rng(1)
    frames = []
    for code in "ab":
        x = pd.Series(rng.normal(10, 1, 60))
        x[[3, 10, 11]] = np.nan
        frames.append(pd.DataFrame({"code": code, "t": range(60), "x": x}))
    pdf = pd.concat(frames, ignore_index=True)
    df = spark.createDataFrame(pdf).withColumn("x", scalars.number("x"))
    w = series.by("code", "t")
    got = df.select("code", "t", series.pct_change("x", w).alias("p"), series.roll(F.stddev_samp, "x", 5, w).alias("s"), series.rank_pct("x", ["code"]).alias("r"), series.momentum("x", 3, w).alias("m")).toPandas().sort_values(["code", "t"]).reset_index(drop=True)
    g = pdf.groupby("code")["x"]
    np.testing.assert_allclose(got["p"], g.transform(lambda s: s.ffill().pct_change(fill_method=None)))
    np.testing.assert_allclose(got["s"], g.transform(lambda s: s.rolling(5).std()), rtol=1e-9)
    np.testing.assert_allclose(got["r"], g.rank(pct=True))
    np.testing.assert_allclose(got["m"], g.transform(lambda s: s / s.shift(3) - 1))


def test_windows_share_one_exchange(spark, data):
    from tidemill.operators import factors
    from tidemill.plans import views

    df = factors.calculate(views.bars(spark, data), ["momentum_5d", "momentum_20d", "volatility_20d", "rsi", "bollinger", "amihud"])
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # One for the bars' aggregate, one for all windows.
    assert plan.count("Exchange hashpartitioning") == 2
