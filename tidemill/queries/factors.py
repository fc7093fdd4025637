"""Factors, normalisers and factor analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions import series
from tidemill.operators import analysis, factors
from tidemill.plans import views
from tidemill.plans.views import with_views
from tidemill.queries.registry import query, r6, rounded

W = "PARTITION BY code ORDER BY trade_date"


def roll(f: str, x: str, n: int, w: str = W) -> str:
    frame = f"OVER ({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({x}) {frame} = {n} THEN {f}({x}) {frame} END"


def mom(n: int) -> str:
    return f"round(close / nullif(lag(close, {n}) OVER ({W}), 0) - 1, 6)"


_STEP = f""", steps AS (
  SELECT *, lag(close) OVER ({W}) AS c1 FROM bars),
moves AS (
  SELECT *, close / nullif(c1, 0) - 1 AS ret, CASE WHEN close / nullif(c1, 0) > 0 THEN ln(close / c1) END AS lr,
    CASE WHEN close - c1 > 0 THEN close - c1 ELSE 0 END AS gain, CASE WHEN close - c1 < 0 THEN c1 - close ELSE 0 END AS loss,
    greatest(high - low, abs(high - c1), abs(low - c1)) AS tr FROM steps),
means AS (SELECT *, abs(ret) / nullif(amount, 0) AS illiq, {roll('avg', 'gain', 14)} AS g, {roll('avg', 'loss', 14)} AS l, {roll('avg', 'close', 20)} AS m, {roll('stddev_samp', 'close', 20)} AS s FROM moves)
"""
_RSI = "round(CASE WHEN l = 0 THEN CASE WHEN g > 0 THEN 100.0::DOUBLE END ELSE 100.0::DOUBLE - 100.0::DOUBLE / (1 + g / nullif(l, 0)) END, 6)"
_VOL = f"round(({roll('stddev_samp', 'ret', 20)}) * sqrt(252), 6)"


@query("factors_flagship", with_views("bars", _STEP + f"SELECT code, trade_date, {mom(20)} AS momentum_20d, {_VOL} AS volatility_20d, {_RSI} AS rsi_14 FROM means"))
def flagship(spark, d):
    return rounded(factors.calculate(views.bars(spark, d), ["momentum_20d", "volatility_20d", "rsi"]), [])


@query(
    "f_technical",
    with_views(
        "bars",
        _STEP
        + f"""SELECT code, trade_date, {mom(5)} AS momentum_5d, {mom(60)} AS momentum_60d, {mom(10)} AS momentum_10d, round({roll('avg', 'tr', 14)}, 6) AS atr_14,
  round(({roll('stddev_samp', 'lr', 20)}) * sqrt(252), 6) AS realized_vol_20d, round(volume / nullif(1000.0::DOUBLE + CAST(code AS BIGINT), 0), 6) AS turnover_rate,
  round(1e6::DOUBLE * ({roll('avg', 'illiq', 20)}), 6) AS amihud_20d, round(volume / nullif({roll('avg', 'volume', 20)}, 0), 6) AS volume_momentum_20d,
  round(m + s * 2, 6) AS bollinger_upper, round(m, 6) AS bollinger_middle, round(m - s * 2, 6) AS bollinger_lower,
  round((close - (m - s * 2)) / nullif((m + s * 2) - (m - s * 2), 0), 6) AS bollinger_position FROM means""",
    ),
)
def technical(spark, d):
    b = views.bars(spark, d).withColumn("float_shares", 1000.0 + views.code_number())
    names = ["momentum_5d", "momentum_60d", ("momentum", {"window": 10}), "atr", "realized_vol", ("turnover_rate", {"source": "volume"}), "amihud", "volume_momentum", "bollinger"]
    out = factors.calculate(b, names)
    return rounded(out.withColumn("amihud_20d", F.col("amihud_20d") * 1e6), [])


def _recursive(extra: str, select: str) -> str:
    return with_views("bars", extra + select, recursive=True)


@query(
    "f_macd",
    _recursive(
        f""", n AS (SELECT *, row_number() OVER ({W}) AS rn FROM bars),
e AS (
  SELECT code, trade_date, rn, close AS f, close AS s, 0.0::DOUBLE AS dea FROM n WHERE rn = 1
  UNION ALL
  SELECT code, trade_date, rn, f, s, (1 - 0.2::DOUBLE) * dea + 0.2::DOUBLE * (f - s) FROM (
    SELECT n.code, n.trade_date, n.rn, (1 - 2.0::DOUBLE / 13) * e.f + (2.0::DOUBLE / 13) * n.close AS f, (1 - 2.0::DOUBLE / 27) * e.s + (2.0::DOUBLE / 27) * n.close AS s, e.dea
    FROM e JOIN n ON n.code = e.code AND n.rn = e.rn + 1))
""",
        "SELECT code, trade_date, round(f - s, 6) AS macd_dif, round(dea, 6) AS macd_dea, round(2 * (f - s - dea), 6) AS macd_hist FROM e",
    ),
)
def macd(spark, d):
    return rounded(factors.calculate(views.bars(spark, d).select("code", "trade_date", "close"), ["macd"]), [])


@query(
    "f_kdj",
    _recursive(
        f""", v AS (SELECT code, trade_date, close, {roll('min', 'low', 9)} AS lo, {roll('max', 'high', 9)} AS hi FROM bars),
v2 AS (SELECT code, trade_date, 100 * (close - lo) / nullif(hi - lo, 0) AS rsv FROM v),
v3 AS (SELECT *, row_number() OVER ({W}) AS rn FROM v2 WHERE rsv IS NOT NULL),
e AS (
  SELECT code, trade_date, rn, rsv AS k, rsv AS d FROM v3 WHERE rn = 1
  UNION ALL
  SELECT code, trade_date, rn, k, (2.0::DOUBLE / 3) * d + k / 3 FROM (
    SELECT v3.code, v3.trade_date, v3.rn, (2.0::DOUBLE / 3) * e.k + v3.rsv / 3 AS k, e.d FROM e JOIN v3 ON v3.code = e.code AND v3.rn = e.rn + 1))
""",
        "SELECT v.code, v.trade_date, round(k, 6) AS kdj_k, round(d, 6) AS kdj_d, round(3 * k - 2 * d, 6) AS kdj_j FROM v LEFT JOIN e ON v.code = e.code AND v.trade_date = e.trade_date",
    ),
)
def kdj(spark, d):
    return rounded(factors.calculate(views.bars(spark, d).select("code", "trade_date", "high", "low", "close"), ["kdj"]), [])


_FUND = ["pe", "pb", "ps", "dividend_yield", "earnings_yield", "roe", "gross_margin", "debt_to_equity", "current_ratio", "asset_turnover"]
_GROW = {"revenue_growth": "revenue", "net_profit_growth": "net_profit", "eps_growth": "eps", "book_value_growth": "shareholders_equity", "operating_cash_flow_growth": "operating_cash_flow"}
_FW = "(PARTITION BY code ORDER BY report_period)"


@query(
    "f_fundamental",
    with_views(
        "finance",
        "SELECT code, report_period, "
        + ", ".join(
            f"round({a} / nullif({b}, 0), 6) AS {n}"
            for n, a, b in (
                ("pe", "close", "eps"),
                ("pb", "close", "bps"),
                ("ps", "market_cap", "revenue"),
                ("dividend_yield", "dividend", "close"),
                ("earnings_yield", "eps", "close"),
                ("roe", "net_profit", "shareholders_equity"),
                ("gross_margin", "(revenue - cost_of_goods_sold)", "revenue"),
                ("debt_to_equity", "total_liabilities", "shareholders_equity"),
                ("current_ratio", "current_assets", "current_liabilities"),
                ("asset_turnover", "revenue", "total_assets"),
                *((n, f"({x} - lag({x}) OVER {_FW})", f"lag({x}) OVER {_FW}") for n, x in _GROW.items()),
            )
        )
        + " FROM finance",
    ),
)
def fundamental(spark, d):
    return rounded(factors.calculate(views.finance(spark, d), [*_FUND, *_GROW], time="report_period"), [])


@query(
    "f_growth_year_on_year",
    with_views("finance", f"SELECT code, report_period, round((revenue - lag(revenue, 4) OVER {_FW}) / nullif(lag(revenue, 4) OVER {_FW}, 0), 6) AS revenue_growth FROM finance"),
)
def yearly_growth(spark, d):
    return rounded(factors.calculate(views.finance(spark, d), [("revenue_growth", {"periods": 4})], time="report_period"), [])


@query(
    "f_fund_flow",
    with_views(
        "flows",
        f"""SELECT code, trade_date, round(buy_amount - sell_amount, 2) AS north_flow_net,
  round((buy_amount - sell_amount) / nullif({roll('avg', '(buy_amount - sell_amount)', 5)}, 0), 4) AS north_flow_momentum_5d,
  round(margin_balance - lag(margin_balance) OVER ({W}), 2) AS margin_balance_change, round(margin_balance / nullif(short_balance, 0), 6) AS margin_ratio FROM flows""",
    ),
)
def fund_flow(spark, d):
    out = factors.calculate(views.flows(spark, d), ["north_flow_net", "north_flow_momentum", "margin_balance_change", "margin_ratio"])
    return out.select(
        "code", "trade_date", F.round("north_flow_net", 2).alias("north_flow_net"), F.round("north_flow_momentum_5d", 4).alias("north_flow_momentum_5d"), F.round("margin_balance_change", 2).alias("margin_balance_change"), r6("margin_ratio")
    )


_BREADTH = """CAST(coalesce(sum(CASE WHEN pct_change >= 10 THEN 1 ELSE 0 END), 0) AS BIGINT) AS limit_up_count,
  CAST(coalesce(sum(CASE WHEN pct_change <= -10 THEN 1 ELSE 0 END), 0) AS BIGINT) AS limit_down_count,
  CASE WHEN sum(CASE WHEN pct_change < 0 THEN 1 ELSE 0 END) > 0 THEN round(sum(CASE WHEN pct_change > 0 THEN 1 ELSE 0 END)::DOUBLE / nullif(sum(CASE WHEN pct_change < 0 THEN 1 ELSE 0 END), 0), 6)
       WHEN sum(CASE WHEN pct_change > 0 THEN 1 ELSE 0 END) > 0 THEN 'infinity'::DOUBLE ELSE 1.0::DOUBLE END AS advance_decline_ratio,
  round(sum(CASE WHEN pct_change > 0 THEN 1 ELSE 0 END)::DOUBLE / count(*), 6) AS market_breadth FROM changes"""


def _breadth(df):
    finite = F.col("advance_decline_ratio") < float("inf")
    return df.withColumns({"advance_decline_ratio": F.when(finite, F.round("advance_decline_ratio", 6)).otherwise(F.col("advance_decline_ratio")), "market_breadth": F.round("market_breadth", 6)})


@query("f_breadth", with_views("changes", f"SELECT trade_date, {_BREADTH} GROUP BY trade_date"))
def breadth(spark, d):
    return _breadth(factors.breadth(views.changes(spark, d)))


@query("f_breadth_whole", with_views("changes", f"SELECT {_BREADTH}"))
def breadth_whole(spark, d):
    return _breadth(factors.breadth(views.changes(spark, d), by=None))


@query(
    "f_volatility_index",
    with_views(
        "changes",
        f""", v AS (SELECT code, trade_date, ({roll('stddev_samp', 'pct_change', 20)}) * sqrt(252) AS vol FROM changes),
s AS (SELECT *, avg(vol) OVER (PARTITION BY code) AS m, stddev_samp(vol) OVER (PARTITION BY code) AS sd FROM v)
SELECT code, trade_date, round(CASE WHEN sd > 0 THEN (vol - m) / sd WHEN vol IS NOT NULL THEN 0 END, 6) AS volatility_index_20d FROM s""",
    ),
)
def volatility_index(spark, d):
    return rounded(factors.calculate(views.changes(spark, d), ["volatility_index"]), [])


# --- normalisers ------------------------------------------------------------------------

_B = "SELECT code, trade_date, close"


@query(
    "n_zscore",
    with_views("bars", ", s AS (SELECT avg(close) AS m, stddev_samp(close) AS sd FROM bars) " + _B + ", round(CASE WHEN sd > 0 THEN (close - m) / sd WHEN close IS NOT NULL THEN 0 END, 6) AS z FROM bars, s"),
)
def zscore(spark, d):
    return analysis.zscore(views.bars(spark, d).select("code", "trade_date", "close"), "close", "z").withColumn("z", F.round("z", 6))


@query(
    "n_zscore_by_day",
    with_views("bars", _B + ", round(CASE WHEN stddev_samp(close) OVER (PARTITION BY trade_date) > 0 THEN (close - avg(close) OVER (PARTITION BY trade_date)) / stddev_samp(close) OVER (PARTITION BY trade_date) WHEN close IS NOT NULL THEN 0 END, 5) AS z FROM bars"),
)
def zscore_by_day(spark, d):
    return analysis.zscore(views.bars(spark, d).select("code", "trade_date", "close"), "close", "z", ["trade_date"]).withColumn("z", F.round("z", 5))


@query("n_minmax", with_views("bars", ", s AS (SELECT min(close) AS lo, max(close) AS hi FROM bars) " + _B + ", round(CASE WHEN hi > lo THEN (close - lo) / (hi - lo) WHEN close IS NOT NULL THEN 0.5 END, 6) AS x FROM bars, s"))
def minmax(spark, d):
    return analysis.minmax(views.bars(spark, d).select("code", "trade_date", "close"), "close", "x").withColumn("x", F.round("x", 6))


_RANK = "round((rank() OVER ({p}ORDER BY close) + (count(*) OVER ({q}) - 1)::DOUBLE / 2) / count(close) OVER ({r}), 6) AS rank_pct FROM bars"


@query("n_rank", with_views("bars", _B + ", " + _RANK.format(p="", q="PARTITION BY close", r="")))
def rank(spark, d):
    return analysis.rank(views.bars(spark, d).select("code", "trade_date", "close"), "close", "rank_pct").withColumn("rank_pct", F.round("rank_pct", 6))


@query("n_rank_by_day", with_views("bars", _B + ", " + _RANK.format(p="PARTITION BY trade_date ", q="PARTITION BY trade_date, close", r="PARTITION BY trade_date")))
def rank_by_day(spark, d):
    return analysis.rank(views.bars(spark, d).select("code", "trade_date", "close"), "close", "rank_pct", ["trade_date"]).withColumn("rank_pct", F.round("rank_pct", 6))


@query(
    "n_winsorize",
    with_views("bars", ", s AS (SELECT quantile_cont(close, 0.01) AS lo, quantile_cont(close, 0.99) AS hi FROM bars) " + _B + ", round(least(greatest(close, lo), hi), 9) AS x FROM bars, s"),
)
def winsorize(spark, d):
    return analysis.winsorize(views.bars(spark, d).select("code", "trade_date", "close"), "close", "x").withColumn("x", F.round("x", 9))


@query(
    "n_normalized_factor",
    with_views(
        "bars",
        f""", f AS MATERIALIZED (SELECT code, trade_date, close / nullif(lag(close, 20) OVER ({W}), 0) - 1 AS x FROM bars), s AS MATERIALIZED (SELECT avg(x) AS m, stddev_samp(x) AS sd, min(x) AS lo, max(x) AS hi FROM f)
SELECT code, trade_date, round((x - m) / sd, 6) AS z, round((x - lo) / (hi - lo), 6) AS unit FROM f, s""",
    ),
)
def normalized_factor(spark, d):
    f = factors.calculate(views.bars(spark, d), ["momentum_20d"])
    out = analysis.minmax(analysis.zscore(f, "momentum_20d", "z"), "momentum_20d", "unit")
    return out.select("code", "trade_date", r6("z"), r6("unit"))


# --- analysis ---------------------------------------------------------------------------


def _panel(spark, d):
    """factor: 5-day momentum; forward_return: the next day's change / 1000."""
    b = factors.calculate(views.bars(spark, d), ["momentum_5d"], keep=["code", "trade_date", "close"])
    ahead = F.lead("close").over(series.by())
    return b.select("code", "trade_date", F.col("momentum_5d").alias("factor"), ((ahead / F.when(F.col("close") != 0, F.col("close")) - 1) / 1000.0).alias("forward_return"))


_PANEL = f""", p0 AS (SELECT code, trade_date, close / nullif(lag(close, 5) OVER ({W}), 0) - 1 AS factor, (lead(close) OVER ({W}) / nullif(close, 0) - 1) / 1000.0::DOUBLE AS forward_return FROM bars),
p AS (SELECT * FROM p0 WHERE factor IS NOT NULL AND forward_return IS NOT NULL),
days AS (SELECT trade_date, corr(factor, forward_return) AS ic, count(*) AS n FROM p GROUP BY 1),
ics AS (SELECT * FROM days WHERE n >= 2 AND ic IS NOT NULL AND NOT isnan(ic))
"""


@query("n_daily_ic", with_views("bars", _PANEL + "SELECT trade_date, round(ic, 6) AS ic FROM ics"))
def daily_ic(spark, d):
    p = _panel(spark, d).filter("factor is not null and forward_return is not null")
    return analysis.daily_ic(p).select("trade_date", r6("ic"))


_ANALYZE = """, r AS (SELECT *, (rank() OVER ({g}ORDER BY factor) + (count(*) OVER ({t}factor) - 1)::DOUBLE / 2) / count(*) OVER ({h}) AS rk FROM p),
t AS (SELECT {s}avg(abs(c)) AS turnover FROM (SELECT *, rk - lag(rk) OVER (PARTITION BY {s}code ORDER BY trade_date) AS c FROM r) {b}),
m AS (SELECT {s}avg(forward_return) AS rm, stddev_samp(forward_return) AS rs FROM p {b}),
c AS (SELECT *, exp(sum(ln(1 + forward_return)) OVER (PARTITION BY {s}code ORDER BY trade_date ROWS UNBOUNDED PRECEDING)) AS cum FROM p),
k AS (SELECT *, max(cum) OVER (PARTITION BY {s}code ORDER BY trade_date ROWS UNBOUNDED PRECEDING) AS peak FROM c),
dd AS (SELECT {s}min(cum / peak - 1) AS mdd FROM k {b})
"""


@query(
    "n_analyze",
    with_views(
        "bars",
        _PANEL
        + _ANALYZE.format(g="", t="PARTITION BY ", h="", s="", b="")
        + ", i AS (SELECT avg(ic) AS im, stddev_pop(ic) AS sd FROM ics) SELECT round(im, 6) AS ic_mean, round(sd, 6) AS ic_std, round(CASE WHEN sd <> 0 THEN im / sd ELSE 0 END, 6) AS ir, round(turnover, 6) AS turnover, round(rm, 6) AS return_mean, round(rs, 6) AS return_std, round((rm - 0.03::DOUBLE / 252) / nullif(rs, 0) * sqrt(252), 6) AS sharpe_ratio, round(mdd, 6) AS max_drawdown FROM i, t, m, dd",
    ),
)
def analyze(spark, d):
    return rounded(analysis.analyze(_panel(spark, d)), [])


@query(
    "n_analyze_by_group",
    with_views(
        "bars",
        _PANEL.replace("p AS (SELECT * FROM p0", "p AS (SELECT *, CAST(code AS BIGINT) % 3 AS grp FROM p0").replace("days AS (SELECT trade_date", "days AS (SELECT grp, trade_date").replace("FROM p GROUP BY 1)", "FROM p GROUP BY 1, 2)")
        + _ANALYZE.format(g="PARTITION BY grp ", t="PARTITION BY grp, ", h="PARTITION BY grp", s="grp, ", b="GROUP BY grp")
        + ", i AS (SELECT grp, avg(ic) AS im, stddev_pop(ic) AS sd FROM ics GROUP BY grp) SELECT grp, round(im, 6) AS ic_mean, round(sd, 6) AS ic_std, round(im / sd, 6) AS ir, round(turnover, 6) AS turnover, round(rm, 6) AS return_mean, round(rs, 6) AS return_std, round((rm - 0.03::DOUBLE / 252) / nullif(rs, 0) * sqrt(252), 6) AS sharpe_ratio, round(mdd, 6) AS max_drawdown FROM i JOIN t USING (grp) JOIN m USING (grp) JOIN dd USING (grp)",
    ),
)
def analyze_by_group(spark, d):
    return rounded(analysis.analyze(_panel(spark, d).withColumn("grp", views.code_number() % 3), by=["grp"]), [])


@query(
    "n_drawdown",
    with_views(
        "bars",
        _PANEL
        + f", c AS (SELECT *, exp(sum(ln(1 + forward_return)) OVER ({W} ROWS UNBOUNDED PRECEDING)) AS cum FROM p), k AS (SELECT *, max(cum) OVER ({W} ROWS UNBOUNDED PRECEDING) AS peak FROM c) SELECT code, round(min(cum / peak - 1), 6) AS max_drawdown FROM k GROUP BY code",
    ),
)
def drawdown(spark, d):
    p = _panel(spark, d).filter("factor is not null and forward_return is not null")
    return rounded(analysis.drawdown(p), [])


@query("n_single_ic", with_views("bars", _PANEL + "SELECT round(corr(factor, forward_return), 6) AS ic_mean, 0.0::DOUBLE AS ic_std FROM p"))
def single_ic(spark, d):
    p = _panel(spark, d).filter("factor is not null and forward_return is not null")
    return rounded(analysis.ic(p, date=None), [])
