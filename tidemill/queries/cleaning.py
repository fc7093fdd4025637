"""Declared tables, filters and the cleaning chain."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tidemill.operators import cleaning
from tidemill.operators.tables import TABLES
from tidemill.plans import views
from tidemill.plans.views import with_views
from tidemill.queries.registry import query, rounded

AS_OF = "1996-06-01"
_NEG = "open < 0 OR high < 0 OR low < 0 OR close < 0"


def _issues(view: str, checks: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{view}' AS table_name, '{label}' AS issue, coalesce(bool_or(coalesce({test}, false)), false) AS violated FROM {view}" for label, test in checks.items())


_DAILY = {"high_below_low": "high < low", "negative_price": _NEG, "negative_volume": "volume < 0"}


@query("f1_validate_daily", with_views("dirty", _issues("dirty", _DAILY)))
def validate_daily(spark, d):
    return TABLES["daily"].validate(views.dirty(spark, d)).select(F.lit("dirty").alias("table_name"), "issue", "violated")


_INSTRUMENTS = {
    "futures": {**_DAILY, "negative_price": _NEG + " OR settle < 0", "negative_open_interest": "open_interest < 0", "margin_rate_out_of_range": "margin_rate < 0 OR margin_rate > 100", "non_positive_contract_multiplier": "contract_multiplier <= 0"},
    "options": {**_DAILY, "non_positive_strike_price": "strike_price <= 0", "bad_option_type": "option_type NOT IN ('call', 'put')", "implied_volatility_out_of_range": "implied_volatility < 0 OR implied_volatility > 500", "delta_out_of_range": "delta < -1 OR delta > 1"},
    "bonds": {**_DAILY, "non_positive_conversion_price": "conversion_price <= 0"},
    "minute_bars": {"high_below_low": "high < low", "negative_price": _NEG},
}


@query("f1_validate_instruments", with_views(" ".join(_INSTRUMENTS), " UNION ALL ".join(_issues(v, c) for v, c in _INSTRUMENTS.items())))
def validate_instruments(spark, d):
    made = {"futures": (views.futures, "futures"), "options": (views.options, "options"), "bonds": (views.bonds, "convertible_bond"), "minute_bars": (views.minute_bars, "minute")}
    parts = [TABLES[t].validate(f(spark, d)).select(F.lit(v).alias("table_name"), "issue", "violated") for v, (f, t) in made.items()]
    return reduce(lambda a, b: a.union(b), parts)


@query(
    "f1_validate_finance",
    with_views("finance", _issues("finance", {"negative_total_assets": "total_assets < 0", "negative_revenue": "revenue < 0", "bad_report_period": "NOT regexp_full_match(report_period, '\\d{4}Q[1-4]')"})),
)
def validate_finance(spark, d):
    f = views.finance(spark, d).withColumns({"report_type": F.lit("quarter"), "pub_date": F.current_date()})
    return TABLES["finance"].validate(f).select(F.lit("finance").alias("table_name"), "issue", "violated")


@query("f1_missing_columns", "SELECT * FROM (VALUES ('missing:adj', true), ('missing:volume', true)) t(issue, violated) WHERE issue <> 'missing:adj'")
def missing_columns(spark, d):
    return TABLES["daily"].validate(views.bars(spark, d).drop("volume"))


@query("f2_drop_invalid", with_views("dirty", f"SELECT * FROM dirty WHERE NOT coalesce(high < low, false) AND NOT coalesce({_NEG}, false) AND NOT coalesce(volume < 0, false)"))
def drop_invalid(spark, d):
    return TABLES["daily"].drop_invalid(views.dirty(spark, d))


@query("f6_drop_null_keys", with_views("dirty", "SELECT code, trade_date, close FROM dirty WHERE code IS NOT NULL AND trade_date IS NOT NULL"))
def drop_null_keys(spark, d):
    return views.dirty(spark, d).dropna(subset=["code", "trade_date"]).select("code", "trade_date", "close")


@query(
    "f_partition_values",
    with_views("futures", "SELECT 'future' AS asset_type, exchange, strftime(trade_date, '%Y') AS year, strftime(trade_date, '%m') AS month, count(*) AS n FROM futures GROUP BY ALL"),
)
def partition_values(spark, d):
    spec = TABLES["futures"]
    return spec.with_partitions(views.futures(spark, d)).groupBy(*spec.partitions).agg(F.count(F.lit(1)).alias("n"))


_UNIFY = "CASE WHEN contains({c}, '.') THEN {c} WHEN starts_with({c}, '6') THEN {c} || '.SH' WHEN starts_with({c}, '0') OR starts_with({c}, '3') THEN {c} || '.SZ' WHEN starts_with({c}, '8') OR starts_with({c}, '4') THEN {c} || '.BJ' ELSE {c} || '.SH' END"


@query("k1_universal", with_views("dirty", f"SELECT DISTINCT * REPLACE ({_UNIFY.format(c='code')} AS code) FROM dirty WHERE code IS NOT NULL AND trade_date IS NOT NULL"))
def universal(spark, d):
    return cleaning.universal(views.dirty(spark, d))


@query(
    "k2_adjustment",
    with_views(
        "dirty",
        """, a AS (SELECT * REPLACE (coalesce(nullif(adj_factor, 0), 1.0::DOUBLE) AS adj_factor) FROM dirty)
SELECT code, trade_date, open * adj_factor AS open, high * adj_factor AS high, low * adj_factor AS low, close * adj_factor AS close,
  CAST(trunc(volume / adj_factor) AS BIGINT) AS volume, adj_factor FROM a""",
    ),
)
def adjustment(spark, d):
    out = cleaning.adjustment(views.dirty(spark, d)).select("code", "trade_date", "open", "high", "low", "close", "volume", "adj_factor")
    return out


@query("k3_status", with_views("dirty", "SELECT code, trade_date, name, coalesce(contains(lower(name), 'st'), false) AS is_st, coalesce(volume = 0, false) AS is_suspended FROM dirty"))
def status(spark, d):
    return cleaning.status(views.dirty(spark, d)).select("code", "trade_date", "name", "is_st", "is_suspended")


_VALID = f"NOT (coalesce(high < low, false) OR coalesce(high < open, false) OR coalesce(high < close, false) OR coalesce(low > open, false) OR coalesce(low > close, false) OR coalesce({_NEG}, false) OR coalesce(volume < 0, false) OR coalesce(amount < 0, false))"


@query("k4_ohlc", with_views("dirty", f"SELECT code, trade_date, close, {_VALID} AS ohlc_valid FROM dirty"))
def ohlc(spark, d):
    return cleaning.ohlc(views.dirty(spark, d)).select("code", "trade_date", "close", "ohlc_valid")


@query(
    "k5_convertible_bond",
    with_views(
        "bonds",
        f""", v AS (SELECT *, close / nullif(conversion_price, 0) * 100 AS cv FROM bonds), w AS (SELECT *, (close - cv) / nullif(cv, 0) * 100 AS pr FROM v)
SELECT code, trade_date, cv AS conversion_value, pr AS premium_rate, coalesce(pr > 50, false) AS high_premium, maturity_date <= DATE '{AS_OF}' + 365 AS near_maturity FROM w""",
    ),
)
def convertible_bond(spark, d):
    out = cleaning.convertible_bond(views.bonds(spark, d), AS_OF)
    return out.select("code", "trade_date", "conversion_value", "premium_rate", "high_premium", "near_maturity")


@query(
    "k6_futures",
    with_views(
        "futures",
        f"""SELECT code, trade_date, volume = max(volume) OVER (PARTITION BY trade_date) AS is_main_contract, volume = max(volume) OVER (PARTITION BY trade_date, underlying) AS is_main_of_underlying,
  expiry_date <= DATE '{AS_OF}' + 30 AS near_delivery, CAST(coalesce(open_interest - lag(open_interest) OVER (PARTITION BY code ORDER BY trade_date), 0) AS BIGINT) AS oi_change FROM futures""",
    ),
)
def futures(spark, d):
    out = cleaning.futures(views.futures(spark, d), AS_OF)
    out = cleaning.futures(out.withColumnRenamed("is_main_contract", "first"), AS_OF, per_underlying=True)
    return out.select("code", "trade_date", F.col("first").alias("is_main_contract"), F.col("is_main_contract").alias("is_main_of_underlying"), "near_delivery", "oi_change")


@query(
    "k7_options",
    with_views(
        "options",
        f""", m AS (SELECT *, close / nullif(strike_price, 0) AS mn FROM options)
SELECT code, trade_date, mn AS moneyness,
  CASE WHEN option_type = 'call' AND mn > 1.05 OR option_type = 'put' AND mn < 0.95 THEN 'in_the_money' WHEN option_type = 'call' AND mn < 0.95 OR option_type = 'put' AND mn > 1.05 THEN 'out_of_the_money' ELSE 'at_the_money' END AS option_status,
  expiry_date <= DATE '{AS_OF}' + 7 AS near_expiry, CAST(coalesce(open_interest - lag(open_interest) OVER w, 0) AS BIGINT) AS oi_change,
  coalesce(implied_volatility - lag(implied_volatility) OVER w, 0) AS iv_change FROM m WINDOW w AS (PARTITION BY code ORDER BY trade_date)""",
    ),
)
def options(spark, d):
    out = cleaning.options(views.options(spark, d), AS_OF)
    return out.select("code", "trade_date", "moneyness", "option_status", "near_expiry", "oi_change", F.col("iv_change").cast("double").alias("iv_change"))


@query("a4_option_status_counts", with_views("options", """, m AS (SELECT *, close / nullif(strike_price, 0) AS mn FROM options)
SELECT CASE WHEN option_type = 'call' AND mn > 1.05 OR option_type = 'put' AND mn < 0.95 THEN 'in_the_money' WHEN option_type = 'call' AND mn < 0.95 OR option_type = 'put' AND mn > 1.05 THEN 'out_of_the_money' ELSE 'at_the_money' END AS option_status, count(*) AS n FROM m GROUP BY 1"""))
def option_status_counts(spark, d):
    return cleaning.options(views.options(spark, d), AS_OF).groupBy("option_status").agg(F.count(F.lit(1)).alias("n"))


_CELLS = "open high low close volume amount adj_factor name code trade_date".split()


_SCORES = f"""g AS (SELECT *, count(*) AS n FROM dirty GROUP BY ALL),
q AS (SELECT CAST(sum(n) AS BIGINT) AS total, sum(n * ({' + '.join(f'CASE WHEN {c} IS NULL THEN 1 ELSE 0 END' for c in _CELLS)}))::DOUBLE AS nulls, sum(n - 1)::DOUBLE AS copies, max(trade_date) AS latest,
  (max(CASE WHEN open < 0 THEN 1 ELSE 0 END) + max(CASE WHEN high < 0 THEN 1 ELSE 0 END) + max(CASE WHEN high < low THEN 1 ELSE 0 END) + max(CASE WHEN low < 0 THEN 1 ELSE 0 END) + max(CASE WHEN close < 0 THEN 1 ELSE 0 END) + max(CASE WHEN volume < 0 THEN 1 ELSE 0 END))::DOUBLE AS bad FROM g),
p AS (SELECT total, (1 - nulls / (total * {len(_CELLS)})) * 100 AS completeness, (1 - copies / total) * 100 AS consistency,
  CASE WHEN DATE '{AS_OF}' - latest <= 0 THEN 100.0::DOUBLE WHEN DATE '{AS_OF}' - latest >= 60 THEN 0.0::DOUBLE ELSE 100 - (DATE '{AS_OF}' - latest)::DOUBLE / 60 * 100 END AS timeliness, greatest(0.0::DOUBLE, (1 - bad / 5) * 100) AS accuracy FROM q),
s AS (SELECT *, completeness * 0.3::DOUBLE + consistency * 0.25::DOUBLE + timeliness * 0.2::DOUBLE + accuracy * 0.25::DOUBLE AS score FROM p)"""


@query(
    "k8_quality",
    with_views(
        "dirty",
        f""", {_SCORES}
SELECT total AS total_records, round(completeness, 6) AS completeness, round(consistency, 6) AS consistency, round(timeliness, 6) AS timeliness, round(accuracy, 6) AS accuracy, round(score, 6) AS quality_score,
  CASE WHEN score >= 90 THEN 'A' WHEN score >= 70 THEN 'B' WHEN score >= 50 THEN 'C' ELSE 'D' END AS grade FROM s""",
    ),
)
def quality(spark, d):
    return rounded(cleaning.quality_parts(views.dirty(spark, d), AS_OF), [])


@query(
    "k_chain",
    with_views(
        "dirty",
        f""", u AS (SELECT DISTINCT * REPLACE ({_UNIFY.format(c='code')} AS code, coalesce(nullif(adj_factor, 0), 1.0::DOUBLE) AS adj_factor) FROM (SELECT DISTINCT * FROM dirty WHERE code IS NOT NULL AND trade_date IS NOT NULL)),
a AS (SELECT * REPLACE (open * adj_factor AS open, high * adj_factor AS high, low * adj_factor AS low, close * adj_factor AS close, CAST(trunc(volume / adj_factor) AS BIGINT) AS volume) FROM u)
SELECT code, trade_date, close, volume, coalesce(contains(lower(name), 'st'), false) AS is_st, coalesce(volume = 0, false) AS is_suspended, {_VALID} AS ohlc_valid FROM a""",
    ),
)
def chain(spark, d):
    df = views.dirty(spark, d)
    for step in (cleaning.universal, cleaning.adjustment, cleaning.status, cleaning.ohlc):
        df = df.transform(step)
    return df.select("code", "trade_date", "close", "volume", "is_st", "is_suspended", "ohlc_valid")


@query(
    "k_issues",
    with_views(
        "futures",
        """SELECT i AS issue, coalesce(v, false) AS violated FROM (
  SELECT '[universal] null code' AS i, bool_or(code IS NULL) AS v FROM futures WHERE code IS NOT NULL AND trade_date IS NOT NULL
  UNION ALL SELECT '[universal] null trade_date', bool_or(trade_date IS NULL) FROM futures WHERE code IS NOT NULL AND trade_date IS NOT NULL
  UNION ALL SELECT '[ohlc] invalid OHLC', bool_or(high < low OR high < open OR high < close OR open < low OR close < low OR open < 0 OR high < 0 OR low < 0 OR close < 0 OR volume < 0 OR amount < 0) FROM futures
  UNION ALL SELECT '[futures] settle far from close', bool_or(abs((settle - close) / nullif(close, 0)) > 0.1) FROM futures
  UNION ALL SELECT '[quality] quality_score out of range', false)""",
    ),
)
def issues(spark, d):
    return cleaning.issues(cleaning.clean(views.futures(spark, d), as_of=AS_OF))


@query("k_quality_rows", with_views("dirty", f", {_SCORES} SELECT code, trade_date, round(score, 6) AS quality_score FROM dirty, s"))
def quality_rows(spark, d):
    scored = cleaning.quality(views.dirty(spark, d), AS_OF)
    return rounded(scored.select("code", "trade_date", "quality_score"), [])
