"""Codes, vendor frames, fallback, storage and streaming."""

from __future__ import annotations

import tempfile
import uuid
from datetime import date

from pyspark.sql import functions as F

from tidemill.functions import scalars
from tidemill.operators import diffs, factors
from tidemill.plans import config, views
from tidemill.plans.views import with_views
from tidemill.queries.registry import query, rounded
from tidemill.sources import fetch, storage
from tidemill.sources.vendors import VENDORS, search, vendor
from tidemill.streaming.upserts import stream_upserts


def _folder(spark) -> str:
    """A folder that driver and executors share; a machine's own one only for a
    session on one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='tidemill-')}"
    return f"{base.rstrip('/')}/tidemill-store/{uuid.uuid4().hex}"


_CODE = "lpad(CAST(p_partkey * 7919 % 1000000 AS VARCHAR), 6, '0')"
_CODES = f"WITH c AS (SELECT DISTINCT CASE WHEN p_partkey % 9 = 0 THEN {_CODE} || '.SZ' ELSE {_CODE} END AS code FROM part) "


def _codes(spark, d):
    digits = F.lpad((F.col("p_partkey") * 7919 % 1000000).cast("string"), 6, "0")
    return views.table(spark, d, "part").select(F.when(F.col("p_partkey") % 9 == 0, F.concat(digits, F.lit(".SZ"))).otherwise(digits).alias("code")).distinct()


_RULE = "CASE WHEN contains(code, '.') THEN code WHEN starts_with(code, '6') THEN code || '.SH' WHEN starts_with(code, '0') OR starts_with(code, '3') THEN code || '.SZ' WHEN starts_with(code, '8') OR starts_with(code, '4') THEN code || '.BJ' ELSE code || '{x}' END"


@query("m6_unify_code", _CODES + f"SELECT code, {_RULE.format(x='.SH')} AS unified, {_RULE.format(x='.SZ')} AS unified_sz FROM c")
def unify(spark, d):
    return _codes(spark, d).select("code", scalars.unify_code("code").alias("unified"), scalars.unify_code("code", "SZ").alias("unified_sz"))


@query(
    "m7_m8_m9_suffixes",
    _CODES
    + f""", u AS (SELECT {_RULE.format(x='.SH')} AS code FROM c), p AS (SELECT code, lower(split_part(code, '.', 2)) || '.' || split_part(code, '.', 1) AS prefixed FROM u)
SELECT code, prefixed, upper(split_part(prefixed, '.', 1)) AS swapped_exchange, code AS back, code AS untouched,
  split_part(code, '.', 1) || CASE split_part(code, '.', 2) WHEN 'SZ' THEN '.XSHE' WHEN 'SH' THEN '.XSHG' ELSE '.XBJ' END AS vendor, code AS from_vendor, split_part(code, '.', 1) AS stripped FROM p""",
)
def suffixes(spark, d):
    u = _codes(spark, d).select(scalars.unify_code("code").alias("code")).withColumn("prefixed", scalars.to_prefixed("code"))
    u = u.withColumn("vendor", scalars.to_vendor_suffix("code"))
    return u.select(
        "code", "prefixed", F.upper(F.substring_index("prefixed", ".", 1)).alias("swapped_exchange"), scalars.from_prefixed("prefixed").alias("back"), scalars.from_prefixed("code").alias("untouched"),
        "vendor", scalars.from_vendor_suffix("vendor").alias("from_vendor"), scalars.strip_suffix("code").alias("stripped"),
    )


@query("m10_bond_code", _CODES + "SELECT code, CASE WHEN contains(code, '.') THEN code WHEN starts_with(code, '11') THEN code || '.SH' ELSE code || '.SZ' END AS bond FROM c")
def bond_code(spark, d):
    return _codes(spark, d).select("code", scalars.bond_code("code").alias("bond"))


_CONTRACT = "WITH k AS (SELECT DISTINCT ['IF', 'cu', 'm', 'SR', 'sc', 'lu'][CAST(o_orderkey % 6 + 1 AS BIGINT)] || strftime(o_orderdate, '%y%m') AS code FROM orders) "


def _contracts(spark, d):
    names = F.array(*[F.lit(x) for x in ("IF", "cu", "m", "SR", "sc", "lu")])
    return views.table(spark, d, "orders").select(F.concat(F.element_at(names, (F.col("o_orderkey") % 6 + 1).cast("int")), F.date_format("o_orderdate", "yyMM")).alias("code")).distinct()


@query(
    "m12_futures_code",
    _CONTRACT
    + """, q AS (SELECT code, regexp_extract(code, '([A-Za-z]+)(\\d{4})', 1) AS underlying, '20' || right(code, 4) AS delivery_month, strptime('20' || right(code, 4) || '01', '%Y%m%d')::DATE AS first FROM k)
SELECT code, underlying, delivery_month, first + CAST((5 - dayofweek(first) + 7) % 7 + 14 AS INTEGER) AS expiry_date FROM q""",
)
def futures_code(spark, d):
    p = scalars.parse_futures_code("code")
    return _contracts(spark, d).select("code", p["underlying"].alias("underlying"), p["delivery_month"].alias("delivery_month"), p["expiry_date"].alias("expiry_date"))


@query(
    "s8_s10_exchanges",
    _CONTRACT
    + """SELECT code, CASE WHEN starts_with(code, 'IF') THEN 'CFFEX' WHEN starts_with(code, 'cu') THEN 'SHFE' WHEN starts_with(code, 'm') THEN 'DCE' WHEN starts_with(code, 'SR') THEN 'CZCE' ELSE 'UNKNOWN' END AS exchange,
  code || CASE WHEN starts_with(code, 'IF') THEN '.CFE' WHEN starts_with(code, 'cu') THEN '.SHF' WHEN starts_with(code, 'm') THEN '.DCE' WHEN starts_with(code, 'SR') THEN '.CZC' ELSE '.INE' END AS suffixed FROM k""",
)
def exchanges(spark, d):
    c = _contracts(spark, d)
    return c.select("code", scalars.futures_exchange(F.upper(scalars.parse_futures_code("code")["underlying"])).alias("exchange"), scalars.futures_suffix("code").alias("suffixed"))


@query(
    "m13_option_code",
    """WITH c(code, u, t, s, e) AS (VALUES ('50ETF购3月2800', '50ETF', 'call', 2.8, DATE '2025-03-28'), ('300ETF沽12月950', '300ETF', 'put', 950.0, DATE '2025-12-28'), ('IOcall4000', 'IO', 'call', 4.0, NULL), ('plain', 'plain', 'call', 0.0, NULL))
SELECT code, u AS underlying, t AS option_type, CAST(s AS DOUBLE) AS strike_price, e AS expiry_date FROM c""",
)
def option_code(spark, d):
    rows = spark.createDataFrame([("50ETF购3月2800",), ("300ETF沽12月950",), ("IOcall4000",), ("plain",)], "code string")
    p = scalars.parse_option_code("code", 2025)
    return rows.select("code", *[p[c].alias(c) for c in ("underlying", "option_type", "strike_price", "expiry_date")])


@query(
    "m14_s11_options",
    "SELECT * FROM (VALUES ('10005867', '认购', '10005867.SSE', 'call'), ('90003688', '认沽', '90003688.SZSE', 'put'), ('123', 'x', '123.SSE', NULL), ('1.SSE', '认购', '1.SSE', 'call')) t(code, kind, suffixed, option_type)",
)
def option_types(spark, d):
    rows = spark.createDataFrame([("10005867", "认购"), ("90003688", "认沽"), ("123", "x"), ("1.SSE", "认购")], "code string, kind string")
    return rows.select("code", "kind", scalars.option_suffix("code").alias("suffixed"), scalars.option_type("kind").alias("option_type"))


@query(
    "m2_m3_m4_dates",
    "WITH o AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) SELECT d, d AS iso, d AS compact, CASE WHEN day(d) = 1 THEN NULL ELSE d END AS lenient FROM o",
)
def dates(spark, d):
    o = views.table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    bad = F.when(F.dayofmonth("d") == 1, "not a day").otherwise(F.col("d").cast("string"))
    return o.select("d", scalars.iso_date(F.col("d").cast("string")).alias("iso"), scalars.compact_date(F.date_format("d", "yyyyMMdd")).alias("compact"), scalars.lenient_date(bad).alias("lenient"))


@query(
    "m1_vendor_daily",
    with_views("bars", "SELECT vendor, code || CASE WHEN vendor IN ('efinance', 'akshare') THEN '.SZ' ELSE '.SZ' END AS code, trade_date, close, volume, 'stock' AS asset_type FROM bars, (VALUES ('akshare'), ('baostock'), ('tushare'), ('efinance'), ('jqdata'), ('mootdx')) v(vendor)"),
)
def vendor_daily(spark, d):
    """Each vendor's raw form of the bars, mapped back."""
    b = views.bars(spark, d).select("code", "trade_date", "close", "volume")
    day = F.col("trade_date").cast("string")
    raw = {
        "akshare": b.select("code", day.alias("日期"), F.col("close").alias("收盘"), F.col("volume").alias("成交量")),
        "baostock": b.select(F.concat(F.lit("sz."), "code").alias("code"), day.alias("date"), F.col("close").cast("string").alias("close"), F.col("volume").cast("string").alias("volume")),
        "tushare": b.select(F.concat("code", F.lit(".SZ")).alias("ts_code"), F.date_format("trade_date", "yyyyMMdd").alias("trade_date"), "close", F.col("volume").alias("vol")),
        "efinance": b.select(F.col("code").alias("股票代码"), day.alias("日期"), F.col("close").alias("收盘"), F.col("volume").alias("成交量")),
        "jqdata": b.select(F.concat("code", F.lit(".XSHE")).alias("code"), day.alias("trade_date"), "close", "volume"),
        "mootdx": b.select("code", day.alias("trade_date"), "close", "volume"),
    }
    out = None
    for name, df in raw.items():
        mapped = VENDORS[name].map(df).select(F.lit(name).alias("vendor"), "code", "trade_date", "close", "volume", "asset_type")
        out = mapped if out is None else out.unionByName(mapped)
    return out


@query(
    "m1_vendor_finance",
    with_views("finance", """SELECT vendor, lpad(code, 6, '0') || '.SZ' AS code, report_period, CASE right(report_period, 1) WHEN '4' THEN 'annual' WHEN '2' THEN 'semiannual' ELSE 'quarterly' END AS report_type,
  CASE WHEN vendor <> 'akshare' THEN last_day(make_date(CAST(left(report_period, 4) AS BIGINT), 3 * CAST(right(report_period, 1) AS BIGINT), 1)) END AS pub_date, CAST(eps AS DOUBLE) AS eps, CAST(bps AS DOUBLE) AS bps
FROM finance, (VALUES ('akshare'), ('tushare'), ('jqdata')) v(vendor)"""),
)
def vendor_finance(spark, d):
    """Each vendor's raw form of the statements, mapped back."""
    year, quarter = F.substring("report_period", 1, 4).cast("int"), F.substring("report_period", -1, 1).cast("int")
    f = views.finance(spark, d).select(F.lpad("code", 6, "0").alias("code"), F.last_day(F.make_date(year, quarter * 3, F.lit(1))).alias("day"), "eps", "bps")
    compact = F.date_format("day", "yyyyMMdd")
    raw = {
        "akshare": f.select("code", F.col("day").cast("string").alias("报告期"), F.col("eps").cast("string").alias("基本每股收益"), F.col("bps").alias("每股净资产")),
        "tushare": f.select(F.concat("code", F.lit(".SZ")).alias("ts_code"), compact.alias("end_date"), compact.alias("ann_date"), "eps", "bps"),
        "jqdata": f.select(F.concat("code", F.lit(".XSHE")).alias("code"), F.col("day").cast("string").alias("statDate"), F.col("day").cast("string").alias("pubDate"), "eps", "bps"),
    }
    keep = ["code", "report_period", "report_type", "pub_date", "eps", "bps"]
    parts = [vendor(name, "finance").map(df).select(F.lit(name).alias("vendor"), *keep) for name, df in raw.items()]
    return parts[0].union(parts[1]).union(parts[2])


@query("m1_vendor_index", with_views("bars", "SELECT code || '.SZ' AS code, trade_date, open, close, volume, amount FROM bars"))
def vendor_index(spark, d):
    """Index frames come with English names."""
    b = views.bars(spark, d)
    raw = b.select("code", F.col("trade_date").cast("string").alias("date"), "open", "high", "low", "close", "volume", "amount")
    return vendor("akshare", "daily").map(raw).select("code", "trade_date", "open", "close", "volume", "amount")


@query("m1_vendor_minute", with_views("minute_bars", "SELECT vendor, '000001.SZ' AS code, trade_time, close, CAST(volume AS BIGINT) AS volume FROM minute_bars, (VALUES ('akshare'), ('efinance'), ('mootdx'), ('jqdata')) v(vendor)"))
def vendor_minute(spark, d):
    b = views.minute_bars(spark, d).withColumn("code", F.lit("000001"))
    time = F.date_format("trade_time", "yyyy-MM-dd HH:mm:ss")
    raw = {
        "akshare": b.select("code", time.alias("时间"), F.col("close").alias("收盘"), F.col("volume").alias("成交量")),
        "efinance": b.select(F.col("code").alias("股票代码"), time.alias("日期"), F.col("close").alias("收盘"), F.col("volume").alias("成交量")),
        "mootdx": b.select("code", time.alias("datetime"), "close", "volume"),
        "jqdata": b.select(F.concat("code", F.lit(".XSHE")).alias("code"), time.alias("time"), "close", "volume"),
    }
    parts = [vendor(name, "minute").map(df).select(F.lit(name).alias("vendor"), "code", "trade_time", "close", "volume") for name, df in raw.items()]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query(
    "s_vendor_contracts",
    _CONTRACT
    + """SELECT vendor, code, DATE '2025-01-02' AS trade_date, 1.5::DOUBLE AS close, 1.4::DOUBLE AS settle, 10::BIGINT AS volume, 5::BIGINT AS open_interest, 'future' AS asset_type FROM k, (VALUES ('akshare'), ('tushare')) v(vendor)""",
)
def vendor_contracts(spark, d):
    """Futures of both vendors in one declared form."""
    c = _contracts(spark, d).withColumns({"date": F.lit("2025-01-02"), "open": F.lit(1.0), "high": F.lit(2.0), "low": F.lit(0.5), "close": F.lit(1.5), "settle": F.lit(1.4), "volume": F.lit(10), "hold": F.lit(5)})
    a = VENDORS["akshare_futures"].map(c)
    t = VENDORS["tushare_futures"].map(c.select(F.concat("code", F.lit(".CFE")).alias("ts_code"), F.lit("20250102").alias("trade_date"), "open", "high", "low", "close", "settle", F.col("volume").alias("vol"), F.col("hold").alias("oi")))
    keep = ["code", "trade_date", "close", "settle", "volume", "open_interest", "asset_type"]
    return a.select(F.lit("akshare").alias("vendor"), *keep).union(t.select(F.lit("tushare").alias("vendor"), *keep))


@query(
    "s_vendor_bonds_options",
    """SELECT * FROM (VALUES ('123001.SZ', 10.0::DOUBLE, 102.0::DOUBLE, '2027-01-01'), ('113001.SH', 8.0::DOUBLE, 99.0::DOUBLE, NULL), ('10005867', NULL, 0.5::DOUBLE, 'call')) t(code, conversion_price, close, note)""",
)
def vendor_bonds_options(spark, d):
    bonds = spark.createDataFrame([("123001", "000001", 10.0, 102.0, "2027-01-01"), ("113001", "600000", 8.0, 99.0, "bad")], "`债券代码` string, `正股代码` string, `转股价` double, `最新价` double, `到期日` string")
    options = spark.createDataFrame([("10005867", "2025-01-02", 0.5, "认购", 5)], "code string, date string, close double, type string, hold int")
    b = VENDORS["akshare_cb"].map(bonds).select("code", "conversion_price", "close", F.col("maturity_date").cast("string").alias("note"))
    o = VENDORS["akshare_options"].map(options).select("code", F.lit(None).cast("double").alias("conversion_price"), "close", F.col("option_type").alias("note"))
    return b.union(o)


@query("s12_search", "SELECT printf('%06d', s_suppkey::INTEGER) || CASE WHEN s_suppkey % 2 = 0 THEN '.SH' ELSE '.SZ' END AS code, s_name AS name, 'Stock' AS type, CASE WHEN s_suppkey % 3 = 0 THEN 'Delisted' ELSE 'Listed' END AS status FROM supplier WHERE regexp_matches(s_name, '(?i)SUPPLIER#0*[1-4]') ORDER BY 1, 2 LIMIT 20")
def find(spark, d):
    s = views.table(spark, d, "supplier")
    n = F.col("s_suppkey")
    i = s.select(F.concat(F.when(n % 2 == 0, "sh.").otherwise("sz."), F.lpad(n.cast("string"), 6, "0")).alias("code"), F.col("s_name").alias("code_name"), F.lit("1").alias("type"), F.when(n % 3 == 0, "0").otherwise("1").alias("status"))
    return search(i, "supplier#0*[1-4]")


# --- fallback ---------------------------------------------------------------------------


@query(
    "c1_priority_fallback",
    with_views("source_a source_b", """, u AS (SELECT 'akshare' AS source, code, trade_date, close, 2 AS p FROM source_b UNION ALL SELECT 'tushare', code, trade_date, close, 1 FROM source_a),
k AS (SELECT *, row_number() OVER (PARTITION BY code, trade_date ORDER BY p DESC) AS n FROM u) SELECT code, trade_date, close, source FROM k WHERE n = 1"""),
)
def fallback(spark, d):
    frames = {"akshare": views.source_b(spark, d), "tushare": views.source_a(spark, d)}
    return fetch.by_priority(frames, config.PRIORITIES["daily"], ["code", "trade_date"]).select("code", "trade_date", "close", "source")


@query("c4_completeness", with_views("source_a source_b", """, m AS (SELECT count(DISTINCT code) AS failed FROM source_a WHERE code NOT IN (SELECT code FROM source_b)), n AS (SELECT count(DISTINCT code) AS requested FROM source_a)
SELECT requested, failed, CASE WHEN failed = 0 THEN 'success' WHEN failed = requested THEN 'failed' ELSE 'partial' END AS status FROM m, n"""))
def completeness(spark, d):
    return fetch.completeness(views.source_b(spark, d), views.source_a(spark, d))


@query("c4_missing_codes", with_views("source_a source_b", "SELECT DISTINCT code FROM source_a WHERE code NOT IN (SELECT code FROM source_b)"))
def missing_codes(spark, d):
    return fetch.missing_codes(views.source_b(spark, d), views.source_a(spark, d))


# --- storage ----------------------------------------------------------------------------


def _daily(spark, d, where: str = "true"):
    return views.bars(spark, d).filter(where).withColumn("asset_type", F.lit("stock"))


@query("p1_p2_write_read", with_views("bars", "SELECT code, trade_date, close FROM bars WHERE code IN ('000001', '000002') AND trade_date BETWEEN DATE '1995-11-01' AND DATE '1996-05-31'"))
def write_read(spark, d):
    store = storage.ParquetStore(spark, _folder(spark))
    store.write("daily", _daily(spark, d))
    return store.read(storage.Query("daily", ("code", "trade_date", "close"), ("000001", "000002"), date(1995, 11, 1), date(1996, 5, 31)))


@query("p2_partition_read", with_views("bars", "SELECT code, trade_date, volume, '1996' AS year, '03' AS month FROM bars WHERE year(trade_date) = 1996 AND month(trade_date) = 3"))
def partition_read(spark, d):
    store = storage.ParquetStore(spark, _folder(spark))
    store.write("daily", _daily(spark, d))
    return store.read(storage.Query("daily", partitions={"year": "1996", "month": "03"})).select("code", "trade_date", "volume", "year", "month")


@query(
    "p3_upsert",
    with_views("bars", "SELECT code, trade_date, CASE WHEN month(trade_date) = 3 AND code < '000005' THEN close + 1 ELSE close END AS close FROM bars WHERE year(trade_date) = 1996 UNION ALL SELECT 'new', DATE '1996-03-05', 1.0::DOUBLE"),
)
def upsert(spark, d):
    store = storage.ParquetStore(spark, _folder(spark))
    store.write("daily", _daily(spark, d))
    changed = _daily(spark, d, "year(trade_date) = 1996 and month(trade_date) = 3 and code < '000005'").withColumn("close", F.col("close") + 1)
    new = changed.limit(1).withColumns({"code": F.lit("new"), "trade_date": F.lit(date(1996, 3, 5)), "close": F.lit(1.0)})
    store.upsert("daily", changed.unionByName(new))
    return store.read(storage.Query("daily", partitions={"year": "1996"})).select("code", "trade_date", "close")


@query("st_stream_upsert", with_views("bars", "SELECT code, trade_date, close FROM bars WHERE year(trade_date) = 1995"))
def stream_upsert(spark, d):
    root = _folder(spark)
    store = storage.ParquetStore(spark, f"{root}/store")
    rows = _daily(spark, d)
    rows.write.parquet(f"{root}/landing")
    stream_upserts(spark, store, "daily", f"{root}/landing", f"{root}/checkpoint").awaitTermination()
    return store.read(storage.Query("daily", partitions={"year": "1995"})).select("code", "trade_date", "close")


_MOMENTUM = "f AS (SELECT code, trade_date, round(close / nullif(lag(close, 5) OVER (PARTITION BY code ORDER BY trade_date), 0) - 1, 6) AS momentum_5d FROM bars)"


def _stored(spark, d):
    store = storage.FactorStore(spark, _folder(spark))
    store.save("momentum_5d", rounded(factors.calculate(views.bars(spark, d), ["momentum_5d"]), []), factors.REGISTRY.metadata("momentum_5d"))
    return store


@query("p8_p9_factor_query", with_views("bars", f", {_MOMENTUM} SELECT * FROM f WHERE code IN ('000003', '000004') AND trade_date >= DATE '1996-01-01'"))
def factor_query(spark, d):
    return _stored(spark, d).query("momentum_5d", ["000003", "000004"], date(1996, 1, 1))


@query("p10_factor_latest", with_views("bars", f", {_MOMENTUM} SELECT * FROM f ORDER BY trade_date DESC, code LIMIT 25"))
def factor_latest(spark, d):
    return _stored(spark, d).latest("momentum_5d", 25)


@query("p3_last_by_key", with_views("dirty", "SELECT code, trade_date, count(*) AS n FROM (SELECT code, trade_date FROM dirty QUALIFY row_number() OVER (PARTITION BY code, trade_date ORDER BY close DESC) = 1) GROUP BY ALL"))
def last_by_key(spark, d):
    return diffs.first_by(views.dirty(spark, d), ["code", "trade_date"], ["close"], last=True).groupBy("code", "trade_date").agg(F.count(F.lit(1)).alias("n"))
