"""The engine's tables derived from the test tables, as Spark plans, and the same
derivations as SQL text for another engine (``SQL``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions import series
from tidemill.functions.scalars import div


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(spark: SparkSession, d: str) -> DataFrame:
    """One bar for supplier and ship date; first and last price by a total order. An
    aggregate only, so that partial results combine before the shuffle."""
    px = div("l_extendedprice", "l_quantity")
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    rows = table(spark, d, "lineitem").select(F.lpad(F.col("l_suppkey").cast("string"), 6, "0").alias("code"), F.col("l_shipdate").cast("date").alias("trade_date"), px.alias("px"), order.alias("o"), "l_quantity", "l_extendedprice")
    return rows.groupBy("code", "trade_date").agg(
        F.min_by("px", "o").alias("open"),
        F.max("px").alias("high"),
        F.min("px").alias("low"),
        F.max_by("px", "o").alias("close"),
        F.sum("l_quantity").cast("bigint").alias("volume"),
        F.round(F.sum("l_extendedprice"), 2).alias("amount"),
    )


def code_number(c: str = "code") -> Column:
    return F.col(c).cast("bigint")


def day(c: str = "trade_date") -> Column:
    return F.dayofmonth(c).cast("bigint")


def changes(spark: SparkSession, d: str) -> DataFrame:
    """pct_change in percent, for breadth and volatility."""
    return bars(spark, d).select("code", "trade_date", "close", F.round(series.pct_change("close", series.by()) * 100.0, 4).alias("pct_change"))


def finance(spark: SparkSession, d: str) -> DataFrame:
    """Statements by nation and quarter."""
    rows = table(spark, d, "orders").join(table(spark, d, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    quarter = F.concat(F.year("o_orderdate").cast("string"), F.lit("Q"), F.quarter("o_orderdate").cast("string"))
    sums = rows.groupBy(F.col("c_nationkey").cast("string").alias("code"), quarter.alias("report_period")).agg(F.round(F.sum("o_totalprice"), 2).alias("revenue"), F.count(F.lit(1)).alias("n"))
    r, n = F.col("revenue"), F.col("n").cast("double")
    return sums.select(
        "code",
        "report_period",
        "revenue",
        (r * 0.6).alias("cost_of_goods_sold"),
        (r * 0.1 - n * 100.0).alias("net_profit"),
        (r * 2.0).alias("total_assets"),
        (r * 0.8 + n).alias("total_liabilities"),
        (r * 1.2 - n).alias("shareholders_equity"),
        (r * 0.5).alias("current_assets"),
        (r * 0.25 + n).alias("current_liabilities"),
        (r * 0.15 - n * 50.0).alias("operating_cash_flow"),
        (r / 100000.0 - n).alias("eps"),
        (n + 5.0).alias("bps"),
        (n * 0.2).alias("dividend"),
        (r * 3.0).alias("market_cap"),
        (n + 10.0).alias("close"),
    )


def flows(spark: SparkSession, d: str) -> DataFrame:
    """Daily sums of line items by their flags."""
    flag = lambda c, v: F.round(F.coalesce(F.sum(F.when(F.col(c) == v, F.col("l_extendedprice"))), F.lit(0.0)), 2)
    rows = table(spark, d, "lineitem").groupBy(F.col("l_shipdate").cast("date").alias("trade_date"))
    return rows.agg(flag("l_returnflag", "A").alias("buy_amount"), flag("l_returnflag", "R").alias("sell_amount"), flag("l_linestatus", "O").alias("margin_balance"), flag("l_linestatus", "F").alias("short_balance")).withColumn("code", F.lit("ALL"))


def minute_bars(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select(F.col("event_type").alias("code"), F.date_trunc("hour", "ts").alias("trade_time"), "value", F.struct("ts", "event_id").alias("o"))
    return rows.groupBy("code", "trade_time").agg(
        F.min_by("value", "o").alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", "o").alias("close"), F.count(F.lit(1)).alias("volume"), F.round(F.sum("value"), 4).alias("amount")
    )


def futures(spark: SparkSession, d: str) -> DataFrame:
    b = bars(spark, d)
    return b.withColumns(
        {
            "underlying": F.concat(F.lit("U"), (code_number() % 5).cast("string")),
            "exchange": F.lit("CFFEX"),
            "settle": F.col("close") * F.when(day() % 3 == 0, 1.2).otherwise(1.01),
            "open_interest": F.col("volume") * 2 + code_number(),
            "margin_rate": (code_number() % 20).cast("double"),
            "contract_multiplier": F.lit(300.0),
            "expiry_date": F.date_add("trade_date", (code_number() % 60).cast("int")),
        }
    )


def options(spark: SparkSession, d: str) -> DataFrame:
    return bars(spark, d).withColumns(
        {
            "strike_price": (code_number() % 40).cast("double") * 50.0,
            "option_type": F.when(code_number() % 2 == 0, "call").otherwise("put"),
            "open_interest": F.col("volume") + day(),
            "implied_volatility": F.col("volume").cast("double") / 2.0,
            "delta": (day() - 15).cast("double") / 20.0,
            "expiry_date": F.date_add("trade_date", (code_number() % 20).cast("int")),
        }
    )


def bonds(spark: SparkSession, d: str) -> DataFrame:
    return bars(spark, d).withColumns({"conversion_price": (code_number() % 30).cast("double") * 40.0, "maturity_date": F.date_add("trade_date", (code_number() * 9).cast("int"))})


def dirty(spark: SparkSession, d: str) -> DataFrame:
    """Bars with names, flags and factors, some rows twice, some keys null, some
    prices wrong."""
    b = bars(spark, d)
    n = code_number()
    b = b.withColumns(
        {
            "code": F.when((n % 11 == 0) & (day() == 3), F.lit(None)).otherwise(F.col("code")),
            "high": F.when((n % 13 == 0) & (day() == 5), F.col("low") - 1.0).otherwise(F.col("high")),
            "open": F.when((n % 17 == 0) & (day() == 7), -F.col("open")).otherwise(F.col("open")),
            "volume": F.when((n % 19 == 0) & (day() == 9), F.lit(0)).otherwise(F.col("volume")),
            "adj_factor": F.when(n % 7 == 0, 0.0).when(n % 5 == 0, F.lit(None)).otherwise(1.25),
            "name": F.when(n % 9 == 0, F.concat(F.lit("*St "), F.col("code"))).otherwise(F.concat(F.lit("co "), F.col("code"))),
        }
    )
    return b.union(b.filter(day() == 11))


def source_a(spark: SparkSession, d: str) -> DataFrame:
    return bars(spark, d).select("code", "trade_date", "close", "volume", F.concat(F.lit(" Co "), "code").alias("name"))


def source_b(spark: SparkSession, d: str) -> DataFrame:
    """A disturbed copy: codes gone and added, prices shifted, names in other case."""
    a = bars(spark, d)
    n = code_number()
    kept = a.filter(n % 10 != 0).select(
        F.when(n % 23 == 0, F.concat(F.lit("x"), F.col("code"))).otherwise(F.col("code")).alias("code"),
        "trade_date",
        F.when(day() % 7 == 0, F.col("close") + (n % 4) * 40.0).when((day() == 5) & (n % 3 == 0), F.lit(None)).otherwise(F.col("close")).alias("close"),
        F.when(day() == 8, F.col("volume") + 2000).otherwise(F.col("volume")).alias("volume"),
        F.when(n % 6 == 0, F.lit("other")).otherwise(F.upper(F.concat(F.lit("co "), "code"))).alias("name"),
    )
    return kept


_DAY = "CAST(day(trade_date) AS BIGINT)"
_N = "CAST(code AS BIGINT)"

SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "bars": (
        (),
        """SELECT lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS code, CAST(l_shipdate AS DATE) AS trade_date,
  first(px ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) AS open, max(px) AS high, min(px) AS low,
  last(px ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) AS close,
  CAST(sum(l_quantity) AS BIGINT) AS volume, round(sum(l_extendedprice), 2) AS amount
FROM (SELECT *, l_extendedprice / nullif(l_quantity, 0) AS px FROM lineitem) GROUP BY 1, 2""",
    ),
    "changes": (("bars",), "SELECT code, trade_date, close, round((close / nullif(lag(close) OVER (PARTITION BY code ORDER BY trade_date), 0) - 1) * 100.0::DOUBLE, 4) AS pct_change FROM bars"),
    "finance": (
        (),
        """SELECT code, report_period, r AS revenue, r * 0.6::DOUBLE AS cost_of_goods_sold, r * 0.1::DOUBLE - n * 100.0::DOUBLE AS net_profit, r * 2.0::DOUBLE AS total_assets,
  r * 0.8::DOUBLE + n AS total_liabilities, r * 1.2::DOUBLE - n AS shareholders_equity, r * 0.5::DOUBLE AS current_assets, r * 0.25::DOUBLE + n AS current_liabilities,
  r * 0.15::DOUBLE - n * 50.0::DOUBLE AS operating_cash_flow, r / 100000.0::DOUBLE - n AS eps, n + 5.0::DOUBLE AS bps, n * 0.2::DOUBLE AS dividend, r * 3.0::DOUBLE AS market_cap, n + 10.0::DOUBLE AS close
FROM (SELECT CAST(c_nationkey AS VARCHAR) AS code, CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS report_period,
        round(sum(o_totalprice), 2) AS r, CAST(count(*) AS DOUBLE) AS n
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)""",
    ),
    "flows": (
        (),
        """SELECT CAST(l_shipdate AS DATE) AS trade_date, round(coalesce(sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END), 0), 2) AS buy_amount,
  round(coalesce(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END), 0), 2) AS sell_amount,
  round(coalesce(sum(CASE WHEN l_linestatus = 'O' THEN l_extendedprice END), 0), 2) AS margin_balance,
  round(coalesce(sum(CASE WHEN l_linestatus = 'F' THEN l_extendedprice END), 0), 2) AS short_balance, 'ALL' AS code FROM lineitem GROUP BY 1""",
    ),
    "minute_bars": (
        (),
        """SELECT event_type AS code, date_trunc('hour', ts) AS trade_time, first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
  last(value ORDER BY ts, event_id) AS close, count(*) AS volume, round(sum(value), 4) AS amount FROM events GROUP BY 1, 2""",
    ),
    "futures": (
        ("bars",),
        f"""SELECT *, 'U' || CAST({_N} % 5 AS VARCHAR) AS underlying, 'CFFEX' AS exchange, close * CASE WHEN {_DAY} % 3 = 0 THEN 1.2::DOUBLE ELSE 1.01::DOUBLE END AS settle,
  volume * 2 + {_N} AS open_interest, CAST({_N} % 20 AS DOUBLE) AS margin_rate, 300.0::DOUBLE AS contract_multiplier, trade_date + CAST({_N} % 60 AS INTEGER) AS expiry_date FROM bars""",
    ),
    "options": (
        ("bars",),
        f"""SELECT *, CAST({_N} % 40 AS DOUBLE) * 50.0::DOUBLE AS strike_price, CASE WHEN {_N} % 2 = 0 THEN 'call' ELSE 'put' END AS option_type, volume + {_DAY} AS open_interest,
  CAST(volume AS DOUBLE) / 2.0::DOUBLE AS implied_volatility, CAST({_DAY} - 15 AS DOUBLE) / 20.0::DOUBLE AS delta, trade_date + CAST({_N} % 20 AS INTEGER) AS expiry_date FROM bars""",
    ),
    "bonds": (("bars",), f"SELECT *, CAST({_N} % 30 AS DOUBLE) * 40.0::DOUBLE AS conversion_price, trade_date + CAST({_N} * 9 AS INTEGER) AS maturity_date FROM bars"),
    "dirty1": (
        ("bars",),
        f"""SELECT CASE WHEN {_N} % 11 = 0 AND {_DAY} = 3 THEN NULL ELSE code END AS code, trade_date,
  CASE WHEN {_N} % 17 = 0 AND {_DAY} = 7 THEN -open ELSE open END AS open, CASE WHEN {_N} % 13 = 0 AND {_DAY} = 5 THEN low - 1.0::DOUBLE ELSE high END AS high, low, close,
  CASE WHEN {_N} % 19 = 0 AND {_DAY} = 9 THEN 0 ELSE volume END AS volume, amount, CASE WHEN {_N} % 7 = 0 THEN 0.0::DOUBLE WHEN {_N} % 5 = 0 THEN NULL ELSE 1.25::DOUBLE END AS adj_factor,
  CASE WHEN {_N} % 9 = 0 THEN '*St ' || code ELSE 'co ' || code END AS name FROM bars""",
    ),
    "dirty": (("dirty1",), f"SELECT * FROM dirty1 UNION ALL SELECT * FROM dirty1 WHERE {_DAY} = 11"),
    "source_a": (("bars",), "SELECT code, trade_date, close, volume, ' Co ' || code AS name FROM bars"),
    "source_b": (
        ("bars",),
        f"""SELECT CASE WHEN {_N} % 23 = 0 THEN 'x' || code ELSE code END AS code, trade_date,
  CASE WHEN {_DAY} % 7 = 0 THEN close + ({_N} % 4) * 40.0::DOUBLE WHEN {_DAY} = 5 AND {_N} % 3 = 0 THEN NULL ELSE close END AS close,
  CASE WHEN {_DAY} = 8 THEN volume + 2000 ELSE volume END AS volume, CASE WHEN {_N} % 6 = 0 THEN 'other' ELSE upper('co ' || code) END AS name
FROM bars WHERE {_N} % 10 <> 0""",
    ),
}


def with_views(names: str, select: str, recursive: bool = False) -> str:
    """``select`` with the views that it names, and those that these need."""
    order: list[str] = []

    def add(name: str) -> None:
        needs, _ = SQL[name]
        for n in needs:
            add(n)
        if name not in order:
            order.append(name)

    for n in names.split():
        add(n)
    views = ",\n".join(f"{n} AS MATERIALIZED ({SQL[n][1]})" for n in order)
    return f"WITH {'RECURSIVE ' if recursive else ''}{views}\n{select}" if not select.lstrip().startswith(",") else f"WITH {'RECURSIVE ' if recursive else ''}{views}{select}"
