"""Tables, cleaning, factors, analysis, validation and storage on small frames."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemill.operators import analysis, cleaning, diffs, factors, linkage, report, resolve, rules
from tidemill.operators.tables import TABLES
from tidemill.plans import config
from tidemill.sources import fetch, storage
from tidemill.sources.datasource import register
from tidemill.sources.tasks import TaskLog, TaskTracer
from tidemill.sources.vendors import VENDORS, search

D = dt.date(2025, 1, 2)
BARS = "code string, trade_date date, open double, high double, low double, close double, volume bigint, amount double"
GOOD = ("000001.SZ", D, 10.0, 10.5, 9.8, 10.2, 1_000_000, 1e7)


def bars(spark, *rows):
    return spark.createDataFrame(list(rows), BARS)


def issues(df):
    return {r.issue for r in df.filter("violated").collect()}


# --- tables -----------------------------------------------------------------------------


def test_daily_checks_and_filter(spark):
    bad = [("a", D, 10.0, 9.0, 10.5, 10.0, 1, 1.0), ("b", D, -10.0, 10.0, 9.0, 10.0, 1, 1.0), ("c", D, 10.0, 10.0, 9.0, 10.0, -1000, 1.0), ("d", D, None, None, None, None, None, None)]
    df = bars(spark, GOOD, *bad)
    spec = TABLES["daily"]
    assert issues(spec.validate(df)) == {"high_below_low", "negative_price", "negative_volume"}
    assert issues(spec.validate(bars(spark, GOOD))) == set()
    assert sorted(r.code for r in spec.drop_invalid(df).collect()) == ["000001.SZ", "d"]
    assert issues(spec.validate(df.drop("close"))) == {"missing:close"}
    assert spec.drop_invalid(df.drop("close")).count() == 0


def test_every_table_is_declared():
    assert set(TABLES) == {"daily", "minute", "finance", "north_flow", "margin_trade", "alternative", "reference", "convertible_bond", "futures", "options"}
    for t in TABLES.values():
        assert set(t.required) <= set(t.struct.names)
        assert set(t.key) <= set(t.struct.names)


def test_conform_turns_nan_into_null(spark):
    df = spark.createDataFrame([("a", float("nan"), "7.5")], "code string, open double, close string")
    assert tuple(TABLES["daily"].conform(df).first()) == ("a", None, 7.5)


# --- cleaning ---------------------------------------------------------------------------


def test_universal(spark):
    df = bars(spark, GOOD, GOOD, ("000001", None, *GOOD[2:]), ("600000", D, *GOOD[2:]))
    assert sorted(r.code for r in cleaning.universal(df).collect()) == ["000001.SZ", "600000.SH"]


def test_adjustment_status_ohlc(spark):
    df = bars(spark, GOOD).withColumns({"adj_factor": F.lit(1.1), "name": F.lit("*ST x")})
    r = cleaning.ohlc(cleaning.status(cleaning.adjustment(df))).first()
    assert (round(r.open, 6), round(r.close, 6), r.volume, r.is_st, r.is_suspended, r.ohlc_valid) == (11.0, 11.22, 909090, True, False, True)
    assert cleaning.adjustment(df.withColumn("adj_factor", F.lit(0.0))).first().adj_factor == 1.0
    assert cleaning.adjustment(bars(spark, GOOD)).columns == bars(spark, GOOD).columns
    assert not cleaning.ohlc(bars(spark, ("a", D, 10.0, 9.0, 10.5, 10.0, 1, 1.0))).first().ohlc_valid


def test_instruments(spark):
    f = spark.createDataFrame([("IF2501", D, 100000), ("IF2502", D, 150000), ("IF2503", D, 80000)], "code string, trade_date date, volume bigint")
    assert [r.code for r in cleaning.futures(f).filter("is_main_contract").collect()] == ["IF2502"]
    oi = spark.createDataFrame([("a", dt.date(2025, 1, i), v) for i, v in ((1, 50000), (2, 55000), (3, 52000))], "code string, trade_date date, open_interest bigint")
    assert [r.oi_change for r in cleaning.futures(oi).orderBy("trade_date").collect()] == [0, 5000, -3000]
    o = spark.createDataFrame([("call", 0.55), ("call", 3000.0), ("call", 2600.0), ("put", 2600.0), ("put", 2800.0)], "option_type string, close double").withColumn("strike_price", F.lit(2800.0))
    assert [r.option_status for r in cleaning.options(o).collect()] == ["out_of_the_money", "in_the_money", "out_of_the_money", "in_the_money", "at_the_money"]
    b = spark.createDataFrame([(102.0, 10.0, D)], "close double, conversion_price double, maturity_date date")
    r = cleaning.convertible_bond(b, "2024-06-01").first()
    assert r.conversion_value == pytest.approx(1020.0)
    assert (r.high_premium, r.near_maturity) == (False, True)
    assert cleaning.convertible_bond(b.withColumn("conversion_value", F.lit(100.0))).first().premium_rate == pytest.approx(2.0)


def test_quality(spark):
    df = bars(spark, GOOD, GOOD, ("b", D, 10.0, 9.0, 9.5, 9.2, None, 1.0))
    r = cleaning.quality_parts(df, "2025-02-01").first()
    assert r.total_records == 3
    assert r.completeness == pytest.approx((1 - 1 / 24) * 100)
    assert r.consistency == pytest.approx((1 - 1 / 3) * 100)
    assert r.timeliness == pytest.approx(50.0)
    assert r.accuracy == pytest.approx(80.0)
    assert cleaning.quality_parts(df.limit(0)).first().quality_score == 100.0
    made = cleaning.quality_report(df, "daily", "p", "2025-02-01")
    assert {i.dimension for i in made["issues"]} == {"consistency", "timeliness", "accuracy"}
    assert cleaning.quality(df).count() == 3


def test_chain_and_its_checks(spark):
    df = bars(spark, GOOD).withColumn("settle", F.lit(20.0))
    assert issues(cleaning.issues(cleaning.clean(df, as_of="2025-01-02"))) == {"[futures] settle far from close"}


# --- factors ----------------------------------------------------------------------------


def test_registry():
    assert len(factors.REGISTRY) == 38
    by = {c: len(factors.REGISTRY.names(c)) for c in factors.Category}
    assert list(by.values()) == [14, 15, 9]
    assert "atr" in factors.REGISTRY and "momentum_5d" in factors.REGISTRY.by_tag("momentum")
    with pytest.raises(ValueError):
        factors.REGISTRY.register(factors.REGISTRY.get("atr"))
    with pytest.raises(KeyError):
        factors.REGISTRY.get("none")


def test_missing_column_gives_a_failed_result(spark):
    r = factors.compute("rsi", spark.createDataFrame([("a", D)], "code string, trade_date date"))
    assert not r.success and r.error_message == "Missing 'close' column"


def test_rsi_of_a_rise_is_100_and_of_a_flat_line_null(spark):
    rows = [("up", dt.date(2025, 1, i), float(i)) for i in range(1, 21)] + [("flat", dt.date(2025, 1, i), 1.0) for i in range(1, 21)]
    r = factors.calculate(spark.createDataFrame(rows, "code string, trade_date date, close double"), ["rsi"])
    last = {x.code: x.rsi_14 for x in r.filter("trade_date = '2025-01-20'").collect()}
    assert last == {"up": 100.0, "flat": None}
    assert r.filter("trade_date = '2025-01-13' and rsi_14 is not null").count() == 0


def test_parameters_change_the_name(spark):
    df = spark.createDataFrame([("a", dt.date(2025, 1, i), float(i)) for i in range(1, 6)], "code string, trade_date date, close double")
    out = factors.compute("momentum", df, window=2).data
    assert [r.momentum_2d for r in out.orderBy("trade_date").collect()] == [None, None, 2.0, 1.0, pytest.approx(2 / 3)]


def test_breadth_ratio_without_decliners(spark):
    df = spark.createDataFrame([("a", D, 11.0), ("b", D, 1.0)], "code string, trade_date date, pct_change double")
    r = factors.breadth(df).first()
    assert (r.limit_up_count, r.advance_decline_ratio, r.market_breadth) == (1, float("inf"), 1.0)
    assert factors.breadth(df.limit(0), by=None).first().market_breadth == 0.5


def test_all_calculate(spark, data):
    from tidemill.plans import views

    b = views.changes(spark, data).join(views.bars(spark, data).drop("close"), ["code", "trade_date"]).withColumn("turnover", F.lit(1.0))
    names = [n for n in factors.REGISTRY.names() if set(factors.REGISTRY.get(n).meta.required) <= set(b.columns)]
    assert len(names) == 19
    assert factors.calculate(b, names).count() == b.count()


# --- analysis ---------------------------------------------------------------------------


def test_normalizers(spark, tmp_path):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (5.0,), (None,)], "x double")
    assert sorted(r.r for r in analysis.rank(df, "x", "r").collect() if r.r) == [0.25, 0.625, 0.625, 1.0]
    same = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert {r.z for r in analysis.zscore(same, "x", "z").collect()} == {0.0}
    assert {r.z for r in analysis.minmax(same, "x", "z").collect()} == {0.5}
    n = analysis.Normalizer().fit(df, "x")
    n.save(str(tmp_path / "n.json"))
    again = analysis.Normalizer.load(str(tmp_path / "n.json"))
    assert [r.y for r in again.apply(df, "x", "minmax", "y").collect()] == [0.0, 0.25, 0.25, 1.0, None]


def test_running_total_is_exact(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"), F.lit(2).alias("n"))
    out = analysis.running_total(df, "v", "n", "before").collect()
    assert all(r.before == 2 * int(r.v) for r in out)


def test_ic_of_a_panel(spark):
    rows = [(f"a{i}", dt.date(2025, 1, d), i + 0.1 * d, i + 0.1 * d) for i in range(10) for d in range(1, 11)]
    df = spark.createDataFrame(rows, "code string, trade_date date, factor double, forward_return double")
    r = analysis.analyze(df).first()
    assert r.ic_mean == pytest.approx(1.0) and r.ic_std == pytest.approx(0.0, abs=1e-9)
    one_a_day = df.filter("code = 'a1'")
    assert tuple(analysis.ic(one_a_day).first()) == (0.0, 0.0)


# --- validation -------------------------------------------------------------------------


def test_rules(spark):
    df = spark.createDataFrame([("A", 10.0), ("B", 20.0), ("A", 40.0)], "code string, price double")
    passed = lambda r: (r.first().passed, r.first().violations)
    assert passed(rules.unique(df, "code")) == (False, 1)
    assert passed(rules.unique_combination(df, ["code"])) == (False, 2)
    assert passed(rules.not_null(df, "code")) == (True, 0)
    assert passed(rules.not_null_combination(df, ["code", "price"])) == (True, 0)
    r = rules.in_range(df, "price", 5, 35).first()
    assert (r.passed, json.loads(r.details)["above_max"]) == (False, 1)
    assert passed(rules.accepted_values(df, "code", ["A"])) == (False, 1)
    other = spark.createDataFrame([("A",), ("C",)], "symbol string")
    assert passed(rules.relationships(df, "code", other, "symbol")) == (False, 1)
    assert [passed(rules.cross_reference(df, "code", other, "symbol", d))[1] for d in ("both", "source_to_target", "target_to_source")] == [2, 1, 1]
    assert not rules.not_null(df, "none").first().passed


def test_similarities():
    assert linkage.ratio("apple", "appel") == pytest.approx(0.8)
    assert linkage.ratio("", "") == 1.0 and linkage.ratio("", "a") == 0.0
    assert linkage.jaro_winkler("martha", "marhta") == pytest.approx(0.9611, abs=1e-4)
    assert linkage.jaro_winkler("dixon", "dicksonx") == pytest.approx(0.8133, abs=1e-4)
    assert linkage.jaro_winkler("abc", "xyz") == 0.0


def test_linkers(spark):
    s = linkage.numbered(spark.createDataFrame([("Apple Inc",), ("Google LLC",), ("Microsoft",)], "name string"), "name")
    t = linkage.numbered(spark.createDataFrame([("Apple Inc.",), ("Google LLC",), ("Microsft",)], "company string"), "company")
    for algorithm in linkage.SIMILARITIES:
        assert linkage.fuzzy(s, t, [("name", "company")], 0.7, algorithm).count() >= 2
    assert linkage.fuzzy(s, t, [("name", "company")], 0.999).count() == 1
    assert linkage.exact(s, t, [("name", "company")]).count() == 1
    assert all(0 <= r.confidence <= 1 for r in linkage.probabilistic(s, t, [("name", "company")], 0.0).collect())
    nulls = linkage.numbered(spark.createDataFrame([(None,)], "name string"), "name")
    assert linkage.exact(nulls, nulls, [("name", "name")]).count() == 1


def test_unblocked_linkage_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(linkage, "MOST_UNBLOCKED", 2)
    df = linkage.numbered(spark.range(3).select(F.col("id").cast("string").alias("x")), "x")
    with pytest.raises(ValueError):
        linkage.fuzzy(df, df, [("x", "x")])


def test_two_sources_end_to_end(spark):
    schema = "code string, trade_date date, close double, volume bigint"
    a = spark.createDataFrame([("000001.SZ", D, 10.5, 1), ("600000.SH", D, 12.3, 1), ("000002.SZ", D, 8.7, 1)], schema)
    b = spark.createDataFrame([("000001.SZ", D, 10.5, 1), ("600000.SH", D, 12.5, 1), ("000003.SZ", D, 9.1, 1)], schema)
    found = diffs.field_diff(a, b, ["code", "trade_date"]).unionByName(diffs.row_diff(a, b, ["code", "trade_date"]))
    summary = diffs.summarize(found, 3, 3)
    assert (summary.total, summary.value, summary.missing, summary.diff_rate) == (3, 1, 2, 0.5)
    r = diffs.of_type(found, "value").first()
    assert (r.column, r.severity, r.key) == ("close", "low", "600000.SH|2025-01-02")
    resolved = resolve.priority(diffs.of_type(found, "value").withColumns({"source": F.lit("akshare"), "target": F.lit("baostock")}), {"akshare": 1, "baostock": 2})
    assert (resolved.first().resolved_value, resolved.first().confidence) == ("12.3", 0.9)
    done = resolve.resolution_counts(resolved).first()
    made = report.report("a", "b", summary, report.ResolutionSummary(done.total_conflicts, done.resolved_count))
    assert made.summary["quality_score"] == 70.0 and made.summary["quality_grade"] == "B"
    assert made.report_id.startswith("VR-") and "<table>" in made.to_html() and json.loads(made.to_json())
    calls = []
    monitor = report.Monitor(callbacks=[calls.append, lambda a: 1 / 0])
    assert [a.level for a in monitor.check(summary)] == ["error"] == [a.level for a in calls]
    assert monitor.get("error") and monitor.summary()["total_alerts"] == 1


def test_field_diff_tolerance_text_and_nulls(spark):
    a = spark.createDataFrame([(1, 1.0, "Apple", None), (2, 5.0, "x", 1.0)], "k int, v double, s string, n double")
    b = spark.createDataFrame([(1, 1.0000001, " apple\t", None), (2, 2000.0, "y", None)], "k int, v double, s string, n double")
    got = {(r.column, r.severity) for r in diffs.field_diff(a, b, ["k"]).collect()}
    assert got == {("v", "critical"), ("s", "medium"), ("n", "medium")}


def test_voting_and_merge(spark):
    df = spark.createDataFrame([(10.0, 12.0, [10.0, 10.0, 12.0]), (None, None, []), (1.0, 2.0, [])], "source_value double, target_value double, more array<double>")
    assert [r.resolved_value for r in resolve.voting(df, "more").collect()] == [10.0, None, 1.0]
    m = spark.createDataFrame([("a", "b"), ("a", "a"), (None, "b"), (None, None)], "source_value string, target_value string").withColumn("column", F.lit("c"))
    assert [(r.resolved_value, r.confidence) for r in resolve.merge(m).collect()] == [("a | b", 0.7), ("a", 0.7), ("b", 1.0), (None, 0.0)]


# --- sources and storage ----------------------------------------------------------------


def daily(spark, *rows):
    return spark.createDataFrame([("stock", *r) for r in rows], "asset_type string, " + BARS)


def test_store_round_trip_pruning_and_upsert(spark, tmp_path):
    store = storage.ParquetStore(spark, f"file://{tmp_path}")
    assert store.read(storage.Query("daily")).count() == 0
    jan, feb = GOOD, ("b", dt.date(2025, 2, 3), *GOOD[2:])
    store.write("daily", daily(spark, jan, feb))
    query = storage.Query("daily", ("code", "year", "month"), start=dt.date(2025, 2, 1))
    assert [tuple(r) for r in store.read(query).collect()] == [("b", "2025", "02")]
    plan = store.read(query)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "PushedFilters: [IsNotNull(trade_date)" in plan
    store.upsert("daily", daily(spark, (*jan[:5], 11.0, *jan[6:])))
    assert {(r.code, r.close) for r in store.read(storage.Query("daily")).collect()} == {("000001.SZ", 11.0), ("b", 10.2)}
    assert store.exists("daily", month="02") and not store.exists("daily", month="07")
    with pytest.raises(storage.StoreError):
        storage.backend("postgres")


def test_factor_store_and_cache(spark, tmp_path):
    store = storage.FactorStore(spark, f"file://{tmp_path}")
    df = spark.createDataFrame([(dt.date(2025, 1, i), "a", i) for i in range(1, 11)], "trade_date date, code string, value bigint")
    store.save("f", df, factors.REGISTRY.metadata("atr"))
    assert store.metadata("f") == factors.REGISTRY.metadata("atr")
    assert [r.value for r in store.latest("f", 3).collect()] == [10, 9, 8]
    assert store.query("f", ["a"], dt.date(2025, 1, 9), columns=["value"]).count() == 2
    assert "TakeOrderedAndProject" in store.latest("f", 3)._jdf.queryExecution().executedPlan().toString()
    assert store.names() == ["f"] and store.exists("f") and store.delete("f") and not store.exists("f")
    with pytest.raises(FileNotFoundError):
        store.load("f")
    now = [0.0]
    cache = storage.FactorCache(10, lambda: now[0])
    double = cache.cached(lambda d: d.withColumn("v2", F.col("value") * 2))
    assert double(df) is double(df)
    now[0] = 11.0
    first = double(df)
    assert first.count() == 10
    cache.clear()


def test_vendor_frames(spark):
    raw = spark.createDataFrame([("600000", "2025-01-02", 10.0, 5)], "code string, `日期` string, `开盘` double, `成交量` bigint")
    r = VENDORS["akshare"].map(raw).first()
    assert (r.code, r.trade_date, r.open, r.volume, r.asset_type) == ("600000.SH", D, 10.0, 5, "stock")
    raw = spark.createDataFrame([("sh.600000", "2025-01-02", "10.0", "x")], "code string, date string, open string, volume string")
    r = VENDORS["baostock"].map(raw).first()
    assert (r.code, r.open, r.volume) == ("600000.SH", 10.0, None)


def test_fallback_retry_and_update(spark, tmp_path):
    registry, waits = fetch.SourceRegistry(), []
    rows = spark.createDataFrame([("600000", "2025-01-02", 10.0, 10.5, 9.8, 10.2, 5, 1.0)], "code string, trade_date string, open double, high double, low double, close double, volume bigint, amount double")
    rows.write.parquet(f"file://{tmp_path}/landing")
    tries = []

    def limited(*_):
        tries.append(1)
        raise fetch.RateLimited("slow down")

    limited.offline = True
    registry.register("daily", fetch.Source(VENDORS["mootdx"], fetch.landed(f"file://{tmp_path}/landing"), 50))
    registry.register("daily", fetch.Source(VENDORS["jqdata"], limited, 100))
    store = storage.ParquetStore(spark, f"file://{tmp_path}/store")
    spec = fetch.FetchSpec("stock", "daily", ("600000.SH", "000001.SZ"))
    got = fetch.run(spark, registry, store, spec, as_of="2025-01-02", sleep=waits.append)
    assert (got.status, got.source, got.rows, got.failed_codes, got.fallback_used) == ("partial", "mootdx", 1, ("000001.SZ",), True)
    assert waits == [5.0, 10.0] and len(tries) == 3
    with pytest.raises(fetch.PipelineError):
        fetch.update(spark, registry, store, "stock", "daily", dt.date(2025, 1, 9), sleep=waits.append)


def test_data_source_reads_each_code(spark):
    register(spark, "fake_vendor", "code string, n int", lambda code, options: [(code, i) for i in range(2)])
    df = spark.read.format("fake_vendor").option("codes", "a,b").load()
    assert sorted(map(tuple, df.collect())) == [("a", 0), ("a", 1), ("b", 0), ("b", 1)]


def test_search(spark):
    df = spark.createDataFrame([("sh.600519", "Moutai", "1", "1"), ("sz.000001", "Bank", "2", "0")], "code string, code_name string, type string, status string")
    assert [tuple(r) for r in search(df, "mou").collect()] == [("600519.SH", "Moutai", "Stock", "Listed")]
    assert search(df, "000001").first().status == "Delisted"


def test_tasks_and_config(spark, tmp_path):
    t = TaskTracer(str(tmp_path / "t.db"))
    t.start("a", "daily", dt.datetime(2025, 1, 1))
    t.start("b", "daily", dt.datetime(2025, 1, 2))
    t.finish("a", "success", rows=5)
    assert t.get("a")["status"] == "success" and t.get("a")["rows"] == 5 and t.get("c") is None
    assert [r["task_id"] for r in t.recent(5, "daily")] == ["b", "a"]
    log = TaskLog(str(tmp_path / "logs"), keep_days=30)
    log.write("a", "INFO", "hello", dt.datetime(2025, 1, 1), rows=3)
    log.write("a", "INFO", "again", dt.datetime(2025, 3, 1))
    assert log.read(spark).count() == 2
    assert log.cleanup(dt.date(2025, 3, 2)) == 1
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"attempts": 5, "priorities": {"daily": {"x": 1}, "nothing": {}}}))
    assert config.load(str(path)).attempts == 5 and list(config.load(str(path)).priorities) == ["daily"]


def test_entry(spark, data):
    import __spark_entry__ as entry

    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q) and len(q) > 90
    assert q["factors_flagship"](spark, data).count() > 0


def test_command_line(spark, tmp_path, capsys):
    from tidemill import cli

    row = ("600000", "2025-01-02", 10.0, 10.5, 9.8, 10.2, 5, 1.0)
    names = "code string, `日期` string, `开盘` double, `最高` double, `最低` double, `收盘` double, `成交量` bigint, `成交额` double"
    spark.createDataFrame([row, (row[0], "2025-01-03", *row[2:])], names).write.parquet(f"file://{tmp_path}/landing/akshare")
    base = ["--data-dir", str(tmp_path / "data"), "--log-dir", str(tmp_path / "logs")]
    common = ["--asset-type", "stock", "--table", "daily", "--landing", str(tmp_path / "landing")]
    assert cli.main([*base, "fetch", *common, "--start-date", "2025-01-01", "--end-date", "2025-01-02"], spark) == 0
    assert cli.main([*base, "update", *common], spark) == 0
    assert cli.main([*base, "fetch", *common, "--start-date", "2025-02-01", "--end-date", "2025-01-02"], spark) == 1
    assert cli.main([*base, "status"], spark) == 0
    store = storage.ParquetStore(spark, f"file://{tmp_path}/data")
    assert store.read(storage.Query("daily")).count() == 2
    instruments = spark.createDataFrame([("sh.600519", "Moutai", "1", "1")], "code string, code_name string, type string, status string")
    instruments.write.parquet(f"file://{tmp_path}/instruments")
    assert cli.main([*base, "search", "mou", "--instruments", f"file://{tmp_path}/instruments"], spark) == 0
    out = capsys.readouterr().out
    assert "success: 1 rows from akshare" in out and "600519.SH  Moutai" in out and "failed" in out


def test_row_numbers_over_several_ranges(spark):
    df = spark.range(1000, numPartitions=7).select(((F.col("id") * 7919) % 1000).alias("v"))
    assert all(r._row == r.v for r in linkage.numbered(df, "v").collect())


# --- whole tables in the queries --------------------------------------------------------


@pytest.fixture
def all_bars(spark, data):
    from tidemill.plans import views

    return {(r.code, r.trade_date): r.close for r in views.bars(spark, data).collect()}


def test_conflicts_and_report_are_of_all_years(spark, data, all_bars):
    from tidemill.queries import QUERIES

    # Prices of source_b that differ: shifted on days 7, 14, 21 and 28, or null on day 5.
    kept = {(c, t) for c, t in all_bars if int(c) % 10 and int(c) % 23}
    want = {f"{c}|{t}" for c, t in kept if (t.day % 7 == 0 and int(c) % 4) or (t.day == 5 and int(c) % 3 == 0)}
    got = [r.key for r in QUERIES["r1_priority"](spark, data).collect()]
    assert len({k[-10:-6] for k in want}) > 1
    assert len(got) == len(want) and set(got) == want
    shifted = {(c, t) for c, t in kept if t.day == 8}
    named = {(c, t) for c, t in kept if int(c) % 6 == 0}
    gone = [(c, t) for c, t in all_bars if int(c) % 10 == 0 or int(c) % 23 == 0]
    added = [(c, t) for c, t in all_bars if int(c) % 10 and int(c) % 23 == 0]
    found = len(want) + len(shifted) + len(named) + len(gone) + len(added)
    rows = len(all_bars) + sum(1 for c, _ in all_bars if int(c) % 10)
    assert QUERIES["r6_report"](spark, data).first().diff_rate == pytest.approx(found / rows, abs=1e-4)


@pytest.mark.parametrize("name, extra", [("p2_partition_read", 0), ("p3_upsert", 1), ("st_stream_upsert", 0)])
def test_stores_hold_all_years(spark, data, all_bars, tmp_path, monkeypatch, name, extra):
    from tidemill.queries import QUERIES, sources

    monkeypatch.setattr(sources, "_folder", lambda _: str(tmp_path))
    assert QUERIES[name](spark, data).count()
    root = tmp_path / "store" if name == "st_stream_upsert" else tmp_path
    stored = storage.ParquetStore(spark, str(root)).read(storage.Query("daily")).collect()
    assert len(stored) == len(all_bars) + extra
    changed = lambda r: name == "p3_upsert" and (r.trade_date.year, r.trade_date.month) == (1996, 3) and r.code < "000005"
    assert all(r.close == all_bars[r.code, r.trade_date] + changed(r) for r in stored if r.code != "new")


STUB = """
import pandas as pd

def stock_zh_a_hist(symbol, period, start_date, end_date, adjust):
    if symbol == "000404":
        raise RuntimeError("no such code")
    return pd.DataFrame({"日期": ["2025-01-02", "2025-01-03"], "开盘": [1.0, 2.0], "收盘": [1.5, float("nan")], "最高": [2.0, 3.0], "最低": [0.5, 1.0], "成交量": [10, 20], "成交额": [15.0, 40.0], "股票代码": [symbol] * 2})

def stock_financial_abstract_ths(symbol):
    return pd.DataFrame({"报告期": ["2024-09-30", "2024-12-31"], "净利润": ["1.5亿", "-20万"], "基本每股收益": ["0.5", "bad"], "净资产收益率": ["4.5%", None]})

def query_history_k_data_plus(code, fields, start_date, end_date, frequency, adjustflag=None):
    class Result:
        error_code, error_msg, fields = "0", "", ["date", "code", "open", "high", "low", "close", "volume", "amount"]
        rows = [["2025-01-02", code, "1.0", "2.0", "0.5", "1.5", "10", "15"]]
        def next(self): return bool(self.rows)
        def get_row_data(self): return self.rows.pop()
    return Result()
"""


def test_readers_ask_a_vendor_for_each_code(spark, tmp_path):
    from dataclasses import replace

    from tidemill.sources import readers
    from tidemill.sources.vendors import vendor

    (tmp_path / "stub_market.py").write_text(STUB, encoding="utf-8")
    spark.sparkContext.addPyFile(str(tmp_path / "stub_market.py"))
    call = lambda *key: replace(readers.CALLS[key], module="stub_market", interval=0.0)
    read = readers.reader("akshare", "daily", "stock", call("akshare", "daily", "stock"))
    spec = fetch.FetchSpec("stock", "daily", ("000001.SZ", "600000.SH"), dt.date(2025, 1, 1), dt.date(2025, 1, 9))
    got = vendor("akshare", "daily").map(read(spark, spec)).collect()
    assert sorted((r.code, r.trade_date.day, r.close, r.volume) for r in got if r.close is not None) == [("000001.SZ", 2, 1.5, 10), ("600000.SH", 2, 1.5, 10)] and len(got) == 4
    among = replace(spec, codes=(), among=spark.createDataFrame([("000001.SZ",)], "code string"))
    assert read(spark, among).count() == 2
    statements = vendor("akshare", "finance").map(readers.reader("akshare", "finance", "stock", call("akshare", "finance", "stock"))(spark, spec))
    rows = sorted((r.code, r.report_period, r.report_type, r.net_profit, r.eps, r.roe) for r in statements.filter("code = '000001.SZ'").collect())
    assert rows == [("000001.SZ", "2024Q3", "quarterly", 1.5e8, 0.5, 4.5), ("000001.SZ", "2024Q4", "annual", -2e5, None, None)]
    index = vendor("baostock", "daily").map(readers.reader("baostock", "daily", "index", call("baostock", "daily", "index"))(spark, replace(spec, codes=("000001.SH",))))
    assert [(r.code, r.close, r.volume) for r in index.collect()] == [("000001.SH", 1.5, 10)]
    with pytest.raises(Exception, match="no such code"):
        read(spark, replace(spec, codes=("000404.SZ",))).count()


def test_calls_wait_and_try_again_when_limited(tmp_path, monkeypatch):
    from tidemill.sources import readers

    (tmp_path / "stub_limited.py").write_text("asked = []\ndef bars(code):\n    asked.append(code)\n    if len(asked) < 3: raise RuntimeError('Rate limit exceeded')\n", encoding="utf-8")
    monkeypatch.syspath_prepend(str(tmp_path))
    waits: list = []
    call = readers.Call("stub_limited", lambda m, c, s, e, f: m.bars(c), ("x",), interval=0.1)
    assert list(readers.ask(call, "1", None, None, "daily", sleep=waits.append)) == [] and len(waits) == 3 and waits == sorted(waits)
    broken = readers.Call("stub_limited", lambda m, c, s, e, f: (_ for _ in ()).throw(RuntimeError("too frequent")), ("x",), interval=0.0)
    with pytest.raises(fetch.RateLimited):
        list(readers.ask(broken, "1", None, None, "daily", sleep=waits.append))
    assert all(c.schema().startswith("`code` string") for c in readers.CALLS.values())
    from tidemill.sources.vendors import vendor

    assert all(vendor(name, table) for name, table, _ in readers.CALLS)


def test_a_source_that_takes_too_long_is_left(spark):
    import time

    from pyspark.sql import functions as F

    slow = F.udf(lambda x: time.sleep(30), "string")
    with pytest.raises(fetch.SourceUnavailable, match="took more than"), fetch.time_limit(spark, 1.0, "slow"):
        spark.range(1).select(slow("id")).collect()
    with fetch.time_limit(spark, 30.0, "quick"):
        assert spark.range(3).count() == 3


def test_finance_landing_is_found(spark, tmp_path):
    from tidemill import cli
    from tidemill.plans.config import Config

    raw = spark.createDataFrame([("000001.SZ", "20240930", "20241030", 0.5)], "ts_code string, end_date string, ann_date string, eps double")
    raw.write.parquet(f"{tmp_path}/landing/tushare/finance")
    sources = cli.registry(f"{tmp_path}/landing", Config(priorities={"finance": {"tushare": 1}}))
    row = sources.primary("finance").fetch(spark, fetch.FetchSpec("stock", "finance")).first()
    assert (row.code, row.report_period, row.pub_date) == ("000001.SZ", "2024Q3", dt.date(2024, 10, 30))


def test_fuzzy_compares_distinct_texts_and_names_every_row(spark):
    s = spark.createDataFrame([(i, t) for i, t in enumerate(["abcd", "abcd", None, "zzzz", "abcd", ""])], "_row bigint, x string")
    t = spark.createDataFrame([(i, t) for i, t in enumerate(["abce", "abce", None, "abcf", ""])], "_row bigint, y string")
    for algorithm in ("levenshtein", "edit", "jaro_winkler"):
        got = {r.source_index: (r.target_index, r.match_type) for r in linkage.fuzzy(s, t, [("x", "y")], 0.7, algorithm).collect()}
        assert got == {**dict.fromkeys((0, 1, 4), (0, "fuzzy")), **dict.fromkeys((2, 5), (2, "fuzzy"))}
