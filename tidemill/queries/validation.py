"""Rules, linkage, differences, conflict resolution and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import diffs, linkage, report, resolve, rules
from tidemill.plans import views
from tidemill.plans.views import with_views
from tidemill.queries.registry import query, rounded


def _rule(name: str, violations: str, tail: str) -> str:
    return f"SELECT '{name}' AS rule, v = 0 AS passed, v AS violations FROM (SELECT CAST({violations} AS BIGINT) AS v {tail})"


def _short(df):
    return df.select("rule", "passed", "violations")


@query("v1_unique", with_views("dirty", _rule("unique", "coalesce(sum(n - 1), 0)", "FROM (SELECT count(*) AS n FROM dirty GROUP BY code)")))
def unique(spark, d):
    return _short(rules.unique(views.dirty(spark, d), "code"))


@query("v2_unique_combination", with_views("dirty", _rule("unique_combination", "coalesce(sum(n), 0)", "FROM (SELECT count(*) AS n FROM dirty GROUP BY code, trade_date HAVING count(*) > 1)")))
def unique_combination(spark, d):
    return _short(rules.unique_combination(views.dirty(spark, d), ["code", "trade_date"]))


@query("v2_duplicated_groups", with_views("dirty", "SELECT code, trade_date, count(*) AS rows FROM dirty GROUP BY ALL HAVING count(*) > 1"))
def duplicated(spark, d):
    return rules.duplicated(views.dirty(spark, d), ["code", "trade_date"])


@query("v3_not_null", with_views("dirty", _rule("not_null", "coalesce(sum(CASE WHEN adj_factor IS NULL THEN 1 ELSE 0 END), 0)", "FROM dirty")))
def not_null(spark, d):
    return _short(rules.not_null(views.dirty(spark, d), "adj_factor"))


@query("v4_not_null_combination", with_views("dirty", _rule("not_null_combination", "coalesce(sum(CASE WHEN adj_factor IS NULL OR code IS NULL THEN 1 ELSE 0 END), 0)", "FROM dirty")))
def not_null_combination(spark, d):
    return _short(rules.not_null_combination(views.dirty(spark, d), ["adj_factor", "code"]))


@query("v5_range", with_views("dirty", _rule("range", "coalesce(sum(CASE WHEN open < 0 OR open > 2000 THEN 1 ELSE 0 END), 0)", "FROM dirty")))
def in_range(spark, d):
    return _short(rules.in_range(views.dirty(spark, d), "open", 0.0, 2000.0))


@query("v6_accepted_values", _rule("accepted_values", "count(DISTINCT o_orderpriority)", "FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')"))
def accepted_values(spark, d):
    return _short(rules.accepted_values(views.table(spark, d, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"]))


@query("v7_relationships", with_views("source_a source_b", _rule("relationships", "count(*)", "FROM (SELECT DISTINCT code FROM source_b WHERE code IS NOT NULL AND code NOT IN (SELECT code FROM source_a))")))
def relationships(spark, d):
    return _short(rules.relationships(views.source_b(spark, d), "code", views.source_a(spark, d), "code"))


_NOT_IN = "(SELECT count(*) FROM (SELECT DISTINCT code FROM {a} WHERE code NOT IN (SELECT code FROM {b})))"


@query("v8_cross_reference", with_views("source_a source_b", _rule("cross_reference", _NOT_IN.format(a="source_a", b="source_b") + " + " + _NOT_IN.format(a="source_b", b="source_a"), "")))
def cross_reference(spark, d):
    return _short(rules.cross_reference(views.source_a(spark, d), "code", views.source_b(spark, d), "code"))


@query("v_missing_column", "SELECT 'unique' AS rule, false AS passed")
def missing_column(spark, d):
    return rules.unique(views.table(spark, d, "orders"), "nothing").select("rule", "passed")


# --- linkage ----------------------------------------------------------------------------


def _names(spark, d):
    """Distinct part names, and a disturbed copy of every other one."""
    p = views.table(spark, d, "part").select("p_name").distinct()
    source = linkage.numbered(p, "p_name")
    target = source.filter("_row % 2 = 0").select(F.concat(F.upper(F.substring("p_name", 1, 3)), F.substring("p_name", 5, 200)).alias("t_name"))
    return source, linkage.numbered(target, "t_name")


_NAMES = """s AS (SELECT p_name, row_number() OVER (ORDER BY p_name) - 1 AS si FROM (SELECT DISTINCT p_name FROM part)),
t AS (SELECT t_name, row_number() OVER (ORDER BY t_name) - 1 AS ti FROM (SELECT upper(substr(p_name, 1, 3)) || substr(p_name, 5, 200) AS t_name FROM s WHERE si % 2 = 0))"""


@query(
    "l1_exact",
    with_views(
        "source_a source_b",
        """, s AS (SELECT *, row_number() OVER (ORDER BY code, trade_date) - 1 AS r FROM source_a), t AS (SELECT *, row_number() OVER (ORDER BY code, trade_date) - 1 AS r FROM source_b)
SELECT s.r AS source_index, t.r AS target_index, 1.0::DOUBLE AS confidence, 'exact' AS match_type FROM s JOIN t ON s.code IS NOT DISTINCT FROM t.code AND s.trade_date IS NOT DISTINCT FROM t.trade_date""",
    ),
)
def exact(spark, d):
    keys = [("code", "code"), ("trade_date", "trade_date")]
    return linkage.exact(linkage.numbered(views.source_a(spark, d), "code", "trade_date"), linkage.numbered(views.source_b(spark, d), "code", "trade_date"), keys)


@query("l2_fuzzy_ratio")
def fuzzy_ratio(spark, d):
    s, t = _names(spark, d)
    return rounded(linkage.fuzzy(s, t, [("p_name", "t_name")], 0.7), [])


@query("l2_fuzzy_jaro_winkler")
def fuzzy_jaro(spark, d):
    s, t = _names(spark, d)
    return rounded(linkage.fuzzy(s, t, [("p_name", "t_name")], 0.8, "jaro_winkler"), [])


@query(
    "l2_fuzzy_edit",
    f"""WITH {_NAMES}, p AS (SELECT si, ti, 1.0::DOUBLE - levenshtein(lower(p_name), lower(t_name))::DOUBLE / greatest(length(p_name), length(t_name)) AS c FROM s, t),
k AS (SELECT *, row_number() OVER (PARTITION BY si ORDER BY c DESC, ti) AS n FROM p WHERE c >= 0.6)
SELECT si AS source_index, ti AS target_index, round(c, 6) AS confidence, 'fuzzy' AS match_type FROM k WHERE n = 1""",
)
def fuzzy_edit(spark, d):
    s, t = _names(spark, d)
    return rounded(linkage.fuzzy(s, t, [("p_name", "t_name")], 0.6, "edit"), [])


@query("l2_fuzzy_blocked")
def fuzzy_blocked(spark, d):
    s, t = _names(spark, d)
    block = F.lower(F.substring("p_name", 1, 1)), F.lower(F.substring("t_name", 1, 1))
    return rounded(linkage.fuzzy(s.withColumn("b", block[0]), t.withColumn("b", block[1]), [("p_name", "t_name")], 0.7, blocking=[("b", "b")]), [])


@query(
    "l3_probabilistic",
    """WITH s AS (SELECT n_name, n_regionkey, row_number() OVER (ORDER BY n_nationkey) - 1 AS si FROM nation),
t AS (SELECT CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE lower(n_name) END AS t_name, CASE WHEN n_nationkey % 7 = 0 THEN 9 ELSE n_regionkey END AS t_region, row_number() OVER (ORDER BY n_nationkey) - 1 AS ti FROM nation),
v AS (SELECT si, ti, t_name IS NULL AS m, coalesce(lower(n_name) = t_name, false) AS a, n_regionkey = t_region AS ra FROM s, t),
f AS (SELECT si, ti, a::INT::DOUBLE AS a, (NOT a AND NOT m)::INT::DOUBLE AS d, m::INT::DOUBLE AS m, ra::INT::DOUBLE AS ra, (NOT ra)::INT::DOUBLE AS rd, 0.0::DOUBLE AS rm FROM v),
w AS (SELECT avg(a) AS a, avg(d) AS d, avg(m) AS m, avg(ra) AS ra, avg(rd) AS rd, avg(rm) AS rm FROM f),
l AS (SELECT ln(a / (1 - a + 1e-10::DOUBLE) + 1e-10::DOUBLE) AS a, ln(d / (1 - d + 1e-10::DOUBLE) + 1e-10::DOUBLE) AS d, ln(m / (1 - m + 1e-10::DOUBLE) + 1e-10::DOUBLE) AS m, ln(ra / (1 - ra + 1e-10::DOUBLE) + 1e-10::DOUBLE) AS ra, ln(rd / (1 - rd + 1e-10::DOUBLE) + 1e-10::DOUBLE) AS rd, ln(rm / (1 - rm + 1e-10::DOUBLE) + 1e-10::DOUBLE) AS rm FROM w),
p AS (SELECT si, ti, 1 / (1 + exp(-(f.a * l.a + f.d * l.d + f.m * l.m + f.ra * l.ra + f.rd * l.rd + f.rm * l.rm))) AS c FROM f, l),
k AS (SELECT *, row_number() OVER (PARTITION BY si ORDER BY round(c, 9) DESC, ti) AS n FROM p WHERE c >= 0.2)
SELECT si AS source_index, ti AS target_index, round(c, 6) AS confidence, 'probabilistic' AS match_type FROM k WHERE n = 1""",
)
def probabilistic(spark, d):
    n = views.table(spark, d, "nation")
    key = F.col("n_nationkey")
    t = n.select("n_nationkey", F.when(key % 5 == 0, None).otherwise(F.lower("n_name")).alias("t_name"), F.when(key % 7 == 0, 9).otherwise(F.col("n_regionkey")).alias("t_region"))
    links = linkage.probabilistic(linkage.numbered(n, "n_nationkey"), linkage.numbered(t, "n_nationkey"), [("n_name", "t_name"), ("n_regionkey", "t_region")], 0.2)
    return rounded(links, [])


@query(
    "l_match_rate",
    with_views("source_a source_b", ", l AS (SELECT count(*) AS links FROM source_a a JOIN source_b b ON a.code = b.code AND a.trade_date = b.trade_date), n AS (SELECT count(*) AS source_count FROM source_a) SELECT links, source_count, round(links / source_count, 6) AS match_rate FROM l, n"),
)
def match_rate(spark, d):
    a, b = linkage.numbered(views.source_a(spark, d), "code", "trade_date"), linkage.numbered(views.source_b(spark, d), "code", "trade_date")
    return rounded(linkage.match_rate(linkage.exact(a, b, [("code", "code"), ("trade_date", "trade_date")]), a), [])


# --- differences ------------------------------------------------------------------------

KEYS = ["code", "trade_date"]
_KEY = "code || '|' || CAST(trade_date AS VARCHAR)"


@query(
    "d1_row_diff",
    with_views(
        "source_a source_b",
        f"""SELECT 'missing' AS diff_type, 'medium' AS severity, {_KEY} AS key, 'missing in target' AS description FROM (SELECT DISTINCT code, trade_date FROM source_a EXCEPT SELECT code, trade_date FROM source_b)
UNION ALL SELECT 'missing', 'medium', {_KEY}, 'missing in source' FROM (SELECT DISTINCT code, trade_date FROM source_b EXCEPT SELECT code, trade_date FROM source_a)""",
    ),
)
def row_diff(spark, d):
    return diffs.row_diff(views.source_a(spark, d), views.source_b(spark, d), KEYS).select("diff_type", "severity", "key", "description")


@query("d2_structural_diff", "SELECT 'structural' AS diff_type, 'high' AS severity, 'name' AS \"column\", 'missing in target' AS description UNION ALL SELECT 'structural', 'high', 'extra', 'missing in source' UNION ALL SELECT 'structural', 'medium', 'volume', 'types differ'")
def structural_diff(spark, d):
    b = views.source_b(spark, d).drop("name").withColumns({"extra": F.lit(1), "volume": F.col("volume").cast("double")})
    return diffs.structural_diff(views.source_a(spark, d), b).select("diff_type", "severity", "column", "description")


_FIELD = """, j AS (SELECT a.code, a.trade_date, a.close AS ac, b.close AS bc, a.volume AS av, b.volume AS bv, a.name AS an, b.name AS bn FROM source_a a JOIN source_b b ON a.code = b.code AND a.trade_date = b.trade_date),
diffs AS (
  SELECT 'value' AS diff_type, CASE WHEN ac IS NULL OR bc IS NULL THEN 'medium' WHEN abs(ac - bc) > 1000 THEN 'critical' WHEN abs(ac - bc) > 100 THEN 'high' WHEN abs(ac - bc) > 10 THEN 'medium' ELSE 'low' END AS severity, code, trade_date, 'close' AS "column"
  FROM j WHERE (ac IS NULL) <> (bc IS NULL) OR abs(ac - bc) > 1e-6
  UNION ALL SELECT 'value', CASE WHEN abs(av - bv) > 1000 THEN 'critical' WHEN abs(av - bv) > 100 THEN 'high' WHEN abs(av - bv) > 10 THEN 'medium' ELSE 'low' END, code, trade_date, 'volume' FROM j WHERE av <> bv
  UNION ALL SELECT 'value', 'medium', code, trade_date, 'name' FROM j WHERE lower(trim(an)) <> lower(trim(bn)))
"""


def _diffs(spark, d):
    return diffs.field_diff(views.source_a(spark, d), views.source_b(spark, d), KEYS)


@query("d3_field_diff", with_views("source_a source_b", _FIELD + f'SELECT diff_type, severity, {_KEY} AS key, "column" FROM diffs'))
def field_diff(spark, d):
    return _diffs(spark, d).select("diff_type", "severity", "key", "column")


@query("d4_counts", with_views("source_a source_b", _FIELD + "SELECT diff_type, severity, count(*) AS diffs FROM diffs GROUP BY ALL"))
def counts(spark, d):
    return diffs.counts(_diffs(spark, d))


@query("d4_classify", with_views("source_a source_b", f""", m AS (SELECT DISTINCT code, trade_date FROM source_a EXCEPT SELECT code, trade_date FROM source_b)
SELECT 'temporal' AS diff_type, 'low' AS severity, count(*) AS n FROM m UNION ALL SELECT 'granularity', 'high', count(*) FROM m"""))
def classify(spark, d):
    gone = diffs.row_diff(views.source_a(spark, d), views.source_b(spark, d), KEYS).filter("description = 'missing in target'")
    both = gone.withColumn("diff_type", F.lit("temporal")).union(gone.withColumn("diff_type", F.lit("granularity")))
    return diffs.classify(both).groupBy("diff_type", "severity").agg(F.count(F.lit(1)).alias("n"))


@query("d4_by_column", with_views("source_a source_b", _FIELD + 'SELECT "column", count(*) AS diffs FROM diffs GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10'))
def by_column(spark, d):
    return diffs.by_column(_diffs(spark, d))


@query(
    "d4_top_issues",
    with_views("source_a source_b", _FIELD + f"""SELECT severity, {_KEY} AS key, "column" FROM diffs ORDER BY CASE severity WHEN 'critical' THEN 0 WHEN 'high' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END, 2, 3 LIMIT 5"""),
)
def top_issues(spark, d):
    return diffs.top_issues(_diffs(spark, d)).select("severity", "key", "column")


@query("d4_at_least_high", with_views("source_a source_b", _FIELD + f"""SELECT severity, {_KEY} AS key, "column" FROM diffs WHERE severity IN ('critical', 'high')"""))
def at_least_high(spark, d):
    return diffs.at_least(diffs.of_type(_diffs(spark, d), "value"), "high").select("severity", "key", "column")


# --- resolution -------------------------------------------------------------------------


def _conflicts(spark, d):
    c = _diffs(spark, d).filter("column = 'close'")
    n = F.substring_index("key", "|", 1).cast("bigint") + F.dayofmonth(F.substring_index("key", "|", -1).cast("date"))
    return c.select("key", "column", "source_value", "target_value", F.when(n % 3 == 0, "akshare").otherwise("tushare").alias("source"), F.when(n % 2 == 0, "baostock").otherwise("other").alias("target"))


@query(
    "r1_priority",
    with_views(
        "source_a source_b",
        _FIELD
        + f""", c AS (SELECT *, CAST(code AS BIGINT) + day(trade_date) AS n FROM j WHERE (ac IS NULL) <> (bc IS NULL) OR abs(ac - bc) > 1e-6),
q AS (SELECT *, CASE WHEN n % 3 = 0 THEN 'akshare' ELSE 'tushare' END AS s, CASE WHEN n % 2 = 0 THEN 'baostock' ELSE 'other' END AS t, CASE WHEN n % 3 = 0 THEN 1 ELSE 3 END <= CASE WHEN n % 2 = 0 THEN 2 ELSE 999 END AS mine FROM c)
SELECT {_KEY} AS key, CASE WHEN mine THEN ac ELSE bc END AS resolved_value, 'priority ' || CASE WHEN mine THEN s ELSE t END AS resolution_method, 0.9::DOUBLE AS confidence FROM q""",
    ),
)
def by_priority(spark, d):
    done = resolve.priority(_conflicts(spark, d), {"akshare": 1, "baostock": 2, "tushare": 3})
    return done.select("key", F.col("resolved_value").cast("double").alias("resolved_value"), "resolution_method", "confidence")


@query(
    "r1_priority_counts",
    """WITH p(source, target) AS (VALUES ('akshare', 'baostock'), ('tushare', 'baostock'), ('x', 'y'), ('other', 'tushare')), r(name, n) AS (VALUES ('akshare', 1), ('baostock', 2), ('tushare', 3))
SELECT source, target, CASE WHEN coalesce(a.n, 999) <= coalesce(b.n, 999) THEN 's' ELSE 't' END AS resolved_value, 0.9::DOUBLE AS confidence FROM p LEFT JOIN r a ON a.name = source LEFT JOIN r b ON b.name = target""",
)
def priority_table(spark, d):
    rows = spark.createDataFrame([("akshare", "baostock"), ("tushare", "baostock"), ("x", "y"), ("other", "tushare")], "source string, target string").withColumns({"source_value": F.lit("s"), "target_value": F.lit("t")})
    return resolve.priority(rows, {"akshare": 1, "baostock": 2, "tushare": 3}).select("source", "target", "resolved_value", "confidence")


_TIMES = [(None, None), (None, 5), (5, None), (5, 6), (6, 5), (5, 5)]


@query(
    "r2_timestamp",
    "WITH c(a, b) AS (VALUES (NULL, NULL), (NULL, 5), (5, NULL), (5, 6), (6, 5), (5, 5)) SELECT CAST(a AS INTEGER) AS a, CAST(b AS INTEGER) AS b, CASE WHEN a IS NULL AND b IS NOT NULL OR b > a THEN 't' ELSE 's' END AS resolved_value, CASE WHEN a IS NULL AND b IS NULL THEN 0.5::DOUBLE WHEN a IS NULL OR b IS NULL THEN 0.8::DOUBLE ELSE 0.95::DOUBLE END AS confidence FROM c",
)
def by_time(spark, d):
    rows = spark.createDataFrame(_TIMES, "a int, b int").withColumns({"source_value": F.lit("s"), "target_value": F.lit("t")})
    return resolve.timestamp(rows, "a", "b").select("a", "b", "resolved_value", "confidence")


@query(
    "r3_voting",
    with_views(
        "source_a source_b",
        """, j AS (SELECT a.code, a.trade_date, a.volume AS s, b.volume AS t, [a.volume % 3, a.volume] AS more FROM source_a a JOIN source_b b ON a.code = b.code AND a.trade_date = b.trade_date),
v AS (SELECT code, trade_date, unnest(list_concat([s, t], more)) AS v, unnest(range(0, 4)) AS pos FROM j),
g AS (SELECT code, trade_date, v, count(*) AS n, min(pos) AS first FROM v WHERE v IS NOT NULL GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY code, trade_date ORDER BY n DESC, first) AS rn, sum(n) OVER (PARTITION BY code, trade_date) AS total FROM g)
SELECT code, trade_date, v AS resolved_value, round(n / total, 6) AS confidence FROM k WHERE rn = 1""",
    ),
)
def voting(spark, d):
    a, b = views.source_a(spark, d), views.source_b(spark, d).select("code", "trade_date", F.col("volume").alias("target_value"))
    both = a.join(b, ["code", "trade_date"]).withColumn("source_value", F.col("volume")).withColumn("more", F.array(F.col("volume") % 3, F.col("volume")))
    return rounded(resolve.voting(both, "more").select("code", "trade_date", "resolved_value", "confidence"), [])


@query(
    "r4_merge",
    with_views(
        "source_a source_b",
        """, j AS (SELECT a.code, a.trade_date, a.name AS s, CASE WHEN b.name = 'other' THEN NULL ELSE b.name END AS t FROM source_a a JOIN source_b b ON a.code = b.code AND a.trade_date = b.trade_date)
SELECT code, trade_date, CASE WHEN t IS NULL THEN s WHEN s = t THEN s ELSE s || ' | ' || t END AS resolved_value, CASE WHEN t IS NULL THEN 1.0::DOUBLE ELSE 0.7::DOUBLE END AS confidence FROM j""",
    ),
)
def merge(spark, d):
    b = views.source_b(spark, d).select("code", "trade_date", F.when(F.col("name") != "other", F.col("name")).alias("target_value"))
    both = views.source_a(spark, d).join(b, ["code", "trade_date"]).withColumns({"source_value": F.col("name"), "column": F.lit("name")})
    return resolve.merge(both).select("code", "trade_date", "resolved_value", "confidence")


@query(
    "r4_merge_custom",
    with_views(
        "source_a source_b",
        """, j AS (SELECT a.code, a.trade_date, a.close AS s, b.close AS t, day(a.trade_date) % 2 = 0 AS custom FROM source_a a JOIN source_b b ON a.code = b.code AND a.trade_date = b.trade_date)
SELECT code, trade_date, CASE WHEN custom THEN (s + t) / 2 ELSE coalesce(s, t) END AS resolved_value,
  CASE WHEN custom THEN 0.85::DOUBLE WHEN s IS NULL AND t IS NULL THEN 0.0::DOUBLE WHEN s IS NULL OR t IS NULL THEN 1.0::DOUBLE ELSE 0.7::DOUBLE END AS confidence FROM j""",
    ),
)
def merge_custom(spark, d):
    """A rule of its own for one column: the mean of both sides."""
    b = views.source_b(spark, d).select("code", "trade_date", F.col("close").alias("target_value"))
    both = views.source_a(spark, d).join(b, ["code", "trade_date"]).withColumn("source_value", F.col("close"))
    both = both.withColumn("column", F.when(F.dayofmonth("trade_date") % 2 == 0, "close").otherwise("open"))
    return resolve.merge(both, {"close": lambda s, t: (s + t) / 2.0}).select("code", "trade_date", "resolved_value", "confidence")


@query("r5_resolution_counts", with_views("source_a source_b", _FIELD + "SELECT count(*) AS total_conflicts, count(*) AS resolved_count, 1.0::DOUBLE AS resolution_rate FROM diffs WHERE \"column\" = 'close'"))
def resolution_counts(spark, d):
    return resolve.resolution_counts(resolve.priority(_conflicts(spark, d), {}))


@query(
    "r6_report",
    with_views(
        "source_a source_b",
        _FIELD
        + """, gone AS ((SELECT DISTINCT code, trade_date FROM source_a EXCEPT SELECT code, trade_date FROM source_b) UNION ALL (SELECT DISTINCT code, trade_date FROM source_b EXCEPT SELECT code, trade_date FROM source_a)),
n AS (SELECT (SELECT count(*) FROM diffs) + (SELECT count(*) FROM gone) AS total, (SELECT count(*) FROM diffs WHERE severity = 'critical') AS critical, (SELECT count(*) FROM source_a) + (SELECT count(*) FROM source_b) AS rows),
r AS (SELECT total / rows AS rate, critical FROM n), q AS (SELECT *, round(0.6::DOUBLE * greatest(0, 100 - 100 * rate) + 40, 2) AS score FROM r)
SELECT score AS quality_score, CASE WHEN score >= 90 THEN 'A' WHEN score >= 70 THEN 'B' WHEN score >= 50 THEN 'C' ELSE 'D' END AS quality_grade, round(rate, 4) AS diff_rate,
  CAST((rate >= 0.1)::INT + (critical >= 5)::INT AS INTEGER) AS alerts FROM q""",
    ),
)
def quality_report(spark, d):
    a, b = views.source_a(spark, d), views.source_b(spark, d)
    found = _diffs(spark, d).unionByName(diffs.row_diff(a, b, KEYS))
    summary = diffs.summarize(found, a.count(), b.count())
    resolved = report.ResolutionSummary(summary.value, summary.value, {"priority": summary.value})
    made = report.report("a", "b", summary, resolved)
    alerts = report.Monitor().check(summary, resolved)
    return spark.createDataFrame([(made.summary["quality_score"], made.summary["quality_grade"], made.summary["diff_rate"], len(alerts))], "quality_score double, quality_grade string, diff_rate double, alerts int")
