"""Record linkage between a source and a target frame. Both have an explicit row
number ``_row`` (see :func:`numbered`), which decides ties: the first target wins.

Similarity needs every pair within a block. Without ``blocking`` columns the block
is the whole frame, which only a bounded target allows; its size is checked."""

from __future__ import annotations

from collections.abc import Callable
from difflib import SequenceMatcher
from functools import reduce

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The most rows of a target that is compared without blocking columns.
MOST_UNBLOCKED = 20_000


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """Row numbers from 0 in a total order. Rows are sorted in ranges, one task each;
    a range's numbers start at the sum of the ranges before it. The sorted frame is
    persisted, so that both passes see the same ranges."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ranged = ranged.persist(StorageLevel.DISK_ONLY)
    part = F.shiftright("_at", 33)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    # One row for each range.
    out = ranged.join(F.broadcast(starts), part == F.col("_part"))
    return out.withColumn("_row", F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at", "_part", "_start")


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def exact(source: DataFrame, target: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """All pairs whose keys are equal as text (nulls too): source_index,
    target_index, confidence, match_type."""
    s = source.select(F.col("_row").alias("source_index"), *[_text(a).alias(f"s{i}") for i, (a, _) in enumerate(on)])
    t = target.select(F.col("_row").alias("target_index"), *[_text(b).alias(f"t{i}") for i, (_, b) in enumerate(on)])
    same = reduce(lambda x, y: x & y, (s[f"s{i}"].eqNullSafe(t[f"t{i}"]) for i in range(len(on))))
    return s.join(t, same).select("source_index", "target_index", F.lit(1.0).alias("confidence"), F.lit("exact").alias("match_type"))


def match_rate(links: DataFrame, source: DataFrame) -> DataFrame:
    """One row: links, source_count, match_rate."""
    n = source.agg(F.count(F.lit(1)).alias("source_count"))
    return links.agg(F.count(F.lit(1)).alias("links")).crossJoin(n).withColumn("match_rate", F.when(F.col("source_count") > 0, F.col("links") / F.when(F.col("source_count") > 0, F.col("source_count"))).otherwise(0.0))


def ratio(a: str, b: str) -> float:
    """Ratcliff-Obershelp similarity of two lower-cased texts."""
    if not a and not b:
        return 1.0
    return SequenceMatcher(None, a.lower(), b.lower()).ratio() if a and b else 0.0


def jaro_winkler(a: str, b: str) -> float:
    """Jaro similarity plus a tenth of the rest for each of up to four equal first
    letters, without a floor."""
    a, b = a.lower(), b.lower()
    if not a or not b:
        return float(a == b)
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    free = dict.fromkeys(range(len(b)), True)
    mine, theirs = [], []
    for i, x in enumerate(a):
        j = next((j for j in range(max(0, i - reach), min(len(b), i + reach + 1)) if free[j] and b[j] == x), None)
        if j is not None:
            free[j] = False
            mine.append(x)
            theirs.append(j)
    if not mine:
        return 0.0
    m = len(mine)
    swapped = sum(x != b[j] for x, j in zip(mine, sorted(theirs), strict=True))
    jaro = (m / len(a) + m / len(b) + (m - swapped / 2) / m) / 3
    common = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4], strict=False)) if x != y), min(4, len(a), len(b)))
    return jaro + common * 0.1 * (1 - jaro)


def _paired(f) -> Callable[[Column, Column], Column]:
    """A text metric as a column function (made when it is used: it needs a session)."""

    def apply(a: Column, b: Column) -> Column:
        @F.pandas_udf("double")
        def metric(x: pd.Series, y: pd.Series) -> pd.Series:
            return pd.Series([f(i, j) for i, j in zip(x, y, strict=True)], dtype="float64")

        return metric(a, b)

    return apply


def _edit(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest > 0, 1.0 - F.levenshtein(F.lower(a), F.lower(b)) / F.when(longest > 0, longest)).otherwise(1.0)


def _sounds(a: Column, b: Column) -> Column:
    return (F.soundex(a) == F.soundex(b)).cast("double")


#: "levenshtein" is the name by which the Ratcliff-Obershelp ratio is asked for.
SIMILARITIES = {"levenshtein": _paired(ratio), "jaro_winkler": _paired(jaro_winkler), "edit": _edit, "soundex": _paired(ratio), "soundex_equal": _sounds}


def _sides(source: DataFrame, target: DataFrame, on: list[tuple[str, str]], blocking: list[tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    s = source.select(F.col("_row").alias("source_index"), *[_text(a).alias(f"s{i}") for i, (a, _) in enumerate(on)], *[_text(a).alias(f"bs{i}") for i, (a, _) in enumerate(blocking)])
    t = target.select(F.col("_row").alias("target_index"), *[_text(b).alias(f"t{i}") for i, (_, b) in enumerate(on)], *[_text(b).alias(f"bt{i}") for i, (_, b) in enumerate(blocking)])
    return s, t


def _meet(s: DataFrame, t: DataFrame, blocks: int) -> DataFrame:
    if blocks:
        return s.join(t, reduce(lambda x, y: x & y, (s[f"bs{i}"] == t[f"bt{i}"] for i in range(blocks))))
    if t.limit(MOST_UNBLOCKED + 1).count() > MOST_UNBLOCKED:
        raise ValueError(f"the target has more than {MOST_UNBLOCKED} rows: name blocking columns")
    # The target's size has just been checked.
    return s.join(F.broadcast(t))


def _best(scored: DataFrame, threshold: float, kind: str) -> DataFrame:
    w = Window.partitionBy("source_index").orderBy(F.desc("confidence"), "target_index")
    best = scored.filter(F.col("confidence") >= threshold).withColumn("_k", F.row_number().over(w)).filter("_k = 1")
    return best.select("source_index", "target_index", "confidence", F.lit(kind).alias("match_type"))


def fuzzy(source: DataFrame, target: DataFrame, on: list[tuple[str, str]], threshold: float = 0.8, algorithm: str = "levenshtein", blocking: list[tuple[str, str]] = ()) -> DataFrame:
    """The best target of each source by mean similarity. Rows that agree in the texts
    compared and in their blocks are compared once: each side is reduced to its
    distinct texts first, the target with the smallest row number of each."""
    s, t = _sides(source, target, on, list(blocking))
    mine, theirs = [c for c in s.columns if c != "source_index"], [c for c in t.columns if c != "target_index"]
    texts = s.groupBy(*mine).agg(F.min("source_index").alias("source_index"))
    pairs = _meet(texts, t.groupBy(*theirs).agg(F.min("target_index").alias("target_index")), len(blocking))
    f = SIMILARITIES[algorithm]
    score = sum((f(F.coalesce(f"s{i}", F.lit("")), F.coalesce(f"t{i}", F.lit(""))) for i in range(1, len(on))), f(F.coalesce("s0", F.lit("")), F.coalesce("t0", F.lit("")))) / float(len(on))
    best = _best(pairs.withColumn("confidence", score), threshold, "fuzzy").withColumnRenamed("source_index", "_first")
    named = best.join(texts.withColumnRenamed("source_index", "_first"), "_first").select("target_index", "confidence", "match_type", *[F.col(c).alias(f"_{c}") for c in mine])
    same = reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in mine))
    return s.join(named, same).select("source_index", "target_index", "confidence", "match_type")


def probabilistic(source: DataFrame, target: DataFrame, on: list[tuple[str, str]], threshold: float = 0.8, blocking: list[tuple[str, str]] = ()) -> DataFrame:
    """Agreement, disagreement and absence of each column, weighted by the logarithm
    of their odds over all pairs; the score is the logistic function of the sum."""
    pairs = _meet(*_sides(source, target, on, list(blocking)), len(blocking))
    features = {}
    for i in range(len(on)):
        gone = F.col(f"s{i}").isNull() | F.col(f"t{i}").isNull()
        same = F.lower(f"s{i}") == F.lower(f"t{i}")
        features |= {f"f{i}a": (~gone & same), f"f{i}d": (~gone & ~same), f"f{i}m": gone}
    vectors = pairs.withColumns({k: F.coalesce(c, F.lit(False)).cast("double") for k, c in features.items()})
    weight = lambda p: F.ln(p / (1.0 - p + 1e-10) + 1e-10)
    weights = vectors.agg(*[weight(F.avg(k)).alias(f"w{k}") for k in features])
    total = sum((F.col(k) * F.col(f"w{k}") for k in list(features)[1:]), F.col("f0a") * F.col("wf0a"))
    scored = vectors.crossJoin(F.broadcast(weights)).withColumn("confidence", 1.0 / (1.0 + F.exp(-total)))
    return _best(scored, threshold, "probabilistic")
