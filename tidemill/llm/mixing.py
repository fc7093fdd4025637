"""Mixing sources to target weights by Pareto order sampling, with DataFrame
functions only.

Targets. Sources weigh in by a repeating list of weights, in order of their
code points (null last), and share all words; a target stops at ``MAX_REPEAT``
times its source's words, and the excess goes to the others by weight until
none is above. That is the water-filling solution: with sources ordered by
cap / weight, the level is the smallest (total - caps so far) / (weights left)
that does not pass the next source's cap / weight.

Sampling. A source with f = target / size has floor(f) certain copies of every
document and inclusion probability p = f - floor(f) for one more. Documents are
ranked by Pareto's variable (u / (1 - u)) / (p / (1 - p)), u uniform by a hash of
the id, and taken in that order until the source's remaining words are reached;
the document at the border is taken if that comes nearer. Sample size is fixed
in words, so a source misses its target by half of one document at most.

A source with a third of all rows is not ordered in one task: words are added
up in ``BINS`` bins of the rank variable first, and only the bin at the border
is put in order.

Edge cases: a null text has size 0; null sources are one source, last; sizes of
zero share nothing. Rows with a null id are ranked by a hash of their text, so that
many of them spread over the bins. Equal ranks are ordered by id, size and a hash of the text,
so reruns agree; repeated rows are rows of their own. Extra columns are never
read by :func:`plan`; :func:`apply` keeps all columns (names that begin with
``_mix_`` are its own).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import written

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
SEED = "mix-1"
BINS = 4096


def n_words(text: str = "text") -> Column:
    """The number of runs of non-white-space (ASCII) characters."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def uniform(key: str = "doc_id", seed: str = SEED, text: str = "text") -> Column:
    """A number in (0, 1) from the first 48 bits of an MD5, which other SQL
    engines compute alike. Rows without an id are told apart by their text."""
    named = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))))
    digest = F.md5(F.concat_ws(":", F.lit(seed), named).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint").cast("double") + 0.5) / float(1 << 48)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, target) from (source, source_size), which has a row
    for each source: windows over it are as small as the list of sources."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    filled = Window.orderBy((F.col("cap").cast("double") / F.col("w")).asc(), F.col("rank").asc())
    every = filled.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double") / (
        F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0))
    ).cast("double")
    return (
        sizes.withColumn("rank", F.row_number().over(order))
        .withColumn("w", weight.cast("bigint"))
        .withColumn("cap", F.col("source_size") * max_repeat)
        .withColumn("level", level)
        # The first source that the level leaves below its cap sets the level.
        .withColumn("water", F.min(F.when(F.col("level") <= F.col("cap").cast("double") / F.col("w"), F.struct((F.col("cap").cast("double") / F.col("w")).alias("at"), "rank", "level"))).over(every)["level"])
        .select("source", "source_size", F.least(F.col("cap").cast("double"), F.coalesce(F.col("water") * F.col("w"), F.col("cap").cast("double"))).alias("target"))
    )


def _plan(spark: SparkSession, docs: DataFrame, columns: list[Column], weights: tuple[int, ...], max_repeat: int, seed: str) -> DataFrame:
    """``columns`` of ``docs`` with _mix_size, _mix_total, _mix_target and
    _mix_copies."""
    rows = docs.select(
        *columns, F.col("source").alias("_mix_source"), F.col("doc_id").alias("_mix_id"), n_words().alias("_mix_size"), F.xxhash64("text").alias("_mix_hash"), uniform("doc_id", seed).alias("_mix_u")
    ).withColumn("_mix_bin", F.floor(F.col("_mix_u") * BINS).cast("int"))
    if not columns:
        rows = written(spark, rows, "sizes")
    bins = rows.groupBy(F.col("_mix_source").alias("source"), F.col("_mix_bin").alias("bin")).agg(F.sum("_mix_size").alias("words"))
    bins = written(spark, bins, "bins")
    by_source = targets(bins.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_repeat)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    by_source = by_source.withColumn("whole", whole).withColumn("rest", F.col("target") - (F.col("whole") * F.col("source_size")).cast("double"))
    p = F.when(F.col("source_size") > 0, F.col("rest") / F.col("source_size")).otherwise(F.lit(0.0))
    by_source = written(spark, by_source.withColumn("odds", F.when((p > 0) & (p < 1), p / (1 - p))), "targets")
    # Within a source p is one number, so Pareto's variable orders as u does and
    # bins of u are bins of the rank. The sums of the bins are BINS rows a source.
    running = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    named = by_source.withColumnRenamed("source", "of")
    border = (
        bins.join(named.filter("odds is not null"), F.col("source").eqNullSafe(F.col("of")))
        .withColumn("start", F.coalesce(F.sum("words").over(running), F.lit(0)))
        .filter((F.col("start") < F.col("rest")) & (F.col("start") + F.col("words") >= F.col("rest")))
        .groupBy("source")
        .agg(F.min(F.struct("bin", "start")).alias("border"))
        .select("source", F.col("border.bin").alias("border_bin"), F.col("border.start").alias("border_start"))
    )
    sources = named.join(border, F.col("of").eqNullSafe(F.col("source")), "left").drop("source")
    sources = written(spark, sources.select(*[F.col(c).alias(f"_mix_{c}") for c in sources.columns]), "sources")
    joined = rows.join(sources, F.col("_mix_source").eqNullSafe(F.col("_mix_of")))
    joined = joined.withColumn("_mix_q", (F.col("_mix_u") / (1 - F.col("_mix_u"))) / F.col("_mix_odds"))
    inside = F.coalesce(F.col("_mix_odds").isNotNull() & (F.col("_mix_bin") == F.col("_mix_border_bin")), F.lit(False))
    early = F.col("_mix_odds").isNotNull() & (F.col("_mix_border_bin").isNull() | (F.col("_mix_bin") < F.col("_mix_border_bin")))
    before = Window.partitionBy("_mix_source").orderBy("_mix_q", F.col("_mix_id").asc_nulls_first(), "_mix_size", "_mix_hash").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_mix_border_start") + F.coalesce(F.sum("_mix_size").over(before), F.lit(0))
    near = joined.filter(inside).withColumn("_mix_start", start)
    near = near.withColumn("_mix_extra", F.col("_mix_start").cast("double") + F.col("_mix_size") / 2.0 <= F.col("_mix_rest")).drop("_mix_start")
    # Without a border the remaining words are never reached and all are taken.
    far = joined.filter(~inside).withColumn("_mix_extra", early)
    return far.unionByName(near).withColumn("_mix_copies", F.col("_mix_whole") + F.col("_mix_extra").cast("bigint"))


def plan(spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """(doc_id, size, source, source_size, target, copies), a row for each row of
    ``docs``."""
    mixed = _plan(spark, docs, [], weights, max_repeat, seed)
    return mixed.select(
        F.col("_mix_id").alias("doc_id"), F.col("_mix_size").alias("size"), F.col("_mix_source").alias("source"), F.col("_mix_source_size").alias("source_size"), F.col("_mix_target").alias("target"), F.col("_mix_copies").alias("copies")
    )


def apply(spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """``docs`` with each row as often as the mix takes it."""
    mixed = _plan(spark, docs, [F.col(c) for c in docs.columns], weights, max_repeat, seed).filter("_mix_copies > 0")
    return mixed.withColumn("_mix_n", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_mix_copies")))).select(*docs.columns)
