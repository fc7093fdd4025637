"""Fetching: vendors by priority with retry and fallback, as driver-side control
flow over lazy frames, and the same rule as one query over landed data."""

from __future__ import annotations

import contextlib
import importlib.util
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions.scalars import lookup
from tidemill.operators import cleaning
from tidemill.operators.tables import TABLES
from tidemill.sources.storage import ParquetStore, Query, StoreError
from tidemill.sources.vendors import Vendor


#: Most missing codes that a report names.
REPORTED = 1000


class SourceUnavailable(Exception):
    pass


class RateLimited(Exception):
    pass


class PipelineError(Exception):
    pass


@dataclass(frozen=True)
class FetchSpec:
    asset_type: str
    table: str
    codes: tuple[str, ...] = ()
    start: date | None = None
    end: date | None = None
    frequency: str = "daily"
    #: Codes as a frame (code) in place of a list, however many there are.
    among: DataFrame | None = None


@dataclass(frozen=True)
class Limits:
    """Attempts and waits of a source, and seconds that a source and a run may take
    (None: any)."""

    attempts: int = 3
    base_delay_s: float = 5.0
    backoff: float = 2.0
    source_timeout_s: float | None = None
    run_timeout_s: float | None = None


@contextlib.contextmanager
def time_limit(spark: SparkSession, seconds: float | None, what: str) -> Iterator[None]:
    """Cancels the Spark jobs of the block after ``seconds``, as a source that is
    unavailable."""
    if seconds is None:
        yield
        return
    tag, fired = f"limit-{uuid.uuid4().hex}", threading.Event()
    spark.sparkContext.addJobTag(tag)

    def stop() -> None:
        fired.set()
        spark.sparkContext.cancelJobsWithTag(tag)

    timer = threading.Timer(seconds, stop)
    timer.start()
    try:
        yield
    except Exception as e:
        if fired.is_set():
            raise SourceUnavailable(f"{what} took more than {seconds:g} s") from e
        raise
    finally:
        timer.cancel()
        spark.sparkContext.removeJobTag(tag)


@dataclass(frozen=True)
class Source:
    """A vendor with a reader: (spark, spec) to the vendor's raw frame. Readers of
    vendors whose client library isn't installed aren't healthy."""

    vendor: Vendor
    read: Callable[[SparkSession, FetchSpec], DataFrame]
    priority: int = 50

    @property
    def name(self) -> str:
        return self.vendor.name

    def healthy(self) -> bool:
        return self.vendor.module is None or importlib.util.find_spec(self.vendor.module) is not None or getattr(self.read, "offline", False)

    def fetch(self, spark: SparkSession, spec: FetchSpec) -> DataFrame:
        df = self.vendor.map(self.read(spark, spec))
        if spec.table == "minute" and spec.frequency != "daily":
            df = df.withColumn("frequency", F.lit(spec.frequency)) if "frequency" not in df.columns else df.fillna({"frequency": spec.frequency})
        if spec.codes:
            df = df.filter(F.col("code").isin(*spec.codes))
        if spec.among is not None:
            df = df.join(spec.among.select("code").distinct(), "code", "left_semi")
        column = next((c for c in ("trade_date", "trade_time") if c in df.columns), None)
        if column and spec.start:
            df = df.filter(F.col(column) >= F.lit(spec.start))
        if column and spec.end:
            df = df.filter(F.col(column) < F.date_add(F.lit(spec.end), 1))
        return df

    def fetch_with_retry(self, spark: SparkSession, spec: FetchSpec, attempts: int = 3, delay: float = 5.0, factor: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
        """A rate limit waits and tries again; a source that is unavailable doesn't."""
        for k in range(attempts):
            try:
                return self.fetch(spark, spec)
            except RateLimited:
                if k == attempts - 1:
                    raise
                sleep(delay * factor**k)
        raise SourceUnavailable(self.name)


def landed(root: str, fmt: str = "parquet", **options) -> Callable[[SparkSession, FetchSpec], DataFrame]:
    """A reader of a folder of landed files, for sources without a network."""

    def read(spark: SparkSession, spec: FetchSpec) -> DataFrame:
        return spark.read.format(fmt).options(**options).load(root)

    read.offline = True
    return read


class SourceRegistry:
    def __init__(self):
        self._sources: dict[str, list[Source]] = {}

    def register(self, table: str, source: Source) -> None:
        self._sources[table] = sorted([*self._sources.get(table, []), source], key=lambda s: -s.priority)

    def primary(self, table: str) -> Source | None:
        return next(iter(self._sources.get(table, [])), None)

    def get_all(self, asset_type: str, table: str) -> list[Source]:
        return [s for s in self._sources.get(table, []) if s.vendor.supports(asset_type, table)]


def by_priority(frames: dict[str, DataFrame], priorities: dict[str, int], key: list[str]) -> DataFrame:
    """One row for each key, from the source of highest priority that has it, with the
    source's name: the fallback rule for whole tables."""
    rows = None
    for name, df in frames.items():
        tagged = df.withColumn("source", F.lit(name))
        rows = tagged if rows is None else rows.unionByName(tagged, allowMissingColumns=True)
    w = Window.partitionBy(*key).orderBy(lookup(priorities, F.col("source"), F.lit(0)).desc(), "source")
    return rows.withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k")


def missing_codes(df: DataFrame, codes: DataFrame) -> DataFrame:
    """Requested codes without a row."""
    return codes.select("code").distinct().join(df.select("code").distinct(), "code", "left_anti")


def completeness(df: DataFrame, codes: DataFrame) -> DataFrame:
    """One row: requested, failed, status (success, partial or failed)."""
    asked = codes.select("code").distinct()
    got = df.select("code").distinct().withColumn("_got", F.lit(1))
    one = asked.join(got, "code", "left").agg(F.count(F.lit(1)).alias("requested"), F.count(F.when(F.col("_got").isNull(), 1)).alias("failed"))
    status: Column = F.when(F.col("failed") == 0, "success").when(F.col("failed") == F.col("requested"), "failed").otherwise("partial")
    return one.withColumn("status", status)


@dataclass(frozen=True)
class PipelineReport:
    status: str
    source: str | None
    rows: int
    failed_codes: tuple[str, ...] = ()
    fallback_used: bool = False
    issues: tuple[str, ...] = ()
    tried: dict = field(default_factory=dict)


def run(
    spark: SparkSession, registry: SourceRegistry, store: ParquetStore, spec: FetchSpec, profile: str = "baseline", as_of=None, upsert: bool = False, sleep: Callable[[float], None] = time.sleep, limits: Limits = Limits()
) -> PipelineReport:
    """Health, fetch, validate, clean, write; the next source after a failure or when
    a source takes too long. A failure of the store is raised."""
    table, tried, began = TABLES[spec.table], {}, time.monotonic()
    for source in registry.get_all(spec.asset_type, spec.table):
        if limits.run_timeout_s is not None and time.monotonic() - began > limits.run_timeout_s:
            raise PipelineError(f"the run took more than {limits.run_timeout_s:g} s: {tried}")
        try:
            if not source.healthy():
                raise SourceUnavailable(f"{source.name} is not healthy")
            with time_limit(spark, limits.source_timeout_s, source.name):
                raw = table.drop_invalid(source.fetch_with_retry(spark, spec, limits.attempts, limits.base_delay_s, limits.backoff, sleep))
                rows = cleaning.clean(raw, profile, as_of).persist()
                n = rows.count()
            try:
                if not n:
                    raise SourceUnavailable(f"{source.name} has no rows")
                found = tuple(r.issue for r in cleaning.issues(rows, profile).filter("violated").collect())
                (store.upsert if upsert else store.write)(spec.table, rows)
                failed: tuple[str, ...] = ()
                asked = spec.among if spec.among is not None else spark.createDataFrame([(c,) for c in spec.codes], "code string") if spec.codes else None
                if asked is not None:
                    failed = tuple(sorted(r.code for r in missing_codes(rows, asked).orderBy("code").limit(REPORTED).collect()))
            finally:
                rows.unpersist()
            first = registry.primary(spec.table)
            return PipelineReport("partial" if failed else "success", source.name, n, failed, first is not None and first.name != source.name, found, tried)
        except StoreError:
            raise
        except (SourceUnavailable, RateLimited, ValueError) as e:
            tried[source.name] = str(e)
    raise PipelineError(f"no source left: {tried}")


def update(spark: SparkSession, registry: SourceRegistry, store: ParquetStore, asset_type: str, table: str, today: date, **options) -> PipelineReport:
    """From the day after the latest stored one to ``today``, for the stored codes,
    as an upsert."""
    stored = store.read(Query(table))
    time_column = "trade_time" if "trade_time" in stored.columns else "trade_date"
    latest = stored.agg(F.max(F.col(time_column).cast("date")).alias("latest")).first().latest
    start = None if latest is None else date.fromordinal(latest.toordinal() + 1)
    return run(spark, registry, store, FetchSpec(asset_type, table, (), start, today, among=stored.select("code").distinct()), upsert=True, **options)
