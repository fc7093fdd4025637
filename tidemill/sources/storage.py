"""Partitioned Parquet tables: write, read with pruning, upsert, and a store of
factors."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemill.operators.factors import Category, Frequency, Metadata
from tidemill.operators.tables import TABLES, TableSpec


_STRING = StringType()


class StoreError(Exception):
    pass


@dataclass(frozen=True)
class Query:
    table: str
    columns: tuple[str, ...] = ()
    codes: tuple[str, ...] = ()
    start: date | None = None
    end: date | None = None
    partitions: dict | None = None


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.delete(p, True)


class ParquetStore:
    """One folder a table, partition columns of each row as Hive folders. Partition
    values are texts ("01" stays "01")."""

    def __init__(self, spark: SparkSession, root: str, compression: str = "zstd"):
        self.spark, self.root, self.compression = spark, root.rstrip("/"), compression

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _spec(self, table: str) -> TableSpec:
        if table not in TABLES:
            raise StoreError(f"no table {table}")
        return TABLES[table]

    def write(self, table: str, df: DataFrame, mode: str = "overwrite") -> None:
        """Replaces the partitions that ``df`` has rows of."""
        spec = self._spec(table)
        rows = spec.with_partitions(df)
        # A partition's rows go to few tasks, and a large partition's to several (adaptive
        # execution splits what a rebalance deals unevenly).
        rows = rows.hint("rebalance", *spec.partitions) if spec.partitions else rows
        writer = rows.write.mode(mode).option("compression", self.compression).option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*spec.partitions).parquet(self.path(table))

    def exists(self, table: str, **partitions: str) -> bool:
        if not self._filled(table):
            return False
        return not partitions or bool(self._scan(table).filter(self._where(partitions)).limit(1).count())

    def _filled(self, table: str) -> bool:
        """Whether there is a table, with a file or a partition at least."""
        if not exists(self.spark, self.path(table)):
            return False
        fs, p = _fs(self.spark, self.path(table))
        return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))

    @staticmethod
    def _where(partitions: dict):
        return reduce(lambda a, b: a & b, (F.col(k) == str(v) for k, v in partitions.items()))

    def _scan(self, table: str) -> DataFrame:
        """Partition columns read as the texts that they are."""
        raw = self.spark.read.parquet(self.path(table))
        names = [k for k in self._spec(table).partitions]
        schema = raw.schema
        for f in schema:
            if f.name in names:
                f.dataType = _STRING
        return self.spark.read.schema(schema).parquet(self.path(table))

    def read(self, query: Query) -> DataFrame:
        """Filters reach the partitions and the files; columns are pruned last, so
        that a projection can't switch a filter off. A table that isn't there is an
        empty frame."""
        spec = self._spec(query.table)
        if not self._filled(query.table):
            empty = self.spark.createDataFrame([], spec.struct).withColumns({k: F.lit(None).cast("string") for k in spec.partitions})
            return empty.select(*query.columns) if query.columns else empty
        df = self._scan(query.table)
        if query.partitions:
            df = df.filter(self._where(query.partitions))
        if query.codes:
            df = df.filter(F.col("code").isin(*query.codes))
        if query.start or query.end:
            column = next((c for c in ("trade_date", "trade_time") if c in df.columns), None)
            if column is None:
                raise StoreError(f"{query.table} has no date to filter by")
            if query.start:
                df = df.filter(F.col(column) >= F.lit(query.start))
            if query.end:
                # The whole last day, for dates and for times.
                df = df.filter(F.col(column) < F.date_add(F.lit(query.end), 1))
            if {"year", "month"} <= set(df.columns):
                df = df.filter(F.col("year").between(f"{query.start:%Y}" if query.start else "0000", f"{query.end:%Y}" if query.end else "9999"))
        return df.select(*query.columns) if query.columns else df

    def upsert(self, table: str, df: DataFrame, order: str | None = None) -> None:
        """New rows replace stored ones with the same key; of several new ones the
        last by ``order`` stays. Touched partitions only are read and written. Not
        atomic across partitions."""
        spec = self._spec(table)
        if not self._filled(table):
            old = None
        else:
            touched = spec.with_partitions(df).select(*spec.partitions).distinct()
            stored = self._scan(table)
            # As many rows as there are partitions; whether to broadcast is the planner's choice.
            old = stored.join(touched, list(spec.partitions), "left_semi") if spec.partitions else stored
        merged = self._merge(spec, old, df, order)
        # Rows are read from the partitions that they replace: set them down first.
        aside = f"{self.root}/_staging/{uuid.uuid4().hex}"
        merged.write.parquet(aside)
        self.write(table, self.spark.read.schema(merged.schema).parquet(aside))
        delete(self.spark, aside)

    @staticmethod
    def _merge(spec: TableSpec, old: DataFrame | None, new: DataFrame, order: str | None) -> DataFrame:
        new = new.withColumns({"_gen": F.lit(1), "_seq": F.col(order) if order else F.lit(0)})
        rows = new
        if old is not None:
            old = old.select(*[c for c in old.columns if c in new.columns or c not in spec.partitions])
            rows = old.withColumns({"_gen": F.lit(0), "_seq": F.lit(None).cast(new.schema["_seq"].dataType)}).unionByName(new, allowMissingColumns=True)
        w = Window.partitionBy(*spec.key).orderBy(F.desc("_gen"), F.desc_nulls_last("_seq"))
        return rows.withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k", "_gen", "_seq")


BACKENDS: dict[str, Callable[..., ParquetStore]] = {"parquet": ParquetStore}


def backend(name: str, *args, **kwargs) -> ParquetStore:
    if name not in BACKENDS:
        raise StoreError(f"no backend {name}")
    return BACKENDS[name](*args, **kwargs)


class FactorStore:
    """A folder a factor, with sorted key=value folders below it, and its metadata as
    one row."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, name: str, keys: dict | None = None) -> str:
        return "/".join([self.root, name, "data", *(f"{k}={v}" for k, v in sorted((keys or {}).items()))])

    def save(self, name: str, df: DataFrame, meta: Metadata | None = None, keys: dict | None = None) -> None:
        df.write.mode("overwrite").parquet(self._path(name, keys))
        if meta:
            row = (meta.name, meta.category.value, meta.frequency.value, meta.description, list(meta.required), json.dumps(meta.params), list(meta.tags))
            schema = "name string, category string, frequency string, description string, required array<string>, params string, tags array<string>"
            self.spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{name}/metadata")

    def load(self, name: str, keys: dict | None = None) -> DataFrame:
        if not exists(self.spark, self._path(name, keys)):
            raise FileNotFoundError(name)
        return self.spark.read.parquet(self._path(name, keys))

    def metadata(self, name: str) -> Metadata:
        if not exists(self.spark, f"{self.root}/{name}/metadata"):
            raise FileNotFoundError(name)
        r = self.spark.read.parquet(f"{self.root}/{name}/metadata").first()
        return Metadata(r.name, Category(r.category), Frequency(r.frequency), r.description, tuple(r.required), json.loads(r.params), tuple(r.tags))

    def exists(self, name: str, keys: dict | None = None) -> bool:
        return exists(self.spark, self._path(name, keys))

    def names(self) -> list[str]:
        fs, p = _fs(self.spark, self.root)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def delete(self, name: str) -> bool:
        return delete(self.spark, f"{self.root}/{name}")

    def query(self, name: str, codes: list[str] | None = None, start: date | None = None, end: date | None = None, columns: list[str] | None = None) -> DataFrame:
        df = self.load(name)
        if codes and "code" in df.columns:
            df = df.filter(F.col("code").isin(*codes))
        if "trade_date" in df.columns:
            if start:
                df = df.filter(F.col("trade_date") >= F.lit(start))
            if end:
                df = df.filter(F.col("trade_date") <= F.lit(end))
        return df.select(*columns) if columns else df

    def latest(self, name: str, n: int = 1, codes: list[str] | None = None) -> DataFrame:
        """The n latest rows (ties by code): a top-k, not a sort."""
        df = self.query(name, codes)
        if "trade_date" not in df.columns:
            return df.limit(n)
        return df.orderBy(F.desc("trade_date"), *[c for c in ("code",) if c in df.columns]).limit(n)


class FactorCache:
    """Persisted frames by the meaning of their plan, for ``ttl`` seconds."""

    def __init__(self, ttl: float = 3600, clock: Callable[[], float] = time.monotonic):
        self.ttl, self.clock, self._held = ttl, clock, {}

    def get(self, key: object, make: Callable[[], DataFrame]) -> DataFrame:
        self.evict()
        if key not in self._held:
            self._held[key] = (self.clock(), make().persist())
        return self._held[key][1]

    def of(self, df: DataFrame) -> DataFrame:
        return self.get(df.semanticHash(), lambda: df)

    def evict(self) -> None:
        for key in [k for k, (at, _) in self._held.items() if self.clock() - at >= self.ttl]:
            self.delete(key)

    def delete(self, key: object) -> None:
        if key in self._held:
            self._held.pop(key)[1].unpersist()

    def clear(self) -> None:
        for key in list(self._held):
            self.delete(key)

    def cached(self, f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        """A decorator: results by function and arguments; frames count by plan."""

        def mark(a):
            return a.semanticHash() if isinstance(a, DataFrame) else repr(a)

        def call(*args, **kwargs):
            key = (f.__qualname__, tuple(map(mark, args)), tuple((k, mark(v)) for k, v in sorted(kwargs.items())))
            return self.get(key, lambda: f(*args, **kwargs))

        return call
