"""A Spark data source over any per-code fetch function: one input partition for
each code, so that executors fetch in parallel and a failed code is fetched again
alone."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class CodePartition(InputPartition):
    def __init__(self, code: str):
        super().__init__(code)
        self.code = code


def register(spark: SparkSession, name: str, schema: str, fetch) -> None:
    """``spark.read.format(name).option("codes", "a,b").load()`` then yields the tuples
    of ``fetch(code, options)`` for every code. ``fetch`` goes to the executors."""

    class Reader(DataSourceReader):
        def __init__(self, options: dict):
            self.options = options

        def partitions(self) -> list[InputPartition]:
            return [CodePartition(c) for c in self.options.get("codes", "").split(",") if c]

        def read(self, partition: CodePartition) -> Iterator[tuple]:
            yield from fetch(partition.code, self.options)

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, schema) -> DataSourceReader:
            return Reader(dict(self.options))

    spark.dataSource.register(Source)
