"""An extension: a landing folder as a stream into a table, each micro-batch an
upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemill.operators.tables import TABLES
from tidemill.sources.storage import ParquetStore


def stream_upserts(spark: SparkSession, store: ParquetStore, table: str, landing: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Every file of ``landing`` is merged once; a batch that is repeated after a
    failure gives the same table, since an upsert is idempotent."""
    spec = TABLES[table]
    rows = spark.readStream.schema(spec.struct).parquet(landing)

    def merge(batch: DataFrame, _: int) -> None:
        store.upsert(table, spec.drop_invalid(batch))

    writer = rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
