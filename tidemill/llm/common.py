"""Helpers shared by the corpus operators: the shared folder, written tables
and connected components."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as a full URI.

    ``spark.checkpoint.dir`` names it on a cluster; a bare path is one of the
    default file system. Only a session whose master is local and that has neither
    that setting nor a checkpoint directory (single-machine tests) gets a temporary
    folder, which goes with the process; any other session without one is an error.
    """
    global _own_dir
    path = _configured(spark)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        if _own_dir is None:
            _own_dir = tempfile.mkdtemp(prefix="tidemill-")
            atexit.register(shutil.rmtree, _own_dir, ignore_errors=True)
        path = f"file://{_own_dir}"
    return qualified(spark, path.rstrip("/"))


def _configured(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) by Hadoop, which knows every scheme that Spark reads."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme; local ones as ``file:///x``."""
    fs, hadoop = _hadoop(spark, path)
    uri = fs.makeQualified(hadoop).toString()
    return "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop = _hadoop(spark, path)
    fs.mkdirs(hadoop)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tidemill/{name}-{uuid.uuid4().hex}"


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage in a way that survives lost executors, and gives
    later joins plain exchanges on both sides, which adaptive execution can
    split where a key is hot.
    """
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a table made by :func:`written`."""
    for file in df.inputFiles()[:1]:
        fs, path = _hadoop(spark, file)
        fs.delete(path.getParent(), True)


#: What a Python worker keeps between tasks: one thing, so that the next stage's
#: replaces it.
_held: list = [None, None]


def held(key: tuple, make: Callable[[], Any]) -> Any:
    """``make()``, kept in this worker until something else is held. Models and
    caches of stages that run one after the other don't add up in reused workers."""
    if _held[0] != key:
        _held[:] = None, None
        trim()
        _held[:] = key, make()
    return _held[1]


def trim() -> None:
    """Give freed memory back to the system, where its C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def slices(batch: pa.RecordBatch, column: int, rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in parts of at most ``rows`` rows, and of at most ``size`` bytes in
    a column of text where a row alone isn't longer."""
    ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch.column(column)), 0).cast(pa.int64())).to_numpy(zero_copy_only=False)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, min(at + rows, int(np.searchsorted(ends, before + size, side="right"))))
        yield batch.slice(at, to - at)
        at = to


def text_id_crc(column: str = "doc_id"):
    """crc32 of an id written as decimal text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest
    node that can be reached.

    Each round gives all nodes of a label the smallest label that any of them
    or their neighbours has (the root is hooked, not the node alone), and then
    follows labels once more (pointer jumping). In a simulation chains in random
    order took 7 rounds for 1,000 nodes and 11 or 12 for 100,000. A label never
    rises and a round without change ends the loop, so that it needs no limit of
    rounds. Labels stay in tables of the shared folder; the driver sees one
    count a round.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(spark, both.filter("a <> b").distinct(), "edges")
    labels = written(
        spark,
        both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")),
        "labels",
    )
    while True:
        seen = labels.select(F.col("node").alias("b"), F.col("root").alias("r"))
        best = both.join(seen, "b").groupBy("a").agg(F.min("r").alias("r"))
        hooks = labels.join(best, labels["node"] == best["a"]).groupBy("root").agg(F.min(F.least("root", "r")).alias("hook"))
        hooks = written(spark, hooks, "hooks")
        lower = written(spark, labels.join(hooks, "root").select("node", F.col("root").alias("old"), F.col("hook").alias("root")), "labels")
        up = lower.select(F.col("node").alias("root"), F.col("root").alias("up"))
        jumped = written(spark, lower.join(up, "root", "left").select("node", "old", F.coalesce("up", "root").alias("root")), "labels")
        changed = jumped.filter("root <> old").limit(1).count()
        for t in (hooks, lower, labels):
            remove(spark, t)
        labels = jumped
        if not changed:
            remove(spark, both)
            return labels.select("node", "root")
