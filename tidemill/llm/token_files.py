"""Token ids in Parquet list columns.

A file row is a document: its id, the number of its ids, a running start within
its part, and the ids as a list. Ids are dictionary encoded while a column
chunk's dictionary fits a page, else plain; the sorted columns are delta encoded
(format version 2); row groups are ``ROW_GROUP`` bytes, pages ``PAGE`` bytes, and
Parquet's page indexes let a reader fetch the pages of a range of documents, or
the metadata columns alone.

Documents are dealt out by ranges of their id, sorted within a range and encoded
where they land; the number of the range is a column, so that starts come from
one sum for each range. Some hundred texts at once are cut into words by the byte-level
pattern, and the library's model encodes each distinct word, once while it stays in a
worker's cache of two generations. A text that holds the string of an added token is
left to the library, which gives it that token's id.

Edge cases: a null text is empty (the end id alone); null ids come first; rows
that share an id are ordered by a hash of their text. Extra columns are never read.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemill.llm.common import held, new_path, slices
from tidemill.llm.words import binaries, cut, distinct, taken

ROW_GROUP = 32 << 20
PAGE = 256 << 10
#: Words of a generation of a worker's cache.
CACHE_WORDS = 200_000
#: Rows and bytes of text that are encoded at once.
ROWS = 256
TEXT_BYTES = 4 << 20


def byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in byte-level vocabularies: printable Latin-1
    characters for themselves, the other bytes in order from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return {b: chr(b) if b in printable else chr(next(others)) for b in range(256)}


class Words(dict):
    """Word to ids, made when asked for and kept for one or two generations."""

    def __init__(self, make: Callable[[bytes], bytes], limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, word: bytes) -> bytes:
        if (ids := self.old.get(word)) is None:
            ids = self.make(word)
        self[word] = ids
        return ids

    def turn(self) -> None:
        """Begins another generation if this one is full."""
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()


class ChunkEncoder:
    """Texts' ids, as the tokenizers library gives them. Texts are cut into words
    together and the library's model encodes each distinct word, once while it is
    cached. Texts that hold the string of an added token, and those of files of other
    kinds, are encoded by the library as they are."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        steps = str(self.library.pre_tokenizer)
        self.by_chunk = steps.startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in steps and self.library.normalizer is None
        self.added = sorted(t.content for t in self.library.get_added_tokens_decoder().values())
        self.letters, self.model = byte_letters(), self.library.model
        self.words = Words(self._word, CACHE_WORDS)

    def _word(self, word: bytes) -> bytes:
        space, body = ("Ġ", word[1:]) if word[:1] == b" " else ("", word)
        # ASCII letters and digits stand for themselves.
        letters = body.decode() if body.isalnum() else body.decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(space + letters)]).tobytes()

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def slices(self, batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
        """Parts of a batch whose words don't outnumber a generation by far."""
        return slices(batch, column, ROWS, min(TEXT_BYTES, 20 * self.words.limit))

    def packed(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one behind the other, and where each text's end."""
        whole = np.full(len(texts), not self.by_chunk)
        for added in self.added:
            whole |= pc.fill_null(pc.match_substring(texts, added), False).to_numpy(zero_copy_only=False)
        words, sizes = cut(pc.if_else(pa.array(whole), "", texts) if whole.any() else texts)
        self.words.turn()
        names, at = distinct(words)
        known = list(map(self.words.__getitem__, names))
        data, offsets = taken(binaries(b"".join(known), np.cumsum([0, *map(len, known)])), at)
        ids, ends = np.frombuffer(data, "<u4", int(offsets[-1]) // 4), offsets[np.cumsum(sizes)] // 4
        if whole.any():
            each = np.split(ids, ends[:-1])
            for i in np.flatnonzero(whole):
                each[i] = self._whole(texts[int(i)].as_py() or "")
            ids, ends = np.concatenate(each), np.cumsum([len(x) for x in each])
        return ids, ends

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out = []
        for part in self.slices(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"]), 0):
            ids, ends = self.packed(part.column(0))
            out += [x.tobytes() for x in np.split(ids, ends[:-1])]
        return out


def _encode_part(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    encoder, start = held(("token files", path), lambda: ChunkEncoder(path)), 0
    for batch in batches:
        for part in encoder.slices(batch, batch.schema.get_field_index("text")):
            ids, ends = encoder.packed(part.column("text"))
            ids = np.insert(ids, ends, end_id)
            ends = ends + np.arange(1, len(ends) + 1)
            n = np.diff(ends, prepend=0)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids.view("<i4")))
            yield pa.RecordBatch.from_arrays([part.column("part"), part.column("doc_id"), pa.array(start + ends - n), pa.array(n), lists], ["part", "doc_id", "part_start", "n_tokens", "ids"])
            start += len(ids)


def write(spark: SparkSession, docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 0, parts: int | None = None) -> str:
    """Encodes every text, appends ``end_id`` and writes the files in ascending
    order of doc_id; returns their folder."""
    folder = folder or new_path(spark, "tokens")
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    # The hash cuts the rows of one id, should they be many, into ranges as well.
    order = [F.col("doc_id").asc_nulls_first(), F.col("hash").asc()]
    ranged = docs.select("doc_id", "text", F.xxhash64("text").alias("hash")).repartitionByRange(parts, *order)
    ranged = ranged.sortWithinPartitions(*order, "text").drop("hash").withColumn("part", F.spark_partition_id())
    coded = ranged.mapInArrow(partial(_encode_part, path=tokenizer, end_id=end_id), f"part int, doc_id {id_type}, part_start bigint, n_tokens bigint, ids array<int>")
    (
        coded.write.option("compression", "zstd")
        .option("parquet.writer.version", "v2")
        .option("parquet.block.size", str(ROW_GROUP))
        .option("parquet.page.size", str(PAGE))
        .option("parquet.enable.dictionary", "true")
        .option("parquet.enable.dictionary#doc_id", "false")
        .option("parquet.enable.dictionary#part_start", "false")
        .parquet(folder)
    )
    return folder


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): start counts the ids of all documents before
    it. Sums come from the metadata columns; one row a range goes through the
    window."""
    files = spark.read.parquet(folder)
    sums = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return files.join(F.broadcast(base), "part").select("doc_id", (F.col("base") + F.col("part_start")).alias("start"), "n_tokens", "ids")


def digests(rows: DataFrame) -> DataFrame:
    """``rows`` of :func:`read` with ids_crc32 in place of ids: the CRC-32 of the
    ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            values, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            crcs = [zlib.crc32(memoryview(np.ascontiguousarray(values[a:b], dtype="<i4")).cast("B")) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "start", "n_tokens", "ids").mapInArrow(run, f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")
