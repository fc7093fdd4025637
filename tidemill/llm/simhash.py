"""SimHash near-dedup with Golay-code fuzzy hashing.

A text's fingerprint has 64 bits: bit b is set if it is set in over half of
the XXH64 hashes (seed 42) of its word shingles. Fingerprints link at
``MAX_BITS`` = 3 or fewer differing bits.

Search. The fingerprint is cut into segments of 22, 21 and 21 bits, each padded
to the 23 bits of the binary Golay code. Of two fingerprints that differ in at most
three bits, either one segment is equal and another differs in one bit at most, or
each segment differs in exactly one bit (pigeonhole). A segment's nearest codeword
is at distance 3 at most, so it is within 4 of any segment that differs in one bit;
each segment has one or six codewords within 4. The keys are therefore

* for each ordered pair of segments the first one and a codeword of the second (33
  or 34 bits): a fingerprint is *stored* under the nearest codeword (6 keys) and
  *looks* under all codewords within 4 (6 or up to 36 keys);
* codewords of all three segments (36 bits): stored under all of the first within
  4 with the nearest of the others (up to 6 keys), looked for under the nearest of
  the first with all of the others (up to 36 keys),

some 11 and 60 keys, and every link is found, while keys are so long that
fingerprints seldom meet by chance. Distinct fingerprints are searched, not
documents, so copies cost nothing.

Keys with many stored fingerprints (clusters of near copies) are searched in
blocks of bounded size, of which each returns a spanning forest of its links, not
all pairs; under other keys fingerprints are verified by ``bit_count`` where they
meet. The look rows are dealt out once: they meet the stored fingerprints of a key
or, where these are many, a mark in their place; only what has met a mark goes on to
the blocks.

Edge cases: null, empty and blank texts have fingerprint zero, which links like
any other; texts of fewer words than a shingle hash their whole sequence. A
null id keeps its row in :func:`components`; component ids are the smallest
non-null id reachable (null where there is none). Rows that share an id are rows of
their own. Extra columns are never read there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations, permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import connected_components, remove, slices, written

SHINGLE = 3
SEED = 42
MAX_BITS = 3
#: (shift, width) of the segments.
SEGMENTS = ((42, 22), (21, 21), (0, 21))
#: Keys with more stored fingerprints than this are searched in blocks.
DENSE = 48
BLOCK = 2048
#: Bytes of text that are fingerprinted at once.
TEXT_BYTES = 8 << 20


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned fingerprint of a whole text. ``bytes.lower`` and
    ``bytes.split`` know A-Z and the six ASCII white-space bytes only."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - shingle + 1
    h = xxhash.xxh64_intdigest
    if n <= 1:
        return h(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    hashes = np.array([h(joined[s:e], seed) for s, e in zip(starts[:n].tolist(), ends[shingle - 1 :].tolist(), strict=True)], dtype="<u8")
    counts = np.zeros(64, np.int64)
    for i in range(0, n, 4096):
        counts += np.unpackbits(hashes[i : i + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, also: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp) and the columns ``also``: fp is the fingerprint as a signed
    64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, batch.num_rows, TEXT_BYTES):
                fps = np.array([fingerprint(t, shingle, seed) for t in part.column(1).to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps.view(np.int64)), *part.columns[2:]], ["doc_id", "fp", *also])

    kind = lambda c: f"{c} {docs.schema[c].dataType.simpleString()}"
    return docs.select("doc_id", "text", *also).mapInArrow(run, ", ".join([kind("doc_id"), "fp bigint", *map(kind, also)]))


# --- the binary Golay code [23, 12, 7] --------------------------------------------------


def _syndrome(v: int, generator: int = 0b110001110101) -> int:
    """Remainder of v (23 bits) by the generator polynomial (degree 11)."""
    for bit in range(22, 10, -1):
        if v >> bit & 1:
            v ^= generator << (bit - 11)
    return v


@cache
def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the high 12 and the low 11 bits; for each syndrome the
    error patterns of weight 4 at most (nearest first, up to six), and their
    number. The code is perfect with radius 3, and a word at distance 3 from
    its codeword has five codewords at distance 4; others have none."""
    single = [_syndrome(1 << i) for i in range(23)]
    high = np.zeros(1 << 12, np.int64)
    low = np.zeros(1 << 11, np.int64)
    for table, offset in ((low, 0), (high, 11)):
        for v in range(1, len(table)):
            bit = v & -v
            table[v] = table[v ^ bit] ^ single[offset + bit.bit_length() - 1]
    patterns = np.zeros((1 << 11, 6), np.int64)
    number = np.zeros(1 << 11, np.int64)
    for weight in range(5):
        for bits in combinations(range(23), weight):
            s = 0
            for b in bits:
                s ^= single[b]
            patterns[s, number[s]] = sum(1 << b for b in bits)
            number[s] += 1
    return high, low, patterns, number


def codeword_indices(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each 23-bit segment the 12-bit indices of the codewords within
    distance 4, nearest first (six columns), and how many there are."""
    high, low, patterns, number = golay_tables()
    s = high[segment >> 11] ^ low[segment & 0x7FF]
    return (segment[:, None] ^ patterns[s]) >> 11, number[s]


def _combined(kind: int, columns: list[tuple[np.ndarray, np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of every choice of one value from each of ``columns`` (values, how many
    of them count, bits), and which of the keys count."""
    n = len(columns[0][0])
    key, valid = np.full((n, 1), kind, np.int64), np.ones((n, 1), bool)
    for values, number, bits in columns:
        key = ((key[:, :, None] << bits) | values[:, None, :]).reshape(n, -1)
        valid = (valid[:, :, None] & (np.arange(values.shape[1]) < number[:, None])[:, None, :]).reshape(n, -1)
    return key, valid


def keys(fps: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Of each fingerprint (uint64) the keys that it is stored under and those that it
    looks under: each as an array of columns and which of them count."""
    one = np.ones(len(fps), np.int64)
    exact, near, all_ = [], [], []
    for shift, width in SEGMENTS:
        segment = ((fps >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)
        words, number = codeword_indices(segment)
        exact.append((segment[:, None], one, 22))
        near.append((words[:, :1], one, 12))
        all_.append((words, number, 12))
    stored = [_combined(k, [exact[i], near[j]]) for k, (i, j) in enumerate(permutations(range(3), 2), 1)]
    looks = [_combined(k, [exact[i], all_[j]]) for k, (i, j) in enumerate(permutations(range(3), 2), 1)]
    stored.append(_combined(7, [all_[0], near[1], near[2]]))
    looks.append(_combined(7, [near[0], all_[1], all_[2]]))
    joined = lambda found: tuple(np.concatenate(x, axis=1) for x in zip(*found, strict=True))
    return joined(stored), joined(looks)


def _key_rows(classes: DataFrame, look: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = np.asarray(batch.column(0))
            for i in range(0, len(signed), 4096):
                fps = signed[i : i + 4096]
                key, valid = keys(fps.view(np.uint64))[look]
                yield pa.RecordBatch.from_arrays([pa.array(key[valid]), pa.array(np.repeat(fps, valid.sum(axis=1)))], ["key", "fp"])

    return classes.select("fp").mapInArrow(run, "key bigint, fp bigint")


def forest(a: np.ndarray, b: np.ndarray, near: np.ndarray, part: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links ``near`` (rows: a, columns: b). A row is
    linked to one member of each part of the graph that it joins. ``part``: the parts
    of the columns so far, which this changes."""
    part = np.arange(len(b)) if part is None else part
    out = []
    for i in range(len(a)):
        js = np.flatnonzero(near[i])
        if not len(js):
            continue
        parts, first = np.unique(part[js], return_index=True)
        out += [(int(a[i]), int(b[j])) for j in js[first]]
        if len(parts) > 1:
            part[np.isin(part, parts)] = parts[0]
    return out


def _block_links(pdf: pd.DataFrame) -> pd.DataFrame:
    stored = pdf.loc[pdf["look"] == 0, "fp"].to_numpy()
    looks = pdf.loc[pdf["look"] == 1, "fp"].to_numpy()
    out, joined = [], np.arange(len(stored))
    if len(stored):
        for i in range(0, len(looks), 512):
            part = looks[i : i + 512]
            near = np.bitwise_count(part.view(np.uint64)[:, None] ^ stored.view(np.uint64)[None, :]) <= MAX_BITS
            out += forest(part, stored, near, joined)
    return pd.DataFrame([(x, y) for x, y in out if x != y], columns=["a", "b"], dtype="int64")


def links(spark: SparkSession, classes: DataFrame, made: list[DataFrame] | None = None) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect whatever is
    linked. ``classes`` has one row for each fingerprint. ``made`` gets the written
    tables that the result reads, which can go when it has been read."""
    stored = written(spark, _key_rows(classes, look=False), "stored")
    dense = stored.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > DENSE)
    dense = written(spark, dense.withColumn("nb", F.ceil(F.col("n") / BLOCK).cast("int")), "dense")
    few = stored.join(dense, "key", "left_anti").select("key", F.col("fp").alias("other"))
    marks = dense.select("key", F.lit(None).cast("bigint").alias("other"))
    faced = written(spark, few.union(marks), "faced")
    # The planner takes the look rows for as small as the fingerprints: the hint keeps
    # them from being broadcast.
    close = F.col("other").isNull() | ((F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= MAX_BITS) & (F.col("fp") != F.col("other")))
    met = _key_rows(classes, look=True).hint("merge").join(faced, "key").filter(close)
    met = written(spark, met.select(F.when(F.col("other").isNull(), F.col("key")).alias("key"), "fp", "other"), "met")
    plain = met.filter("other is not null").select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b"))
    looks = met.filter("key is not null").select("key", "fp")
    asked = looks.groupBy("key").agg(F.count("*").alias("m"))
    plan = written(spark, dense.join(asked, "key").select("key", "nb", F.ceil(F.col("m") / BLOCK).cast("int").alias("mb")), "plan")
    if made is not None:
        made += [stored, dense, faced, met, plan]
    mine = F.pmod(F.xxhash64("fp"), F.col("nb").cast("bigint")).cast("int")
    theirs = F.pmod(F.xxhash64("fp"), F.col("mb").cast("bigint")).cast("int")
    blocks = (
        stored.join(plan, "key")
        .select("key", "fp", F.lit(0).alias("look"), mine.alias("i"), F.explode(F.sequence(F.lit(0), F.col("mb") - 1)).alias("j"))
        .union(looks.join(plan, "key").select("key", "fp", F.lit(1).alias("look"), F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("i"), theirs.alias("j")))
    )
    return plain.union(blocks.groupBy("key", "i", "j").applyInPandas(_block_links, "a bigint, b bigint"))


def _groups(spark: SparkSession, fps: DataFrame, best: Column) -> DataFrame:
    """(fp, root, best): the group of each distinct fingerprint and the smallest
    ``best`` of the group's rows."""
    classes = written(spark, fps.groupBy("fp").agg(F.min(best).alias("best")), "classes")
    made: list[DataFrame] = []
    roots = connected_components(spark, links(spark, classes, made))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "best", F.coalesce("root", "fp").alias("root"))
    rooted = written(spark, rooted, "rooted")
    smallest = written(spark, rooted.groupBy("root").agg(F.min("best").alias("best")), "smallest")
    named = written(spark, rooted.drop("best").join(smallest, "root").select("fp", "root", "best"), "named")
    for t in (rooted, smallest, roots, classes, *made):
        remove(spark, t)
    return named


def components(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp, component_id), a row for each document."""
    fps = written(spark, fingerprints(docs, shingle, seed), "fps")
    named = _groups(spark, fps, F.col("doc_id"))
    return fps.join(named, "fp").select("doc_id", "fp", F.col("best").alias("component_id"))


def keep_one(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near copies: that with the smallest id
    (null ids last), and of rows that share it that with the smallest hash of all
    columns (but maps, which have no hash). Rows that are equal in all of these count
    as one. Names that begin with ``_simhash_`` are its own."""
    hashed = [c for c, kind in docs.dtypes if "map<" not in kind]
    rows = docs.withColumn("_simhash_row", F.xxhash64(*[F.col(f"`{c}`") for c in hashed]))
    fps = written(spark, fingerprints(rows, also=("_simhash_row",)), "fps")
    named = _groups(spark, fps, F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("_simhash_row").alias("row")))
    best = named.filter("fp = root").select(F.col("best.id").alias("_simhash_id"), F.col("best.row").alias("_simhash_like"))
    again = fps.groupBy(F.col("doc_id").alias("of"), F.col("_simhash_row").alias("like")).agg(F.count("*").alias("n")).filter("n > 1")
    same = best["_simhash_id"].eqNullSafe(again["of"]) & (best["_simhash_like"] == again["like"])
    kept = written(spark, best.join(again, same, "left").select("_simhash_id", "_simhash_like", F.col("n").isNotNull().alias("again")), "kept")
    remove(spark, fps)
    remove(spark, named)

    def of(some: DataFrame) -> DataFrame:
        return rows.join(some, rows["doc_id"].eqNullSafe(some["_simhash_id"]) & (rows["_simhash_row"] == some["_simhash_like"]), "left_semi")

    once, repeated = of(kept.filter("not again")), of(kept.filter("again"))
    return once.unionByName(repeated.dropDuplicates(["doc_id", "_simhash_row"])).select(*[F.col(f"`{c}`") for c in docs.columns])
