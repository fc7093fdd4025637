"""Quality classifier: logistic regression on hashed word n-grams, trained
with follow-the-regularised-leader (FTRL-proximal) updates and scored as a
sparse dot product.

A text's words give unigrams of their letters, unigrams of the marks around
them (``***``, ``|``, ``!!``, all capitals) and bigrams; a word that repeats
the one before it gives a back-reference bigram in place of the pair, so that
stutter is one feature whatever the word. Values are shares of the words,
times ``SCALE``.

Edge cases: null and empty texts have no features and get the score of the
intercept; with no labelled rows every score is 0.5 (predicted 1). Rows are
scored one by one, so that ties, repeated rows and null ids keep their rows;
extra columns are never read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import held, text_id_crc

BITS = 18
SCALE = 12.0
#: Most labelled rows that training reads, and the longest text among them.
SAMPLE_ROWS = 4000
SAMPLE_CHARS = 20_000
CACHE_WORDS = 150_000

_PARTS = re.compile(r"^([\W_]*)(.*?)([\W_]*)$", re.DOTALL)
_SAME = zlib.crc32(b"\x00same")


def _codes(word: str) -> int:
    """The hash of the letters in the low half, that of the marks above it."""
    lead, core, trail = _PARTS.match(word).groups()
    mark = lead + "\x01" + trail if lead or trail else ""
    if len(core) > 1 and core.isupper():
        mark += "\x02"
    low = core.lower()
    code = zlib.crc32(low.encode("utf-8", "surrogatepass")) if low else 0
    return code | zlib.crc32(mark.encode("utf-8", "surrogatepass")) << 32 if mark else code


class _Words(dict):
    """Word to hash codes; emptied when it is full, which bounds its memory."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = code = _codes(word)
        return code




def features(text: str | None) -> tuple[np.ndarray, int]:
    """Indices of all n-grams of the whole text, repeats included, and the
    number of words."""
    words = text.split() if text else []
    if not words:
        return np.empty(0, np.int64), 0
    known = held(("quality",), _Words)
    codes = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    core, mark = codes & np.uint64(0xFFFFFFFF), codes >> np.uint64(32)
    pair = (core[:-1] * np.uint64(0x9E3779B1) + core[1:] * np.uint64(0x85EBCA77)) >> np.uint64(7)
    pair[(core[:-1] == core[1:])] = _SAME
    every = np.concatenate([core[core > 0], mark[mark > 0] + np.uint64(0x5BD1E995), pair])
    return ((every * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64), len(words)


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    bias: float

    def logit(self, text: str | None) -> float:
        index, n = features(text)
        return self.bias + (SCALE * float(self.weights[index].sum(dtype=np.float64)) / n if n else 0.0)


def train(rows: list[tuple[str | None, int]], epochs: int = 4, alpha: float = 0.3, beta: float = 0.1, l1: float = 0.02, l2: float = 0.001) -> QualityModel:
    """FTRL-proximal over ``rows`` (text, label) in their order."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weight(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2))

    ready = []
    for text, label in rows:
        index, words = features(text)
        index, counts = np.unique(index, return_counts=True)
        ready.append((np.append(index, size - 1), np.append(SCALE * counts / max(words, 1), 1.0), label))
    for _ in range(epochs):
        for index, value, label in ready:
            w = weight(index)
            p = 1 / (1 + np.exp(-np.clip(w @ value, -35, 35)))
            g = (p - label) * value
            sigma = (np.sqrt(n[index] + g * g) - np.sqrt(n[index])) / alpha
            z[index] += g - sigma * w
            n[index] += g * g
    w = weight(np.arange(size))
    return QualityModel(w[:-1].astype(np.float32), float(w[-1]) if ready else 0.0)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> list[tuple[str, int]]:
    """At most ``rows`` labelled (text, label) of at most ``chars`` characters,
    taken by a hash of the id among the labels that ``usable`` admits."""
    ids = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & usable)
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # At most `rows` pairs of numbers, so that this side can be broadcast.
    got = (
        docs.select("doc_id", "text")
        .join(F.broadcast(ids), "doc_id")
        .filter(F.length("text") <= chars)
        .select(F.xxhash64("doc_id").alias("h"), "doc_id", "text", "label")
        .collect()
    )
    return [(r.text, r.label) for r in sorted(got, key=lambda r: (r.h, r.doc_id, r.text))]


def usable_ids() -> Column:
    return text_id_crc() % 3 != 1


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> QualityModel:
    return train(labelled_sample(docs, labels, "quality", usable_ids(), rows))


def scorer(spark: SparkSession, model: QualityModel):
    """A column function: text to probability of label 1."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        for batch in texts:
            logits = np.fromiter((m.logit(t) for t in batch), dtype=np.float64, count=len(batch))
            yield pd.Series(1 / (1 + np.exp(-np.clip(logits, -500, 500))))

    return score.asNondeterministic()
