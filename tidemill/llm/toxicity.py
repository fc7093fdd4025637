"""Toxicity by compression distance: windows of a text are compressed with a
zstandard dictionary of ordinary text and with one of toxic text; what the
toxic dictionary saves is the evidence, and thresholds on it are calibrated on
labelled rows.

Both dictionaries are trained by zstandard's trainer. That of ordinary text is
trained on ordinary windows; the toxic one on what remains of toxic texts when the
words that ordinary texts hold as well are taken out, since toxic texts are ordinary
but for a few words, and a dictionary of whole windows holds these by chance only. A
word remains if one of its beginnings is ``RATIO`` times as frequent among toxic
training texts. The toxic dictionary ends in the ordinary one, so that ordinary words
cost the same in either. Windows are runs of whole words of at least ``WINDOW`` bytes
and cover the whole text; a longer word is cut into windows of ``LONGEST`` bytes. A
text's score is a logistic function of its largest saving, the means of its three
largest and of all savings, the number of windows, and how many of them pass each of
three thresholds, fitted on the training rows.

Edge cases: null, empty and blank texts have no window and score 0; without
labelled rows of both kinds every score is 0. Rows are scored one by one, so
that ties, repeated rows and null ids keep their rows; extra columns are never
read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import text_id_crc
from tidemill.llm.quality import labelled_sample

WINDOW = 64
#: Longest window of a word that has no white space in it.
LONGEST = 4096
ORDINARY_BYTES = 32_768
TOXIC_BYTES = 1024
#: How many times as frequent among toxic texts a beginning has to be, the share of
#: toxic texts that have it at least, and words of a sample for the trainer.
RATIO = 30
SHARE = 0.04
SAMPLE_WORDS = 4
SAMPLE_ROWS = 6000
SAMPLE_CHARS = 20_000
_MARKS = b".,;:!?$%&*#|\"'()"


def windows(text: str | None) -> list[bytes]:
    out, run, size = [], [], 1
    for word in text.encode("utf-8", "surrogatepass").lower().split() if text else ():
        if len(word) > LONGEST:
            if run:
                out.append(b" " + b" ".join(run) + b" ")
                run, size = [], 1
            out += [word[i : i + LONGEST] for i in range(0, len(word), LONGEST)]
            continue
        run.append(word)
        size += len(word) + 1
        if size >= WINDOW:
            out.append(b" " + b" ".join(run) + b" ")
            run, size = [], 1
    if run:
        out.append(b" " + b" ".join(run) + b" ")
    return out


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_LAZY2, min_match=4, window_log=16, hash_log=15, chain_log=15, search_log=8, target_length=32, write_content_size=0, write_dict_id=0
    )
    data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=data, compression_params=settings)


@dataclass
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    coefficients: np.ndarray

    def __getstate__(self):
        return {"ordinary": self.ordinary, "toxic": self.toxic, "coefficients": self.coefficients}

    def savings(self, text: str | None) -> np.ndarray:
        """Bytes that the toxic dictionary saves in each window."""
        if not hasattr(self, "_pair"):
            self._pair = _compressor(self.ordinary).compress, _compressor(self.toxic).compress
        plain, toxic = self._pair
        return np.array([len(plain(w)) - len(toxic(w)) for w in windows(text)], dtype=np.float64)

    def evidence(self, text: str | None) -> np.ndarray | None:
        saved = self.savings(text)
        if not len(saved):
            return None
        top = -np.sort(-saved)[:3]
        passed = [float((saved >= t).sum()) for t in (1, 2, 3)]
        return np.array([1.0, top[0], top.mean(), passed[1] / len(saved), np.log(len(saved)), *np.log1p(passed), saved.mean(), float(top[0] >= 3), float(top[0] >= 2)])

    def score(self, text: str | None) -> float:
        if self.coefficients is None or (x := self.evidence(text)) is None:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(x @ self.coefficients, -500, 500))))


def _beginnings(words: set[bytes]) -> set[bytes]:
    out = set()
    for word in words:
        word = b" " + word.strip(_MARKS)
        out.update(word[:k] for k in range(4, min(len(word), 13) + 1))
    return out


def toxic_samples(rows: list[tuple[str, int]]) -> list[bytes]:
    """What remains of the toxic texts without the words of ordinary ones, in pieces
    of ``SAMPLE_WORDS`` words."""
    seen: tuple[Counter, Counter] = Counter(), Counter()
    total = [0, 0]
    for text, label in rows:
        seen[label].update(_beginnings(set((text or "").encode("utf-8", "surrogatepass").lower().split())))
        total[label] += 1
    if not min(total):
        return []
    marks = {p for p, n in seen[1].items() if n >= max(3, SHARE * total[1]) and n * total[0] >= RATIO * (seen[0][p] + 0.5) * total[1]}
    out = []
    for text, label in rows:
        if label and text:
            words = [b" " + w.strip(_MARKS) for w in text.encode("utf-8", "surrogatepass").lower().split()]
            words = [w for w in words if any(w[:k] in marks for k in range(4, 14))]
            out += [b"".join(words[i : i + SAMPLE_WORDS]) + b" " for i in range(0, len(words), SAMPLE_WORDS)]
    return out


def _dictionary(samples: list[bytes], size: int, **settings: int) -> bytes:
    """Content of a dictionary that zstandard trains on ``samples``; of too few for its
    trainer the samples themselves."""
    try:
        # Its header and tables come first and are left out.
        return zstandard.train_dictionary(size + 4096 if size > 4096 else 2 * size, samples, **settings).as_bytes()[-size:]
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, toxic_weight: float = 2.0) -> np.ndarray:
    """Logistic regression by Newton's method; a missed toxic text counts
    ``toxic_weight`` times a wronged ordinary one."""
    w = np.zeros(x.shape[1])
    v = np.where(y > 0, toxic_weight, 1.0)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        h = (x * (v * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (v * (p - y)) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(rows: list[tuple[str, int]]) -> ToxicityModel:
    samples = toxic_samples(rows)
    plain = [w for text, label in rows if not label for w in windows(text)]
    if not samples or len(plain) < 20:
        return ToxicityModel(b"", b"", None)
    # Evenly spaced windows, so that every part of the sample has a share.
    ordinary = _dictionary(plain[:: max(1, len(plain) // 40_000)], ORDINARY_BYTES)
    model = ToxicityModel(ordinary, _dictionary(samples, TOXIC_BYTES, k=16, d=6) + ordinary, None)
    pairs = [(e, label) for text, label in rows if (e := model.evidence(text)) is not None]
    model.coefficients = _calibrate(np.array([e for e, _ in pairs]), np.array([label for _, label in pairs], dtype=np.float64))
    return model


def usable_ids() -> Column:
    return text_id_crc() % 5 != 0


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> ToxicityModel:
    return train(labelled_sample(docs, labels, "toxic", usable_ids(), rows, SAMPLE_CHARS))


def scorer(spark: SparkSession, model: ToxicityModel):
    """A column function: text to probability that it is toxic."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        for batch in texts:
            yield pd.Series([m.score(t) for t in batch], dtype="float64")

    return score.asNondeterministic()
