"""The corpus pipeline against a plain version of every stage."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest

pytest.importorskip("public_tokenizers")
import corpus_pipeline  # noqa: E402
import public_tokenizers  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tests.llm.test_text import _fingerprint, _roots, _targets  # noqa: E402
from tidemill.llm import bpe, quality, toxicity  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _mix(rows):
    """doc_id to copies, from Pareto's variable in plain arithmetic."""
    sizes = Counter()
    for r in rows:
        sizes[r.source] += len((r.text or "").split())
    targets, out = _targets(dict(sizes)), {}
    for s, total in sizes.items():
        whole = int(targets[s] // total) if total else 0
        rest, mine = targets[s] - whole * total, []
        for r in rows:
            if r.source == s:
                u = (int(hashlib.md5(f"mix-1:{r.doc_id}".encode()).hexdigest()[:12], 16) + 0.5) / (1 << 48)
                mine.append((u / (1 - u), r.doc_id, len((r.text or "").split())))
        start, p = 0, rest / total if total else 0
        for _, d, n in sorted(mine):
            out[d] = whole + int(0 < p < 1 and start + n / 2 <= rest)
            start += n
    return out


def test_pipeline_equals_a_plain_version(spark, data):
    tiktoken = pytest.importorskip("tiktoken")
    docs = spark.read.parquet(f"{data}/documents.parquet")
    labels = spark.read.parquet(f"{data}/labels.parquet")
    rows = docs.collect()
    model = quality.fit(docs, labels)
    rows = [r for r in rows if model.logit(r.text) >= 0]
    kept = spark.createDataFrame(rows, docs.schema)
    toxic = toxicity.fit(kept, labels)
    rows = sorted((r for r in rows if toxic.score(r.text) < 0.5), key=lambda r: r.doc_id)
    roots = _roots([_fingerprint(r.text) for r in rows])
    rows = [r for i, r in enumerate(rows) if roots[i] == i]
    copies = _mix(rows)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    want = Counter()
    for r in rows:
        ids = library.encode_ordinary(r.text or "")
        want[(r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())] = copies[r.doc_id]
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, data).collect())
    assert got == +want


def test_stages_keep_the_columns_and_take_odd_rows(spark, data, docs, odd):
    frame = docs(odd + [(50 + i, f"some words number {i} of a clean text", "t") for i in range(5)], clash=False)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, data)
        assert frame.columns == COLUMNS
        frame = spark.createDataFrame(frame.collect(), frame.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, frame, data)
    assert last.count() == frame.count()
    nothing = docs([], clash=False)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, data).count() == 0
    assert len(corpus_pipeline.STAGES) == 5 and F is not None
