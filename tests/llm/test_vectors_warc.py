"""Vector operators and WARC bundles against brute force."""

from __future__ import annotations

import base64
import hashlib
import io

import duckdb
import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tidemill.llm import pq_dedup, queries, rp_forest, warc
from tidemill.llm.vectors import kmeans, unit

VEC = "vec_id bigint, embedding array<float>, label int"
ODD_VECTORS = [(900, None, 1), (901, [0.0] * 8, 1), (902, [float("nan")] + [1.0] * 7, 1), (903, [float("inf")] + [1.0] * 7, 1), (904, [None] + [1.0] * 7, 1), (905, [], 1), (906, [1.0] * 8, None), (907, [1.0] * 5, 1), (908, [1.0] * 5, 1)]


def _vectors(n=400, dim=8, seed=4):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(60, dim))
    x = base[rng.integers(0, 60, n)] + rng.normal(scale=0.06, size=(n, dim))
    x[10:25] = x[9]
    return [(i, [float(np.float32(v)) for v in x[i]], int(i % 3)) for i in range(n)]


def _brute(rows, threshold=0.98):
    ok = [i for i, (_, v, lab) in enumerate(rows) if v and lab is not None and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    near: dict = {i: [] for i in range(len(rows))}
    for i in ok:
        for j in ok:
            if i != j and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1]), np.array(rows[j][1])
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                    near[i].append(j)
    out = {}
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[rows[i][0]] = (len(near[i]), min(rows[j][0] for j in seen))
    return out


@pytest.mark.parametrize("block", [256, 7])
def test_pq_dedup_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(pq_dedup, "BLOCK", block)
    rows = _vectors() + ODD_VECTORS
    df = spark.createDataFrame(rows, VEC).withColumns({c: F.lit(0) for c in ("cell", "cid", "m", "root", "links", "n_links", "component_id")})
    got = {r.vec_id: (r.n_links, r.component_id) for r in pq_dedup.components(spark, df).collect()}
    assert got == _brute(rows)


def test_pq_probes_and_bounds_are_sufficient():
    rng = np.random.default_rng(1)
    x = unit(rng.normal(size=(600, 16)))
    y = unit(x + rng.normal(scale=0.03, size=x.shape))
    q = pq_dedup.fit(list(x))
    home, _ = q.lists(y)
    codes, errors = q.code(y, home)
    _, probes = q.lists(x)
    linked = np.flatnonzero((x * y).sum(axis=1) >= 0.98)
    assert len(linked) > 100
    for i in linked:
        assert probes[i, home[i]]
        assert q.near(x[i : i + 1], int(home[i]), codes[i : i + 1], errors[i : i + 1])[0, 0]


def test_pq_dedup_empty_repeated_and_sql(spark, data):
    assert pq_dedup.components(spark, spark.createDataFrame([], VEC)).count() == 0
    same = [(5, [1.0, 2.0], 1), (5, [1.0, 2.0], 1), (3, [1.0, 2.0], 1), (None, [1.0, 2.0], 1)]
    got = pq_dedup.components(spark, spark.createDataFrame(same, VEC)).collect()
    assert [(r.n_links, r.component_id) for r in got] == [(3, 3)] * 4
    db = duckdb.connect()
    db.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{data}/embeddings.parquet'")
    rel = db.sql(queries.OP6_SQL)
    rows = queries.QUERIES["op6_pq_dedup"](spark, data).collect()
    assert sorted(tuple(r[c] for c in rel.columns) for r in rows) == sorted(rel.fetchall())


def _exact(rows, k):
    ok = [(i, np.array(v)) for i, v, _ in rows if v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    out = {}
    for q, v in ok:
        if q % 20 == 0:
            out[q] = sorted(((-(x * v).sum(), i) for i, x in ok if i != q and len(x) == len(v)))[:k]
    return out


def test_forest_of_small_tables_is_exhaustive(spark):
    rows = _vectors(120) + ODD_VECTORS + [(920, [1.0, 2.0, 0.5, 1.0, 1.0], 1), (940, [2.0, 1.0], 1)]
    df = spark.createDataFrame(rows, VEC).withColumns({c: F.lit(0) for c in ("leaf", "tree", "rank", "score")})
    got: dict = {}
    for r in rp_forest.search(spark, df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = _exact(rows, 20)
    assert set(got) == {q for q in want if want[q]} and len(got[920]) == 2
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, len(want[q]) + 1))
        assert [v for _, v, _ in found] == [i for _, i in want[q]]
        assert [s for _, _, s in found] == pytest.approx([-s for s, _ in want[q]], rel=1e-14)


def test_forest_counts_repeated_rows_once(spark):
    rows = [(i, v) for i, v, _ in _vectors(120)[:100]]
    twice = rows * 2
    q = np.array(rows[0][1])
    nearest = max((r for r in rows if r[0] != rows[0][0]), key=lambda r: np.array(r[1]) @ q)
    for table in (twice, [*rows, *[nearest] * 30], [*rows, *[(nearest[0], [0.5 * c for c in nearest[1]])] * 30]):
        df = spark.createDataFrame([(i, v, 0) for i, v in table], VEC)
        found = rp_forest.search(spark, df, F.col("vec_id") == rows[0][0]).orderBy("rank").collect()
        want = sorted((-(np.array(v) * q).sum(), i) for i, v in rows if i != rows[0][0])[:20]
        assert [r.vec_id for r in found] == [i for _, i in want]
        assert [r.score for r in found] == pytest.approx([-s for s, _ in want], rel=1e-14)


def test_forest_recall_and_few_candidates(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    df = spark.createDataFrame([(i, [float(c) for c in v], 0) for i, v in enumerate(x)], VEC)
    hits: dict = {}
    for r in rp_forest.search(spark, df, F.col("vec_id") % 100 == 0).collect():
        hits.setdefault(r.query_id, set()).add(r.vec_id)
    y = x.astype(float)
    recall = [len(hits[q] & set(sorted((i for i in range(3000) if i != q), key=lambda i: -(y[i] @ y[q]))[:20])) / 20 for q in hits]
    assert len(hits) == 30 and np.mean(recall) >= 0.9
    assert all(len(h) == 20 for h in hits.values())
    few = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [1.0, 1.0], 0), (2, [1.0, 1.0], 0)], VEC)
    assert [(r.rank, r.vec_id) for r in rp_forest.search(spark, few, F.col("vec_id") == 0).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert rp_forest.search(spark, spark.createDataFrame([], VEC), F.lit(True)).count() == 0


def _clustered(n, dim=24, seed=13):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 40, dim))
    return (centres[rng.integers(0, len(centres), n)] + rng.normal(scale=0.1, size=(n, dim))).astype(np.float32)


def test_forest_grows_with_the_rows(spark, monkeypatch):
    """Twice the rows, but not twice the candidates; recall is that of brute force."""
    monkeypatch.setattr(rp_forest, "ROWS_PER_LEAF", 32)
    monkeypatch.setattr(rp_forest, "LEAF", 8)
    read = {}
    for n in (4000, 8000):
        x = _clustered(n)
        df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], VEC).cache()
        y = x.astype(float)
        forest, visits = rp_forest.plan(y, float(np.sqrt((y * y).sum(axis=1).max())), n, lambda df=df: rp_forest.nearest(df, 20))
        assert visits < 0.15 * forest.count()
        read[n] = visits * n * len(forest.trees) / forest.count()
        hits: dict = {}
        for r in rp_forest.search(spark, df, F.col("vec_id") % 100 == 0).collect():
            hits.setdefault(r.query_id, set()).add(r.vec_id)
        want = {q: set(sorted((i for i in range(n) if i != q), key=lambda i, q=q: -(y[i] @ y[q]))[:20]) for q in hits}
        assert len(hits) == n // 100 and np.mean([len(hits[q] & want[q]) / 20 for q in hits]) >= 0.9
    assert read[8000] < 1.6 * read[4000]


def test_lists_grow_with_the_rows():
    """More rows make more lists; vectors outside the sample then meet no larger share
    of the rows, and probe a bounded number of lists."""
    share, lists = {}, {}
    for n in (8000, 32_000):
        x = unit(_clustered(n).astype(float))
        q = pq_dedup.fit(x[: pq_dedup.SAMPLE_PER_LIST * pq_dedup.n_lists(n)], lists=pq_dedup.n_lists(n))
        home, probes = q.lists(x[-500:])
        lists[n] = len(q.centres)
        share[n] = (probes @ np.bincount(q.lists(x)[0], minlength=len(q.centres))).mean() / n
        assert (probes & (np.arange(lists[n])[None, :] <= home[:, None])).sum(axis=1).mean() <= pq_dedup.MEAN_PROBES
    assert lists[32_000] > 2 * lists[8000] and share[32_000] <= share[8000] * 1.05


def test_kmeans_handles_few_rows():
    assert len(kmeans(np.ones((5, 2)), 4)) == 1


# --- WARC -------------------------------------------------------------------------------

PAGES = "page_id bigint, url string, html string"


def _digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_warc_round_trip(spark, tmp_path):
    rows = [(5, "http://a/", "same"), (2, "http://b/", "same"), (9, None, "same"), (1, "http://c/", None), (4, "http://d\n/", ""), (3, "u", "x" * 3_000_000), (7, "u", "WARC/1.1\r\n\r\nü"), (None, "u", "same"), (None, "u", "alone"), (2, "http://b/", "same")]
    pages = spark.createDataFrame(rows, PAGES).withColumns({c: F.lit(0) for c in ("key", "salt", "first", "payload", "frame")})
    index = warc.write(spark, pages, f"file://{tmp_path}/w")
    got = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read(index).collect())
    first: dict = {}
    for p, _, h in rows:
        if p is not None:
            first[h or ""] = min(p, first.get(h or "", p))
    want = []
    for p, _, h in rows:
        payload = (h or "").encode()
        f = first.get(h or "")
        revisit = f is not None and p != f
        want.append((str(p), len(payload), _digest(payload), "revisit" if revisit else "response", f if revisit else None))
    assert got == sorted(want, key=lambda r: r[:4])
    # Any Zstandard reader sees one stream, and the index leads to single records.
    entries = index.collect()
    assert len(entries) == len(rows)
    for e in entries:
        headers, block = warc.read_record(e)
        assert headers["WARC-Record-ID"] == warc.record_id(e.page_id)
        if e.record_type == "response" and e.page_id == 3:
            assert block.endswith(b"x" * 3_000_000)
    for bundle in {e.bundle for e in entries}:
        with open(bundle.removeprefix("file://"), "rb") as f:
            table = warc.seek_table(f)
            f.seek(0)
            plain = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
        assert len(plain) == sum(n for _, _, n in table)
        assert plain.startswith(b"WARC/1.1\r\n")


def test_warc_minimum_and_empty(spark, tmp_path):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")]
    index = warc.write(spark, spark.createDataFrame(rows, PAGES), f"file://{tmp_path}/m", min_bytes=3)
    assert {r.page_id: r.record_type for r in index.collect()} == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    assert warc.read(warc.write(spark, spark.createDataFrame([], PAGES), f"file://{tmp_path}/e")).count() == 0


def test_seek_table_of_several_frames():
    out = io.BytesIO()
    w = warc.BundleWriter(out)
    where = [w.frame(bytes([i]) * 1000) for i in range(5)]
    w.close()
    assert [(s, c) for s, c, _ in warc.seek_table(out)] == [(s, c) for _, s, c in where]


def test_warc_sql(spark, data):
    db = duckdb.connect()
    db.sql(f"CREATE VIEW pages AS SELECT * FROM '{data}/pages.parquet'")
    rel = db.sql(queries.OP3_SQL)
    rows = queries.QUERIES["op3_warc"](spark, data).collect()
    assert sorted(map(str, (tuple(r[c] for c in rel.columns) for r in rows))) == sorted(map(str, rel.fetchall()))


@pytest.mark.parametrize("scheme", ["{}", "file:{}", "file://{}"])
def test_warc_query_makes_its_folder_by_any_kind_of_path(spark, data, tmp_path, scheme, monkeypatch):
    from tidemill.llm import common

    db = duckdb.connect()
    db.sql(f"CREATE VIEW pages AS SELECT * FROM '{data}/pages.parquet'")
    rel = db.sql(queries.OP3_SQL)
    monkeypatch.setattr(common, "_configured", lambda _: scheme.format(tmp_path / "new"))
    rows = queries.QUERIES["op3_warc"](spark, data).collect()
    assert sorted(map(str, (tuple(r[c] for c in rel.columns) for r in rows))) == sorted(map(str, rel.fetchall()))
    assert list(tmp_path.rglob("*.warc.zst"))


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from tidemill.llm.common import shared_dir

    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"))
    with pytest.raises(RuntimeError, match=r"spark\.checkpoint\.dir"):
        shared_dir(bare)
