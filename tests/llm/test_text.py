"""SimHash, mixing, BPE and token files against brute force."""

from __future__ import annotations

import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemill.llm import bpe, mixing, queries, simhash, token_files

public_tokenizers = pytest.importorskip("public_tokenizers")


# --- SimHash ----------------------------------------------------------------------------


def _fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _roots(fps):
    """Smallest reachable index of each fingerprint, all pairs compared."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def _components(spark, df):
    return {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in simhash.components(spark, df).collect()}


def test_golay_code_is_perfect():
    _, _, patterns, number = simhash.golay_tables()
    nearest = [int(p[0]).bit_count() for p in patterns]
    assert max(nearest) == 3 and sorted(set(number.tolist())) == [1, 6]
    assert sum(n == 3 for n in nearest) == 1771


def test_keys_meet_whenever_three_bits_differ():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 63, 400, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 400, dtype=np.uint64)
    b = a.copy()
    for i in range(len(a)):
        for bit in rng.choice(64, rng.integers(0, 4), replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    (stored, kept), (every, mask) = simhash.keys(a)[0], simhash.keys(b)[1]
    assert all(set(s[k].tolist()) & set(e[m].tolist()) for s, k, e, m in zip(stored, kept, every, mask, strict=True))
    assert kept.sum(axis=1).mean() < 12 and mask.sum(axis=1).mean() < 65


def test_fingerprints_and_components_match_brute_force(spark, docs, data):
    base = "the quick brown fox jumps over the lazy dog and runs far away from here today".split()
    rows = [(100 + i, " ".join(base * 8 + [f"w{i}"])) for i in range(40)]
    rows += [(r.doc_id + 1000, r.text) for r in queries.read(spark, data, "documents").collect()]
    rows += [(1, None), (2, ""), (3, "  \n"), (4, "A b"), (5, "a  B"), (6, "x " * 20_000)]
    got = _components(spark, docs(rows))
    rows.sort()
    fps = [_fingerprint(t) for _, t in rows]
    roots = _roots(fps)
    assert got == {d: (fps[i], rows[roots[i]][0]) for i, (d, _) in enumerate(rows)}


def test_dense_clusters_are_searched_in_blocks(spark, monkeypatch):
    """Thousands of fingerprints around one, with small limits."""
    monkeypatch.setattr(simhash, "DENSE", 3)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = np.random.default_rng(5)
    fps = {0x0123456789ABCDEF}
    while len(fps) < 250:
        f = int(rng.choice(sorted(fps)))
        for bit in rng.choice(64, 3, replace=False):
            f ^= 1 << int(bit)
        fps.add(f)
    fps |= {int(x) for x in rng.integers(0, 1 << 62, 100)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >= 1 << 63 else f for f in fps]
    classes = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    from tidemill.llm.common import connected_components

    roots = {r.node: r.root for r in connected_components(spark, simhash.links(spark, classes)).collect()}
    brute = _roots(fps)
    together = lambda keys: {frozenset(i for i, k in enumerate(keys) if k == v) for v in set(keys)}
    assert together([roots.get(s, s) for s in signed]) == together(brute)


def test_thousands_of_near_fingerprints_under_one_key(spark):
    """A cluster whose members share two segments, so that they meet under the same
    keys, in several blocks; and a chain that leads out of it."""
    rng = np.random.default_rng(6)
    centre = 0x5A5A5_00000_00000A
    low = [0, *(1 << i for i in range(21)), *(1 << i | 1 << j for i in range(21) for j in range(i)), *(1 << i | 1 << j | 1 << k for i in range(21) for j in range(i) for k in range(j))]
    fps = {centre ^ x for x in low} | {centre ^ (x << 21) for x in low}
    chain = centre
    for _ in range(30):
        chain ^= sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
        fps.add(chain)
    fps |= {int(x) for x in rng.integers(0, 1 << 62, 200)}
    assert len(fps) > 3000
    signed = [f - (1 << 64) if f >= 1 << 63 else f for f in sorted(fps)]
    found = simhash.links(spark, spark.createDataFrame([(f,) for f in signed], "fp bigint"))
    from tidemill.llm.common import connected_components, written

    found = written(spark, found, "found")
    assert found.count() < 100 * len(fps)  # forests under some 70 keys, not pairs
    roots = {r.node: r.root for r in connected_components(spark, found).collect()}
    x = np.array(sorted(fps), dtype=np.uint64)
    root = np.arange(len(x))
    while True:  # brute force over all pairs
        lower = np.array([root[np.bitwise_count(x ^ f) <= 3].min() for f in x])
        lower = lower[lower]
        if (lower == root).all():
            break
        root = lower
    together = lambda keys: {frozenset(i for i, k in enumerate(keys) if k == v) for v in set(keys)}
    assert together([roots.get(s, s) for s in signed]) == together(root.tolist())


def test_components_of_a_long_chain_in_random_order(spark):
    from tidemill.llm.common import connected_components

    ids = np.random.default_rng(9).permutation(1000).tolist()
    edges = spark.createDataFrame([*zip(ids, ids[1:], strict=False), (5001, 5000), (5002, 5001)], "a bigint, b bigint")
    got = {r.node: r.root for r in connected_components(spark, edges).collect()}
    assert got == dict.fromkeys(ids, 0) | dict.fromkeys((5000, 5001, 5002), 5000)


def test_simhash_odd_rows(spark, docs, odd):
    rows = simhash.components(spark, docs(odd)).collect()
    assert len(rows) == len(odd)
    assert {r.component_id for r in rows if r.fp == 0} == {1}
    assert {r.component_id for r in rows if r.doc_id == 4} <= {1, 4, 5, 6, 7}
    assert simhash.components(spark, docs([])).count() == 0
    nulls = simhash.components(spark, docs([(None, "p q r"), (None, "p q r")])).collect()
    assert [r.component_id for r in nulls] == [None, None]


def _one_of_each_group(rows, kept):
    """Of each group of ``rows`` (doc_id, text) one is kept, and it has the smallest id
    of the group, nulls last."""
    groups: dict = {}
    for row, root in zip(rows, _roots([_fingerprint(t) for _, t in rows]), strict=True):
        groups.setdefault(root, []).append(row)
    by_id = lambda r: (r[0] is None, r[0] or 0)
    for group in groups.values():
        mine = [r for r in kept if r in group]
        assert len(mine) == 1 and by_id(mine[0]) == min(map(by_id, group))
    assert len(kept) == len(groups)


def test_keep_one_loses_no_text_and_keeps_no_copy(spark, docs, odd):
    a, b = "one two three four five six", "quite other words stand in here"
    for rows in ([(1, a), (4, a), (4, b)], [(4, a), (4, b), (4, b), (None, a), (None, b)], [(None, a), (None, a), (None, b)], odd, odd * 2):
        for clash in (True, False):
            _one_of_each_group(rows, [(r.doc_id, r.text) for r in simhash.keep_one(spark, docs(rows, clash)).collect()])


def test_keep_one_keeps_columns_and_one_of_each_group(spark, docs):
    kept = simhash.keep_one(spark, docs([(3, "a b c d"), (2, "a b c d"), (2, "a b c d"), (9, "quite other words here"), (None, "a b c d")]))
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == [(False, 2), (False, 9)]
    assert kept.columns == docs([]).columns


# --- mixing -----------------------------------------------------------------------------


def _targets(sizes, weights=(1, 2, 3)):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * w[s] / sum(w[f] for f in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s] + 1e-9]
        if not over:
            return fixed | share
        fixed |= {s: 3 * sizes[s] for s in over}


MIXES = {
    "caps": [(i, "w " * (1 + i % 7), s) for i, s in enumerate(["a"] * 5 + ["b"] * 60 + ["c"] * 3 + ["d"] * 30 + [None] * 10)],
    "one source": [(i, "w " * (i + 1), "a") for i in range(9)],
    "no words": [(1, "", "a"), (2, None, "b")],
    "a hot source": [(i, "w " * (i % 50), "hot" if i % 3 else f"s{i % 30}") for i in range(600)],
}


@pytest.mark.parametrize("name", MIXES)
def test_mix_targets_and_sizes(spark, docs, name):
    rows = MIXES[name]
    got = mixing.plan(spark, docs(rows)).collect()
    assert len(got) == len(rows)
    sizes: dict = {}
    for _, text, s in rows:
        sizes[s] = sizes.get(s, 0) + len((text or "").split())
    expected = _targets(sizes)
    for s in sizes:
        mine = [r for r in got if r.source == s]
        assert {r.source_size for r in mine} == {sizes[s]}
        assert mine[0].target == pytest.approx(expected[s])
        taken = sum(r.copies * r.size for r in mine)
        assert abs(taken - expected[s]) <= max([r.size for r in mine], default=0)
        assert all(0 <= r.copies <= 3 for r in mine)
        whole = int(expected[s] // sizes[s]) if sizes[s] else 0
        assert all(r.copies in (whole, whole + 1) for r in mine)
    again = mixing.plan(spark, docs(rows).repartition(3)).collect()
    key = lambda r: (str(r.doc_id), r.copies)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mix_apply_repeats_rows(spark, docs, odd):
    rows = MIXES["caps"]
    copies = {r.doc_id: r.copies for r in mixing.plan(spark, docs(rows)).collect()}
    mixed = mixing.apply(spark, docs(rows))
    assert mixed.columns == docs(rows).columns
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {d: c for d, c in copies.items() if c}
    assert mixing.plan(spark, docs(odd)).count() == len(odd)
    assert mixing.plan(spark, docs([])).count() == mixing.apply(spark, docs([])).count() == 0


def test_rows_without_an_id_spread_over_the_bins(spark, docs):
    rows = [(None, f"text number {i}", "s") for i in range(400)] + [(i, "a b", "t") for i in range(50)]
    bins = docs(rows).filter("doc_id is null").select(F.floor(mixing.uniform() * 64)).distinct().count()
    assert bins > 50
    got = mixing.plan(spark, docs(rows)).collect()
    assert len(got) == len(rows) and len({r.copies for r in got if r.source == "s"}) == 2


def test_many_rows_of_one_id_are_cut_into_ranges(spark, docs, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(None, f"text number {i}") for i in range(300)] + [(7, f"other text {i}") for i in range(300)]
    folder = token_files.write(spark, docs(rows), path, f"file://{tmp_path}/h", parts=4)
    parts = {r.part: r["count"] for r in spark.read.parquet(folder).groupBy("part").count().collect()}
    assert len(parts) == 4 and max(parts.values()) < 300
    got = token_files.read(spark, folder).orderBy("start").collect()
    assert [r.doc_id is None for r in got] == [True] * 300 + [False] * 300
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:], strict=False))


def test_mix_sql(spark, data):
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    want = sorted(db.sql(queries.OP4_SQL).fetchall())
    cols = [c[0] for c in db.sql(queries.OP4_SQL).description]
    got = sorted(tuple(r[c] for c in cols) for r in queries.QUERIES["op4_mixing"](spark, data).collect())
    assert got == want


# --- BPE --------------------------------------------------------------------------------

TRICKY = ["", " ", "  ", "a  b", "a \n b", "\n\n", "x\n\ny", " lead", "trail ", "trail  ", "it's we'll  don't I'M", "a\u00a0b \u2003 c", "\ttab\t x", "1 234  5", "日本 語 テスト", "\x1c a\x85b", "😀 😀x", "a <|endoftext|> b", "x" * 3000, "ab " * 5000]


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_coder_equals_the_library(ranks, library, spark, data):
    coder = bpe.Coder(ranks, public_tokenizers.PATTERN)
    texts = TRICKY + [r.text for r in queries.read(spark, data, "documents").limit(60).collect()]
    for t in texts:
        assert coder.ids(t).tolist() == library.encode_ordinary(t)
        listed, decoded = coder.decimals(coder.packed([t])[0])
        assert decoded == t.encode()
        assert listed == ",".join(map(str, library.encode_ordinary(t))).encode()
    for together in (texts, texts[::-1]):
        assert [np.frombuffer(x, "<u4").tolist() for x in coder.packed(together)] == [library.encode_ordinary(t) for t in together]


def test_cache_generations_change_nothing(ranks, library):
    coder = bpe.Coder(ranks, public_tokenizers.PATTERN)
    coder.chunks.limit = 3
    text = "one two three four five one two three four five six"
    assert coder.ids(text).tolist() == library.encode_ordinary(text)


def test_bulk_fold_equals_the_library(ranks, library):
    rng = np.random.default_rng(12)
    letters = list("abcdetnisro .!\n1é日")
    words = ["".join(rng.choice(letters, n)) for n in rng.integers(1, 40, 3000)]
    words += ["ab" * 40_000, "x" * 5000, "é" * 300, "".join(rng.choice(letters, 3000)), "a" * bpe.LONGEST, "a" * (bpe.LONGEST + 1), ""]
    got = bpe.fold_many([w.encode() for w in words], ranks, bpe.pair_table(ranks))
    for w, ids in zip(words, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == (library._encode_single_piece(w.encode()) if w else [])


def test_a_worker_holds_one_thing_and_slices_are_bounded():
    import pyarrow as pa

    from tidemill.llm.common import held, slices

    one = held(("a",), dict)
    assert held(("a",), dict) is one and held(("b",), list) == [] and held(("a",), dict) is not one
    texts = ["x" * 10, None, "", "y" * 1000, "z", "ü" * 30, "w"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], ["i", "t"])
    parts = [p.column(1).to_pylist() for p in slices(batch, 1, 3, 64)]
    assert [t for p in parts for t in p] == texts
    assert all(len(p) <= 3 and (len(p) == 1 or sum(len((t or "").encode()) for t in p) <= 64) for p in parts)
    assert [p.num_rows for p in slices(batch.slice(2, 3), 1, 5, 10)] == [1, 1, 1]


def test_higher_order_fold_equals_the_library(spark, ranks, library):
    words = [" the", "zzzzqqq", "a", " Straße", "日本", "'s", "  ", "antidisestablishmentarianism", "\n", " 12345"]
    df = spark.createDataFrame([(w.encode(),) for w in words], "word binary")
    got = {bytes(r.word).decode(): list(r.ids) for r in bpe.encode_words(spark, df, ranks).collect()}
    assert got == {w: library.encode_ordinary(w) for w in words}


def test_bpe_query(spark, data, library):
    texts = {r.doc_id: r.text for r in queries.read(spark, data, "documents").collect()}
    for r in queries.QUERIES["op5_bpe"](spark, data).collect():
        ids = library.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_bpe_odd_rows(spark, docs, odd, library):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows = bpe.encode(spark, docs(odd), path, public_tokenizers.PATTERN).collect()
    want = sorted((str(d), library.encode_ordinary(t or "")) for d, t in odd)
    assert sorted((str(r.doc_id), list(r.ids)) for r in rows) == want
    assert bpe.encode(spark, docs([]), path, public_tokenizers.PATTERN, digests=True).count() == 0


# --- token files ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


ADDED = ["<|endoftext|> first", "in the<|endoftext|>middle", "last <|endoftext|>", "<|endoftext|><|endoftext|>", "a <|endoftext|>  <|endoftext|> b\n", "<|endoftext|>", "<|endoftext| > not one"]


def test_chunked_encoding_equals_the_library(tokenizer, spark, data):
    coder = token_files.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert coder.by_chunk
    texts = TRICKY + ADDED + [r.text for r in queries.read(spark, data, "documents").limit(60).collect()]
    assert 50256 in np.frombuffer(coder.encode(ADDED)[0], "<u4")
    for t, got in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_token_file_query(spark, data, tokenizer):
    docs = sorted((r.doc_id, r.text) for r in queries.read(spark, data, "documents").collect())
    got = {r.doc_id: r for r in queries.QUERIES["op10_token_files"](spark, data).collect()}
    start = 0
    for d, t in docs:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_token_files_odd_rows_and_selective_reads(spark, docs, odd, tmp_path):
    import pyarrow.parquet as pq

    path = public_tokenizers.path("byte_bpe_50k.json")
    folder = token_files.write(spark, docs(odd), path, f"file://{tmp_path}/t", parts=3)
    rows = token_files.read(spark, folder).orderBy("start").collect()
    assert len(rows) == len(odd) and rows[0].start == 0 and rows[0].doc_id is None
    assert all(a.start + a.n_tokens == b.start and len(a.ids) == a.n_tokens and a.ids[-1] == 0 for a, b in zip(rows, rows[1:], strict=False))
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    plan = spark.read.parquet(folder).select("doc_id", "n_tokens").filter("doc_id = 4")._jdf.queryExecution().toString()
    assert "ids" not in plan.split("ReadSchema")[-1]
    file = next(p for p in (tmp_path / "t").glob("*.parquet") if pq.ParquetFile(p).metadata.num_rows)
    group = pq.ParquetFile(file).metadata.row_group(0)
    columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert all(c.has_offset_index and c.has_column_index for c in columns.values())
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert any("DICTIONARY" in e for e in columns["ids.list.element"].encodings)
    empty = token_files.write(spark, docs([]), path, f"file://{tmp_path}/e", parts=2)
    assert token_files.digests(token_files.read(spark, empty)).count() == 0
    assert F is not None


# --- every word by the fold of higher-order functions -----------------------------------


def test_documents_get_all_ids_from_the_higher_order_fold(spark, docs, library, monkeypatch):
    """The queries' plan folds between naming words and filling in ids; a table without
    joins leaves bytes, also for the words that a cache of frequent words would hold; no
    sample of documents is read."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows = [(i, " ".join(f"zq{i}xv{j} commonword qqzz" for j in range(40))) for i in range(30)]
    made = bpe.encode(spark, docs(rows), path, public_tokenizers.PATTERN)
    plan = made._jdf.queryExecution().analyzed().toString()
    assert "aggregate(" in plan and plan.count("MapInArrow") == 2 and "Limit" not in plan
    assert {r.doc_id: list(r.ids) for r in made.collect()} == {d: library.encode_ordinary(t) for d, t in rows}
    none = bpe.Joins(*(np.full(1, x) for x in (0, -1, -1)))
    monkeypatch.setattr(bpe, "join_table", lambda ranks: none)
    unjoined = bpe.encode(spark, docs([(1, "qqzz qqzz"), (2, "qqzz")]), path, public_tokenizers.PATTERN).collect()
    ranks = bpe.read_ranks(path)
    assert {r.doc_id: list(r.ids) for r in unjoined} == {d: [ranks[bytes([b])] for b in t.encode()] for d, t in ((1, "qqzz qqzz"), (2, "qqzz"))}


def test_long_words_by_rounds_and_forgotten_words(spark, ranks, library):
    import pyarrow as pa

    rng = np.random.default_rng(8)
    words = ["ab" * 5000, "x" * 20_001, "é" * 300, "".join(rng.choice(list("abcdetnisro"), 400)), "a" * bpe.SINGLE, "a" * (bpe.SINGLE + 1), "b"]
    words += ["".join(rng.choice(list("ths anioe"), n)) for n in rng.integers(2, 150, 200)]
    got = {bytes(r.word).decode(): list(r.ids) for r in bpe.encode_words(spark, spark.createDataFrame([(w.encode(),) for w in words], "word binary"), ranks).collect()}
    assert got == {w: library._encode_single_piece(w.encode()) for w in words}
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    texts = [" ".join(f"w{i % 7}x{j % 5}, it's" for j in range(9)) for i in range(40)] + [None, "", " a  b "]

    def run(known):  # without the fold the ids are those of bytes and whole pieces
        bpe.KNOWN, bpe.ROWS, kept = known, 4, (bpe.KNOWN, bpe.ROWS)
        try:
            batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
            cut = list(bpe._cut(iter([batch]), path, public_tokenizers.PATTERN))
            out = [r for b in bpe._fill(iter(cut), path, True) for r in b.to_pylist()]
            return sum(b.column("fresh")[0].as_py() for b in cut), out
        finally:
            bpe.KNOWN, bpe.ROWS = kept

    (often, few), (once, many) = run(10), run(10_000)
    assert often > 3 and once == 1 and few == many
    assert [r["decoded_sha256"] for r in few] == [hashlib.sha256((t or "").encode()).hexdigest() for t in texts]


def test_word_generations_of_token_files_change_nothing(tokenizer, spark, data):
    coder = token_files.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    coder.words.limit, made = 50, []
    coder.words.make = lambda word, make=coder.words.make: made.append(word) or make(word)
    texts = TRICKY + ADDED + [r.text for r in queries.read(spark, data, "documents").limit(20).collect()]
    for t, got in zip(texts * 2, coder.encode(texts * 2), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids
    assert len(made) > len(set(made)) and len(coder.words.old) > 50


# --- words of many texts at once --------------------------------------------------------


def test_words_of_many_texts_are_the_matches_of_the_pattern():
    import pyarrow as pa
    import regex

    from tidemill.llm import words

    find = regex.compile(words.PATTERN).findall
    rng = np.random.default_rng(3)
    letters = [*"abstredvlm'''  \n\t é日1²½,.!\"\x1c\x85 😀́٣Ⅷ", "'s", "'re", "'ll", "'ve", "'t", "'d", "'m", " '"]
    for k in range(400):
        some = letters[:17] if k % 2 else letters
        texts = [None if n == 0 else "".join(rng.choice(some, n - 1)) for n in rng.integers(0, 25, k % 9)] + (TRICKY + ADDED) * (k == 0)
        for start in (0, len(texts) // 2):
            got, sizes = words.cut(pa.array(texts, pa.string()).slice(start))
            want = [find(t or "") for t in texts[start:]]
            assert got.to_pylist() == [w.encode() for found in want for w in found]
            assert sizes.tolist() == [len(found) for found in want]
    assert words.PATTERN == public_tokenizers.PATTERN


def test_token_files_look_each_distinct_word_up_once(tokenizer):
    coder, asked = token_files.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json")), []

    class Asked(token_files.Words):
        def __getitem__(self, word):
            asked.append(word)
            return super().__getitem__(word)

    coder.words = Asked(coder.words.make, coder.words.limit)
    texts = ["the same few words, " * 300, None, "few <|endoftext|> the", ""] * 20
    for t, got in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids
    assert 0 < len(asked) == len(set(asked)) < 10


def test_bpe_asks_for_the_number_of_each_distinct_word_once(monkeypatch, library):
    import pyarrow as pa

    asked = []

    class Asked(bpe.Numbers):
        def __getitem__(self, word):
            asked.append(word)
            return super().__getitem__(word)

    monkeypatch.setattr(bpe, "Numbers", Asked)
    texts = ["the same few words, " * 300, None, "it's the  same", ""] * 20
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    cut = list(bpe._cut(iter([batch]), path, public_tokenizers.PATTERN))
    assert 0 < len(asked) == len(set(asked)) < 12
    rows = [r for b in bpe._fill(iter(cut), path, True) for r in b.to_pylist()]
    assert [r["decoded_sha256"] for r in rows] == [hashlib.sha256((t or "").encode()).hexdigest() for t in texts]
    whole = [library.encode_ordinary(t or "") for t in texts]  # all these words are pieces
    assert [(r["n_tokens"], r["ids_sha256"]) for r in rows] == [(len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()) for ids in whole]
