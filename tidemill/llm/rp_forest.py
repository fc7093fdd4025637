"""Approximate nearest neighbours by inner product: a forest of random-projection
trees searched through one shared priority queue, with exact reranking.

Largest inner product is nearest direction once a vector x gets the component
sqrt(M^2 - |x|^2), M being the largest norm, and a query a zero. A tree's node cuts
its part of a bounded sample at the median of a random projection; every vector
goes down to one leaf of each tree. A query's queue holds the nodes of all trees by
the smallest margin on the way to them; it takes leaves until it has ``VISITS``.

Members and queries of a leaf meet in blocks of bounded size, and a block returns
k rows a query. Scores are sums of products of doubles, one row at a time, so that
equal vectors have equal scores.

The depth grows with the rows, a leaf having ``ROWS_PER_LEAF`` of them, and VISITS is
what recall needs: the k nearest rows of ``TRIED`` vectors are found by brute force in
one pass over the table, and so many leaves are taken that ``RECALL`` of these rows lie
in them. For data without any
structure (independent directions) recall needs a constant share of the rows, whatever
the trees: where more than ``SHARE`` of the leaves would be needed, shallow trees of
``DEPTH`` are searched with ``VISITS`` visits, which reads most rows, in few large
blocks. A leaf holds LEAF vectors of the sample at least, so that small tables are
searched as a whole and every query finds k rows where there are as many.

Edge cases: vectors that are null, empty, zero or hold null or non-finite
components and those with a null id take no part. Vectors of different length are
not compared; lengths other than the sample's most common one are searched as a whole,
each by itself. Candidates exclude every row with the query's id; rows that share an
id count once, with their best score. Extra columns are never read.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemill.llm.common import written
from tidemill.llm.vectors import sample, stack, valid

SAMPLE = 16_384
TREES = 4
DEPTH = 5
LEAF = 16
VISITS = 48
ROWS_PER_LEAF = 1024
MOST_DEPTH = 9
RECALL = 0.95
SHARE = 0.15
#: Vectors by which recall is measured.
TRIED = 64
MEMBERS = 4096
QUERIES = 512
SLACK = 1e-9


@dataclass
class Tree:
    normals: list = field(default_factory=list)
    cuts: list = field(default_factory=list)
    children: list = field(default_factory=list)
    leaves: list = field(default_factory=list)


def _grow(x: np.ndarray, depth: int, random: np.random.Generator) -> Tree:
    tree = Tree()

    def node(part: np.ndarray, left: int) -> int:
        me = len(tree.cuts)
        for column in (tree.normals, tree.cuts, tree.children, tree.leaves):
            column.append(None)
        if left and len(part) >= 2 * LEAF:
            w = random.normal(size=x.shape[1])
            w /= np.linalg.norm(w)
            p = x[part] @ w
            cut = float(np.median(p))
            low, high = part[p <= cut], part[p > cut]
            if len(low) and len(high):
                tree.normals[me], tree.cuts[me] = w, cut
                tree.children[me] = (node(low, left - 1), node(high, left - 1))
                return me
        tree.leaves[me] = sum(n is not None for n in tree.leaves)
        return me

    node(np.arange(len(x)), depth)
    return tree


@dataclass(frozen=True)
class Forest:
    trees: list[Tree]
    size: int
    largest: float

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree (columns)."""
        rest = np.sqrt(np.maximum(self.largest**2 - (x * x).sum(axis=1), 0))
        x = np.concatenate([x, rest[:, None]], axis=1)
        out = np.zeros((len(x), len(self.trees)), int)
        for t, tree in enumerate(self.trees):
            stack_ = [(0, np.arange(len(x)))]
            while stack_:
                node, part = stack_.pop()
                if tree.children[node] is None:
                    out[part, t] = tree.leaves[node]
                else:
                    low = x[part] @ tree.normals[node] <= tree.cuts[node]
                    stack_ += [(tree.children[node][0], part[low]), (tree.children[node][1], part[~low])]
        return out

    def count(self) -> int:
        """The leaves of all trees."""
        return sum(sum(n is not None for n in t.leaves) for t in self.trees)

    def visits(self, query: np.ndarray, n: int) -> list[tuple[int, int]]:
        """The (tree, leaf) that the shared queue takes first. The query is scaled
        to the largest norm, which doesn't change its order of candidates."""
        q = np.append(query * (self.largest / np.sqrt((query * query).sum())), 0.0)
        queue, out = [(-np.inf, t, 0) for t in range(len(self.trees))], []
        while queue and len(out) < n:
            priority, t, node = heapq.heappop(queue)
            tree = self.trees[t]
            if tree.children[node] is None:
                out.append((t, tree.leaves[node]))
                continue
            margin = float(q @ tree.normals[node]) - tree.cuts[node]
            low, high = tree.children[node]
            heapq.heappush(queue, (max(priority, margin), t, low))
            heapq.heappush(queue, (max(priority, -margin), t, high))
        return out


def fit(vectors: np.ndarray, largest: float, trees: int = TREES, depth: int = DEPTH, seed: int = 11) -> Forest | None:
    if not len(vectors):
        return None
    x = np.asarray(vectors, dtype=np.float64)
    rest = np.sqrt(np.maximum(largest**2 - (x * x).sum(axis=1), 0))
    raised = np.concatenate([x, rest[:, None]], axis=1)
    random = np.random.default_rng(seed)
    return Forest([_grow(raised, depth, random) for _ in range(trees)], x.shape[1], largest)


def nearest(rows: DataFrame, k: int, tried: int = TRIED) -> list[tuple[np.ndarray, np.ndarray]]:
    """Some vectors, each with its k nearest rows by brute force. A task returns k rows
    for each of them."""
    some = rows.select("vec_id", "embedding").orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id", "embedding").limit(tried).collect()
    size = len(some[0].embedding) if some else 0
    ids, x = np.array([r.vec_id for r in some if len(r.embedding) == size]), [r.embedding for r in some if len(r.embedding) == size]
    if not len(ids):
        return []
    queries = stack(x)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = [pd.DataFrame({"q": [], "score": [], "embedding": []})] * len(ids)
        for pdf in frames:
            pdf = pdf[pdf["embedding"].map(len) == size]
            if not len(pdf):
                continue
            scores = stack(pdf["embedding"]) @ queries.T
            scores[pdf["vec_id"].to_numpy()[:, None] == ids[None, :]] = -np.inf
            for q in range(len(ids)):
                top = np.argsort(-scores[:, q], kind="stable")[:k]
                top = top[scores[top, q] > -np.inf]
                here = pd.DataFrame({"q": q, "score": scores[top, q], "embedding": pdf["embedding"].to_numpy()[top]})
                best[q] = pd.concat([best[q], here] if len(best[q]) else [here]).nlargest(k, "score")
        yield from best

    found = rows.select("vec_id", "embedding").mapInPandas(run, f"q int, score double, embedding {rows.schema['embedding'].dataType.simpleString()}")
    order = Window.partitionBy("q").orderBy(F.desc("score"))
    got = found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k).select("q", "embedding").collect()
    return [(queries[q], stack(mine)) for q in range(len(ids)) if (mine := [r.embedding for r in got if r.q == q])]


def needed_visits(forest: Forest, known: list[tuple[np.ndarray, np.ndarray]], recall: float = RECALL) -> int:
    """The fewest visits by which ``recall`` of the nearest rows are found."""
    total = forest.count()
    found = np.zeros(total + 1)
    for query, rows in known:
        turn = {leaf: n for n, leaf in enumerate(forest.visits(query, total), 1)}
        first = [min(turn[t, leaf] for t, leaf in enumerate(row)) for row in forest.leaves(rows).tolist()]
        found += np.bincount(first, minlength=total + 1)
    return max(1, int(np.searchsorted(np.cumsum(found) / max(1.0, found.sum()), recall)))


def plan(x: np.ndarray, largest: float, rows: int, known: Callable[[], list[tuple[np.ndarray, np.ndarray]]]) -> tuple[Forest | None, int]:
    """A forest for a table of ``rows`` rows, fitted on ``x``, and how many of its leaves
    to visit. ``known``: some vectors with their nearest rows."""
    depth = int(np.clip(np.ceil(np.log2(max(rows, 1) / ROWS_PER_LEAF)), 0, MOST_DEPTH))
    if len(x) > 1 and depth > DEPTH:
        deep = fit(x, largest, depth=depth)
        visits = needed_visits(deep, [(q, r) for q, r in known() if len(q) == deep.size])
        if visits <= SHARE * deep.count():
            return deep, visits
    return fit(x, largest), VISITS


def _assign(rows: DataFrame, forest, visits: int) -> DataFrame:
    """Member rows (one for each tree) and query rows (one for each leaf visited).
    Vectors of another length are in a leaf of their own of a tree -1."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = forest.value
        for pdf in frames:
            for dim, group in pdf.groupby(pdf["embedding"].map(len)):
                for i in range(0, len(group), 256):
                    part = group.iloc[i : i + 256]
                    asks = np.flatnonzero(part["is_query"].to_numpy())
                    if f is None or dim != f.size:
                        home, taken = np.full((len(part), 1), dim), [[(-1, dim)]] * len(asks)
                    else:
                        x = stack(part["embedding"])
                        home, taken = f.leaves(x), [f.visits(x[r], visits) for r in asks]
                    n, t = home.shape
                    trees = np.arange(t) if dim == getattr(f, "size", None) else np.array([-1])
                    yield _rows(part, np.repeat(np.arange(n), t), np.tile(trees, n), home.ravel(), 0)
                    if len(asks):
                        where = np.array([w for leaves in taken for w in leaves])
                        yield _rows(part, np.repeat(asks, [len(leaves) for leaves in taken]), where[:, 0], where[:, 1], 1)

    return rows.mapInPandas(run, f"tree int, leaf int, look int, vec_id bigint, embedding {rows.schema['embedding'].dataType.simpleString()}")


def _rows(part: pd.DataFrame, who: np.ndarray, tree: np.ndarray, leaf: np.ndarray, look: int) -> pd.DataFrame:
    return pd.DataFrame({"tree": tree, "leaf": leaf, "look": look, "vec_id": part["vec_id"].to_numpy()[who], "embedding": part["embedding"].to_numpy()[who]})


def _best(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        members, queries = pdf[pdf["look"] == 0], pdf[pdf["look"] == 1]
        out = []
        if len(members) and len(queries):
            y, ids = stack(members["embedding"]), members["vec_id"].to_numpy()
            x = stack(queries["embedding"])
            near = x @ y.T
            near[queries["vec_id"].to_numpy()[:, None] == ids[None, :]] = -np.inf
            # Rows that share an id take one place, that of the nearest.
            order = np.argsort(ids, kind="stable")
            first = np.flatnonzero(np.diff(ids[order], prepend=ids[order[0]] - 1))
            top = near if len(first) == len(ids) else np.maximum.reduceat(near[:, order], first, axis=1)
            # The products of a matrix differ in their last digits: a little more passes.
            floor = np.partition(top, -k, axis=1)[:, -k] - SLACK if len(first) > k else np.full(len(x), -np.inf)
            for r, q in enumerate(queries["vec_id"].to_numpy()):
                j = np.flatnonzero((near[r] >= floor[r]) & (near[r] > -np.inf))
                exact = (y[j] * x[r]).sum(axis=1)
                by = np.lexsort((ids[j], -exact))
                by = by[np.sort(np.unique(ids[j[by]], return_index=True)[1])[:k]]
                j, exact = j[by], exact[by]
                out.append(pd.DataFrame({"query_id": q, "vec_id": ids[j], "score": exact}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    return run


def search(spark: SparkSession, vectors: DataFrame, is_query: Column, k: int = 20, visits: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query, nearest
    first, ties to the smaller id. ``visits``: leaves to take, else what recall needs."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", is_query.alias("is_query")).filter(valid() & F.col("vec_id").isNotNull())
    norm = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    total, largest = rows.agg(F.count("*"), F.max(F.sqrt(norm))).first()
    grown, needed = plan(sample(rows, SAMPLE, "vec_id"), largest or 0.0, total, lambda: nearest(rows, k))
    assigned = _assign(rows, spark.sparkContext.broadcast(grown), visits or needed)
    counted = assigned.groupBy("tree", "leaf").agg(F.sum(1 - F.col("look")).alias("members"), F.sum("look").alias("queries")).filter("members > 0 and queries > 0")
    leaves = written(spark, counted.select("tree", "leaf", F.ceil(F.col("members") / MEMBERS).cast("int").alias("nb"), F.ceil(F.col("queries") / QUERIES).cast("int").alias("mb")), "leaves")
    is_member = F.col("look") == 0
    mine = F.pmod(F.xxhash64("vec_id"), F.when(is_member, F.col("nb")).otherwise(F.col("mb")).cast("bigint")).cast("int")
    # At most TREES * 2^MOST_DEPTH leaves and a row for each other length: this side can
    # be broadcast.
    dealt = assigned.join(F.broadcast(leaves), ["tree", "leaf"]).withColumn("own", mine)
    dealt = dealt.withColumn("facing", F.explode(F.sequence(F.lit(0), F.when(is_member, F.col("mb")).otherwise(F.col("nb")) - 1)))
    dealt = dealt.withColumns({"i": F.when(is_member, F.col("own")).otherwise(F.col("facing")), "j": F.when(is_member, F.col("facing")).otherwise(F.col("own"))})
    found = dealt.groupBy("tree", "leaf", "i", "j").applyInPandas(_best(k), "query_id bigint, vec_id bigint, score double")
    # Dealt by query once, which serves the grouping and the window.
    distinct = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return distinct.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
