"""Near-duplicate vectors by product quantisation.

Vectors with equal non-null labels link at cosine >= ``threshold``, in double
precision. Copies (equal label and vector) are one class. Unit vectors go to the
inverted list of their nearest coarse centre, as codes of the residual in
``PARTS`` subspaces with the length of the coding error.

Probes are sufficient: a pair at cosine t is at distance r = sqrt(2 - 2t), so the
other's list c obeys d(x, c)^2 - d(x, c*)^2 <= 2 r |c - c*|, c* being the list of x;
exactly the lists that do are probed, of two vectors' lists that of lower number only,
by the vector of the other. In a list, asymmetric distances come from
tables (query residual to codewords); a member is passed on unless its distance
less its coding error exceeds r, which loses no pair. What is passed on is
compared by exact cosine.

There is a list for each ``ROWS_PER_LIST`` classes, up to ``MOST_LISTS``, so that a
list's length stays. Sufficient probes reach a share of the lists that depends on how
well centres tell the vectors apart; where ``MEAN_PROBES`` wouldn't suffice there are
fewer lists, which bounds the rows that are dealt out for a vector, not the members
that it meets.
Lists are searched in blocks of ``BLOCK`` members and ``QUERIES`` queries. A block
returns the numbers of links that it finds for its vectors and a spanning forest of
the links, not all pairs.
The quantiser is fitted on ``SAMPLE_PER_LIST`` classes a list; every vector is indexed.

Edge cases: vectors that are null, empty, zero or hold null or non-finite
components, and those with a null label, link with nothing; vectors of different
length don't link. Lengths that the sample doesn't show have one list without
codes, compared exactly. Rows that share an id are vectors of their own. Extra
columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import connected_components, remove, written
from tidemill.llm.simhash import forest
from tidemill.llm.vectors import kmeans, kmeans_two_level, sample, squared, stack, unit, valid

THRESHOLD = 0.98
ROWS_PER_LIST = 512
LEAST_LISTS = 16
#: Where the sample's vectors would probe more lists than this, fewer are made.
MEAN_PROBES = 48
MOST_LISTS = 4096
SAMPLE_PER_LIST = 8
PARTS = 8
WORDS = 16
BLOCK = 512
QUERIES = 4096
#: Queries whose distances to a block are held at once.
TILE = 256
SLACK = 1e-9


@dataclass(frozen=True)
class Quantiser:
    """Coarse centres, and codewords of each residual subspace. ``radius``: the
    distance of unit vectors at the threshold."""

    centres: np.ndarray
    words: list[np.ndarray]
    cuts: np.ndarray
    radius: float

    def lists(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The home list of each row, and which lists (columns) it probes."""
        d = squared(x, self.centres)
        home = d.argmin(axis=1)
        apart = np.sqrt(squared(self.centres[home], self.centres))
        return home, d - d[np.arange(len(x)), home][:, None] <= 2 * self.radius * apart + SLACK

    def tables(self, residual: np.ndarray) -> list[np.ndarray]:
        """Squared distances of each row to each codeword, for each subspace."""
        return [squared(residual[:, a:b], w) for w, a, b in zip(self.words, self.cuts[:-1], self.cuts[1:], strict=True)]

    def code(self, x: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals and the lengths of the coding errors."""
        residual = x - self.centres[home]
        codes = np.stack([t.argmin(axis=1) for t in self.tables(residual)], axis=1).astype(np.uint8)
        back = np.concatenate([w[codes[:, s]] for s, w in enumerate(self.words)], axis=1)
        return codes, np.sqrt(((residual - back) ** 2).sum(axis=1))

    def near(self, x: np.ndarray, cell: int, codes: np.ndarray, errors: np.ndarray) -> np.ndarray:
        """Which members (columns) each query's asymmetric distance admits."""
        total = np.zeros((len(x), len(codes)))
        for s, table in enumerate(self.tables(x - self.centres[cell])):
            total += table[:, codes[:, s]]
        return np.sqrt(total) <= self.radius + errors[None, :] + 1e-6


def n_lists(classes: int) -> int:
    return int(np.clip(classes // ROWS_PER_LIST, LEAST_LISTS, MOST_LISTS))


def fit(vectors: np.ndarray, threshold: float = THRESHOLD, lists: int = LEAST_LISTS) -> Quantiser | None:
    if not len(vectors):
        return None
    x = unit(np.asarray(vectors, dtype=np.float64))
    radius = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    lists = min(lists, max(1, len(x) // 4))
    # Centres lie nearer to the vectors that they are fitted on: others are counted.
    apart = 256 if len(x) >= 4 * 256 else 0
    while True:
        centres = kmeans_two_level(x[apart:], lists)
        _, probes = Quantiser(centres, [], np.empty(0), radius).lists(x[: apart or None])
        if lists <= LEAST_LISTS or (mean := float(probes.sum(axis=1).mean()) / 2) <= MEAN_PROBES:
            break
        lists = max(LEAST_LISTS, int(0.9 * lists * MEAN_PROBES / mean))
    residual = x - centres[squared(x, centres).argmin(axis=1)]
    cuts = np.linspace(0, x.shape[1], min(PARTS, x.shape[1]) + 1).astype(int)
    words = [kmeans(residual[:8192, a:b], WORDS) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return Quantiser(centres, words, cuts, radius)


ASSIGNED = "label {label}, dim int, cell int, look int, home boolean, cid bigint, m bigint, embedding {vector}, codes binary, error double"


def _assign(classes: DataFrame, quantiser) -> DataFrame:
    """A member row for each class in its home list and a query row for each list
    that it probes."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q = quantiser.value
        for pdf in frames:
            for dim, part in pdf.groupby(pdf["embedding"].map(len)):
                # So many that the distances to all centres, and the rows made, stay small.
                step = max(16, min(1024, (1 << 20) // max(1, len(q.centres) if q is not None else 1)))
                for i in range(0, len(part), step):
                    yield from _assigned(part.iloc[i : i + step], int(dim), q)

    types = {k: classes.schema[c].dataType.simpleString() for k, c in (("label", "label"), ("vector", "embedding"))}
    return classes.select("label", "cid", "m", "embedding").mapInPandas(run, ASSIGNED.format(**types))


def _assigned(part: pd.DataFrame, dim: int, q: Quantiser | None) -> Iterator[pd.DataFrame]:
    x = unit(stack(part["embedding"]))
    if q is None or q.centres.shape[1] != dim:
        home, probes = np.zeros(len(x), int), np.ones((len(x), 1), bool)
        codes, errors = [b""] * len(x), np.zeros(len(x))
    else:
        home, probes = q.lists(x)
        coded, errors = q.code(x, home)
        codes = [c.tobytes() for c in coded]
    who, cell = np.nonzero(probes & (np.arange(probes.shape[1])[None, :] <= home[:, None]))
    label, cid, m, vector = (part[c].to_numpy() for c in ("label", "cid", "m", "embedding"))
    yield pd.DataFrame({"label": label, "dim": dim, "cell": home, "look": 0, "home": True, "cid": cid, "m": m, "embedding": vector, "codes": codes, "error": errors})
    for i in range(0, len(who), 16_384):
        w, c = who[i : i + 16_384], cell[i : i + 16_384]
        yield pd.DataFrame({"label": label[w], "dim": dim, "cell": c, "look": 1, "home": c == home[w], "cid": cid[w], "m": m[w], "embedding": vector[w], "codes": None, "error": 0.0})


def _search(quantiser, threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        q, members, queries = quantiser.value, pdf[pdf["look"] == 0], pdf[pdf["look"] == 1]
        if not len(members) or not len(queries):
            return pd.DataFrame({"cid": [], "links": [], "other": []})
        y, b, held = unit(stack(members["embedding"])), members["cid"].to_numpy(), members["m"].to_numpy()
        codes = np.frombuffer(b"".join(members["codes"]), np.uint8).reshape(len(y), -1) if len(members["codes"].iloc[0]) else None
        errors, cell = members["error"].to_numpy(), int(pdf["cell"].iloc[0])
        asked, links, edges = [], [], []
        of_members, joined = np.zeros(len(y), np.int64), np.arange(len(y))
        for at in range(0, len(queries), TILE):
            part = queries.iloc[at : at + TILE]
            x, a = unit(stack(part["embedding"])), part["cid"].to_numpy()
            near = q.near(x, cell, codes, errors) if codes is not None else np.ones((len(x), len(y)), bool)
            near &= a[:, None] != b[None, :]
            i, j = np.nonzero(near)
            near[i, j] = (x[i] * y[j]).sum(axis=1) >= threshold
            # Two vectors of one list meet in both roles, others once: these count for both.
            guest = ~part["home"].to_numpy()
            asked.append(a)
            links.append(near @ held)
            of_members += near[guest].T @ part["m"].to_numpy()[guest]
            edges += forest(a, b, near, joined)
        links, both = np.concatenate([*links, of_members]), np.concatenate([*asked, b])
        counted = links > 0
        return pd.DataFrame(
            {"cid": np.concatenate([both[counted], [e[0] for e in edges]]), "links": np.concatenate([links[counted], np.zeros(len(edges))]), "other": [None] * int(counted.sum()) + [e[1] for e in edges]}
        ).astype({"cid": "int64", "links": "int64", "other": "Int64"})

    return run


def components(spark: SparkSession, vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id), a row for each row of ``vectors``."""
    rows = vectors.select("vec_id", "embedding", "label", (valid() & F.col("label").isNotNull()).alias("takes_part"))
    rows = rows.withColumn("vkey", F.when(F.col("takes_part"), F.xxhash64("label", "embedding")))
    part = rows.filter("takes_part")
    classes = part.groupBy("vkey", "label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("m"))
    # The written table fixes the class numbers.
    classes = written(spark, classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    lists = n_lists(classes.count())
    quantiser = spark.sparkContext.broadcast(fit(sample(classes, SAMPLE_PER_LIST * lists, "vkey"), threshold, lists))
    assigned = _assign(classes, quantiser)
    where = ["label", "dim", "cell"]
    counted = assigned.groupBy(*where).agg(F.sum(1 - F.col("look")).alias("members"), F.sum("look").alias("queries")).filter("members > 0 and queries > 0")
    plan = written(spark, counted.select(*where, F.ceil(F.col("members") / BLOCK).cast("int").alias("nb"), F.ceil(F.col("queries") / QUERIES).cast("int").alias("mb")), "plan")
    mine = lambda n: F.pmod(F.xxhash64("cid"), F.col(n).cast("bigint")).cast("int")
    other = F.when(F.col("look") == 0, F.col("mb")).otherwise(F.col("nb"))
    # A left join can broadcast its right side only: the planner takes the left one for as
    # small as the classes, which it exceeds many times.
    dealt = assigned.join(plan, where, "left").withColumn("own", F.when(F.col("look") == 0, mine("nb")).otherwise(mine("mb")))
    dealt = dealt.withColumn("facing", F.explode(F.when(other.isNotNull(), F.sequence(F.lit(0), other - 1)).otherwise(F.array().cast("array<int>"))))
    dealt = dealt.withColumns({"i": F.when(F.col("look") == 0, F.col("own")).otherwise(F.col("facing")), "j": F.when(F.col("look") == 0, F.col("facing")).otherwise(F.col("own"))})
    found = dealt.groupBy(*where, "i", "j").applyInPandas(_search(quantiser, threshold), "cid bigint, links bigint, other bigint")
    found = written(spark, found, "links")
    links = found.filter("other is null").groupBy("cid").agg(F.sum("links").alias("links"))
    roots = connected_components(spark, found.filter("other is not null").select(F.col("cid").alias("a"), F.col("other").alias("b")))
    rooted = classes.select("vkey", "label", "embedding", "cid", "rep", "m").join(links, "cid", "left").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    rooted = written(spark, rooted.withColumn("root", F.coalesce("root", "cid")), "rooted")
    smallest = written(spark, rooted.groupBy("root").agg(F.min("rep").alias("component_id")), "smallest")
    # Equal hashes are told apart by label and vector.
    named = rooted.join(smallest, "root").select(
        "vkey", F.col("label").alias("of_label"), F.col("embedding").alias("of_vector"), (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), "component_id"
    )
    named = written(spark, named, "named")
    for t in (found, roots, rooted, smallest, classes, plan):
        remove(spark, t)
    same = (rows["vkey"] == named["vkey"]) & (rows["label"] == named["of_label"]) & (rows["embedding"] == named["of_vector"])
    return rows.join(named, same, "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.when(F.col("takes_part"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id")
    )
