"""URL filters: listed rules first, and for other urls logistic regression on
hashed character n-grams of host and path, trained from a small labelled table.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z
in lower case; path: what follows that up to ``?``, ``#`` or the end. A url that
is null or has no ``://`` has both empty. A rule (host, path) fits its host and
all subdomains if the url's path starts with the rule's; of several the longest
wins.

Edge cases: empty host and path match no rule and have no n-grams but those of
the empty strings' ends, so that the model's score for them is that of its
intercept and these; repeated rows and null ids keep their rows; extra columns
are never read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (host, path, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

#: A labelled table: 1 is a url to block. Hosts of both kinds share domains, prefixes
#: and paths, so that none of these tells them apart. None is a host of the test pages.
UNWANTED_HOSTS = (
    "best-casino", "casino", "online-casino", "bets", "bet-now", "poker-room", "slots-win", "jackpot", "roulette", "gambling",
    "adult", "adult-video", "xxx-tube", "porn", "sexy-cams", "hot-dating", "pills", "pills-online", "viagra-shop", "pharma-cheap",
    "spam", "spam-mail", "link-farm", "click-farm", "ads", "track-ads", "adserver", "tracker", "clickbait", "free-money",
    "win-prize", "payday-loan", "fast-loans", "crack-download", "warez", "replica-watch",
)
WANTED_HOSTS = (
    "news", "library", "garden", "science", "museum", "weather", "cooking", "history", "school", "travel",
    "music", "kitchen", "river", "mountain", "forum", "docs", "help", "archive", "city", "village",
    "recipes", "stories", "theatre", "nature", "bakery", "painting", "cycling", "hospital", "university", "bookshop",
    "gallery", "astronomy", "parish", "railway", "orchestra", "heritage", "market", "coffee", "bridge", "harbour",
    "theory", "letters", "radio", "fishing", "forest", "window", "planet", "winter", "summer", "lantern",
    "children", "hotel", "teacher", "zeitung", "garten", "bibliothek", "schule", "wohnung", "jardin", "ecole",
    "musique", "voyage", "maison", "escuela", "cocina", "ciudad", "camino", "noticias", "biblioteca",
)
DOMAINS = ("example.com", "example.org", "example.net", "test")
PREFIXES = ("", "www.", "blog.", "m.")
PATHS = ("/en/{}", "/de/{}/", "/fr/{}.html", "/es/{}", "/{}", "")
BITS = 16
GRAMS = (3, 4, 5)


def labelled_urls() -> list[tuple[str, str, int]]:
    """(host, path, label): each listed host with some prefixes, domains and paths."""
    rows = []
    for label, hosts in ((0, WANTED_HOSTS), (1, UNWANTED_HOSTS)):
        for i, host in enumerate(hosts):
            for j in range(4):
                path = PATHS[(i + j) % len(PATHS)].format(37 * i + 11 * j)
                rows.append((f"{PREFIXES[(i + j) % 4]}{host}.{DOMAINS[(i // 4 + j) % 4]}", path, label))
    return rows


def grams(host: str, path: str) -> np.ndarray:
    """Hashed n-grams of ``^host$`` and of ``>path$``, each once."""
    found = set()
    for text in (f"^{host}$", f">{path}$"):
        raw = text.encode("utf-8", "surrogatepass")
        kind = raw[:1]
        for n in GRAMS:
            found.update(zlib.crc32(kind + raw[i : i + n]) & ((1 << BITS) - 1) for i in range(len(raw) - n + 1))
    return np.fromiter(found, dtype=np.int64, count=len(found))


@dataclass(frozen=True)
class UrlModel:
    weights: np.ndarray
    bias: float

    def score(self, host: str, path: str) -> float:
        index = grams(host, path)
        logit = self.bias + (float(np.sort(self.weights[index]).sum()) / np.sqrt(len(index)) if len(index) else 0.0)
        return float(1 / (1 + np.exp(-np.clip(logit, -500, 500))))


def train(rows: list[tuple[str, str, int]] | None = None, epochs: int = 60, rate: float = 0.8, l2: float = 1e-4) -> UrlModel:
    """Logistic regression by stochastic gradient steps in a fixed order."""
    rows = labelled_urls() if rows is None else rows
    weights, bias = np.zeros(1 << BITS), 0.0
    ready = [(grams(h, p), y) for h, p, y in rows]
    order = np.random.default_rng(7)
    for epoch in range(epochs):
        step = rate / (1 + epoch / 10)
        for k in order.permutation(len(ready)):
            index, y = ready[k]
            scale = 1 / np.sqrt(max(len(index), 1))
            g = 1 / (1 + np.exp(-np.clip(bias + weights[index].sum() * scale, -35, 35))) - y
            weights[index] -= step * (g * scale + l2 * weights[index])
            bias -= 0.1 * step * g
    return UrlModel(weights, bias)


def host_of(url: str = "url") -> Column:
    rest = F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: str = "url") -> Column:
    return F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (``host`` + ``path``, else null) and its verdict."""
    rule = verdict = None
    for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    return (rule, verdict) if rule is not None else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def judge(spark: SparkSession, pages: DataFrame, rules=RULES, model: UrlModel | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, score): score is the model's
    probability that the url is to be blocked."""
    shared = spark.sparkContext.broadcast(model or train())

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        m = shared.value
        for hosts, paths in batches:
            yield pd.Series([m.score(h, p) for h, p in zip(hosts, paths, strict=True)], dtype="float64")

    score = score.asNondeterministic()
    parts = pages.select("page_id", host_of().alias("host"), path_of().alias("path"))
    parts = parts.withColumn("score", score("host", "path"))
    rule, listed = rule_of(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return parts.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(listed, learned).alias("verdict"), "score")
