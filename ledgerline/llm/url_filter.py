"""URL filters: a rule list, then logistic regression on hashed character n-grams.

Host and path give character 3- to 5-grams, hashed into a fixed number of
buckets; the model is fitted on a small labelled URL table on the driver and
sent to the tasks. Rules (host, path prefix) come first: a rule fits its host
and all subdomains, and the longest that fits decides. URLs no rule fits get
the model's verdict. Each URL is judged on its own: no shuffle.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import ngrams as NG

BUCKETS = 1 << 13
LABELLED_ROWS = 10_000      # rows of the labelled table that are used, at most
BLOCK_AT = 0.5

#: Rules of the query, (verdict, host and path).
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"),
         ("allow", "org/fr/")]

#: The labelled URL table that the query's model is fitted on: 1 is block.
LABELLED_URLS = [(1, f"http://{host}/{path}") for host in (
    "casino-win.example.com", "best-casino.example.org", "www.casino-royal.example.net",
    "free-bets.example.com", "free-spins.example.org", "bets-online.example.net",
    "cheap-pills.example.org", "pills-shop.example.com", "cheap-meds.example.net",
    "adult-x.example.org", "xxx-adult.example.com", "adult-cams.example.net",
    "spam-farm.example.com", "link-farm.example.org", "seo-spam.example.net",
    "ads-track.example.org", "track-click.example.com", "ads-server.example.net",
) for path in ("en/14", "fr/728?utm_source=feed", "de/3.html", "")] + [
    (0, f"https://{host}/{path}") for host in (
    "thething.example.com", "www.threader.example.org", "blog.tionson.example.net",
    "m.ererhat.example.com", "news.thandor.example.org", "handson.example.net",
    "www.riverton.example.com", "blog.inthend.example.org", "forum.ontheour.example.net",
    "docs.hereal.example.com", "thouand.example.org", "m.theatre.example.net",
    "wiki.ofthing.example.com", "shop.leather.example.org", "thistle.example.net",
    "blog.estate.example.com", "www.weather.example.org", "m.shoreline.example.net",
) for path in ("en/25#top", "fr/853/", "es/120.html", "")]


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): after the first ``://`` up to ``/``, ``?``, ``#`` or the end,
    A-Z lower-cased; then up to ``?``, ``#`` or the end. Both empty without one."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min(i for i in (rest.find("/"), rest.find("?"), rest.find("#"), len(rest)) if i >= 0)
    host = rest[:end].encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    rest = rest[end:]
    end = min(i for i in (rest.find("?"), rest.find("#"), len(rest)) if i >= 0)
    return host, rest[:end]


def _buckets(host: str, path: str) -> list[int]:
    grams = []
    for kind, text in (("h", f"^{host}$"), ("p", f"^{path}$")):
        grams += [f"{kind}{text[i:i + n]}" for n in (3, 4, 5) for i in range(len(text) - n + 1)]
    return [zlib.crc32(g.encode("utf-8", "surrogatepass")) % BUCKETS for g in grams]


@dataclass
class UrlModel:
    weights: np.ndarray
    bias: float

    def score(self, host: str, path: str) -> float:
        """Probability that the URL should be blocked."""
        found = _buckets(host, path)
        return float(NG.sigmoid(self.weights[found].sum() / np.sqrt(max(1, len(found))) + self.bias))


def fit(labelled: DataFrame, rows: int = LABELLED_ROWS) -> UrlModel:
    """Fit on ``labelled(label, url)``, the first ``rows`` by hash of the URL. Null
    urls and labels other than 0 and 1 are left out; with one class only the
    model is the smoothed share of ones."""
    known = labelled.where(F.col("label").isin(0, 1) & F.col("url").isNotNull())
    got = known.orderBy(F.xxhash64("url"), "url", "label").limit(rows).collect()
    x = np.zeros((len(got), BUCKETS), dtype=np.float32)
    for i, r in enumerate(got):
        found = _buckets(*split_url(r.url))
        np.add.at(x[i], found, 1 / np.sqrt(max(1, len(found))))
    y = np.array([r.label for r in got], dtype=np.float64)
    share = (y.sum() + 1) / (len(y) + 2)
    bias = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return UrlModel(np.zeros(BUCKETS), bias)
    model = NG.minimise(lambda z: (NG.sigmoid(z) - y) / len(y), x, bias, 400, 1.0, 1e-5)
    return UrlModel(model.weights, model.bias)


class RuleList:
    """The longest rule that fits a URL, by looking up the host's suffixes."""

    def __init__(self, rules: list[tuple[str, str]]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, text in rules:
            host, slash, path = text.partition("/")
            self.by_host.setdefault(host, []).append((slash + path, text, verdict))

    def decide(self, host: str, path: str) -> tuple[str | None, str | None]:
        labels, best = host.split("."), None
        for i in range(len(labels)):
            for prefix, text, verdict in self.by_host.get(".".join(labels[i:]), ()):
                if path.startswith(prefix) and (best is None or len(text) > len(best[0])):
                    best = (text, verdict)
        return best or (None, None)


def filter_urls(pages: DataFrame, model: UrlModel, rules: list[tuple[str, str]] = RULES,
                url_col: str = "url") -> DataFrame:
    """``pages`` with a struct column ``url_verdict``: host, path, rule (or null),
    score (the model's probability of block) and verdict.

    Null URLs and those without ``://`` have an empty host and path; no rule
    fits them and the model judges them too. Repeated rows are judged each; an
    empty table stays empty.
    """
    sent = pages.sparkSession.sparkContext.broadcast((model, RuleList(rules)))

    @F.pandas_udf("host string, path string, rule string, score double, verdict string")
    def verdict(urls: pd.Series) -> pd.DataFrame:
        judge, listed = sent.value
        out = []
        for url in urls:
            host, path = split_url(url)
            rule, said = listed.decide(host, path)
            p = judge.score(host, path)
            out.append((host, path, rule, p, said or ("block" if p >= BLOCK_AT else "allow")))
        return pd.DataFrame(out, columns=["host", "path", "rule", "score", "verdict"])

    return pages.withColumn("url_verdict", verdict(F.col(url_col)))


def labelled_urls(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LABELLED_URLS, "label int, url string")
