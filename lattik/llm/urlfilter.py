"""URL filter: gradient-boosted trees on lexical features, after explicit rules.

The trees (squared loss on the logistic gradient with Newton leaves, histogram splits) are fitted with numpy on a bounded
sample of labelled URLs; features are lengths, depth, digit ratio, entropy, counts of parameters and marks, and statistics
of host suffixes (share of blocked labelled URLs under a suffix, smoothed). For a URL that the trees are fitted on, a suffix's
share is taken from the URLs of other hosts only, so that trees don't learn a host's own label from it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattik.llm.common import map_batches

#: Labelled URLs that the trees are fitted on, at most (about; chosen by a hash of the URL).
SAMPLE = 20_000
TREES, DEPTH, RATE, BINS = 60, 3, 0.2, 32
#: Labelled URLs that a suffix needs for a statistic of its own.
LEAST = 5
#: Probability from which a URL is blocked.
CUT = 0.5

FEATURES = (
    "length", "host length", "path length", "depth", "host labels", "digit ratio", "host digit ratio", "entropy", "host entropy", "parameters",
    "hyphens in host", "longest host label", "longest path part", "fragment", "encoded characters", "upper-case ratio", "suffix of 1", "suffix of 2", "suffix of 3",
)


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host_: Column, path_: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule (``host/path``) that fits a host or its subdomains and the path's start, as a struct of rule and verdict; else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is asked first
        name, _, rest = rule.partition("/")
        fits = ((host_ == name) | host_.endswith("." + name)) & path_.startswith("/" + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _entropy(text: str) -> float:
    if not text:
        return 0.0
    p = np.fromiter(Counter(text).values(), float) / len(text)
    return float(-(p * np.log2(p)).sum())


def _digits(text: str) -> float:
    return sum(c.isdigit() for c in text) / max(1, len(text))


def suffixes(name: str) -> list[str]:
    """The last label, two labels and three labels of a host."""
    labels = name.split(".")
    return [".".join(labels[-n:]) if n <= len(labels) else "" for n in (1, 2, 3)]


_PARTS = re.compile(r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?")


def features(url: str | None, stats: dict[str, float], base: float) -> list[float]:
    url = url or ""
    m = _PARTS.match(url)
    name, way, query, fragment = (g or "" for g in m.groups()) if m else ("", url, "", "")
    name = name.lower()
    parts, labels = [p for p in way.split("/") if p], [x for x in name.split(".") if x]
    return [
        len(url), len(name), len(way), len(parts), len(labels), _digits(url), _digits(name), _entropy(url), _entropy(name),
        query.count("&") + 1 if len(query) > 1 else 0, name.count("-"), max(map(len, labels), default=0), max(map(len, parts), default=0),
        float(bool(fragment)), url.count("%"), sum(c.isupper() for c in url) / max(1, len(url)), *(stats.get(s, base) for s in suffixes(name)),
    ]


@dataclass
class Model:
    stats: dict[str, float] = field(default_factory=dict)
    base: float = 0.5
    start: float = 0.0
    #: Each a list of (feature, threshold, left, right) by node; leaves are (-1, value, 0, 0).
    trees: list[list[tuple[int, float, int, int]]] = field(default_factory=list)

    def probability(self, urls: Sequence[str | None]) -> np.ndarray:
        if not len(urls):
            return np.empty(0)
        return _sigmoid(self.raw(np.array([features(u, self.stats, self.base) for u in urls])))

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for tree in self.trees:
            total += RATE * _walk(tree, x)
        return total


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _walk(tree: list[tuple[int, float, int, int]], x: np.ndarray) -> np.ndarray:
    kind, cut, left, right = (np.array(c) for c in zip(*tree))
    at = np.zeros(len(x), int)
    for _ in range(DEPTH):
        inner = kind[at] >= 0
        goes = x[np.arange(len(x)), np.maximum(kind[at], 0)] <= cut[at]
        at = np.where(inner, np.where(goes, left[at], right[at]), at)
    return cut[at]


def _grow(x: np.ndarray, edges: list[np.ndarray], g: np.ndarray, h: np.ndarray) -> list[tuple[int, float, int, int]]:
    tree: list = []

    def node(rows: np.ndarray, depth: int) -> int:
        here = len(tree)
        tree.append(None)
        gs, hs = g[rows].sum(), h[rows].sum()
        best = (1e-6, -1, 0.0)
        if depth < DEPTH and len(rows) >= 10:
            for f, cuts in enumerate(edges):
                if not len(cuts):
                    continue
                bins = np.searchsorted(cuts, x[rows, f], side="left")
                gl, hl = (np.cumsum(np.bincount(bins, v[rows], len(cuts) + 1))[:-1] for v in (g, h))
                gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), f, float(cuts[k]))
        if best[1] < 0:
            tree[here] = (-1, float(gs / (hs + 1)), 0, 0)
        else:
            goes = x[rows, best[1]] <= best[2]
            tree[here] = (best[1], best[2], node(rows[goes], depth + 1), node(rows[~goes], depth + 1))
        return here

    node(np.arange(len(x)), 0)
    return tree


def fit(urls: Sequence[str | None], blocked: Sequence[int]) -> Model:
    """Trees from URLs and labels (1: block). Without labels of both kinds every URL gets the share of blocked ones."""
    y = np.array(blocked, float)
    model = Model()
    if not len(y):
        model.start = -5.0
        return model
    share = min(max(float(y.mean()), 0.01), 0.99)
    model.base, model.start = share, float(np.log(share / (1 - share)))
    if y.min() == y.max():
        return model
    seen, bad = Counter(), Counter()
    names = [(m[1].lower() if (m := _PARTS.match(u or "")) else "") for u in urls]
    own = {name: [0, 0.0] for name in names}
    for name, label in zip(names, y):
        own[name][0] += 1
        own[name][1] += label
        for s in suffixes(name):
            seen[s] += 1
            bad[s] += label

    def stat(s: str, n: int = 0, blocked: float = 0.0) -> float:
        """The share of a suffix, without ``n`` URLs of which some are blocked."""
        return (bad[s] - blocked + 5 * share) / (seen[s] - n + 5) if s and seen[s] - n >= LEAST else share

    model.stats = {s: stat(s) for s in seen if s and seen[s] >= LEAST}
    x = np.array([features(u, {s: stat(s, *own[name]) for s in suffixes(name)}, share) for u, name in zip(urls, names)])
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
    edges = [e[e < x[:, f].max()] for f, e in enumerate(edges)]
    raw = np.full(len(y), model.start)
    for _ in range(TREES):
        p = _sigmoid(raw)
        tree = _grow(x, edges, y - p, p * (1 - p))
        model.trees.append(tree)
        raw += RATE * _walk(tree, x)
    return model


def train(labelled: DataFrame, sample: int = SAMPLE, url_col: str = "url", label_col: str = "blocked") -> Model:
    """Fit on at most about ``sample`` distinct labelled URLs, chosen by a hash; null URLs and labels are left out."""
    known = labelled.where(F.col(url_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(url_col).alias("url")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    total, slots = known.count(), 1 << 20
    share = slots if total <= sample else max(1, slots * sample // total)
    rows = sorted((r["url"], r["y"]) for r in known.where(F.pmod(F.xxhash64("url"), F.lit(slots)) < share).collect())  # bounded by sample
    return fit([u for u, _ in rows], [y for _, y in rows])


def judge(pages: DataFrame, model: Model, rules: Sequence[tuple[str, str]] = (), id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``id_col``, ``host``, ``path``, ``rule`` (else null), ``verdict`` (allow or block), ``block_probability`` by the trees.

    A null URL and one without ``://`` have an empty host and path and get the trees' verdict. Repeated rows are judged
    each; very long URLs are read whole; an empty table gives no rows; other columns are not read.
    """
    shared = pages.sparkSession.sparkContext.broadcast((model.stats, model.base, model.start, model.trees))

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        fitted = Model(*shared.value)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            p = fitted.probability(batch.column(1).to_pylist())
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())], names=["id", "url", "p"])

        return run

    rows = map_batches(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")), make, f"id {dict(pages.dtypes)[id_col]}, url string, p double")
    found = rows.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    found = found.withColumn("hit", rule_for(F.col("host"), F.col("path"), rules))
    return found.select(
        F.col("id").alias(id_col), "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce(F.col("hit.verdict"), F.when(F.col("p") >= CUT, "block").otherwise("allow")).alias("verdict"), F.col("p").alias("block_probability"),
    )
