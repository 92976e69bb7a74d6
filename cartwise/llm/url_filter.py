"""URL filter: host and path rules, and boosted trees on lexical features for
the URLs that no rule fits.

A rule (host, path) fits its host and every subdomain when the URL's path
starts with the rule's path; the longest rule (host and path together) wins,
then the alphabetically first.  URLs that a rule fits are the labelled URLs:
gradient-boosted trees learn block or allow from their lexical features
(length, depth, digit ratio, entropy, parameter counts, suffix statistics) and
judge the others.  Suffix statistics are the smoothed share of blocked URLs per
last one and last two host labels, counted over all labelled URLs; a labelled
URL's own label is left out of its statistics.

Training is bounded: ``TRAIN_URLS`` labelled URLs per verdict (smallest page_id
hash); counting and judging read every URL.

Defined results: a null URL, or one without ``://``, has empty host and path,
fits no rule and is judged by the model; repeated rows get equal results;
labelled URLs of one verdict only make that verdict the answer for the rest, no
labelled URL at all makes it ``allow``; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.skew import sized_broadcast, top_k_per_group
from .common import table, written

# The rules of the registered query, (verdict, host, path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
TRAIN_URLS = 5_000
TREES, DEPTH, RATE, BINS = 40, 3, 0.2, 32
RIDGE = 1.0
SMOOTH = 10.0               # weight of the overall share in a suffix's share

FEATURES = ("length", "host_length", "host_labels", "depth", "path_length", "digits", "entropy", "parameters",
            "query_length", "fragment", "hyphens", "suffix_share", "domain_share")


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_urls(pages: DataFrame, url: str = "url", page_id: str = "page_id") -> DataFrame:
    """page_id, url, host (A-Z lower-cased), path."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"))
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return rows.select("page_id", "url", _ascii_lower(host).alias("host"), path.alias("path"))


def rule_index(rules) -> dict[str, list[tuple[str, str, str]]]:
    """host -> (path, name, verdict), the longest path first."""
    index: dict[str, list[tuple[str, str, str]]] = {}
    for verdict, host, path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2], r[0])):
        index.setdefault(host, []).append((path, host + path, verdict))
    return index


def best_rule(index: dict, host: str, path: str) -> tuple[str | None, str | None]:
    """(rule, verdict) of the longest rule that fits."""
    best: tuple[int, str, str] | None = None
    suffix = host
    while suffix:
        for p, name, verdict in index.get(suffix, ()):
            if path.startswith(p):
                if best is None or (-len(name), name) < (best[0], best[1]):
                    best = (-len(name), name, verdict)
                break
        _, dot, suffix = suffix.partition(".")
        if not dot:
            break
    return (best[1], best[2]) if best else (None, None)


def _entropy(url: str) -> float:
    if not url:
        return 0.0
    n = np.unique(np.frombuffer(url.encode("utf-32-le"), dtype=np.uint32), return_counts=True)[1] / len(url)
    return float(-(n * np.log2(n)).sum())


def lexical(url: str, host: str, path: str) -> list[float]:
    """The FEATURES but the suffix shares."""
    query = url.partition("?")[2].partition("#")[0]
    return [len(url), len(host), host.count(".") + 1 if host else 0, len([p for p in path.split("/") if p]), len(path),
            sum(map(url.count, "0123456789")) / max(1, len(url)), _entropy(url),
            len([p for p in query.split("&") if p]), len(query), float("#" in url), url.count("-")]


def judged_urls(pages: DataFrame, rules=RULES, url: str = "url", page_id: str = "page_id") -> DataFrame:
    """page_id, host, path, rule, label (of the rule), suffix, domain, features."""
    index = rule_index(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for u, h, p in zip(*(batch.column(c).to_pylist() for c in ("url", "host", "path"))):
                name, verdict = best_rule(index, h, p)
                labels = h.split(".")
                out.append((name, verdict, labels[-1], ".".join(labels[-2:]), lexical(u, h, p)))
            cols = list(zip(*out)) if out else [()] * 5
            kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("host"), batch.column("path"),
                 *(pa.array(c, k) for c, k in zip(cols, kinds))],
                names=["page_id", "host", "path", "rule", "label", "suffix", "domain", "x"])

    return split_urls(pages, url, page_id).withColumn("page_id", F.col("page_id").cast("long")).mapInArrow(
        run, "page_id long, host string, path string, rule string, label string, suffix string, domain string, x array<double>")


# ---------------------------------------------------------------- boosted trees

class Trees:
    """``edges`` per feature; each tree is (feature, bin, value) arrays over the
    nodes of a complete binary tree, root first."""

    def __init__(self, base: float, edges=(), trees=()):
        self.base, self.edges, self.trees = base, list(edges), list(trees)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        if self.trees and len(x):
            b, row = self.bins(x), np.arange(len(x))
            for feature, cut, value in self.trees:
                node = np.zeros(len(x), dtype=np.int64)
                while True:
                    inner = feature[node] >= 0
                    if not inner.any():
                        break
                    f = np.maximum(feature[node], 0)
                    node = np.where(inner, 2 * node + 1 + (b[row, f] > cut[node]), node)
                out += value[node]
        return out

    def parts(self) -> tuple:
        return self.base, self.edges, self.trees


def boost(x: np.ndarray, y: np.ndarray) -> Trees:
    """Gradient-boosted trees (logistic loss) on binned features; y is 0 or 1."""
    if not len(y):
        return Trees(-1.0)
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    model = Trees(float(np.log(mean / (1 - mean))))
    if y.min() == y.max():
        return model
    model.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    b, margin = model.bins(x), np.full(len(y), model.base)
    size = 2 ** (DEPTH + 1) - 1
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        feature, cut, value = np.full(size, -1), np.zeros(size, dtype=int), np.zeros(size)
        node = np.zeros(len(y), dtype=np.int64)
        for n in range(size):
            own = np.flatnonzero(node == n)
            if not len(own):
                continue
            gs, hs = g[own].sum(), h[own].sum()
            value[n] = RATE * gs / (hs + RIDGE)
            best = (1e-6, -1, 0)
            if n < size // 2:
                for j, e in enumerate(model.edges):
                    left_g = np.bincount(b[own, j], weights=g[own], minlength=len(e) + 1).cumsum()[:-1]
                    left_h = np.bincount(b[own, j], weights=h[own], minlength=len(e) + 1).cumsum()[:-1]
                    if len(left_g):
                        gain = (left_g ** 2 / (left_h + RIDGE) + (gs - left_g) ** 2 / (hs - left_h + RIDGE)
                                - gs ** 2 / (hs + RIDGE))
                        k = int(gain.argmax())
                        if gain[k] > best[0]:
                            best = (float(gain[k]), j, k)
            if best[1] >= 0:
                feature[n], cut[n] = best[1], best[2]
                node[own] = 2 * n + 1 + (b[own, best[1]] > best[2])
        margin += value[node]
        model.trees.append((feature, cut, value))
    return model


def _with_shares(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """``rows`` with the shares of blocked URLs of their suffix and domain
    (their own label left out)."""
    total = labelled.agg(F.avg("y").alias("m")).first()["m"]
    overall = float(total) if total is not None else 0.0
    own = F.when(F.col("label").isNull(), F.lit(0)).otherwise(1)
    y = F.when(F.col("label") == "block", 1).otherwise(0)
    for key in ("suffix", "domain"):
        stats = labelled.groupBy(key).agg(F.sum("y").alias(f"{key}_y"), F.count(F.lit(1)).alias(f"{key}_n"))
        rows = rows.join(sized_broadcast(written(stats, f"url-{key}"), 100_000), key, "left")
        seen_y, seen_n = F.coalesce(f"{key}_y", F.lit(0)) - y, F.coalesce(f"{key}_n", F.lit(0)) - own
        rows = rows.withColumn(f"{key}_share", (seen_y + SMOOTH * overall) / (seen_n + SMOOTH)).drop(f"{key}_y", f"{key}_n")
    return rows.withColumn("x", F.concat("x", F.array("suffix_share", "domain_share")))


def filter_urls(pages: DataFrame, rules=RULES, url: str = "url", page_id: str = "page_id") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score (the model's
    margin for blocking)."""
    rows = written(judged_urls(pages, rules, url, page_id), "url-rows")
    labelled = rows.where("label IS NOT NULL").withColumn("y", (F.col("label") == "block").cast("int"))
    rows = _with_shares(rows, labelled)
    chosen = top_k_per_group(rows.where("label IS NOT NULL").select("label", "page_id", "host", "path", "x"), "label",
                             [F.xxhash64("page_id"), F.col("page_id"), F.col("host"), F.col("path")], TRAIN_URLS).toArrow()
    x = np.array(chosen["x"].to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    y = np.array([v == "block" for v in chosen["label"].to_pylist()], dtype=float)
    order = np.lexsort((*x.T, y)) if len(y) else np.empty(0, dtype=int)
    shared = pages.sparkSession.sparkContext.broadcast(boost(x[order], y[order]).parts())      # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Trees(*shared.value)
        for batch in batches:
            own = np.array(batch.column("x").to_pylist(), dtype=float).reshape(-1, len(FEATURES))
            margin = model.margin(own)
            verdict = [v if v is not None else ("block" if m > 0 else "allow")
                       for v, m in zip(batch.column("label").to_pylist(), margin)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "host", "path", "rule")),
                                              pa.array(verdict, pa.string()), pa.array(margin)],
                                             names=["page_id", "host", "path", "rule", "verdict", "score"])

    return (rows.select("page_id", "host", "path", "rule", "label", "x")
            .mapInArrow(run, "page_id long, host string, path string, rule string, verdict string, score double"))


def op6(spark, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))
