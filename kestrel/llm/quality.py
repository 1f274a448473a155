"""Document quality by histogram gradient-boosted trees over text statistics.

Statistics of every whole text are computed in Arrow batches and written once;
trees are fitted on a bounded sample of the labelled rows and flattened into
arrays, which numpy walks for all rows of a batch at once, one level a step.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import held_out, written

FOLDS, HELD_OUT = 3, 1
SAMPLE_ROWS = 20_000  # labelled rows the trees are fitted on, at most
THRESHOLD = 0.5

FEATURES = ("log_bytes", "upper", "lower", "digit", "space", "newline", "punctuation", "high",
            "entropy", "top_byte", "log_words", "word_bytes", "distinct_words", "distinct_pairs",
            "log_lines", "distinct_lines", "line_bytes", "symbol_ends", "repeat_runs", "bars")

_BYTE = np.arange(256)
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_LOWER = (_BYTE >= 97) & (_BYTE <= 122)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_PUNCT = (_BYTE > 32) & (_BYTE < 127) & ~(_UPPER | _LOWER | _DIGIT)
_SYMBOL_END = re.compile(r"[^\w\s.,;:?'\")\]][ \n]")


def statistics(text: str | None) -> list[float]:
    """The ``FEATURES`` of one whole text; all zero for a null or empty one."""
    if not text:
        return [0.0] * len(FEATURES)
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    n = len(raw)
    counts = np.bincount(raw, minlength=256)
    share = counts[counts > 0] / n
    ws, lines = text.split(), text.split("\n")
    nw, nl = max(1, len(ws)), len(lines)
    return [
        np.log1p(n), counts[_UPPER].sum() / n, counts[_LOWER].sum() / n, counts[_DIGIT].sum() / n,
        counts[32] / n, counts[10] / n, counts[_PUNCT].sum() / n, counts[128:].sum() / n,
        float(-(share * np.log2(share)).sum()), float(share.max()), np.log1p(len(ws)), n / nw,
        len(set(ws)) / nw, len(set(zip(ws, ws[1:]))) / nw, np.log1p(nl), len(set(lines)) / nl,
        n / nl, len(_SYMBOL_END.findall(text)) / nw, int((raw[1:] == raw[:-1]).sum()) / n,
        counts[124] / nw,
    ]


def with_statistics(df: DataFrame, text: str = "text", out: str = "features") -> DataFrame:
    """``df`` with the statistics of its text column as array<double> ``out``."""
    @F.pandas_udf("array<double>")
    def stats(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts])

    return df.withColumn(out, stats(F.col(text)))


@dataclass
class Trees:
    """Trees as flat arrays: node i sends x to ``left[i]`` if x[feature[i]] <= cut[i],
    else to ``left[i] + 1``; a leaf has itself as ``left`` and an infinite cut."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        at = np.repeat(self.roots[None, :], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = self.left[at] + (x[rows, self.feature[at]] > self.cut[at])
        return self.base + self.value[at].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margin(x))) if len(x) else np.zeros(0)


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15,
              bins: int = 64, ridge: float = 1.0, least: int = 10) -> Trees:
    """Boost ``trees`` trees on logistic loss; splits are chosen from histograms of
    gradients over at most ``bins`` quantile bins a feature.  Without rows, or with
    one class, the trees are empty and the score is the class's smoothed share."""
    n, width = x.shape
    base = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    feature, cut, left, value, roots = [], [], [], [], []

    def node() -> int:
        feature.append(0), cut.append(np.inf), left.append(len(left)), value.append(0.0)
        return len(left) - 1

    if n and 0 < y.sum() < n:
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
        binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(width)], axis=1)
        flat = binned + np.arange(width) * bins
        margin = np.full(n, base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = p - y, p * (1 - p)
            root = node()
            roots.append(root)
            level = [(root, np.arange(n))]
            for d in range(depth + 1):
                deeper = []
                for at, rows in level:
                    g, h = grad[rows].sum(), hess[rows].sum()
                    value[at] = -rate * g / (h + ridge)
                    if d == depth or len(rows) < 2 * least:
                        continue
                    cells = flat[rows].ravel()
                    shape = (width, bins)
                    hg = np.bincount(cells, np.repeat(grad[rows], width), width * bins).reshape(shape).cumsum(1)
                    hh = np.bincount(cells, np.repeat(hess[rows], width), width * bins).reshape(shape).cumsum(1)
                    hn = np.bincount(cells, minlength=width * bins).reshape(shape).cumsum(1)
                    gain = hg ** 2 / (hh + ridge) + (g - hg) ** 2 / (h - hh + ridge) - g ** 2 / (h + ridge)
                    gain[(hn < least) | (len(rows) - hn < least)] = 0
                    f, b = np.unravel_index(np.argmax(gain), shape)
                    if gain[f, b] <= 1e-6 or b >= len(edges[f]):
                        continue
                    a, c = node(), node()
                    feature[at], cut[at], left[at] = int(f), float(edges[f][b]), a
                    goes = binned[rows, f] <= b
                    deeper += [(a, rows[goes]), (c, rows[~goes])]
                level = deeper
            tree = Trees(0.0, np.array([root]), np.array(feature), np.array(cut), np.array(left),
                         np.array(value) * np.array([x == i for i, x in enumerate(left)]), depth)
            margin += tree.margin(x)
    leaf = np.array([x == i for i, x in enumerate(left)], dtype=float)
    return Trees(base, np.array(roots, int), np.array(feature, int), np.array(cut, float),
                 np.array(left, int), np.array(value, float) * leaf, depth)


def fit(features: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS,
        **options) -> Trees:
    """Fit on the ``sample_rows`` labelled documents whose hashed ids are lowest.

    ``features`` has doc_id and features; an id labelled more than once counts with
    its largest label, null labels and ids not at all.
    """
    known = labels.groupBy("doc_id").agg(F.max(label).alias("__label")).dropna()
    rows = (features.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id")
            .select("features", "__label").limit(sample_rows).toPandas())
    x = np.array(rows["features"].tolist(), dtype=float).reshape(len(rows), len(FEATURES))
    return fit_trees(x, rows["__label"].to_numpy(dtype=float), **options)


def score(features: DataFrame, model: Trees) -> DataFrame:
    """``features`` with ``score``: the probability of label 1."""
    @F.pandas_udf("double")
    def apply(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array(x.tolist(), dtype=float).reshape(len(x), len(FEATURES))))

    return features.withColumn("score", apply("features"))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Null and empty texts have statistics of zero and are scored like others; a
    row of ``documents`` gives one row, repeated ones included."""
    features = written(
        with_statistics(docs.select("doc_id", "text")).select(
            "doc_id", held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), "features"),
        "quality-features")
    model = fit(features.filter(~F.col("held_out")), labels)
    return score(features, model).select(
        "doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
