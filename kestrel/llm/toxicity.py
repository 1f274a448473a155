"""Toxicity by compression distance.

One zstandard dictionary is built from toxic text and one from ordinary text.
Both hold the same most usual words of ordinary text; the toxic one adds the words
that toxic documents use far more often.  A window of a text is judged by how many
bytes fewer it takes with the toxic dictionary, and a document by those differences
through a calibrated logistic curve.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import held_out

FOLDS, HELD_OUT = 4, 2
SAMPLE_ROWS = 9_000       # labelled documents to learn from, at most
SAMPLE_BYTES = 32 << 20   # and bytes of their texts, at most
WINDOW = 48               # bytes
SHARED_BYTES = 24 << 10   # usual words, in both dictionaries
TOXIC_BYTES = 8 << 10     # words of toxic text
LIFT, LEAST_DOCS = 10.0, 4
THRESHOLD = 0.3

_PARAMETERS = dict(window_log=18, hash_log=17, chain_log=17, search_log=5, min_match=4,
                   target_length=64, strategy=zstandard.STRATEGY_BTLAZY2, write_content_size=False,
                   write_checksum=False, write_dict_id=False)


def windows(text: str | None, size: int = WINDOW) -> list[bytes]:
    """The whole lower-cased text as consecutive windows, each cut back to a blank
    where its last third has one."""
    raw = (text or "").lower().encode("utf-8", "replace")
    out, at = [], 0
    while at < len(raw):
        end = at + size
        if end < len(raw):
            blank = raw.rfind(b" ", at + size * 2 // 3, end)
            end = blank + 1 if blank > 0 else end
        out.append(raw[at:end])
        at = end
    return out


@lru_cache(maxsize=8)
def _compress(dictionary: bytes):
    parameters = zstandard.ZstdCompressionParameters(**_PARAMETERS)
    loaded = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    loaded.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=loaded, compression_params=parameters).compress


def differences(text: str | None, toxic: bytes, ordinary: bytes) -> np.ndarray:
    """Bytes the toxic dictionary saves against the ordinary one, a window each."""
    a, b = _compress(toxic), _compress(ordinary)
    return np.array([len(b(w)) - len(a(w)) for w in windows(text)], dtype=float)


def summary(d: np.ndarray) -> np.ndarray:
    """What a document's differences say in fixed width; zeros without windows."""
    if not len(d):
        return np.zeros(9)
    top = np.sort(d)[::-1]
    return np.array([top[0], top[:3].mean(), d.mean(), np.quantile(d, 0.75), (d > 6).mean(),
                     (d >= 4).mean(), (d >= 6).sum(), (d >= 9).sum(), np.log1p(len(d))])


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        x = summary(differences(text, self.toxic, self.ordinary))
        z = ((x - self.mean) / self.scale) @ self.weights + self.bias
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def dictionaries(rows: list[tuple[str, int]]) -> tuple[bytes, bytes]:
    """The toxic and the ordinary dictionary of (text, label) rows; the words that
    matter most come last, where zstandard reaches them at least cost."""
    seen = {0: Counter(), 1: Counter()}
    total = Counter()
    for text, label in rows:
        seen[label].update(set((text or "").lower().split()))
        total[label] += 1

    def lift(w):
        return ((seen[1][w] + 0.5) / (total[1] + 1)) / ((seen[0][w] + 0.5) / (total[0] + 1))

    rich = {w: n * np.log(lift(w)) for w, n in seen[1].items() if n >= LEAST_DOCS and lift(w) > LIFT}
    toxic = [w for w, _ in sorted(rich.items(), key=lambda x: (x[1], x[0]))]
    usual = sorted((w for w in seen[0] if w not in rich), key=lambda w: (seen[0][w], w))
    shared = " ".join(usual[-SHARED_BYTES:]).encode()[-SHARED_BYTES:] + b" "
    return shared + " ".join(toxic).encode()[-TOXIC_BYTES:] + b" ", shared


def fit_rows(rows: list[tuple[str, int]]) -> Model:
    """Dictionaries from two thirds of the rows, the curve from the rest, which the
    dictionaries have not seen.  Without both labels the score is constant."""
    toxic, ordinary = dictionaries([r for i, r in enumerate(rows) if i % 3])
    rest = [r for i, r in enumerate(rows) if i % 3 == 0]
    x = np.array([summary(differences(t, toxic, ordinary)) for t, _ in rest]).reshape(len(rest), 9)
    y = np.array([label for _, label in rest], dtype=float)
    rate = (y.sum() + 0.5) / (len(y) + 10.0)
    if not len(y) or y.min() == y.max():
        return Model(toxic, ordinary, np.zeros(9), np.ones(9), np.zeros(9), float(np.log(rate / (1 - rate))))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w, ridge = np.zeros(z.shape[1]), np.diag([1.0] * (z.shape[1] - 1) + [1e-6])
    for _ in range(25):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z + ridge
        w -= np.linalg.solve(hessian, z.T @ (p - y) + ridge @ w)
    return Model(toxic, ordinary, mean, scale, w[:-1], float(w[-1]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = SAMPLE_ROWS,
        sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on the labelled documents whose hashed ids are lowest, within both bounds.

    A text of more than a sixteenth of ``sample_bytes`` is left out, so that no single
    one takes the room of the others; such texts are scored like all.
    An id labelled more than once counts with its largest label; null labels and
    null ids don't count.
    """
    order = F.xxhash64("doc_id")
    known = labels.groupBy("doc_id").agg(F.max(label).cast("int").alias("__label")).dropna()
    sizes = (docs.select("doc_id", F.octet_length("text").alias("size")).join(known, "doc_id")
             .select(order.alias("h"), F.coalesce("size", F.lit(0)).alias("size"), "__label", "doc_id")
             .filter(F.col("size") <= sample_bytes // 16).orderBy("h", "doc_id").limit(sample_rows).toPandas())
    taken = sizes[sizes["size"].cumsum() <= sample_bytes]
    if not len(taken):
        return fit_rows([])
    chosen = docs.sparkSession.createDataFrame(
        pd.DataFrame({"doc_id": taken["doc_id"], "__label": taken["__label"]}).drop_duplicates("doc_id"))
    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # sample_rows at most
            .toPandas().sort_values("doc_id", kind="stable"))
    return fit_rows([(t or "", int(y)) for t, y in zip(rows["text"], rows["__label"])])


def with_toxicity(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` plus the probability that its whole text is toxic; null counts as empty."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # two dictionaries of fixed size

    @F.pandas_udf("double")
    def apply(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t) for t in texts], dtype=float)

    return df.withColumn(out, apply(F.col(text)))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per row of ``documents``; a null doc_id is neither learned from nor held out.

    Null and empty texts get the score of a text without windows; a text of any length is
    scored whole, window by window.  Repeated rows are scored once each, an empty table
    gives an empty one, without labels the score is the same for all; columns beyond doc_id
    and text are not read.
    """
    rows = docs.select("doc_id", held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), "text")
    model = fit(rows.filter(~F.col("held_out")).select("doc_id", "text"), labels)
    return with_toxicity(rows, model).select(
        "doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
