"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained with follow-the-regularised-leader (FTRL-proximal)
under elastic-net penalties, its probabilities calibrated by one temperature.

Document frequencies cover every learnable document; weights are fitted on a
bounded sample of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import held_out, written

FOLDS, HELD_OUT = 5, 0
BITS = 15                # n-grams are hashed into 2^15 features
ORDERS = (1, 2, 3)
SAMPLE_ROWS = 3_000      # labelled documents the weights are fitted on, at most
SAMPLE_FEATURES = 4 << 20  # and their features together (6 bytes each): the driver's memory
UNKNOWN = "und"
_MIX = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-gram features of a whole text and how often each occurs."""
    chars = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    shift = np.uint32(32 - BITS)
    found = []
    for n in ORDERS:
        if len(chars) >= n:
            h = np.full(len(chars) - n + 1, n * 0x27D4EB2F & 0xFFFFFFFF, dtype=np.uint32)
            for i in range(n):
                h = (h ^ chars[i:len(chars) - n + 1 + i]) * np.uint32(_MIX[i])
            found.append((h ^ (h >> np.uint32(15))) * np.uint32(_MIX[0]) >> shift)
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    seen = np.bincount(np.concatenate(found), minlength=1 << BITS)
    at = np.flatnonzero(seen)
    return at, seen[at]


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray          # a feature's inverse document frequency
    weights: np.ndarray      # languages x features, mostly zero
    bias: np.ndarray
    temperature: float = 1.0

    def vector(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        x = (1.0 + np.log(n)) * self.idf[at]
        return x / max(1e-12, float(np.sqrt((x * x).sum())))

    def logits(self, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        return self.weights[:, at] @ x + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        """The likeliest language and its calibrated probability."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        at, n = counts(text)
        p = softmax(self.logits(at, self.vector(at, n)) / self.temperature)
        best = int(np.argmax(p))
        return self.languages[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray, str]], idf: np.ndarray, epochs: int = 3,
          alpha: float = 0.5, beta: float = 1.0, l1: float = 0.01, l2: float = 0.01) -> Model:
    """FTRL-proximal over the rows; every fifth row is kept for the temperature."""
    languages = sorted({lang for _, _, lang in rows})
    k, width = len(languages), len(idf)
    z, n = np.zeros((k, width + 1)), np.zeros((k, width + 1))
    model = Model(languages, idf, np.zeros((k, width)), np.zeros(k))

    def weights(at):
        pull = np.maximum(np.abs(z[:, at]) - l1, 0) * -np.sign(z[:, at])
        return pull / ((beta + np.sqrt(n[:, at])) / alpha + l2)

    def ready(row):
        """Places and values of a row, and its language; made anew each time, not kept."""
        at, c, lang = row
        return np.append(at.astype(np.int64), width), np.append(model.vector(at, c), 1.0), languages.index(lang)

    order = np.random.default_rng(7)
    fit_on = [d for i, d in enumerate(rows) if i % 5 or len(rows) < 10]
    for _ in range(epochs):
        for i in order.permutation(len(fit_on)):
            at, x, y = ready(fit_on[i])
            w = weights(at)
            p = softmax(w @ x)
            p[y] -= 1.0
            grad = p[:, None] * x[None, :]
            sigma = (np.sqrt(n[:, at] + grad * grad) - np.sqrt(n[:, at])) / alpha
            z[:, at] += grad - sigma * w
            n[:, at] += grad * grad
    if rows:
        final = weights(np.arange(width + 1))
        model.weights, model.bias = final[:, :-1], final[:, -1]
        kept = [d for i, d in enumerate(rows) if i % 5 == 0] or rows
        raw = np.array([model.logits(at[:-1], x[:-1]) for at, x, _ in map(ready, kept)])
        truth = np.array([languages.index(lang) for _, _, lang in kept])
        model.temperature = min(
            np.geomspace(0.05, 20, 121),
            key=lambda t: -np.log(softmax(raw / t)[np.arange(len(truth)), truth] + 1e-12).mean())
    return model


def fit(learnable: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on a table doc_id, text, lang (rows without lang or id are left out).

    The sample is the ``sample_rows`` documents whose hashed ids are lowest, fewer where
    these have more than ``SAMPLE_FEATURES`` features; ties at the last hash are all taken.
    The driver holds their sparse counts only, as bytes.
    """
    width = 1 << BITS
    learnable = learnable.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())

    def frequencies(batches):
        df, rows = np.zeros(width, np.int64), 0
        for pdf in batches:
            for text in pdf["text"]:
                df[counts(text)[0]] += 1
            rows += len(pdf)
        at = np.flatnonzero(df)
        yield pd.DataFrame({"feature": np.append(at, -1), "n": np.append(df[at], rows)})

    got = (learnable.select("text").mapInPandas(frequencies, "feature long, n long")
           .groupBy("feature").agg(F.sum("n").alias("n")).toPandas())  # at most 2^15 + 1 rows
    df = np.zeros(width + 1, np.int64)
    df[got["feature"].to_numpy(dtype=np.int64)] = got["n"].to_numpy(dtype=np.int64)
    idf = np.log((1.0 + df[-1]) / (1.0 + df[:-1])) + 1.0

    order = F.xxhash64("doc_id")
    last = (learnable.select(order.alias("h")).orderBy("h").limit(sample_rows)
            .agg(F.max("h").alias("h")).first()["h"])

    def sparse(batches):
        for pdf in batches:
            pairs = [counts(t) for t in pdf["text"]]
            yield pd.DataFrame({"h": pdf["h"], "lang": pdf["lang"], "size": [len(a) for a, _ in pairs],
                                "at": [a.astype(np.uint16).tobytes() for a, _ in pairs],
                                "n": [c.astype(np.uint32).tobytes() for _, c in pairs]})

    if last is None:
        return train([], idf)
    sample = written(learnable.select(order.alias("h"), "text", "lang").filter(F.col("h") <= last)
                     .mapInPandas(sparse, "h long, lang string, size long, at binary, n binary"), "language-sample")
    sizes = sample.groupBy("h").agg(F.sum("size").alias("size")).toPandas().sort_values("h")
    fits = sizes["h"][(sizes["size"].cumsum() <= SAMPLE_FEATURES).to_numpy() | (np.arange(len(sizes)) == 0)]
    rows = sample.filter(F.col("h") <= int(fits.max())).toPandas().sort_values(["h", "lang"], kind="stable")
    return train([(np.frombuffer(a, np.uint16), np.frombuffer(n, np.uint32), lang)
                  for a, n, lang in zip(rows["at"], rows["n"], rows["lang"])], idf)


def with_language(df: DataFrame, model: Model, text: str = "text", lang: str = "lang_pred",
                  score: str = "score") -> DataFrame:
    """``df`` plus the predicted language and its probability.

    A text that is null or has no letters gets ``und`` and 0, as does every text
    of a model without training rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)  # fixed size: 2^15 features a language

    @F.pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang", "score"])

    return (df.withColumn("__language", predict(F.col(text)))
            .withColumns({lang: F.col("__language.lang"), score: F.col("__language.score")})
            .drop("__language"))


def learnable(docs: DataFrame) -> DataFrame:
    return docs.filter(~held_out(F.col("doc_id"), FOLDS, HELD_OUT)).select("doc_id", "text", "lang")


def query(docs: DataFrame) -> DataFrame:
    """A null doc_id is never learned from and is not held out; repeated rows are
    predicted once each.  An empty table gives an empty one; texts of any length are read
    whole; columns beyond doc_id, text and lang are not read."""
    model = fit(learnable(docs))
    rows = docs.select("doc_id", held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), "text")
    return with_language(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def stage(spark, docs: DataFrame, sf_dir: str, min_score: float = 0.4) -> DataFrame:
    """Pipeline stage: keep documents whose language is told with some confidence.

    Rejected are texts without letters and those scored under ``min_score`` (the
    even share of four languages is 0.25).  Columns and values stay as they are.
    """
    rows = with_language(docs, fit(learnable(docs)), lang="__told_language", score="__told_score")
    keep = (F.col("__told_language") != UNKNOWN) & (F.col("__told_score") >= min_score)
    return rows.filter(keep).select(*docs.columns)
