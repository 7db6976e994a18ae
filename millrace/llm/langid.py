r"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of hashed character 1- to 3-grams of the whole
lower-cased text.  Document frequencies and class counts cover every training row
of the table.  The weights are fitted on a bounded sample of these rows (at most
about ``max_rows``, shared equally by the languages and chosen by a hash of the
id) by follow-the-regularised-leader with L1 and L2 penalties; a fifth of the
sample is kept apart to calibrate the temperature of the softmax.

Training rows are those with a non-null language whose id does not fall into the
held-out fold; prediction sees nothing but the text.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; with
no training row every text is ``und``; with one language all texts with letters
get it; rows that repeat an id are rows of their own; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold

#: Hashed features; bounds the model, the frequencies and what a task keeps.
DIMENSION = 1 << 15
MAX_ROWS = 6000
_LETTER = regex.compile(r"\p{L}")


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a text and how often each occurs."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    # Signs and digits of ASCII say nothing of the language; they part words like a space.
    c = np.where((c < 0x61) | ((c > 0x7A) & (c < 0xAA)), np.uint32(0x20), c)
    one = c * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ np.uint32(0x5BD1E995)) * np.uint32(0x85EBCA6B) + c[1:] * np.uint32(0xC2B2AE35)
    three = (two[:-1] ^ np.uint32(0x27D4EB2F)) * np.uint32(0x165667B1) + c[2:] * np.uint32(0x9E3779B1)
    grams = np.concatenate([one * np.uint32(0x7FEB352D), two, three])
    grams = ((grams ^ (grams >> np.uint32(15))) * np.uint32(0x846CA68B)) >> np.uint32(32 - 15)
    if len(grams) < 2000:
        return np.unique(grams, return_counts=True)
    counts = np.bincount(grams, minlength=DIMENSION)
    ids = np.flatnonzero(counts)
    return ids, counts[ids]


def _weigh(ids: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1.0 + np.log(counts)) * idf[ids]
    norm = np.sqrt((x * x).sum())
    return x / norm if norm else x


@dataclass
class Model:
    """Languages, inverse document frequencies, weights (one row per language) and temperature."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not _LETTER.search(text):
            return "und", 0.0
        ids, counts = gram_counts(text)
        logits = (self.weights[:, ids] @ _weigh(ids, counts, self.idf) + self.bias) / self.temperature
        p = np.exp(logits - logits.max())
        best = int(p.argmax())
        return self.languages[best], float(p[best] / p.sum())


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(
    rows: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    n_classes: int,
    epochs: int = 3,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.5,
) -> tuple[np.ndarray, np.ndarray]:
    """Per-coordinate FTRL-proximal with elastic net; the bias is not penalised."""
    z, n = np.zeros((n_classes, DIMENSION)), np.zeros((n_classes, DIMENSION))
    bias, bias_n = np.zeros(n_classes), np.zeros(n_classes)

    def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            ids, x = rows[i]
            zi, ni = z[:, ids], n[:, ids]
            w = weights(zi, ni)
            error = _softmax(w @ x + bias)
            error[labels[i]] -= 1.0
            g = error[:, None] * x[None, :]
            grown = ni + g * g
            z[:, ids] = zi + g - (np.sqrt(grown) - np.sqrt(ni)) / alpha * w
            n[:, ids] = grown
            bias_n += error * error
            bias -= alpha * error / (beta + np.sqrt(bias_n))
    return weights(z, n), bias


def _temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the smallest negative log likelihood on rows kept apart."""
    if not len(labels):
        return 1.0
    at = np.arange(len(labels))
    loss = lambda t: -np.log(_softmax(logits / t)[at, labels] + 1e-300).sum()
    return float(min(np.geomspace(0.05, 10.0, 120), key=loss))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", modulus: int = 5, max_rows: int = MAX_ROWS) -> Model:
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (fold(id_col, modulus) != 0)).select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    per_lang = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(per_lang)
    if not languages:
        return Model([], np.zeros(0), np.zeros((0, 0)), np.zeros(0), 1.0)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(DIMENSION, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                seen[gram_counts(text.as_py())[0]] += 1
        ids = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), pa.array(seen[ids])], names=["id", "df"])

    df = np.zeros(DIMENSION)
    for r in rows.select("text").mapInArrow(frequencies, "id int, df bigint").groupBy("id").agg(F.sum("df").alias("df")).collect():
        df[r["id"]] = r["df"]
    idf = np.log((1.0 + sum(per_lang.values())) / (1.0 + df)) + 1.0

    share = max_rows / len(languages)
    chance = F.create_map(*[x for lang in languages for x in (F.lit(lang), F.lit(min(1.0, share / per_lang[lang])))])
    drawn = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("langid")), F.lit(1 << 20)) < F.element_at(chance, F.col("lang")) * (1 << 20)
    sample = rows.filter(drawn).withColumn("_all", F.lit(0))

    def fit(sample: pd.DataFrame) -> pd.DataFrame:
        sample = sample.sort_values(["doc_id", "text"], kind="stable", na_position="last")
        grams = [gram_counts(t) for t in sample["text"]]
        x = [(ids, _weigh(ids, counts, idf)) for ids, counts in grams]
        y = sample["lang"].map({lang: i for i, lang in enumerate(languages)}).to_numpy()
        apart = np.arange(len(x)) % 5 == 4
        w, b = fit_ftrl([v for v, a in zip(x, apart) if not a], y[~apart], len(languages))
        logits = np.array([w[:, ids] @ v + b for (ids, v), a in zip(x, apart) if a]).reshape(-1, len(languages))
        return pd.DataFrame({"class": range(len(languages)), "weights": [r.tolist() for r in w], "bias": b, "t": _temperature(logits, y[apart])})

    fitted = sorted(sample.groupBy("_all").applyInPandas(fit, "class int, weights array<double>, bias double, t double").collect())
    if not fitted:
        return Model([], np.zeros(0), np.zeros((0, 0)), np.zeros(0), 1.0)
    return Model(languages, idf, np.array([r["weights"] for r in fitted]), np.array([r["bias"] for r in fitted]), fitted[0]["t"])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", modulus: int = 5) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row; the model's size is languages x DIMENSION."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), (fold(id_col, modulus) == 0).alias("held_out"), F.col(text_col).cast("string")).mapInArrow(
        run, f"doc_id {id_type}, held_out boolean, lang_pred string, score double"
    )


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = MAX_ROWS) -> DataFrame:
    return identify(docs, train(docs, id_col, text_col, lang_col, max_rows=max_rows), id_col, text_col)
