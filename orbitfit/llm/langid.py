"""Language ID by error-correcting output codes over byte n-grams.

Every language gets a codeword of +1/-1 bits; one logistic classifier per bit,
trained here on hashed 1- to 3-byte n-gram shares, tells the bit from a text.
Decoding adds up, per language, the logistic losses of its bits, each weighted
by how reliable its classifier was in training, and picks the language with
the smallest sum. A document is flagged ambiguous if the runner-up is nearly
as near.

Up to ten languages use the exhaustive code (every split of the languages in
two); more use random codewords of ``10 * log2(languages)`` bits, the best of
several seeded draws by smallest distance.

The fit takes a bounded sample of labelled rows (``MAX_TRAIN``, all if there
are fewer); the rows travel to the driver as fixed-size feature vectors. Scoring
reads whole texts.

Cases: null text and text without a letter are ``und`` with score 0, not
ambiguous; without any training row every document is ``und``; with one
language every other document gets it with score 1; repeated rows get equal
results; an empty table gives an empty result; other columns are not inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbitfit.llm.base import bounded_sample, fresh

MAX_TRAIN = 4000
BUCKETS = 4096
STEPS = 150
MARGIN = 0.05         # smallest loss gap to the runner-up, per bit weight, that is not ambiguous
UNKNOWN = "und"


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def features(text: str) -> np.ndarray:
    """Square roots of the hashed 1-, 2- and 3-byte n-gram shares (unit length)."""
    b = np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.zeros(BUCKETS)
    step = 1 << 20
    for i in range(0, len(b), step):
        p = b[i:i + step + 2].astype(np.uint32)
        own = min(step, len(b) - i)
        two = p[:-1] * np.uint32(0x9E3779B1) + p[1:] * np.uint32(0x85EBCA6B)
        three = two[:-1] + p[2:] * np.uint32(0xC2B2AE35)
        for h in (p * np.uint32(0x27D4EB2F), two + np.uint32(0x165667B1), three):
            counts += np.bincount(((h[:own] * np.uint32(0x2C1B3C6D)) >> np.uint32(20)), minlength=BUCKETS)
    return np.sqrt(counts / counts.sum()).astype(np.float32)


def codewords(n: int) -> np.ndarray:
    """(languages, bits) matrix of +1/-1; no two rows alike, no bit constant."""
    if n < 2:
        return np.zeros((n, 0), np.float32)
    if n <= 10:
        bits = np.arange(1, 2 ** (n - 1))
        return np.where((bits[None, :] >> np.arange(n)[:, None]) & 1, 1, -1).astype(np.float32)
    width = int(np.ceil(10 * np.log2(n)))
    rng = np.random.default_rng(7)
    draws = [rng.choice(np.float32([-1, 1]), (n, width)) for _ in range(32)]
    return max(draws, key=lambda m: ((width - m @ m.T) / 2 + 2 * width * np.eye(n)).min())


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray       # (languages, bits)
    weights: np.ndarray    # (BUCKETS, bits)
    bias: np.ndarray       # (bits)
    trust: np.ndarray      # (bits)

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language index, score and ambiguity of each feature row."""
        z = x @ self.weights + self.bias
        losses = np.stack([np.logaddexp(0, -z * row) @ self.trust for row in self.code], axis=1)
        share = np.exp(losses.min(axis=1, keepdims=True) - losses)
        best = losses.argmin(axis=1)
        two = np.sort(losses, axis=1)[:, :2]
        gap = two[:, 1] - two[:, 0] if two.shape[1] > 1 else np.full(len(x), np.inf)
        return best, (1 / share.sum(axis=1)), gap < MARGIN * self.trust.sum() / max(1, len(self.trust))


def train(x: np.ndarray, labels: list[str]) -> Model:
    """Fit one logistic classifier per bit by accelerated gradient steps."""
    languages = sorted(set(labels))
    place = {v: i for i, v in enumerate(languages)}
    code = codewords(len(languages))
    y = code[[place[v] for v in labels]] if languages else np.zeros((0, 0), np.float32)
    w, b = np.zeros((BUCKETS, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    if not code.shape[1]:
        return Model(languages, code, w, b, b)
    aw, ab = w, b
    rate, decay = np.float32(8.0), np.float32(1e-5)
    for t in range(STEPS):
        err = -y / (1 + np.exp(y * (x @ aw + ab))) / len(x)
        nw, nb = aw - rate * (x.T @ err + decay * aw), ab - rate * err.sum(axis=0)
        m = np.float32(t / (t + 3))
        aw, ab, w, b = nw + m * (nw - w), nb + m * (nb - b), nw, nb
    right = ((x @ w + b) * y > 0).mean(axis=0)
    trust = np.log((right + 1e-3) / (1 - right + 1e-3)).clip(0.1).astype(np.float32)
    return Model(languages, code, w, b, trust / trust.max())


def fit(rows: DataFrame, key: Column, text_col: str, lang_col: str, max_train: int = MAX_TRAIN) -> Model:
    """Model from the rows with a language and a text that has a letter."""
    known = rows.select(key.alias("k"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    known = known.filter("lang is not null and text is not null")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                got = [(v, features(t).astype(np.float16).tobytes())
                       for t, v in zip(part.column(0).to_pylist(), part.column(1).to_pylist()) if has_letter(t)]
                yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.string()),
                                                  pa.array([g[1] for g in got], pa.binary())], ["lang", "x"])

    sample = bounded_sample(known, F.col("k"), max_train).select("text", "lang")
    got = sorted(tuple(r) for r in sample.mapInArrow(vectors, "lang string, x binary").collect())
    x = np.array([np.frombuffer(r[1], np.float16) for r in got], np.float32).reshape(len(got), BUCKETS)
    return train(x, [r[0] for r in got])


def predictor(model: Model):
    """Column function text -> struct(lang_pred, score, ambiguous)."""
    names = np.array([*model.languages, UNKNOWN], object)

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            n = len(texts)
            best, score, unsure = np.full(n, len(names) - 1), np.zeros(n), np.zeros(n, bool)
            rows = [i for i, t in enumerate(texts) if model.languages and has_letter(t)]
            for i in range(0, len(rows), 256):
                part = rows[i:i + 256]
                x = np.stack([features(texts.iloc[j]) for j in part])
                best[part], score[part], unsure[part] = model.decode(x)
            yield pd.DataFrame({"lang_pred": names[best], "score": score, "ambiguous": unsure})
    return predict


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> Column:
    return predictor(model)(F.col(text_col))


def keep_identified(docs: DataFrame, train_on: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang") -> DataFrame:
    """The documents with a recognised language, all columns kept.

    Rejected are texts without a letter (or null) and ambiguous ones.
    """
    model = fit(train_on, F.col(id_col), text_col, lang_col)
    (found,) = fresh(docs, "__lang")
    marked = docs.withColumn(found, identify(docs, model, text_col))
    return (marked.filter((F.col(found)["lang_pred"] != UNKNOWN) & ~F.col(found)["ambiguous"])
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
