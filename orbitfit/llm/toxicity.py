"""Toxicity score: a character n-gram linear classifier with naive Bayes scaled features.

A document's features are the hashed 3-, 4- and 5-byte n-grams that occur in
its lower-cased text, each present or not. A first pass over the training rows
counts in how many toxic and other documents each feature occurs (summed by
Spark); the log ratio of its two smoothed shares scales the feature. The
features with the largest likelihood ratio statistic stay, and a logistic
regression with ridge penalty is fitted to the scaled features.

The fit takes a bounded sample of labelled rows (``MAX_TRAIN``, all if there
are fewer); counts and feature lists of fixed size reach the driver. Scoring
reads whole texts.

Cases: null text counts as empty; a text without n-grams scores the bias
alone; labels other than 0 and 1 and null labels are not used; without both
kinds of label the score is the share of toxic rows (0 without any);
repeated rows get equal scores; an empty table gives an empty result; other
columns are not inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitfit.llm.base import bounded_sample

MAX_TRAIN = 6000
HASH_BITS = 18
FEATURES = 8192
STEPS = 120
RIDGE = 1e-3
PRIMES = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1)


def grams(text: str | None) -> Iterator[np.ndarray]:
    """Hashes of the 3-, 4- and 5-byte n-grams of a text, in pieces."""
    b = np.frombuffer(f" {(text or '').lower()} ".encode("utf-8", "surrogatepass"), np.uint8)
    step = 1 << 20
    for i in range(0, len(b), step):
        p = b[i:i + step + 4].astype(np.uint32)
        h = p * np.uint32(PRIMES[0])
        for n in range(1, 5):
            if len(p) <= n:
                break
            h = h[:-1] + p[n:] * np.uint32(PRIMES[n])
            if n >= 2:
                yield ((h[:step] + np.uint32(n)) * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - HASH_BITS)


def present(text: str | None, place: np.ndarray | None = None) -> np.ndarray:
    """Distinct features of a text; with ``place`` only the chosen ones, as their places."""
    parts = []
    for h in grams(text):
        if place is not None:
            h = place[h]
            h = h[h >= 0]
        parts.append(np.unique(h))
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, np.int64)


@dataclass
class Model:
    place: np.ndarray     # hash -> feature or -1
    weights: np.ndarray   # per feature, the naive Bayes scale included
    bias: float

    def score(self, text: str | None) -> float:
        z = self.bias + self.weights[present(text, self.place)].sum()
        with np.errstate(over="ignore"):
            return float(1 / (1 + np.exp(-z)))


def labelled(docs: DataFrame, labels: DataFrame, keep, id_col: str, text_col: str, label_col: str,
             max_train: int) -> DataFrame:
    """(text, y) of the training rows; the chosen labels are at most about ``max_train`` rows."""
    y = labels.select(F.col(id_col).alias("k"), F.col(label_col).cast("int").alias("y")).filter("y in (0, 1)")
    y = bounded_sample(y.filter(keep(F.col("k"))), F.col("k"), max_train)
    return docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("text")).join(F.broadcast(y), "k").select("text", "y")


def fit(rows: DataFrame) -> Model:
    """Model from (text, y) rows."""
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros((2, 1 << HASH_BITS), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for t, y in zip(batch.column(0), batch.column(1).to_pylist()):
                df[y, present(t.as_py())] += 1
                n[y] += 1
        used = np.flatnonzero(df.sum(axis=0))
        yield pa.RecordBatch.from_arrays([
            pa.array(np.append(used, -1)), pa.array(np.append(df[1, used], n[1])),
            pa.array(np.append(df[0, used], n[0]))], ["f", "toxic", "other"])

    total = rows.mapInArrow(counts, "f long, toxic long, other long").groupBy("f").sum("toxic", "other").toArrow()
    f, one, zero = (np.asarray(c) for c in total.columns)
    n1, n0 = int(one[f < 0].sum()), int(zero[f < 0].sum())
    place = np.full(1 << HASH_BITS, -1, np.int32)
    if not n1 or not n0:
        p = n1 / (n1 + n0) if n1 + n0 else 0.0
        with np.errstate(divide="ignore"):
            return Model(place, np.zeros(1), float(np.log(p) - np.log1p(-p)))
    f, one, zero = f[f >= 0], one[f >= 0], zero[f >= 0]

    def part(k, n):   # k * log(k / n), 0 at k = 0
        return k * np.log(np.where(k > 0, k, 1) / n)

    gain = (part(one, n1) + part(zero, n0) + part(n1 - one, n1) + part(n0 - zero, n0)
            - part(one + zero, n1 + n0) - part(n1 + n0 - one - zero, n1 + n0))
    top = np.lexsort((f, -gain))[:FEATURES]
    place[f[top]] = np.arange(len(top))
    ratio = np.log((one[top] + 1) / (n1 + 2)) - np.log((zero[top] + 1) / (n0 + 2))

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(1)
            x = [present(t.as_py(), place).astype(np.int16).tobytes() for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([y, pa.array(x, pa.binary())], ["y", "x"])

    got = sorted(tuple(r) for r in rows.mapInArrow(lists, "y int, x binary").collect())
    ids = [np.frombuffer(x, np.int16).astype(np.int64) for _, x in got]
    size = np.array([len(i) for i in ids])
    flat, row = np.concatenate(ids), np.repeat(np.arange(len(ids)), size)
    y = np.array([v for v, _ in got], float)
    # Accelerated gradient on the scaled features; the step from a bound of the curvature.
    w, b = np.zeros(len(top)), float(np.log(n1 / n0))
    aw, ab = w, b
    scale = ratio[flat]
    v = np.ones(len(top))
    for _ in range(8):
        m = np.bincount(row, scale * v[flat], len(ids))
        v = np.bincount(flat, scale * m[row], len(top))
        norm = np.linalg.norm(v)
        v /= norm
    rate = 4 * len(ids) / (norm + len(ids))
    for t in range(STEPS):
        z = ab + np.bincount(row, scale * aw[flat], len(ids))
        err = (1 / (1 + np.exp(-np.clip(z, -700, 700))) - y) / len(ids)
        nw = aw - rate * (np.bincount(flat, scale * err[row], len(top)) + RIDGE * aw)
        nb = ab - rate * err.sum()
        k = t / (t + 3)
        aw, ab, w, b = nw + k * (nw - w), nb + k * (nb - b), nw, nb
    return Model(place, w * ratio, float(b))


def scorer(model: Model):
    """Column function text -> score."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.score(t) for t in texts], dtype="float64")
    return score


def score_documents(docs: DataFrame, labels: DataFrame, keep, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", max_train: int = MAX_TRAIN) -> DataFrame:
    """Per row: id, score, predicted. ``keep`` says by id which labels may be learnt from."""
    model = fit(labelled(docs, labels, keep, id_col, text_col, label_col, max_train))
    scored = docs.select(F.col(id_col), scorer(model)(F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
