"""Toxicity: a linear classifier over character n-grams whose features are scaled by naive Bayes log-count ratios.

Features are the n-grams of 3 to 6 characters of a lower-cased text with single spaces around its words, hashed to
2 ** BITS bins; a feature counts once per text.  On a bounded sample of labelled texts the log-count ratio r of every bin
is taken from smoothed class counts; the bins that tell most (largest likelihood ratio statistic) become the features,
each with the value r where present, and a logistic regression with an L2 penalty, both classes weighing the same, is
fitted to them.

``SAMPLE_ROWS`` bounds the labelled texts: where there are more, a hash of the id chooses about so many.  What reaches
the driver is one count per bin and the chosen features of the sample.  Scoring is a map over all rows.

Defined cases: null and empty texts get the score of a text without features; equal ids and repeated rows are scored row
by row; a null id passes through and is never learned from; null labels are not used, and of several labels for one id the
highest counts; without labels of both classes every score is the smoothed share of class 1.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import chars
from tidemark.llm.common import bound_batches, stored

LENGTHS = (3, 4, 5, 6)
BITS = 20
FEATURES = 1 << 13
SAMPLE_ROWS = 20_000
SMOOTHING = 0.5
PENALTY = 1e-3
ROUNDS = 300


@dataclass
class Model:
    slot: np.ndarray  # feature number of each bin, or -1
    weight: np.ndarray
    bias: float


def bins(text: str | None) -> np.ndarray:
    """The bins of all n-grams of a text, repeats included."""
    padded = " " + " ".join((text or "").lower().split()) + " "
    folded = chars.fold(chars.code_points(padded))
    salted = [chars.slots(chars.grams(folded, n) + (np.uint64(n) << np.uint64(56)), BITS) for n in LENGTHS]
    return np.concatenate(salted)


def held_out(id_: Column, parts: int = 5) -> Column:
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % parts == 0


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int) -> DataFrame:
    wanted = (
        labels.select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("y"))
        .filter(F.col("i").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("i")))
        .groupBy("i")
        .agg(F.max("y").alias("y"))
    )
    share = min(1.0, rows / max(1, wanted.count()))
    if share < 1:
        wanted = wanted.filter(F.pmod(F.xxhash64("i"), F.lit(1 << 30)) < int(share * (1 << 30)))
    texts = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("text"))
    # About ``rows`` ids at most, which is a bound of a few hundred kilobytes.
    return stored(texts.join(F.broadcast(wanted), "i").select("text", "y"), "labelled")


def _class_counts(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Texts of each class, and per class and bin the texts that have it."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts, having = np.zeros(2, np.int64), np.zeros((2, 1 << BITS), np.int32)
        for batch in batches:
            for text, y in zip(batch["text"], batch["y"]):
                texts[int(y > 0)] += 1
                having[int(y > 0), np.unique(bins(text))] += 1
        if texts.sum():
            yield pd.DataFrame({"texts": [texts.tobytes()], "having": [having.tobytes()]})

    texts, having = np.zeros(2, np.int64), np.zeros((2, 1 << BITS), np.int64)
    parts = sample.coalesce(8).mapInPandas(count, "texts binary, having binary")
    for row in parts.toLocalIterator():  # eight rows of fixed size
        texts += np.frombuffer(row.texts, np.int64)
        having += np.frombuffer(row.having, np.int32).reshape(2, -1)
    return texts, having


def _choose(texts: np.ndarray, having: np.ndarray, features: int) -> tuple[np.ndarray, np.ndarray]:
    """Bins that tell most about the class, and the log-count ratios of all bins."""
    smooth = having + SMOOTHING
    ratio = np.log(smooth[1] / smooth[1].sum()) - np.log(smooth[0] / smooth[0].sum())
    share = texts[1] / texts.sum()
    seen = having.sum(0)
    part = np.clip(having[1] / np.maximum(seen, 1), 1e-9, 1 - 1e-9)
    gain = having[1] * np.log(part / share) + having[0] * np.log((1 - part) / (1 - share))
    gain[seen < 3] = 0
    order = np.argsort(-gain, kind="stable")[:features]
    return np.sort(order[gain[order] > 2.0]), ratio


def _fit(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on 0/1 features times ``scale``, by accelerated gradient descent with an L2 penalty."""
    index = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    value, n = scale[index], len(rows)
    bound = np.bincount(doc, value * value, n).max(initial=1.0) / 4 + 1.0
    part = np.where(y > 0, 0.5 / max(1.0, y.sum()), 0.5 / max(1.0, n - y.sum()))  # both classes weigh the same
    w, b = np.zeros(len(scale)), 0.0
    v, c, t = w.copy(), b, 1.0
    size = 16.0 / bound  # far beyond the safe step; halved below whenever the loss grows
    last = np.inf
    for _ in range(ROUNDS):
        z = np.bincount(doc, value * v[index], n) + c
        loss = part @ (np.logaddexp(0, z) - y * z) + PENALTY * (v @ v) / 2
        if loss > last:
            size, t, v, c = size / 2, 1.0, w.copy(), b
            last = np.inf
            continue
        last = loss
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * part
        gradient = np.bincount(index, value * error[doc], len(scale)) + PENALTY * v
        w_next, b_next = v - size * gradient, c - size * error.sum()
        t_next = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, c = w_next + (t - 1) / t_next * (w_next - w), b_next + (t - 1) / t_next * (b_next - b)
        w, b, t = w_next, b_next, t_next
    return w, b


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    rows: int = SAMPLE_ROWS, features: int = FEATURES,
) -> Model:
    bound_batches(docs.sparkSession)
    sample = _sample(docs, labels, id_col, text_col, label_col, rows)
    texts, having = _class_counts(sample)
    slot = np.full(1 << BITS, -1, np.int32)
    if not texts.all():
        share = (texts[1] + 1) / (texts.sum() + 2)
        return Model(slot, np.zeros(0), math.log(share / (1 - share)))
    chosen, ratio = _choose(texts, having, features)
    slot[chosen] = np.arange(len(chosen))
    shared = docs.sparkSession.sparkContext.broadcast(slot)

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = shared.value
        for batch in batches:
            found = [np.unique(table[bins(t)]) for t in batch["text"]]
            yield pd.DataFrame({"f": [f[f >= 0].astype(np.int32).tobytes() for f in found], "y": batch["y"]})

    got = sample.mapInPandas(project, "f binary, y int").collect()  # at most ``features`` numbers for each sampled text
    y = np.array([row.y > 0 for row in got], float)
    weight, bias = _fit([np.frombuffer(row.f, np.int32) for row in got], y, ratio[chosen])
    return Model(slot, weight * ratio[chosen], bias)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        m = shared.value
        out = []
        for text in texts:
            found = m.slot[bins(text)]
            found = np.unique(found[found >= 0])
            out.append(1 / (1 + math.exp(-min(max(m.bias + float(m.weight[found].sum()), -700.0), 700.0))))
        return pd.Series(out, dtype="float64")

    scored = docs.select(
        F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), probability(F.col(text_col)).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
