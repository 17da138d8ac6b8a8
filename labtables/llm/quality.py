"""Quality classifier: hashed word n-grams, logistic regression by FTRL, sparse dot products (operator 1)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labtables.llm import features
from labtables.llm.common import hash_sample, held_out

BITS = 18
TRAIN_ROWS = 4_000
THRESHOLD = 0.7


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    bits: int


def ftrl(examples: Sequence[tuple], size: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02,
         l2: float = 0.1, epochs: int = 3) -> tuple[np.ndarray, float]:
    """Weights and bias by follow-the-regularised-leader, each coordinate with its own rate.

    ``z`` and ``n`` are the sums of adjusted gradients and of squared gradients; a weight is computed
    from them when an example needs it and is zero while ``z`` stays within ``l1``.
    """
    z, n = np.zeros(size + 1), np.zeros(size + 1)  # the last coordinate is the bias

    def weights(at):
        shrunk = z[at] - np.sign(z[at]) * l1
        return np.where(np.abs(z[at]) <= l1, 0.0, -shrunk / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for buckets, values, label in examples:
            at, x = np.append(buckets, size), np.append(values, 1.0)
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - label) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(slice(None))
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", bits: int = BITS, rows: int = TRAIN_ROWS,
          most: int = features.TRAIN_FEATURES) -> Model:
    """Fit on at most ``rows`` labelled ids (smallest hash of the id) outside the held-out fold.

    Rows without id or label teach nothing. An id with several labels has the smallest, one with several
    texts teaches one of them. Texts of a label are taken until they hold ``most`` features. Without any
    labelled row all scores are 0.5.
    """
    known = labels.where(~held_out(F.col(id_col)) & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    labelled = known.groupBy(F.col(id_col).alias("id")).agg(F.min(F.col(label_col).cast("int")).alias("label_of_id"))
    chosen = hash_sample(labelled, "id", rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # the sample has a fixed number of narrow rows, so it may be broadcast whatever the size of the tables
    examples = features.collect(texts.join(F.broadcast(chosen), "id"), features.ngrams, bits, "label_of_id", most)
    weights, bias = ftrl(examples, 1 << bits)
    return Model(weights.astype(np.float32), bias, bits)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(id, score, predicted) for each row; null and empty texts get the score of the bias alone.

    One row out for each row in, whatever its id; columns besides the two named are not read.
    """
    return features.score_rows(docs, model.weights, model.bias, features.ngrams, model.bits, threshold, id_col, text_col)


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` with all their columns that are predicted as good."""
    return features.filter_rows(docs, model.weights, model.bias, features.ngrams, model.bits, threshold, text_col,
                                above=True)
