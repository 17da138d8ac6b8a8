"""Toxicity: non-negative positive-unlabelled learning over hashed words (operator 8).

Confirmed toxic texts are the positives; all other training texts are unlabelled, toxic ones among them.
The risk of taking unlabelled texts as clean is corrected by the class prior; where the corrected part
becomes negative, its gradient is turned, which keeps the classifier from fitting the positives by heart.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labtables.llm import features
from labtables.llm.common import hash_sample, held_out

BITS = 18
POSITIVE_ROWS = 2_500
UNLABELLED_ROWS = 10_000
THRESHOLD = 0.3

PIECE = 1 << 18


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    bits: int


class _Rows:
    """Sparse rows of ones over renumbered buckets, with products in both directions.

    Entries are kept in pieces of whole rows, 4 bytes each. Nothing else is as long as all entries, neither
    here nor in a product, and no single array is large.
    """

    def __init__(self, rows: Iterable[np.ndarray], size: int):
        self.n, self.size, self.pieces = 0, size, []
        some, held = [], 0
        for row in rows:
            some.append(row)
            held += len(row)
            if held >= PIECE:
                self._add(some)
                some, held = [], 0
        if some:
            self._add(some)

    def _add(self, rows: list[np.ndarray]) -> None:
        self.pieces.append((self.n, np.array([len(r) for r in rows]), np.concatenate(rows)))
        self.n += len(rows)

    def times(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n)
        for first, lengths, column in self.pieces:
            row = np.repeat(np.arange(len(lengths)), lengths)
            out[first:first + len(lengths)] = np.bincount(row, w[column], len(lengths))
        return out

    def back(self, g: np.ndarray) -> np.ndarray:
        out = np.zeros(self.size)
        for first, lengths, column in self.pieces:
            out += np.bincount(column, np.repeat(g[first:first + len(lengths)], lengths), self.size)
        return out


def _texts_with(rows: Iterable[np.ndarray], size: int) -> np.ndarray:
    seen = np.zeros(size, np.int64)
    for row in rows:
        np.add.at(seen, row, 1)
    return seen


def nnpu(positive: Sequence[np.ndarray], unlabelled: Sequence[np.ndarray], size: int, prior: float,
         l1: float = 1e-3, rate: float = 0.1, epochs: int = 250, least: int = 4) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic classifier under the non-negative risk.

    risk = prior * E_p[loss(+)] + max(0, E_u[loss(-)] - prior * E_p[loss(-)]). Buckets in fewer than
    ``least`` texts stay at zero. Full gradients with rates by coordinate, and soft thresholding for ``l1``; the result is the mean of the
    last fifth of the steps, as the turned gradients make single steps swing.
    """
    if not positive or not unlabelled:
        return np.zeros(size), float(np.log(prior / (1 - prior)))
    used = np.flatnonzero(_texts_with(chain(positive, unlabelled), size) >= max(least, 1))
    number = np.full(size, -1, np.int32)
    number[used] = np.arange(len(used))
    narrow = lambda rows: _Rows((m[m >= 0] for m in (number[r] for r in rows)), len(used))
    p, u = narrow(positive), narrow(unlabelled)
    del positive, unlabelled  # the fit needs the collected bytes no more
    w, b = np.zeros(len(used)), float(np.log(prior / (1 - prior)))
    squares, square_b = np.full(len(used), 1e-8), 1e-8
    sigmoid = lambda s: 1 / (1 + np.exp(-np.clip(s, -30, 30)))
    mean_w, mean_b, kept = np.zeros(len(used)), 0.0, max(1, epochs // 5)
    for epoch in range(epochs):
        sp, su = p.times(w) + b, u.times(w) + b
        qp, qu = sigmoid(sp), sigmoid(su)
        negative = np.logaddexp(0, su).mean() - prior * np.logaddexp(0, sp).mean()
        if negative >= 0:
            gp, gu = prior * (qp - 1 - qp) / p.n, qu / u.n  # loss(+) and the corrected loss(-) together
        else:
            gp, gu = prior * qp / p.n, -qu / u.n  # back out of the negative part
        g, gb = p.back(gp) + u.back(gu), float(gp.sum() + gu.sum())
        squares += g * g
        square_b += gb * gb
        step = rate / np.sqrt(squares)
        w -= step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
        b -= rate / np.sqrt(square_b) * gb
        if epoch >= epochs - kept:
            mean_w += w / kept
            mean_b += b / kept
    out = np.zeros(size)
    out[used] = mean_w
    return out, mean_b


def class_prior(labels: DataFrame, label_col: str, default: float = 0.1) -> float:
    """Share of toxic rows among the labelled ones, kept within 0.1 and 50 percent."""
    share = labels.agg(F.avg(F.col(label_col).cast("double"))).first()[0]
    return min(max(default if share is None else share, 0.001), 0.5)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", bits: int = BITS, positive_rows: int = POSITIVE_ROWS,
          unlabelled_rows: int = UNLABELLED_ROWS, most: int = features.TRAIN_FEATURES) -> Model:
    """Fit on bounded samples of ids (smallest hashes) outside the held-out fold.

    Positives are ids confirmed as toxic; the unlabelled sample is taken from all ids with a text, its labels
    are not looked at. Rows without id teach nothing, an id with several texts teaches one of them, and
    texts of a sample are taken until they hold ``most`` features. Without positives all scores are the
    prior.
    """
    known = labels.where(~held_out(F.col(id_col)) & F.col(id_col).isNotNull())
    prior = class_prior(known, label_col)
    texts = docs.where(~held_out(F.col(id_col))).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    toxic = hash_sample(known.where(F.col(label_col) == 1).select(F.col(id_col).alias("id")).distinct(), "id",
                        positive_rows).withColumn("kind", F.lit(1))
    others = hash_sample(texts.select("id").where("id IS NOT NULL").distinct(), "id", unlabelled_rows).withColumn("kind", F.lit(0))
    # both samples have a fixed number of narrow rows, so they may be broadcast
    chosen = F.broadcast(toxic.unionByName(others))
    examples = features.collect(texts.join(chosen, "id"), features.presence, bits, "kind", most, shares=False)
    rows = [[b for b, _, kind in examples if kind == k] for k in (1, 0)]
    del examples
    weights, bias = nnpu(rows.pop(0), rows.pop(0), 1 << bits, prior)
    return Model(weights.astype(np.float32), bias, bits)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(id, score, predicted) for each row; null and empty texts get the score of the bias alone.

    One row out for each row in, whatever its id; columns besides the two named are not read.
    """
    return features.score_rows(docs, model.weights, model.bias, features.presence, model.bits, threshold, id_col, text_col)


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` with all their columns that are not predicted as toxic."""
    return features.filter_rows(docs, model.weights, model.bias, features.presence, model.bits, threshold, text_col,
                                above=False)
