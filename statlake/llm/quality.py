"""Quality classifier from positive and unlabelled documents.

Positives are labelled good documents, the unlabelled ones are all documents. With the
logistic loss the risk of the negatives is the unlabelled risk less the positives'
share of it, by the class prior; a model that drives it below zero overfits, so it
counts as zero at least and no step is taken that brings it below (the non-negative
estimator). The prior is the share of good documents among the labelled rows that may
be learned from.

A document is a short vector of shares (kinds of characters, repeated words and lines,
lengths of words) with two bends each. Means and spreads, and every gradient, are sums
over all documents, one row a task; only such sums reach the driver.

Defined results: null texts are empty, and empty texts score like any other; labels
other than 0 and 1 are ignored, of several labels of an id the least counts; rows with a
null id are scored and counted as unlabelled; without positives all scores are the
prior, without labels one half; repeated rows stay; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm.decontamination import AT_ONCE, tokens
from statlake.llm.toxicity import held_out
from statlake.session import materialise

PASSES, RIDGE = 24, 5.0

_KINDS = ["upper", "lower", "digit", "space", "line", "bang", "pipe", "sign", "stop", "other", "wide"]
_KIND = np.full(256, 9, dtype=np.int64)
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[128:] = 0, 1, 2, 10
for _number, _chars in ((3, b" \t"), (4, b"\n\r\x0b\x0c"), (5, b"!?"), (6, b"|"), (7, b"#$%&*@^~=+<>{}[]\\/_"), (8, b".,;:'\"()-")):
    _KIND[list(_chars)] = _number
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def _per_text(values: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(text, weights=values, minlength=n)


def _distinct(values: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Number of different values of each text."""
    order = np.lexsort((values, text))
    v, t = values[order], text[order]
    new = np.ones(len(v), dtype=bool)
    new[1:] = (v[1:] != v[:-1]) | (t[1:] != t[:-1])
    return np.bincount(t[new], minlength=n)


def shares(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of shares for each text."""
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    size = np.maximum(np.diff(offsets), 1).astype(float)
    kinds = np.bincount(owner * len(_KINDS) + _KIND[data], minlength=n * len(_KINDS)).reshape(n, len(_KINDS))
    starts, ends, words, text = tokens(_FOLD[data], offsets)
    count = np.maximum(np.bincount(text, minlength=n), 1).astype(float)
    long = (ends - starts).astype(float)
    same = np.zeros(len(words))
    if len(words) > 1:
        same[1:] = (words[1:] == words[:-1]) & (text[1:] == text[:-1])
    shout = np.zeros(len(words))
    if len(words):
        capital = np.concatenate([[0], np.cumsum((data >= 65) & (data < 91))])
        shout = (capital[ends] - capital[starts] >= 2).astype(float)
    pair = words[1:] * np.uint64(0x9E3779B97F4A7C15) + words[:-1]
    paired = text[1:] == text[:-1]
    pairs, pair_text = pair[paired], text[1:][paired]
    columns = [kinds[:, k] / size for k in range(len(_KINDS)) if _KINDS[k] != "lower"]
    columns += [
        _per_text(same, text, n) / count, _per_text(shout, text, n) / count,
        1 - _distinct(words, text, n) / count, 1 - _distinct(pairs, pair_text, n) / np.maximum(np.bincount(pair_text, minlength=n), 1),
        _per_text(long, text, n) / count / 20, _per_text((long > 15).astype(float), text, n) / count, _per_text((long == 1).astype(float), text, n) / count,
        np.minimum(np.log1p(count) / 10, 1), 1 / count,
    ]
    return np.stack(columns, axis=1)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Constant one, shares, their roots, and a bend that is steep near zero."""
    x = np.clip(shares(data, offsets), 0, 1)
    return np.concatenate([np.ones((len(x), 1)), x, np.sqrt(x), x / (x + 0.02)], axis=1)


def feature_rows(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, f array<double>`` of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1).cast(pa.large_string()).fill_null("")
            raw = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
            ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
            at = 0
            while at < len(column):
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + AT_ONCE, side="right")) - 1)
                x = features(raw[ends[at]:ends[to]], ends[at:to + 1] - ends[at])
                values = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), values], names=["doc_id", "f"])
                at = to

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, f array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _sums(rows: DataFrame, of) -> np.ndarray | None:
    """Adds up ``of(features, positive)``, a vector a batch; one row a task reaches the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of(_matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False).astype(bool))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["sums"])

    parts = rows.select("f", "positive").mapInArrow(run, "sums array<double>").collect()
    return np.sum([p["sums"] for p in parts], axis=0) if parts else None


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(((x - self.mean) / self.scale) @ self.weights)


def fit(rows: DataFrame, prior: float, passes: int = PASSES, ridge: float = RIDGE) -> Model | None:
    """Newton steps on the risk of ``rows`` (``f, positive``), none of which takes the negatives' risk below zero.

    A step that would, or that does not lower the risk, is halved; so the fit ends at the
    least risk or where the negatives' risk is used up. The ridge is that of a prior on
    the weights: its share falls as positives grow. None if there are no rows or no positives.
    """
    moments = _sums(rows, lambda x, p: np.concatenate([[len(x), p.sum()], x.sum(axis=0), (x * x).sum(axis=0)]))
    if moments is None or moments[1] == 0:
        return None
    n, positives = moments[:2]
    d = (len(moments) - 2) // 2
    mean = moments[2:2 + d] / n
    scale = np.sqrt(np.maximum(moments[2 + d:] / n - mean ** 2, 0))
    scale[scale < 1e-9] = 1.0
    mean[0], scale[0] = 0.0, 1.0                          # the constant
    penalty = np.full(d, ridge / positives)
    penalty[0] = 0.0

    def risks(w: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray]:
        """Risk of the negatives, whole risk, its gradient and curvature."""
        def sums(x, p):
            x = (x - mean) / scale
            z = x @ w
            s = _sigmoid(z)
            return np.concatenate([[np.logaddexp(0, z).sum(), np.logaddexp(0, z[p]).sum(), np.logaddexp(0, -z[p]).sum()],
                                   s @ x, x[p].sum(axis=0), ((x * (s * (1 - s))[:, None]).T @ x).ravel()])

        total = _sums(rows, sums)
        negative = total[0] / n - prior * total[1] / positives
        risk = prior * total[2] / positives + max(negative, 0.0) + 0.5 * (penalty * w * w).sum()
        gradient = total[3:3 + d] / n - prior * total[3 + d:3 + 2 * d] / positives + penalty * w
        return negative, risk, gradient, total[3 + 2 * d:].reshape(d, d) / n + np.diag(penalty + 1e-9)

    w = np.zeros(d)
    w[0] = np.log(prior / (1 - prior))
    _, risk, gradient, curve = risks(w)
    share = 1.0
    for _ in range(passes):
        step = np.linalg.solve(curve, gradient)
        longest = np.abs(step).max()
        if longest * share < 1e-3:
            break
        tried = w - share * step * min(1.0, 2.0 / longest)
        negative, new_risk, new_gradient, new_curve = risks(tried)
        if negative < 0 or new_risk > risk:
            share /= 2
        else:
            w, risk, gradient, curve, share = tried, new_risk, new_gradient, new_curve, min(1.0, share * 2)
    return Model(mean, scale, w)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row."""
    out = F.col("doc_id")
    known = (labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").filter(~held_out(out, 4, 2))
             .groupBy(out.cast("long").alias("l_id")).agg(F.min("quality").alias("quality")))
    good, labelled = known.agg(F.coalesce(F.sum("quality"), F.lit(0)), F.count("*")).first()
    prior = min(max(good / labelled, 0.01), 0.99) if labelled else 0.5
    positive = known.filter("quality = 1").select("l_id", F.lit(True).alias("good"))
    rows = materialise(
        feature_rows(docs).join(positive, F.col("doc_id") == F.col("l_id"), "left")
        .select("doc_id", "f", F.coalesce("good", F.lit(False)).alias("positive")), "quality-features")
    model = fit(rows, prior)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(_matrix(batch.column(1))) if model is not None and batch.num_rows else np.full(batch.num_rows, prior)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = rows.select("doc_id", "f").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(out, 4, 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
