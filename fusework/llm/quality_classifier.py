"""Regularised quadratic discriminant over transformed document statistics.

Each text becomes a dozen statistics, transformed by logarithms and kept as fixed-point numbers, so
that sums over any number of documents are exact and do not depend on their order. The classes' means
and covariances come from one aggregate. Covariances are shrunk towards the pooled diagonal, factored
once, and the inverse Cholesky factors travel to the tasks: a score is the difference of two
Mahalanobis log densities, passed through the logistic function.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fusework.llm.textbatch import SPACES, bounded_batches, pieces, send, span_hashes, word_spans

SCALE = 1024
SHRINKAGE = 0.15
PRIOR = 30.0
NAMES = (
    "words", "word_length", "upper", "symbols", "digits", "distinct", "neighbours", "short_words", "stops",
    "line_length", "repeated_lines", "sentence",
)


def _table(*spans: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, np.int64)
    for a, b in spans:
        out[a : b + 1] = 1
    return out


UPPER, DIGIT = _table((65, 90)), _table((48, 57))
LETTER = _table((65, 90), (97, 122), (128, 255))
STOP = _table((33, 33), (46, 46), (63, 63))
SYMBOL = _table((33, 47), (58, 64), (91, 96), (123, 126)) * (1 - STOP) * (1 - _table((44, 44)))


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, statistics) of a piece as integers, 1 / SCALE each."""
    n = len(offsets) - 1

    def count(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(table[data])])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    size = np.diff(offsets)
    starts, ends, rows = word_spans(data, offsets)
    words = np.bincount(rows, minlength=n)
    hashes = span_hashes(data, starts, ends)
    inside = np.bincount(rows, ends - starts, n)
    short = np.bincount(rows, ends - starts <= 3, n)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    neighbours = np.bincount(rows, same, n)
    distinct = _distinct(hashes, rows, n)
    breaks = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate([offsets[:-1][size > 0], breaks + 1]))
    line_start = line_start[line_start < len(data)]
    line_row = np.searchsorted(offsets, line_start, "right") - 1
    line_end = np.concatenate([line_start[1:], [len(data)]])
    line_end = np.minimum(line_end, offsets[line_row + 1])
    filled = np.concatenate([[0], np.cumsum(~SPACES[data])])
    full = filled[line_end] > filled[line_start]
    line_start, line_end, line_row = line_start[full], line_end[full], line_row[full]
    line_end = line_end - ((line_end > line_start) & (data[np.maximum(line_end - 1, 0)] == 10))
    lines = np.bincount(line_row, minlength=n)
    repeated = lines - _distinct(span_hashes(data, line_start, line_end), line_row, n)
    letters, stops = count(LETTER), count(STOP)

    def share(part, whole, usual):
        # short texts count as if PRIOR units with the usual share came before them
        return np.log((part + PRIOR * usual) / (whole + PRIOR))

    columns = [
        np.log(words + PRIOR), np.log((inside + 5 * PRIOR) / (words + PRIOR)), share(count(UPPER), letters, 0.03),
        share(count(SYMBOL), size, 0.01), share(count(DIGIT), size, 0.01), share(distinct, words, 0.8), share(neighbours, words, 0.01),
        share(short, words, 0.4), share(stops, words, 0.1), np.log((words + 3 * PRIOR) / (lines + 0.1 * PRIOR)), share(repeated, lines, 0.05),
        np.log((words + PRIOR) / (stops + 0.1 * PRIOR)),
    ]
    return np.rint(np.stack(columns, 1) * SCALE).astype(np.int64)


def _distinct(hashes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((hashes, rows))
    h, r = hashes[order], rows[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return np.bincount(r[new], minlength=n)


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, x (array<bigint>) of every row of ``docs``; a NULL text counts as an empty one."""
    bounded_batches(docs.sparkSession)
    key = docs.schema["doc_id"].dataType.simpleString()

    def work(batches):
        for rows, data, offsets in pieces(batches):
            x = statistics(data, offsets)
            values = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), values], ["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {key}, x array<bigint>")


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors and log weights of class 0 and 1; ``prior`` alone if a class is missing."""

    means: np.ndarray
    factors: np.ndarray
    offsets: np.ndarray
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for rows of fixed-point statistics."""
        if not len(self.means):
            return np.full(len(x), self.prior)
        density = []
        for mean, factor, offset in zip(self.means, self.factors, self.offsets):
            z = (x / SCALE - mean) @ factor.T
            density.append(offset - 0.5 * (z * z).sum(1))
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0], -500, 500)))


def fit_discriminant(rows: DataFrame, shrinkage: float = SHRINKAGE) -> Discriminant:
    """Fits on all of ``rows`` (x, label 0 or 1; other and NULL labels teach nothing).

    One aggregate gives exact sums and sums of products, one row per class, to the driver.
    """
    d = len(NAMES)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    x = [F.get("x", i) for i in range(d)]
    exact = "decimal(20,0)"  # its sum has 30 digits
    sums = [F.sum(x[i].cast(exact)).alias(f"s{i}") for i in range(d)]
    sums += [F.sum((x[i] * x[j]).cast(exact)).alias(f"p{i}_{j}") for i, j in pairs]
    found = {r["label"]: r for r in rows.where("label IN (0, 1)").groupBy("label").agg(F.count(F.lit(1)).alias("n"), *sums).collect()}
    total = sum(r["n"] for r in found.values())
    if any(k not in found or found[k]["n"] < 2 for k in (0, 1)):
        prior = found[1]["n"] / total if 1 in found else 0.0 if total else 0.5
        return Discriminant(np.zeros((0, d)), np.zeros((0, d, d)), np.zeros(0), prior)
    means, covariances, weights = [], [], []
    for k in (0, 1):
        r = found[k]
        n = r["n"]
        mean = np.array([int(r[f"s{i}"]) / n for i in range(d)])
        cov = np.zeros((d, d))
        for i, j in pairs:
            cov[i, j] = cov[j, i] = (int(r[f"p{i}_{j}"]) * n - int(r[f"s{i}"]) * int(r[f"s{j}"])) / (n * n)
        means.append(mean / SCALE)
        covariances.append(cov / SCALE**2)
        weights.append(n / total)
    pooled = np.diag(np.diag(sum(w * c for w, c in zip(weights, covariances)))) + 1e-4 * np.eye(d)
    factors, offsets = [], []
    for cov, weight in zip(covariances, weights):
        lower = np.linalg.cholesky((1 - shrinkage) * cov + shrinkage * pooled)
        factors.append(np.linalg.inv(lower))
        offsets.append(np.log(weight) - np.log(np.diag(lower)).sum())
    return Discriminant(np.array(means), np.array(factors), np.array(offsets), weights[1])


def score_documents(rows: DataFrame, model: Discriminant) -> DataFrame:
    """Adds score (double) and predicted (int) to ``rows``, which has ``x``."""
    receive = send(rows.sparkSession, model)
    schema = rows.select("*", F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema

    def work(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(NAMES))
            score = receive().scores(x)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score), pa.array((score >= 0.5).astype(np.int32))], [*batch.schema.names, "score", "predicted"]
            )

    return rows.mapInArrow(work, schema)
