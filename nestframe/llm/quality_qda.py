"""Quality by regularised quadratic discriminant analysis of document statistics.

A document becomes about twenty numbers: lengths, shares of kinds of characters, repetition of words, runs of words
and lines, transformed to be nearer to normal (logarithms of sizes, logits of shares) and standardised. Each class has
a mean and a covariance, drawn towards the pooled covariance and towards its diagonal. The score is the probability
that the difference of the two log densities gives. Mahalanobis distances use the inverse Cholesky factors, which are
worked out once when the model is fitted.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestframe.llm.bytesets import Hasher, batched, buffer_of, mix, word_bounds
from nestframe.llm.labelled import held_out, teaching_rows

_KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "symbol": b"#*$%&|<>~^=+@{}[]\\_/",
    "stop": b".,;:",
    "loud": b"!?",
    "bar": b"|",
}
_LETTER = np.zeros(256, bool)
_LETTER[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True
_LETTER[128:] = True
_LINE_END = np.zeros(256, bool)
_LINE_END[ord("\n")] = True


def statistics(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A row of transformed statistics per text; a text without words has those of nothing."""
    count = len(starts)
    begin, stop, row = word_bounds(data, starts, ends)
    words = np.bincount(row, minlength=count).astype(float)
    per = np.maximum(words, 1)
    length = (stop - begin).astype(float)
    chars = np.bincount(row, length, count)
    mean = chars / per
    spread = np.sqrt(np.maximum(np.bincount(row, length**2, count) / per - mean**2, 0))

    def share(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags)))
        return _logit((sums[ends] - sums[starts]) / np.maximum(chars, 1), chars)

    kinds = []
    for members in _KINDS.values():
        table = np.zeros(256, np.int32)
        table[list(members)] = 1
        kinds.append(share(table[data]))
    kinds.append(share((~_LETTER[data]).astype(np.int32)))
    of_words = lambda flags: _logit(np.bincount(row, flags, count) / per, words)

    hasher = Hasher(data) if len(begin) else None
    hashes = hasher(begin, stop) if len(begin) else np.zeros(0, np.uint64)
    pair, pair_row = _runs(hashes, row, 2)
    five, five_row = _runs(hashes, row, 5)

    def repeated(value: np.ndarray, at: np.ndarray) -> np.ndarray:
        of = np.bincount(at, minlength=count)
        return _logit(_repeats(value, at, count) / np.maximum(of, 1), of)

    line_begin, line_stop, line_row = word_bounds(data, starts, ends, _LINE_END)
    lines = np.bincount(line_row, minlength=count).astype(float)
    line_hash = hasher(line_begin, line_stop) if hasher else np.zeros(len(line_row), np.uint64)
    ending = np.isin(data[line_stop - 1], list(b".!?\"'")) if len(line_stop) else np.zeros(0)
    columns = [
        np.log1p(words),
        np.log1p(mean),
        np.log1p(spread),
        *kinds,
        of_words(length <= 3),
        of_words(length >= 12),
        repeated(hashes, row),
        repeated(pair, pair_row),
        repeated(five, five_row),
        np.log1p(lines),
        np.log1p(words / np.maximum(lines, 1)),
        repeated(line_hash, line_row),
        _logit(np.bincount(line_row, ending, count) / np.maximum(lines, 1), lines),
    ]
    return np.stack(columns, axis=1)


def _logit(share: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The logit of a share, drawn in by half a case so that none and all stay finite."""
    share = (np.clip(share, 0, 1) * of + 0.5) / (of + 1)
    return np.log(share / (1 - share))


def _repeats(value: np.ndarray, row: np.ndarray, count: int) -> np.ndarray:
    """For each of ``count`` rows, how many of its values it has had before; values are compared by 44 bits."""
    joined = (row.astype(np.uint64) << np.uint64(44)) | (value >> np.uint64(20))
    joined.sort()
    again = joined[1:][joined[1:] == joined[:-1]] >> np.uint64(44)
    return np.bincount(again.astype(np.int64), minlength=count).astype(float)


def _runs(hashes: np.ndarray, row: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words within a row."""
    if len(hashes) < width:
        return hashes[:0], row[:0]
    value = hashes[: len(hashes) - width + 1].copy()
    for i in range(1, width):
        value = mix(value * np.uint64(3) + hashes[i : len(hashes) - width + 1 + i])
    same = row[: len(value)] == row[width - 1 :]
    return value[same], row[: len(value)][same]


class Discriminant:
    """Two normal densities over standardised statistics."""

    def __init__(self, pooled: float = 0.3, diagonal: float = 0.1):
        self.pooled, self.diagonal = pooled, diagonal

    def fit(self, rows: np.ndarray, labels: np.ndarray) -> Discriminant:
        """With one class only, or none, every score is that class's share (a half without rows)."""
        ones = float((labels == 1).sum())
        self.prior = (ones + 1) / (len(labels) + 2) if len(labels) else 0.5
        self.parts = None
        if min(ones, len(labels) - ones) < 2:
            return self
        self.center, self.scale = rows.mean(axis=0), rows.std(axis=0) + 1e-6
        x = (rows - self.center) / self.scale
        means = [x[labels == c].mean(axis=0) for c in (0, 1)]
        covariances = [np.cov(x[labels == c].T) for c in (0, 1)]
        weights = [len(labels) - ones, ones]
        whole = sum(w * c for w, c in zip(weights, covariances, strict=True)) / len(labels)
        self.parts = []
        for mean, own in zip(means, covariances, strict=True):
            mixed = (1 - self.pooled) * own + self.pooled * whole
            mixed = (1 - self.diagonal) * mixed + self.diagonal * np.diag(np.diag(mixed)) + 1e-3 * np.eye(len(mean))
            factor = np.linalg.cholesky(mixed)
            self.parts.append((mean, np.linalg.inv(factor), np.log(np.diag(factor)).sum()))
        return self

    def score(self, rows: np.ndarray) -> np.ndarray:
        odds = np.full(len(rows), np.log(self.prior / (1 - self.prior)))
        if self.parts is not None:
            x = (rows - self.center) / self.scale
            densities = [-0.5 * (((x - mean) @ factor.T) ** 2).sum(axis=1) - size for mean, factor, size in self.parts]
            odds = odds + densities[1] - densities[0]
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit_quality(documents: DataFrame, labels: DataFrame, label: str = "quality", **columns: str) -> Discriminant:
    """Learns from a bounded sample of the labelled rows that are not held out."""
    rows = teaching_rows(documents, labels, F.col(label), **columns)

    def measure(table: pa.Table) -> pa.Table:
        x = statistics(*buffer_of(table.column("text")))
        return pa.table({"x": pa.array(list(x), pa.list_(pa.float64())), "label": table.column("label").cast(pa.int32())})

    found = sorted((row.label, tuple(row.x)) for row in rows.mapInArrow(batched(measure), "x array<double>, label int").collect())
    if not found:
        return Discriminant().fit(np.zeros((0, 1)), np.zeros(0))
    return Discriminant().fit(np.array([x for _, x in found]), np.array([y for y, _ in found]))


def score_quality(
    documents: DataFrame, model: Discriminant, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``id, held_out, score, predicted``, a row per document, scored on its whole text.

    A null text counts as empty; empty texts have the score of statistics without words. Ids may be null or repeated.
    """
    rows = documents.select(F.col(id_column).alias("id"), held_out(id_column).alias("held_out"), F.col(text_column).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, held_out boolean, score double"
    scored = rows.mapInArrow(batched(_scoring(model)), schema)
    return scored.select(F.col("id").alias(id_column), "held_out", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def _scoring(model: Discriminant) -> Callable[[pa.Table], pa.Table]:
    def score(table: pa.Table) -> pa.Table:
        return table.drop_columns(["text"]).append_column("score", pa.array(model.score(statistics(*buffer_of(table.column("text"))))))

    return score
