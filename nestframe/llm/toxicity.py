"""Toxicity by a regularised linear classifier that swapping identity terms must not move.

A text is the set of its words and of their first four, five and six bytes, so that word stems count. Features that
toxic texts have more often than chance would give them are chosen on the labelled sample, then a logistic regression
is fitted. Beside the weights' squares, its loss has the squared change of the score when an identity term of a
labelled text is swapped for another of its group or for the group's neutral word. So a group's name, which may well
be frequent in toxic texts, can not carry their label, and neutral mentions of the group score low.

Counting is done by tasks and summed up by Spark; what is collected is the chosen features of the sampled texts only.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestframe.llm.bytesets import Hasher, batched, buffer_of, gaps_between, word_bounds
from nestframe.llm.labelled import held_out, teaching_rows

#: Groups of terms that may take each other's place, the neutral word first. Fixed lists; others can be given.
IDENTITY_GROUPS = (
    ("people", "women", "men", "girls", "boys"),
    ("person", "woman", "man", "girl", "boy"),
    ("people", "muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("religious", "muslim", "christian", "jewish", "hindu", "buddhist"),
    ("people", "immigrants", "refugees", "foreigners", "natives"),
    ("human", "black", "white", "asian", "latino", "african", "european", "arab"),
    ("human", "gay", "lesbian", "straight", "bisexual", "transgender"),
    ("human", "disabled", "blind", "deaf", "autistic", "old", "young"),
    ("leute", "frauen", "männer", "juden", "christen", "muslime", "ausländer", "flüchtlinge"),
    ("gens", "femmes", "hommes", "juifs", "chrétiens", "musulmans", "étrangers", "réfugiés"),
    ("gente", "mujeres", "hombres", "judíos", "cristianos", "musulmanes", "extranjeros", "refugiados"),
)
_BUCKETS = 1 << 20
_GAPS = gaps_between(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789'_")
_PREFIXES = (4, 5, 6)
#: Features chosen at most.
FEATURES = 20_000


def text_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and of their stems, with their rows; repeats included."""
    begin, stop, row = word_bounds(data, starts, ends, _GAPS)
    if not len(begin):
        return np.zeros(0, np.uint64), row
    hasher = Hasher(data)
    values, rows = [hasher(begin, stop)], [row]
    for size in _PREFIXES:
        longer = stop - begin > size
        # The length enters the hash, so a stem is another feature than the word of its letters.
        values.append(hasher(begin[longer], begin[longer] + size) + np.uint64(size))
        rows.append(row[longer])
    return np.concatenate(values), np.concatenate(rows)


def _sets(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``wanted`` (sorted) of each row's features, each once."""
    value, row = text_features(data, starts, ends)
    if not len(wanted) or not len(value):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(wanted, value), len(wanted) - 1)
    hit = wanted[at] == value
    joined = np.unique(row[hit] * len(wanted) + at[hit])
    return joined % len(wanted), joined // len(wanted)


class ToxicityModel:
    """Weights of features by hash (sorted), and an intercept."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray, intercept: float):
        self.hashes, self.weights, self.intercept = hashes, weights, intercept

    def score(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        at, row = _sets(data, starts, ends, self.hashes)
        margin = self.intercept + np.bincount(row, self.weights[at] if len(at) else None, len(starts))
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


class Swapper:
    """Swaps the identity terms of a text within their groups."""

    def __init__(self, groups: tuple[tuple[str, ...], ...]):
        self.group = {term: group for group in groups for term in group[1:]}
        terms = sorted(map(re.escape, self.group), key=lambda term: (-len(term), term))
        self.pattern = re.compile(rf"\b(?:{'|'.join(terms)})\b", re.I) if terms else None

    def versions(self, text: str) -> list[str]:
        """The text with neutral words, and with the next term of each group; none if it has no terms."""
        if self.pattern is None or not self.pattern.search(text):
            return []

        def turned(match: re.Match) -> str:
            group = self.group[match[0].lower()]
            return group[1 + group.index(match[0].lower(), 1) % (len(group) - 1)]

        neutral = self.pattern.sub(lambda m: self.group[m[0].lower()][0], text)
        return [neutral, self.pattern.sub(turned, text)]


def fit_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    groups: tuple[tuple[str, ...], ...] = IDENTITY_GROUPS,
    swap_penalty: float = 10.0,
    l2: float = 1e-4,
    **columns: str,
) -> ToxicityModel:
    """Learns from a bounded sample of the labelled rows that are not held out.

    Without labelled rows of both kinds every text has the score of the known kind's share, or a half.
    """
    rows = teaching_rows(documents, labels, F.col(label), **columns)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, _BUCKETS), np.int32)
        texts = np.zeros(2, np.int64)

        def add(table: pa.Table) -> pa.Table:
            value, row = text_features(*buffer_of(table.column("text")))
            joined = np.unique(row * _BUCKETS + (value % np.uint64(_BUCKETS)).astype(np.int64))
            kind = np.asarray(table.column("label")) > 0
            for k in (0, 1):
                np.add(counts[k], np.bincount(joined[kind[joined // _BUCKETS] == k] % _BUCKETS, minlength=_BUCKETS), out=counts[k], casting="unsafe")
                texts[k] += (kind == k).sum()
            return table.slice(0, 0)

        for _ in batched(add)(batches):
            pass
        seen = np.flatnonzero(counts.any(axis=0))
        bucket = np.append(seen, -1)
        of = [np.append(counts[k][seen], texts[k]) for k in (0, 1)]
        yield pa.RecordBatch.from_pydict({"bucket": bucket.astype(np.int64), "clean": of[0].astype(np.int64), "toxic": of[1].astype(np.int64)})

    counted = rows.mapInArrow(count, "bucket long, clean long, toxic long")
    counted = counted.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    total = counted.where("bucket = -1").first()
    clean, toxic = (total.clean, total.toxic) if total else (0, 0)
    if not clean or not toxic:
        rate = (toxic + 1) / (clean + toxic + 2)
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), float(np.log(rate / (1 - rate))))
    rate = toxic / (clean + toxic)
    n = F.col("clean") + F.col("toxic")
    odd = (F.col("toxic") - n * rate) / F.sqrt(n * (rate * (1 - rate)))
    chosen = counted.where("bucket >= 0 AND toxic >= 3").withColumn("odd", odd).where("odd >= 3")
    buckets = np.array(sorted(r.bucket for r in chosen.orderBy(F.desc("odd"), "bucket").limit(FEATURES).collect()), np.int64)
    swapper = Swapper(groups)
    terms = np.unique(_term_features(groups))

    def describe(table: pa.Table) -> pa.Table:
        data, starts, ends = buffer_of(table.column("text"))
        value, row = text_features(data, starts, ends)
        at = np.minimum(np.searchsorted(buckets, (value % np.uint64(_BUCKETS)).astype(np.int64)), max(len(buckets) - 1, 0))
        hit = np.isin(value, terms)
        if len(buckets):
            hit |= buckets[at] == (value % np.uint64(_BUCKETS)).astype(np.int64)
        features = [np.unique(value[hit & (row == i)]).view(np.int64) for i in np.unique(row[hit])]
        lists = dict(zip(np.unique(row[hit]).tolist(), features, strict=True))
        swapped = []
        for text in table.column("text").to_pylist():
            versions = swapper.versions(text or "")
            own = [text_features(*buffer_of(pa.array([version])))[0] for version in versions]
            swapped.append([np.unique(v[np.isin(v, terms)]).view(np.int64).tolist() for v in own])
        return pa.table(
            {
                "label": table.column("label").cast(pa.int32()),
                "features": pa.array([lists.get(i, np.zeros(0, np.int64)) for i in range(table.num_rows)], pa.list_(pa.int64())),
                "swapped": pa.array(swapped, pa.list_(pa.list_(pa.int64()))),
            }
        )

    found = rows.mapInArrow(batched(describe), "label int, features array<long>, swapped array<array<long>>").collect()
    examples = sorted((row.label, tuple(row.features), tuple(map(tuple, row.swapped))) for row in found)
    return _fit(examples, set(terms.view(np.int64).tolist()), swap_penalty, l2)


def _term_features(groups: tuple[tuple[str, ...], ...]) -> np.ndarray:
    """The features that swapping can change; neutral words have none, so that no weight can move to them."""
    words = pa.array([term for group in groups for term in group[1:]], pa.string())
    return text_features(*buffer_of(words))[0] if len(words) else np.zeros(0, np.uint64)


def _fit(examples: list, terms: set[int], swap_penalty: float, l2: float, steps: int = 400) -> ToxicityModel:
    """Gradient descent with momentum on logistic loss, squared weights and squared changes by swaps."""
    known = sorted({f for _, features, swaps in examples for f in (*features, *(g for swap in swaps for g in swap))})
    place = {f: i for i, f in enumerate(known)}
    y = np.array([float(label > 0) for label, _, _ in examples])
    row = np.repeat(np.arange(len(examples)), [len(features) for _, features, _ in examples])
    at = np.array([place[f] for _, features, _ in examples for f in features], int)
    change_row, change_at, change = [], [], []
    number = 0
    for _, features, swaps in examples:
        before = terms & set(features)
        for swap in swaps:
            for f in before ^ set(swap):
                change_row.append(number), change_at.append(place[f]), change.append(1.0 if f in before else -1.0)
            number += 1
    change_row, change_at, change = np.array(change_row, int), np.array(change_at, int), np.array(change)
    weights, intercept = np.zeros(len(known)), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    # A toxic text counts as three: they are rare, and predictions ask for more than even odds.
    weight = np.where(y > 0, 3.0, 1.0)
    # Each weight has a step of its own (Adam), as features differ widely in how many texts have them.
    first, second = np.zeros(len(known) + 1), np.zeros(len(known) + 1)
    for step in range(1, steps + 1):
        margin = intercept + np.bincount(row, weights[at], len(y))
        error = weight * (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - y)
        gradient = np.bincount(at, error[row], len(known)) / len(y) + l2 * weights
        if number:
            moved = np.bincount(change_row, change * weights[change_at], number)
            gradient += 2 * swap_penalty * np.bincount(change_at, change * moved[change_row], len(known)) / number
        gradient = np.append(gradient, error.mean())
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        move = 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights, intercept = weights - move[:-1], intercept - move[-1]
    hashes = np.array(known, np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return ToxicityModel(hashes[order], weights[order], float(intercept))


def score_toxicity(
    documents: DataFrame, model: ToxicityModel, threshold: float = 0.7, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``id, held_out, score, predicted``, a row per document, scored on its whole text.

    A null text counts as empty; an empty text scores what the share of toxic texts gives. Ids may be null or repeated.
    """
    rows = documents.select(F.col(id_column).alias("id"), held_out(id_column).alias("held_out"), F.col(text_column).alias("text"))

    def score(table: pa.Table) -> pa.Table:
        return table.drop_columns(["text"]).append_column("score", pa.array(model.score(*buffer_of(table.column("text")))))

    scored = rows.mapInArrow(batched(score), f"id {rows.schema['id'].dataType.simpleString()}, held_out boolean, score double")
    return scored.select(
        F.col("id").alias(id_column), "held_out", "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted")
    )


def drop_toxic(documents: DataFrame, model: ToxicityModel, threshold: float = 0.7, text_column: str = "text") -> DataFrame:
    """The documents, all columns, that score below the threshold."""
    names = documents.columns
    plain = documents.toDF(*(f"_{i}" for i in range(len(names))))
    place = f"_{names.index(text_column)}"

    def keep(table: pa.Table) -> pa.Table:
        return table.filter(pa.array(model.score(*buffer_of(table.column(place))) < threshold))

    return plain.mapInArrow(batched(keep, column=place), plain.schema).toDF(*names)
