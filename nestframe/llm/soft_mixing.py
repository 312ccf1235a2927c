"""Mixing documents so that the expected tokens of each domain meet target weights, with soft membership.

A naive Bayes classifier over hashed words, counted on labelled documents by Spark, gives each document a probability
for each domain; a temperature fitted on labelled rows left out of the counts keeps these honest. Each document gets a
rate, the number of times it should be used. The rates minimise the squared gaps between the domains' expected tokens
(tokens times rate times probability) and their targets, each gap over the domain's present tokens, with every rate
within its bounds. They are found by projected gradient steps: a document's step depends on its probabilities and the
gaps only, so the gaps of the steps so far, a handful of numbers, are all that tasks need; each step is one sum over a
written table.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestframe.llm.bytesets import batched, buffer_of, word_hashes
from nestframe.llm.labelled import teaching_rows
from nestframe.operators.durable import durable

_BUCKETS = 1 << 13
#: Words of a text that weigh fully; beyond it evidence grows with the square root.
_FULL = 50
#: Domains at most; their names and sums are collected.
MAX_DOMAINS = 100
#: With more domains, steps are scaled by each domain for itself.
COUPLED = 24
#: Steps go on until every domain is as near to its target, as a share of all tokens; a greater gap left is warned of.
TOLERANCE, REPORTED = 1e-4, 1e-2


class DomainModel:
    """Log probabilities of word buckets (domains x buckets), priors and a temperature."""

    def __init__(self, domains: list[str], counts: np.ndarray, documents: np.ndarray):
        self.domains = domains
        smooth = counts + 0.5
        self.words = np.log(smooth / smooth.sum(axis=1, keepdims=True)) if len(domains) else counts
        self.prior = np.log((documents + 1) / (documents.sum() + len(domains))) if len(domains) else documents
        self.temperature = 1.0

    def evidence(self, table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """A row of log likelihoods per text, brought down for long ones, and the texts' words."""
        hashes, row = word_hashes(*buffer_of(table.column("text")))
        words = np.bincount(row, minlength=table.num_rows)
        bucket = (hashes % np.uint64(_BUCKETS)).astype(np.int64)
        sums = np.stack([np.bincount(row, w[bucket], table.num_rows) for w in self.words], axis=1)
        weight = np.where(words > _FULL, np.sqrt(_FULL * np.maximum(words, 1)) / np.maximum(words, 1), 1.0)
        return sums * weight[:, None], words

    def posteriors(self, evidence: np.ndarray) -> np.ndarray:
        logits = self.prior + evidence / self.temperature
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        return p / p.sum(axis=1, keepdims=True)


def fit_domains(
    documents: DataFrame, labels: DataFrame, domain: Column, id_column: str = "doc_id", text_column: str = "text"
) -> DomainModel:
    """Learns from labelled documents; ``domain`` is an expression over ``labels``. Two thirds of the rows that may
    teach are counted, the rest sets the temperature. Without labels all documents are of one domain without a name.
    """
    rows = teaching_rows(documents, labels, domain.cast("string"), id_column, text_column)
    rows = rows.withColumn("aside", F.pmod(F.xxhash64("text"), F.lit(3)) == 0)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}

        def add(table: pa.Table) -> pa.Table:
            hashes, row = word_hashes(*buffer_of(table.column("text")))
            bucket = (hashes % np.uint64(_BUCKETS)).astype(np.int64)
            names = np.array(table.column("label").to_pylist(), object)
            for name in set(names.tolist()):
                own = counts.setdefault(name, np.zeros(_BUCKETS + 1, np.int64))
                own[:-1] += np.bincount(bucket[names[row] == name], minlength=_BUCKETS)
                own[-1] += (names == name).sum()
            return table.slice(0, 0)

        for _ in batched(add)(batches):
            pass
        for name, own in counts.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_pydict({"domain": pa.array([name] * len(at), pa.string()), "bucket": at, "n": own[at]})

    counted = rows.where("NOT aside").mapInArrow(count, "domain string, bucket long, n long")
    counted = counted.groupBy("domain", "bucket").agg(F.sum("n").alias("n"))
    found = counted.groupBy("domain").agg(F.collect_list(F.struct("bucket", "n")).alias("counts")).limit(MAX_DOMAINS + 1).collect()
    if len(found) > MAX_DOMAINS:
        raise ValueError(f"More than {MAX_DOMAINS} domains")
    domains = sorted(row.domain for row in found) or [""]
    counts = np.zeros((len(domains), _BUCKETS + 1))
    for row in found:
        for bucket, n in row.counts:
            counts[domains.index(row.domain), bucket] = n
    model = DomainModel(domains, counts[:, :-1], counts[:, -1])

    def weigh(table: pa.Table) -> pa.Table:
        evidence, _ = model.evidence(table)
        return pa.table({"label": table.column("label"), "evidence": pa.array(list(evidence), pa.list_(pa.float64()))})

    aside = rows.where("aside").select("text", "label").mapInArrow(batched(weigh), "label string, evidence array<double>")
    known = sorted((row.label, tuple(row.evidence)) for row in aside.collect() if row.label in domains)
    if known:
        truth, evidence = np.array([domains.index(label) for label, _ in known]), np.array([e for _, e in known])
        losses = []
        for temperature in np.geomspace(0.25, 64, 33):
            model.temperature = float(temperature)
            p = model.posteriors(evidence)[np.arange(len(truth)), truth]
            losses.append((float(-np.log(np.maximum(p, 1e-12)).mean()), float(temperature)))
        model.temperature = min(losses)[1]
    return model


def mixing_rates(
    documents: DataFrame,
    model: DomainModel,
    targets: dict[str, float],
    lowest: float = 0.0,
    highest: float | None = None,
    steps: int = 60,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``id, tokens, domain, posteriors, rate, copies, gap``, a row per document.

    Tokens are words. ``domain`` is the likeliest. ``targets`` are weights by domain; a domain without one weighs
    nothing. With ``lowest`` 0 the tokens used come to what there are; else to as many as let each rate be
    ``lowest`` at least. Rates have no upper bound but ``highest``, if given. ``gap`` is what the domain farthest
    from its target lacks or has too much, as a share of all tokens used; it is the same in all rows, and a warning is
    given where it is over one in a hundred, as it may be with bounds or if a wanted domain is in no document. ``copies`` is the rate rounded up or down by a hash of id and text, so that its mean is the
    rate. A null or empty text has no tokens, the priors as probabilities, and a rate like others. Ids may be null or
    repeated; equal rows get equal copies.
    """
    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    known = durable(
        rows.withColumn("lot", _lot(F.col("id"), F.col("text")))
        .mapInArrow(batched(_weigh(model)), f"id {id_type}, lot double, tokens long, posteriors array<double>")
    )
    rate, gap = rate_of(known, model, targets, lowest, highest, steps)
    best = F.array_position("posteriors", F.array_max("posteriors"))
    names = F.array(*(F.lit(domain) for domain in model.domains))
    return known.withColumn("rate", rate).select(
        F.col("id").alias(id_column), "tokens", F.element_at(names, best.cast("int")).alias("domain"), "posteriors", "rate",
        _copies(F.col("rate"), F.col("lot")).alias("copies"), F.lit(gap).alias("gap"),
    )


def mix_documents(
    documents: DataFrame,
    model: DomainModel,
    targets: dict[str, float],
    lowest: float = 0.0,
    highest: float | None = None,
    steps: int = 60,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The documents, all columns, each as often as its copies say; see ``mixing_rates``."""
    names = documents.columns
    plain = documents.toDF(*(f"_{i}" for i in range(len(names))))
    id_at, text_at = F.col(f"_{names.index(id_column)}"), F.col(f"_{names.index(text_column)}")
    rows = durable(
        plain.withColumn("lot", _lot(id_at, text_at)).withColumn("text", text_at)
        .mapInArrow(batched(_weigh(model)), ", ".join(
            [f"{f.name} {f.dataType.simpleString()}" for f in plain.schema] + ["lot double", "tokens long", "posteriors array<double>"]
        ))
    )
    rate, _ = rate_of(rows, model, targets, lowest, highest, steps)
    copies = _copies(rate, F.col("lot")).cast("int")
    # One row per copy: a sequence of that many numbers is exploded.
    many = rows.withColumn("copy", F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies)).otherwise(F.array().cast("array<int>"))))
    return many.select(plain.columns).toDF(*names)


def _lot(*columns: Column) -> Column:
    """A number in [0, 1) that hangs on the columns' values alone."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / F.lit(float(1 << 30))


def _copies(rate: Column, lot: Column) -> Column:
    return F.floor(rate + lot).cast("long")


def _weigh(model: DomainModel):
    def weigh(table: pa.Table) -> pa.Table:
        evidence, words = model.evidence(table)
        own = table.drop_columns(["text"]).append_column("tokens", pa.array(words))
        return own.append_column("posteriors", pa.array(list(model.posteriors(evidence)), pa.list_(pa.float64())))

    return weigh


def rate_of(
    known: DataFrame, model: DomainModel, targets: dict[str, float], lowest: float, highest: float | None, steps: int
) -> tuple[Column, float]:
    """The rate as an expression over ``posteriors``, and the gap that is left, as a share of all tokens used.

    Projected gradient steps, scaled by how the domains' tokens hang together, are made until the gap is below
    ``TOLERANCE``, or no step makes the loss smaller, or for ``steps`` trials. The expression holds the gaps of the steps as numbers, so it does not grow with them in size to compile.
    """
    size = len(model.domains)
    weights = np.array([max(0.0, float(targets.get(domain, 0))) for domain in model.domains])
    weights = weights / weights.sum() if weights.sum() else np.full(size, 1 / size)
    p = [F.col("posteriors")[i] for i in range(size)]

    def dot(factors: Column) -> Column:
        return reduce(lambda a, b: a + b, [p[i] * factors[i] for i in range(size)])

    def numbers(values: np.ndarray) -> Column:
        return F.array(*(F.lit(float(value)) for value in values))

    def sums(rate: Column) -> tuple[np.ndarray, np.ndarray]:
        """Tokens used by domain, and how they change with steps along each domain, of rates that are at no bound."""
        free = rate > lowest if highest is None else (rate > lowest) & (rate < highest)
        weight = F.when(free, F.col("tokens")).otherwise(0)
        both = [(i, j) for i in range(size) for j in range(i + 1)] if size <= COUPLED else [(i, i) for i in range(size)]
        found = known.agg(
            *(F.sum(F.col("tokens") * rate * p[i]) for i in range(size)), *(F.sum(weight * p[i] * p[j]) for i, j in both)
        ).first()
        values = [float(value or 0) for value in found]
        change = np.zeros((size, size))
        for (i, j), value in zip(both, values[size:], strict=True):
            change[i, j] = change[j, i] = value
        return np.array(values[:size]), change

    present, _ = sums(F.lit(1.0))
    if not present.sum():
        return _clip(F.lit(1.0), lowest, highest), 0.0
    total = present.sum() if lowest <= 0 else float(max(lowest * m / w for m, w in zip(present, weights, strict=True) if w > 0))
    goal, scale = weights * total, np.maximum(present, present.sum() * 1e-9)
    # Starts where hard membership would have it, which few steps then correct.
    start = _clip(dot(numbers(goal / scale)), lowest, highest)

    def rate_after(moves: list[np.ndarray]) -> Column:
        if not moves:
            return start
        return F.aggregate(F.array(*map(numbers, moves)), start, lambda r, move: _clip(r - dot(move), lowest, highest))

    made: list[np.ndarray] = []
    tries: list[np.ndarray] = [np.zeros(size)]
    least, gap = np.inf, 0.0
    for _ in range(steps):
        if not tries:
            break
        move = tries.pop(0)
        mass, change = sums(rate_after([*made, move]))
        loss = float(((mass - goal) ** 2 / scale).sum())
        if loss >= least * (1 - 1e-6):
            continue
        made.append(move)
        least, gap = loss, float(np.abs(mass - goal).max() / total)
        if gap < TOLERANCE:
            break
        # The step that would close the gaps if no rate met a bound, parts of it, and plain steps down the slope.
        root = np.sqrt(1 / scale)
        whole = np.linalg.lstsq(root[:, None] * change, root * (mass - goal), rcond=1e-9)[0]
        plain = (mass - goal) / scale
        tries = [whole, whole / 2, plain, whole / 8, plain / 4]
    if gap > REPORTED:
        warnings.warn(f"The targets are missed by up to {gap:.2%} of the tokens used.", stacklevel=3)
    return rate_after(made), gap


def _clip(rate: Column, lowest: float, highest: float | None) -> Column:
    rate = F.greatest(rate, F.lit(float(lowest)))
    return rate if highest is None else F.least(rate, F.lit(float(highest)))
