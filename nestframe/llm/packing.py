"""Packing token streams of several sources into windows of fixed length with a fixed mixture.

Each source is a queue of its documents' tokens, one after the other. Deficit round-robin fills the windows: each turn
a source is due its share of a window, takes whole tokens, and what it was due beyond them is its deficit, carried into
the next window. Here the deficit has a closed form, so no state passes from window to window or task to task: of the
first ``g`` tokens packed, a tree of sources gives each half ``floor(g * its share)`` and the other half the rest, and
so on down to the single source. That total grows with ``g``, never by more than ``g`` does, the totals of all sources
add up to ``g``, and none is off its share by more tokens than the tree has levels. What a window takes from a source
is the difference of two totals. A task can therefore cut its documents knowing only how many tokens of their source
come before them.

Documents are cut wherever a window ends its turn. All windows but the last are full.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nestframe.llm.bytesets import buffer_of
from nestframe.llm.tokens import shared_tokenizer
from nestframe.operators.durable import durable

#: Rows of (task, source) totals that are broadcast at most; more are joined by shuffle.
BROADCAST_ROWS = 500_000
#: Sources beyond this share queues by hash.
MAX_QUEUES = 10_000


class Shares:
    """How many tokens of each source are among the first ``g`` packed.

    ``totals`` are the sources' tokens. With ``weights`` windows follow these until a source runs dry, then the weights
    of those left, and so on; each such stretch is a phase. Without, the totals are the weights and there is one phase.
    """

    def __init__(self, totals: list[int], weights: list[float] | None = None):
        self.count = len(totals)
        self.total = sum(totals)
        left = list(totals)
        phases = []
        while any(left):
            active = [i for i in range(self.count) if left[i] and (weights is None or weights[i] > 0)]
            if weights is None or not active:
                part = list(left)
            else:
                turns = min(left[i] / weights[i] for i in active)
                part = [min(left[i], round(turns * weights[i])) if i in set(active) else 0 for i in range(self.count)]
                dry = min(active, key=lambda i: left[i] / weights[i])
                part[dry] = left[dry]
            phases.append(part)
            left = [a - b for a, b in zip(left, part, strict=True)]
        self.begins, self.before, self.sums = [], [], []
        passed = [0] * self.count
        for part in phases:
            self.begins.append(sum(passed))
            self.before.append(_sums(passed))
            self.sums.append(_sums(part))
            passed = [a + b for a, b in zip(passed, part, strict=True)]

    def taken(self, amounts: list[int]) -> np.ndarray:
        """A row for each amount ``g``: of the first ``g`` tokens, those of the sources before the first, second, ...

        The last column is ``g`` itself. Products of totals are exact: beyond 64 bits they are Python's numbers.
        """
        kind = np.int64 if self.total < 1 << 31 else object
        rows = np.zeros((len(amounts), self.count + 1), kind)
        phase = np.array([bisect_right(self.begins, g) - 1 for g in amounts], int)
        for number in np.unique(phase):
            here = phase == number
            local = np.array([g - self.begins[number] for g, mine in zip(amounts, here, strict=True) if mine], kind)
            sums, own = self.sums[number], np.zeros((len(local), self.count), kind)
            halves = [(0, self.count, local)]
            while halves:
                low, high, amount = halves.pop()
                if high - low == 1:
                    own[:, low] = amount
                    continue
                middle = (low + high) // 2
                whole = sums[high] - sums[low]
                part = amount * (sums[middle] - sums[low]) // whole if whole else amount * 0
                halves += [(low, middle, part), (middle, high, amount - part)]
            rows[here, 1:] = np.cumsum(own, axis=1) + np.array(self.before[number][1:], kind)
        return rows


def _sums(values: list[int]) -> list[int]:
    result = [0]
    for value in values:
        result.append(result[-1] + value)
    return result


class Cutter:
    """Cuts stretches of a source's queue at the ends of its turns in the windows, a block of windows at a time."""

    def __init__(self, shares: Shares, size: int, block: int = 512):
        self.shares, self.size, self.block = shares, size, block
        self.blocks = -(-shares.total // (size * block))
        self.seen: dict[int, np.ndarray] = {}
        self.turns: dict[tuple[int, int], tuple[list[int], list[int]]] = {}
        self.last: dict[int, int] = {}

    def turns_of(self, block: int, source: int) -> tuple[list[int], list[int]]:
        """At the beginning of each window of the block and at its end: tokens of the source, and of those before it."""
        if (block, source) not in self.turns:
            if block not in self.seen:
                if len(self.seen) >= 16:
                    self.seen.clear(), self.turns.clear()
                first = block * self.block
                amounts = [min(w * self.size, self.shares.total) for w in range(first, first + self.block + 1)]
                self.seen[block] = self.shares.taken(amounts)
            rows = self.seen[block]
            self.turns[block, source] = (rows[:, source + 1] - rows[:, source]).tolist(), rows[:, source].tolist()
        return self.turns[block, source]

    def pieces(self, source: int, begin: int, length: int) -> Iterator[tuple[int, int, int, int]]:
        """``start, length, window, offset`` of the pieces of the tokens begin ... begin + length - 1 of the queue."""
        block = self.last.get(source, 0)
        own, ahead = self.turns_of(block, source)
        if not own[0] <= begin < own[-1]:
            block, high = 0, self.blocks
            while high - block > 1:
                middle = (block + high) // 2
                at = self.shares.taken([min(middle * self.block * self.size, self.shares.total)])[0]
                if at[source + 1] - at[source] <= begin:
                    block = middle
                else:
                    high = middle
            own, ahead = self.turns_of(block, source)
        self.last[source] = block
        place, done = bisect_right(own, begin) - 1, 0
        while done < length:
            if place >= self.block:
                block, place = block + 1, 0
                own, ahead = self.turns_of(block, source)
                continue
            take = min(own[place + 1] - begin, length) - done
            if take > 0:
                offset = ahead[place + 1] - ahead[place] + begin + done - own[place]
                yield done, take, block * self.block + place, offset
                done += take
            place += 1


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The values of these sizes in bytes that lie one after the other in the array."""
    bounds = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(bounds), pa.py_buffer(data)])


def pack(
    documents: DataFrame,
    tokenizer: str,
    size: int = 2048,
    end_id: int = 1,
    targets: dict[str | None, float] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """``id, source, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset``, a row per piece.

    A document is its text's ids and then ``end_id``; a null or empty text is the ``end_id`` alone. A null id stays
    null; repeated rows are packed as often as they come. Null is a source of its own. ``targets`` maps sources to
    weights, others weigh nothing and come last; by default each source weighs what it has, so that no queue runs dry
    before the end. No rows give no rows.
    """
    texts = documents.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(source_column).cast("string").alias("source")
    )

    def tokenize(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, part, before = shared_tokenizer(tokenizer), TaskContext.get().partitionId(), {}
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                some = batch.slice(begin, 1000)
                ids, counts = words.encode_column(some.column("text"))
                counts = counts + 1
                ends = np.cumsum(counts)
                whole = np.full(len(ids) + len(counts), end_id, "<u2")
                inner = np.ones(len(whole), bool)
                inner[ends - 1] = False
                whole[inner] = ids
                places = []
                for source, n in zip(some.column("source").to_pylist(), counts.tolist(), strict=True):
                    places.append(before.get(source, 0))
                    before[source] = places[-1] + n
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": some.column("id"), "source": some.column("source"), "part": np.full(len(counts), part, np.int32),
                        "place": pa.array(places, pa.int64()), "ids": _binary(whole, counts * 2), "n": counts,
                    }
                )

    id_type = texts.schema["id"].dataType.simpleString()
    tokens = durable(texts.mapInArrow(tokenize, f"id {id_type}, source string, part int, place long, ids binary, n long"))
    if targets is None and tokens.select("source").distinct().limit(MAX_QUEUES + 1).count() > MAX_QUEUES:
        raise ValueError(f"More than {MAX_QUEUES} sources: map them to fewer queues first")
    totals = tokens.groupBy("part", "source").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    places = durable(totals.select("part", "source", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")))
    queues = sorted(
        ((row.source, row.n) for row in places.groupBy("source").agg(F.sum("n").alias("n")).collect()),
        key=lambda queue: (queue[0] is not None, queue[0] or ""),
    )
    number = {source: i for i, (source, _) in enumerate(queues)}
    weights = [float(targets.get(source, 0)) for source, _ in queues] if targets is not None else None
    shares = Shares([n for _, n in queues], weights)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(shares, size)
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                some = batch.slice(begin, 512)
                sources, lengths = some.column("source").to_pylist(), some.column("n").to_pylist()
                bases = (np.asarray(some.column("place")) + np.asarray(some.column("base"))).tolist()
                cuts = [
                    list(cutter.pieces(number[source], base, n))
                    for source, base, n in zip(sources, bases, lengths, strict=True)
                ]
                own = some.select(["id", "source", "n"]).take(pa.array(np.repeat(np.arange(len(cuts)), [len(pieces) for pieces in cuts])))
                start, length, window, offset = np.array([piece for pieces in cuts for piece in pieces], np.int64).T
                # The pieces of a document, and so of all of them, lie one after the other.
                data, _, _ = buffer_of(some.column("ids"))
                wide = data.view("<u2").astype("<u4")
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": own.column("id"), "source": own.column("source"), "start": start, "length": length,
                        "ids": _binary(wide, length * 4),
                        "doc_tokens": own.column("n"), "sequence_id": window, "offset": offset,
                    }
                )

    places = places.withColumnRenamed("source", "queue").withColumnRenamed("part", "task").drop("n")
    if places.count() <= BROADCAST_ROWS:
        places = F.broadcast(places)
    placed = tokens.join(places, (F.col("part") == F.col("task")) & F.col("source").eqNullSafe(F.col("queue")))
    schema = (
        f"id {id_type}, source string, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
    pieces = placed.select("id", "source", "place", "base", "ids", "n").mapInArrow(cut, schema)
    return pieces.withColumnRenamed("id", id_column)
