"""Repair of conversations by cheapest edits, found by a Viterbi search that runs over chunks of rows in parallel.

Roles must be an optional system turn and then pairs of user and assistant, which an automaton of four states accepts.
Backwards through the rows, the cost to go from each state is a vector of four; a row makes it from the vector after it
by sums and minima. As for all such products, the vectors that different ends lead to soon differ by a constant only.
So every chunk of a long conversation starts from a speculative vector, all chunks at once. Then a fix-up pass takes the
chunks whose speculative end differs from the begin of the next chunk by more than a constant, and runs them again from
there; passes are repeated until no such chunk is left. The stitched vectors are right up to constants, and differences
are all that tracing needs: from the first row on, each step takes the least of the edits that cost no more than the
rest allows.

Rows are sorted over the cluster by conversation and turn. Conversations that lie whole in a slice of the sort, and have
no more rows than a chunk, are done there; the others' rows are written out by chunk.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nestframe.operators.durable import durable

#: Rows of a conversation that are searched at a time.
CHUNK = 4096
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
#: States: nothing yet, after a system turn, after a user turn, after an assistant turn.
_AFTER = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
#: The state after an inserted or re-roled turn, and its role.
_FORCED = (2, 2, 3, 2)
_ROLES = ("user", "user", "assistant", "user")
_END = (0, 6, 3, 0)
_BLANKS = " \t\n\v\f\r"
#: Characters of role and text by which rows of equal turn are dealt to slices; all of them order the rows of a slice.
_DEALT = 64
_LEGAL = ("su", "ua", "au")
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
_RESULT = (
    "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string,"
    " repaired_sha256 string"
)
_ROW = "conv string, slice long, part int, place int, turn long, role string, text string, copied boolean"


def _shown(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def conversation_id(column: str = "conv_id") -> Column:
    """The id of a conversation as ``conv`` has it: text, one space for null."""
    return _shown(column)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv, turn, role, text, first, second`` of conversations as crc32 of ``conv:turn`` modulo 20 damages them.

    0 drops a row, 1 empties its text, 2 removes the characters ``.!?``, 3 repeats it, 4 sets its role to user. A null
    id, turn, role or text is one space there; ``turn`` stays null. ``first`` and ``second`` are role and text
    before, by which rows of equal turn are ordered, so that repeats lie beside each other.
    """

    lot = (F.crc32(F.concat(_shown("conv_id"), F.lit(":"), _shown("turn"))) % 20).alias("lot")
    turn = F.col("turn").cast("long").alias("turn")
    rows = conversations.select(
        conversation_id().alias("conv"), turn, _shown("role").alias("first"), _shown("text").alias("second"), lot
    ).where("lot <> 0")
    role = F.when(F.col("lot") == 4, F.lit("user")).otherwise(F.col("first"))
    text = F.when(F.col("lot") == 1, F.lit("")).when(F.col("lot") == 2, F.translate("second", ".!?", "")).otherwise(F.col("second"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("lot") == 3, 2).otherwise(1)))
    return rows.select("conv", "turn", role.alias("role"), text.alias("text"), "first", "second", times.alias("_")).drop("_")


def repair(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Faults, cheapest edits and repaired digest of each conversation in ``rows``.

    ``rows`` has ``conv`` (text, not null), ``turn``, ``role``, ``text`` (not null), and optionally ``first`` and
    ``second``, which order rows of equal turn, nulls first; without them role and text do. Equal rows are duplicates of
    each other. Texts of any length are looked at whole. No rows give no rows, and other columns do not matter. A
    conversation of any number of rows is searched chunk by chunk in as many tasks as it has chunks; only its last
    pass, which traces the edits and digests the repaired turns, reads its rows in order, as one digest must, a chunk
    at a time and in bounded memory. What passes depend on is written to the shared folder.
    """
    order = [c for c in ("first", "second") if c in rows.columns] or ["role", "text"]
    ordering = [F.col("conv"), F.col("turn").asc_nulls_first(), *order]
    dealt = rows.repartitionByRange("conv", F.col("turn").asc_nulls_first(), *(F.left(c, F.lit(_DEALT)) for c in order))
    ordered = dealt.sortWithinPartitions(*ordering, "role", "text")
    ordered = ordered.select("conv", "turn", "role", "text", F.spark_partition_id().cast("long").alias("slice"))
    columns = f"{_RESULT}, {_ROW.removeprefix('conv string, ')}"
    sorted_out = durable(ordered.mapInArrow(_in_slice(chunk), columns))
    whole = sorted_out.where("slice IS NULL").select(*_names(_RESULT))
    pieces = sorted_out.where("slice IS NOT NULL").select(*_names(_ROW))
    if pieces.isEmpty():
        return whole
    return whole.unionByName(_long_conversations(pieces))


def _names(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(", ")]


@dataclass
class _Turn:
    turn: int | None
    role: str
    text: str
    fault: str | None

    @property
    def fixed(self) -> bool:
        return self.fault not in (BLANK, DUPLICATE)


def _fault(text: str, copied: bool) -> str | None:
    """The first fault of a row."""
    last = text.rstrip(_BLANKS)[-1:]
    if not last:
        return BLANK
    return DUPLICATE if copied else None if last in ".!?" else TRUNCATED


def _back(turn: _Turn, after: tuple) -> tuple:
    """The costs to go before a row, from those after it."""
    costs = [DELETE_COST + cost for cost in after]
    if turn.fixed:
        more = TRUNCATED_COST if turn.fault else 0
        kept = _AFTER.get(turn.role[:1], (None,) * 4)
        for state in range(4):
            best = REROLE_COST + more + after[_FORCED[state]]
            if kept[state] is not None:
                best = min(best, more + after[kept[state]])
            costs[state] = min(costs[state], best)
    return _inserted(costs)


def _inserted(costs: list[int]) -> tuple:
    """The costs if turns may be inserted first; more than two in a row lead nowhere new."""
    user, assistant = min(costs[2], INSERT_COST + costs[3]), min(costs[3], INSERT_COST + costs[2])
    return min(costs[0], INSERT_COST + user), min(costs[1], INSERT_COST + user), user, assistant


def _vectors(turns: list[_Turn], end: tuple) -> list[tuple]:
    """The costs to go before each row and after the last."""
    vectors = [end]
    for turn in reversed(turns):
        vectors.append(_back(turn, vectors[-1]))
    vectors.reverse()
    return vectors


def _relative(vector: Iterable[int]) -> tuple:
    vector = tuple(vector)
    return tuple(cost - vector[0] for cost in vector)


@dataclass
class _Repair:
    """The running result of one conversation, fed with its chunks in order."""

    conv: str
    state: int = 0
    cost: int = 0
    audit: list[str] = field(default_factory=list)
    faults: dict[str, int] = field(default_factory=lambda: {BLANK: 0, DUPLICATE: 0, TRUNCATED: 0})
    illegal: int = 0
    last: str | None = None
    least: int | None = None
    turn: int | None = None
    distinct: int = 0
    written: int = 0

    def __post_init__(self) -> None:
        self.digest = sha256()

    def add(self, turns: list[_Turn], end: tuple, is_last: bool) -> None:
        """Takes up the next rows, after which the costs to go are ``end``, up to a constant."""
        for turn in turns:
            if turn.fault:
                self.faults[turn.fault] += 1
            initial = turn.role[:1]
            self.illegal += self.last is not None and self.last + initial not in _LEGAL
            self.last = initial
            if turn.turn is not None:
                self.least = turn.turn if self.least is None else self.least
                self.distinct += turn.turn != self.turn
                self.turn = turn.turn
        vectors = _vectors(turns, end)
        for at, turn in enumerate(turns):
            while not self._take(turn, vectors[at], vectors[at + 1]):
                self._insert()
        while is_last and _END[self.state]:
            self._insert()

    def _take(self, turn: _Turn, here: tuple, after: tuple) -> bool:
        """Deletes, keeps or re-roles a row unless inserting before it is as cheap and less."""
        state, goal = self.state, here[self.state]
        if DELETE_COST + after[state] == goal:
            self._note(DELETE, DELETE_COST)
            return True
        if INSERT_COST + here[_FORCED[state]] == goal:
            return False
        more = TRUNCATED_COST if turn.fault else 0
        kept = _AFTER.get(turn.role[:1], (None,) * 4)[state]
        if kept is not None and more + after[kept] == goal:
            self._note(KEEP, more)
            self._write(turn.role, turn.text)
            self.state = kept
        else:
            self._note(REROLE, REROLE_COST + more)
            self._write(_ROLES[state], turn.text)
            self.state = _FORCED[state]
        return True

    def _insert(self) -> None:
        self._note(INSERT, INSERT_COST)
        self._write(_ROLES[self.state], "")
        self.state = _FORCED[self.state]

    def _note(self, edit: str, cost: int) -> None:
        self.audit.append(edit)
        self.cost += cost

    def _write(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.written else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.written += 1

    def result(self) -> tuple:
        gaps = self.turn - self.least + 1 - self.distinct if self.turn is not None else 0
        faults = (self.faults[kind] for kind in (BLANK, DUPLICATE, TRUNCATED))
        return self.conv, gaps, *faults, self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest()


def _schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def _in_slice(chunk: int):
    """Results of the conversations inside a slice of the sort; of those at its ends and the long ones, the rows."""
    schema = _schema(f"{_RESULT}, {_ROW.removeprefix('conv string, ')}")
    blank_row, blank_result = (None,) * (len(_names(_ROW)) - 1), (None,) * (len(_names(_RESULT)) - 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, turns, seen, part, is_open, found = None, [], set(), 0, True, []

        def rows_out() -> None:
            nonlocal part
            for place, (turn, role, text, copied) in enumerate(turns):
                found.append((conv, *blank_result, number, part, place, turn, role, text, copied))
            part += 1
            turns.clear()
            seen.clear()

        def close(at_end: bool) -> None:
            if turns and (is_open or at_end):
                rows_out()
            elif turns:
                whole = _Repair(conv)
                whole.add([_Turn(turn, role, text, _fault(text, copied)) for turn, role, text, copied in turns], _END, True)
                found.append((*whole.result(), *blank_row))

        def out() -> pa.RecordBatch:
            columns = list(zip(*found, strict=True))
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
            found.clear()
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        first = True
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if row[0] != conv:
                    close(False)
                    is_open, first = first, False
                    conv, part = row[0], 0
                    turns.clear()
                    seen.clear()
                elif len(turns) == chunk:
                    is_open = True
                    rows_out()
                number = row[4]
                turns.append((row[1], row[2], row[3], row[2:4] in seen))
                seen.add(row[2:4])
            if found:
                yield out()
        close(True)
        if found:
            yield out()

    return run


def _long_conversations(pieces: DataFrame) -> DataFrame:
    """Results of conversations in chunks ``(slice, part)``, whose duplicates within a chunk are marked."""
    chunk = ["conv", "slice", "part"]
    # Only rows that are the first of their kind in a chunk are compared with other chunks.
    kind = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    firsts = pieces.where("NOT copied").select(*chunk, "place", kind.alias("kind"))
    earliest = firsts.groupBy("conv", "kind").agg(F.min(F.struct("slice", "part")).alias("at"), F.count("*").alias("n")).where("n > 1")
    later = firsts.join(earliest, ["conv", "kind"]).where(F.struct("slice", "part") > F.col("at")).select(*chunk, "place")
    marked = pieces.join(later.withColumn("later", F.lit(True)), [*chunk, "place"], "left")
    turns = durable(marked.select(*_names(_ROW)[:-1], (F.col("copied") | F.coalesce("later", F.lit(False))).alias("copied")))

    # What the search needs of a row: its initial and its fault.
    steps = durable(
        turns.mapInArrow(_steps, "conv string, slice long, part int, place int, initial string, fault string")
    )
    ends = _ends(steps)
    absent = (("place", "int"), ("turn", "long"), ("role", "string"), ("text", "string"), ("copied", "boolean"))
    heads = ends.select(*chunk, *(F.lit(None).cast(kind).alias(name) for name, kind in absent), "end")
    rows = turns.withColumn("end", F.lit(None).cast("array<long>")).unionByName(heads)
    rows = rows.repartition("conv").sortWithinPartitions(*chunk, F.col("place").asc_nulls_first())
    return rows.select(*_names(_ROW), "end").mapInArrow(_traced, _RESULT)


def _ends(steps: DataFrame) -> DataFrame:
    """The costs to go after each chunk, up to a constant.

    All chunks are run from the vector for the end of a conversation, those whose next chunk begins with another one
    again from that, and so on until all fit.
    """
    chunk = ["conv", "slice", "part"]
    chunks = steps.select(*chunk).distinct()
    following = F.lead("begin").over(Window.partitionBy("conv").orderBy("slice", "part"))
    final = F.array(*(F.lit(cost).cast("long") for cost in _END))
    vectors = durable(_run(steps, chunks.select(*chunk, final.alias("end"))))
    while True:
        wanted = vectors.select(*chunk, "begin", "end", F.coalesce(following, final).alias("wanted"))
        wanted = durable(wanted)
        wrong = wanted.where("end <> wanted")
        if wrong.isEmpty():
            return wanted.select(*chunk, "end")
        again = _run(steps, wrong.select(*chunk, F.col("wanted").alias("end")))
        vectors = durable(wanted.where("end = wanted").select(*chunk, "end", "begin").unionByName(again))


def _run(steps: DataFrame, ends: DataFrame) -> DataFrame:
    """Chunks run backwards from the given costs after them: ``end`` and ``begin``, the costs before them."""
    chunk = ["conv", "slice", "part"]
    rows = steps.join(ends.select(*chunk), chunk, "left_semi").withColumn("end", F.lit(None).cast("array<long>"))
    absent = (F.lit(None).cast(t).alias(c) for c, t in (("place", "int"), ("initial", "string"), ("fault", "string")))
    rows = rows.unionByName(ends.select(*chunk, *absent, "end"))
    rows = rows.repartition(*chunk).sortWithinPartitions(*chunk, F.col("place").asc_nulls_first())
    return rows.mapInArrow(_run_back, "conv string, slice long, part int, end array<long>, begin array<long>")


def _steps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        conv, slices, part, place, _, role, text, copied = batch.columns
        initials = [r[:1] for r in role.to_pylist()]
        faults = [_fault(t, c) for t, c in zip(text.to_pylist(), copied.to_pylist(), strict=True)]
        names = ["conv", "slice", "part", "place", "initial", "fault"]
        arrays = [conv, slices, part, place, pa.array(initials, pa.string()), pa.array(faults, pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, names)


def _groups(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """The rows with equal first ``width`` columns, which lie together."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if row[:width] != key:
                if held:
                    yield key, held
                key, held = row[:width], []
            held.append(row)
    if held:
        yield key, held


def _run_back(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _schema("conv string, slice long, part int, end array<long>, begin array<long>")
    for (conv, number, part), rows in _groups(batches, 3):
        end = tuple(rows[0][6])
        vector = end
        for row in reversed(rows[1:]):
            vector = _back(_Turn(None, row[4], "", row[5]), vector)
        found = [[conv], [number], [part], [list(end)], [list(_relative(vector))]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(found, schema, strict=True)], schema=schema)


def _traced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results from rows in order, each chunk headed by the costs after it."""
    schema = _schema(_RESULT)

    def out(done: _Repair) -> pa.RecordBatch:
        arrays = [pa.array([value], f.type) for value, f in zip(done.result(), schema, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    running, waiting = None, None
    for (conv, _, _), rows in _groups(batches, 3):
        end = tuple(rows[0][8])
        turns = [_Turn(row[4], row[5], row[6], _fault(row[6], row[7])) for row in rows[1:]]
        if running is None or running.conv != conv:
            if running is not None:
                running.add(*waiting, True)
                yield out(running)
            running = _Repair(conv)
        else:
            running.add(*waiting, False)
        waiting = turns, end
    if running is not None:
        running.add(*waiting, True)
        yield out(running)
