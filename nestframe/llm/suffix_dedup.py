"""Removing long repeated passages by sorting suffixes.

A byte goes if it lies in a string of ``length`` bytes that also starts earlier: in a document that comes before, or
in the same document further ahead. Strings overlap freely and are judged on the input, so the first place stays whole.

How it works. A suffix is taken at every *anchor*: the place of the smallest hash of 32 bytes among those a string of
``length`` bytes holds. Equal strings have their anchor at the same distance, so all strings that start in one stretch
belong to one anchor, and only anchors whose 32 bytes occur a second time anywhere can matter.

1. Documents are dealt into blocks of about four megabytes, by id and text. A block names its anchors' hashes, each once.
2. Hashes known to two blocks, or found twice within one, go back to their blocks.
3. Each block takes the stretches of such anchors; of equal stretches within the block only the first goes on.
4. Splitters sampled from leading bytes of anchors deal the stretches into ranges. A leading string so frequent that
   several splitters equal it is spread over the ranges between them; ranges too few for the blocks are dealt on by hash. Each range sorts by multikey quicksort and
   compares neighbours, first whole stretches, then the single strings of those that still share 32 bytes.
   So is an anchor that more blocks have than a range should: blocks are counted exactly, whatever the sample shows.
5. Where a leading string lies in several ranges, the first place of each string in its range is compared across them.

The texts cross the network once (the same exchange serves steps 1, 3 and the end), hashes once, stretches of repeated
anchors once. No step holds more than a block, a range, or one document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nestframe.llm.bytesets import buffer_of, mix, ranges, spans_of
from nestframe.operators.durable import durable

GRAM = 32
LEAD = 16
NO_ID = -(2**63)
_LOW = np.uint64((1 << 24) - 1)


def remove_repeats(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = 100,
    block_bytes: int = 4 << 20,
    sampled_documents: int = 1000,
    splitters: list[bytes] | None = None,
    range_blocks: int = 4096,
) -> DataFrame:
    """``id, n_bytes, kept (binary), spans (array of removed start and end)``, a row per document.

    A null text is empty. A null id comes before all others. Rows with the same id are told apart by their text,
    the smaller one coming first; rows with the same id and text are one document, and each of them gets its result.
    Texts shorter than ``length`` keep all. Other columns are not looked at. ``length`` is 64 at least. The number of
    sampled documents bounds what the splitters are taken from, nothing else. An anchor found in more than
    ``range_blocks`` blocks is spread over as many ranges as that takes.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be {2 * GRAM} at least")
    texts = documents.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    size, count = texts.select(F.sum(F.octet_length("text")), F.count("*")).first()
    blocks = max(1, -(-(size or 0) // block_bytes))
    if splitters is None:
        splitters = _splitters(texts, min(1.0, sampled_documents / max(count, 1)), blocks, length)
    texts = _numbered(texts).select(
        F.pmod(F.xxhash64("id", "seq"), F.lit(blocks)).cast("int").alias("block"), "id", "seq", "copies", "text"
    )

    hashes = texts.groupBy("block").applyInArrow(_block_hashes(length), "hash long, block int, twice boolean")
    same = Window.partitionBy("hash")
    known = (
        hashes.withColumn("blocks", F.count("*").over(same)).withColumn("any_twice", F.max("twice").over(same))
        .where("blocks > 1 OR any_twice")
        .select("block", "hash", F.ceil(F.col("blocks") / range_blocks).cast("int").alias("slices"))
    )
    stretches = (
        texts.groupBy("block")
        .cogroup(known.groupBy("block"))
        .applyInArrow(_stretches(length, splitters, -(-blocks // (len(splitters) + 1))), _STRETCH)
    )
    found = stretches.groupBy("range").applyInArrow(_compare(length), _FOUND)
    # Without a digest a row is a finding; with one it is the first place in its range, to be compared across ranges.
    across = Window.partitionBy(
        F.coalesce("digest", F.concat_ws(":", "block", "id", "seq", "start").cast("binary"))
    ).orderBy("id", "seq", "start")
    repeats = (
        found.withColumn("place", F.row_number().over(across))
        .where("digest IS NULL OR place > 1")
        .select("block", "id", "seq", "start", "n")
    )
    result = texts.groupBy("block").cogroup(repeats.groupBy("block")).applyInArrow(_remove(length), _RESULT)
    copies = F.explode(F.sequence(F.lit(1), "copies")).alias("copy")
    return result.select("*", copies).select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias(id_column), "n_bytes", "kept", "spans"
    )


def _numbered(texts: DataFrame) -> DataFrame:
    """``id, seq, copies, text``, a row per document. ``seq`` sorts the documents of one id as their texts do.

    Ids that come once, as they should, are 0 in it. The others' documents are sorted by id and text, however many
    have the same id, and their numbers written, as another run of the sort could give others.
    """
    several = texts.groupBy("id").count().where("count > 1").select("id")
    once = texts.select("id", F.lit(0).cast("long").alias("seq"), F.lit(1).cast("long").alias("copies"), "text")
    if several.isEmpty():
        return once
    several = durable(several)
    documents = texts.join(several, "id", "left_semi").groupBy("id", "text").agg(F.count(F.lit(1)).alias("copies"))
    sorted_once = documents.orderBy("id", "text").withColumn("seq", F.monotonically_increasing_id())
    return once.join(several, "id", "left_anti").unionByName(durable(sorted_once.select(*once.columns)))


_STRETCH = "range int, block int, id long, seq long, start int, n int, shift int, shared boolean, bytes binary"
_FOUND = "block int, id long, seq long, start int, n int, digest binary"
_RESULT = "id long, copies long, n_bytes long, kept binary, spans array<struct<start: int, end: int>>"


class _Block:
    """The documents of a block in order, as one buffer."""

    def __init__(self, table: pa.Table):
        ids, seq = table.column("id").to_numpy(), table.column("seq").to_numpy()
        order = np.lexsort((seq, ids))
        self.ids, self.seq, self.copies = ids[order], seq[order], table.column("copies").to_numpy()[order]
        texts = table.column("text").cast(pa.large_binary()).to_pylist()
        texts = [texts[i] for i in order.tolist()]
        self.starts = np.cumsum([0, *map(len, texts)])
        self.ends, self.starts = self.starts[1:], self.starts[:-1]
        self.data = np.frombuffer(b"".join(texts), np.uint8)


def anchors(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, chunk: int = 1 << 20
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``document, start, n, anchor, hash``: the strings starting at start ... start + n - 1 have that anchor.

    Which place is the anchor follows from the string's bytes alone: the leftmost of the smallest 40-bit hashes.
    """
    width = length - GRAM + 1
    parts = []
    usable = np.flatnonzero(ends - starts >= length)
    starts, ends = starts[usable], ends[usable]
    for base in range(0, len(data), chunk):
        piece = data[base : base + chunk + length - 1]
        if len(piece) < length:
            continue
        hashes = (piece.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        span = 1
        while span < GRAM:
            hashes = mix(hashes[:-span] * np.uint64(0xD6E8FEB86659FD93) + hashes[span:])
            span *= 2
        best = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
        span = 1
        while span * 2 <= width:
            best = np.minimum(best[:-span], best[span:])
            span *= 2
        if span < width:
            best = np.minimum(best[: len(best) - (width - span)], best[width - span :])
        place = (best & _LOW).astype(np.int64)
        edge = np.ones(len(place), bool)
        edge[1:] = place[1:] != place[:-1]
        inner = starts[(starts >= base) & (starts < base + len(place))] - base
        edge[inner] = True
        run = np.flatnonzero(edge)
        owner = np.searchsorted(starts, run + base, side="right") - 1
        limit = np.where(owner >= 0, ends[np.maximum(owner, 0)] - length + 1 - base, 0)
        stop = np.minimum(np.append(run[1:], len(place)), limit)
        good = stop > run
        run, stop, owner = run[good], stop[good], owner[good]
        parts.append((usable[owner], run + base, stop - run, place[run] + base, hashes[place[run]]))
    if not parts:
        return tuple(np.zeros(0, kind) for kind in (np.int64, np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(column) for column in zip(*parts, strict=True))


def multikey_runs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings and, for each place in it, the number of its run of equal strings.

    Multikey quicksort with characters of eight bytes: each open partition is sorted by the character at its depth,
    and the parts that are equal there are the open partitions of the next depth. All partitions of a depth go
    together, so each depth is one vectorised sort. Equal strings keep their order.
    """
    count = len(starts)
    order = np.arange(count)
    new_run = np.zeros(count, bool)
    if not count:
        return order, new_run.astype(np.int64)
    new_run[0] = True
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    words = np.ndarray((len(padded) - 7,), ">u8", padded, strides=(1,))
    slots = order.copy()
    partition = np.zeros(count, np.int64)
    depth = 0
    while len(slots):
        item = order[slots]
        left = lengths[item] - depth
        character = words[np.minimum(starts[item] + depth, len(words) - 1)].astype(np.uint64)
        cut = np.clip(8 - left, 0, 8).astype(np.uint64)
        character = np.where(cut >= 8, np.uint64(0), character >> (cut * np.uint64(8) % np.uint64(64)) << (cut * np.uint64(8) % np.uint64(64)))
        # Zero bytes at the end of a string are told from its end by what is left of it.
        sort = np.lexsort((np.minimum(left, 8), character, partition))
        item, partition, character, left = item[sort], partition[sort], character[sort], np.minimum(left[sort], 8)
        order[slots] = item
        step = np.ones(len(slots), bool)
        step[1:] = (partition[1:] != partition[:-1]) | (character[1:] != character[:-1]) | (left[1:] != left[:-1])
        new_run[slots[step]] = True
        first, last = np.flatnonzero(step), np.append(np.flatnonzero(step)[1:], len(step))
        open_run = (last - first > 1) & (left[first] >= 8)
        take = np.repeat(open_run, last - first)
        partition = np.repeat(np.arange(len(first)), last - first)[take]
        slots = slots[take]
        depth += 8
    return order, np.cumsum(new_run) - 1


def _splitters(texts: DataFrame, fraction: float, parts: int, length: int) -> list[bytes]:
    """Leading bytes of sampled anchors, so chosen that each of ``parts`` ranges has as many."""

    def leads(batches):
        for batch in batches:
            data, starts, ends = buffer_of(batch.column(0))
            for place in range(len(starts)):
                text = data[starts[place] : ends[place]]
                at = anchors(text, np.array([0]), np.array([len(text)]), length)[3]
                at = at[:: max(1, len(at) // 100)]
                yield pa.RecordBatch.from_pydict({"lead": pa.array([text[i : i + LEAD].tobytes() for i in at], pa.binary())})

    if parts == 1:
        return []
    rows = texts.select("text").sample(fraction, seed=11).mapInArrow(leads, "lead binary").collect()
    found = sorted(bytes(row.lead) for row in rows)
    parts = min(parts, max(1, len(found) // 8))
    return [found[len(found) * i // parts] for i in range(1, parts)] if found else []


def _block_hashes(length: int) -> Callable[[pa.Table], pa.Table]:
    def name(table: pa.Table) -> pa.Table:
        block = _Block(table)
        hashes = anchors(block.data, block.starts, block.ends, length)[4]
        value, count = np.unique(hashes, return_counts=True)
        number = np.full(len(value), table.column("block")[0].as_py(), np.int32)
        return pa.table({"hash": value.view(np.int64), "block": number, "twice": count > 1})

    return name


def _stretches(length: int, splitters: list[bytes], fan: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    limits = np.array(splitters, f"S{LEAD}")

    def cut(texts: pa.Table, known: pa.Table) -> pa.Table:
        if not texts.num_rows or not known.num_rows:
            return _table([], _STRETCH_TYPES)
        block = _Block(texts)
        number = texts.column("block")[0].as_py()
        document, start, n, anchor, hashes = anchors(block.data, block.starts, block.ends, length)
        wanted = known.column("hash").to_numpy().view(np.uint64)
        order = np.argsort(wanted)
        at = order[np.minimum(np.searchsorted(wanted, hashes, sorter=order), len(wanted) - 1)]
        live = np.flatnonzero(wanted[at] == hashes)
        document, start, n, anchor, hashes = document[live], start[live], n[live], anchor[live], hashes[live]
        slices = known.column("slices").to_numpy()[at[live]].astype(np.uint64)
        whole = block.data.tobytes()
        seen: dict[bytes, int] = {}
        repeated = np.zeros(len(live), bool)
        pieces = []
        for i, (a, size) in enumerate(zip(start.tolist(), (n + length - 1).tolist(), strict=True)):
            piece = whole[a : a + size]
            repeated[i] = seen.setdefault(piece, i) != i
            if not repeated[i]:
                pieces.append(piece)
        # Findings need no comparing: neighbours become one, and they are dealt out evenly.
        again = np.flatnonzero(repeated)
        opens = np.ones(len(again), bool)
        opens[1:] = start[again][1:] != (start + n)[again][:-1]
        ends = (start + n)[again][np.append(opens[1:], True)] if len(again) else start[:0]
        again = again[opens]
        first = np.flatnonzero(~repeated)
        lead = np.array([whole[a : a + LEAD] for a in anchor[first].tolist()], f"S{LEAD}")
        low, high = np.searchsorted(limits, lead, "left"), np.searchsorted(limits, lead, "right")
        spread = mix((block.ids + block.seq)[document[first]].view(np.uint64) + start[first].astype(np.uint64))
        shared = high - low > 1
        within = (spread % np.maximum(high - low, 1).astype(np.uint64)).astype(np.int64)
        # Where there are fewer splitters than blocks, a hash of the leading bytes deals each range further.
        target = np.where(shared, low + within, low) * fan
        if fan > 1 and len(first):
            halves = lead.view(np.uint64).reshape(-1, 2)
            target += (mix(halves[:, 0] ^ mix(halves[:, 1])) % np.uint64(fan)).astype(np.int64)
        total = (len(limits) + 1) * fan
        sliced = slices[first] > 1
        dealt = mix(hashes[first] + spread % slices[first]) % np.uint64(total)
        target, shared = np.where(sliced, dealt.astype(np.int64), target), shared | sliced
        rows = np.concatenate((first, again))
        return _table(
            [
                np.concatenate((target, np.full(len(again), number % total))),
                np.full(len(rows), number),
                block.ids[document[rows]],
                block.seq[document[rows]],
                start[rows] - block.starts[document[rows]],
                np.concatenate((n[first], ends - start[again])),
                anchor[rows] - start[rows],
                np.concatenate((shared, np.zeros(len(again), bool))),
                pieces + [None] * len(again),
            ],
            _STRETCH_TYPES,
        )

    return cut


_STRETCH_TYPES = {
    "range": pa.int32(), "block": pa.int32(), "id": pa.int64(), "seq": pa.int64(), "start": pa.int32(),
    "n": pa.int32(), "shift": pa.int32(), "shared": pa.bool_(), "bytes": pa.binary(),
}
_FOUND_TYPES = {
    "block": pa.int32(), "id": pa.int64(), "seq": pa.int64(), "start": pa.int32(), "n": pa.int32(), "digest": pa.binary(),
}


def _table(columns: list, types: dict) -> pa.Table:
    if not columns:
        return pa.table({name: pa.array([], kind) for name, kind in types.items()})
    return pa.table({n: pa.array(c).cast(k) if isinstance(c, np.ndarray) else pa.array(c, k) for (n, k), c in zip(types.items(), columns, strict=True)})


def _compare(length: int) -> Callable[[pa.Table], pa.Table]:
    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("id", "ascending"), ("seq", "ascending"), ("start", "ascending")])
        known = table.filter(pc.is_null(table.column("bytes"))).select(["block", "id", "seq", "start", "n"])
        table = table.filter(pc.is_valid(table.column("bytes")))
        data, begin, end = buffer_of(table.column("bytes"))
        n, shift = table.column("n").to_numpy(), table.column("shift").to_numpy()
        shared = np.asarray(table.column("shared").combine_chunks())
        repeated = np.zeros(table.num_rows, bool)
        order, run = multikey_runs(data, begin, end - begin)
        repeated[order[1:]] = run[1:] == run[:-1]
        # Strings are compared one by one only where different stretches share their anchor's bytes.
        first = np.flatnonzero(~repeated)
        order, run = multikey_runs(data, begin[first] + shift[first], np.full(len(first), GRAM))
        alike = np.zeros(len(first), bool)
        alike[order] = np.bincount(run, minlength=1)[run] > 1 if len(run) else False
        rows = first[alike | shared[first]]
        string = ranges(begin[rows], n[rows])
        row = np.repeat(rows, n[rows])
        again = np.zeros(len(string), bool)
        order, run = multikey_runs(data, string, np.full(len(string), length))
        again[order[1:]] = run[1:] == run[:-1]
        # Runs of strings that come again, cut where the next stretch begins.
        opens = again.copy()
        if len(again):
            opens[1:] &= ~again[:-1] | (row[1:] != row[:-1])
            closes = again.copy()
            closes[:-1] &= ~again[1:] | (row[1:] != row[:-1])
            a, z = np.flatnonzero(opens), np.flatnonzero(closes)
        else:
            a = z = np.zeros(0, np.int64)
        parts = [_found(table, np.flatnonzero(repeated), 0, n[repeated], None)]
        parts.append(_found(table, row[a], string[a] - begin[row[a]], z - a + 1, None))
        edge = np.flatnonzero(~again & shared[row]) if len(again) else a[:0]
        digests = [hashlib.blake2b(data[s : s + length].tobytes(), digest_size=16).digest() for s in string[edge]]
        parts.append(_found(table, row[edge], string[edge] - begin[row[edge]], np.ones(len(edge), np.int32), digests))
        known = known.append_column("digest", pa.nulls(known.num_rows, pa.binary()))
        return pa.concat_tables([known.cast(parts[0].schema), *parts])

    return compare


def _found(table: pa.Table, rows: np.ndarray, offset: np.ndarray | int, n: np.ndarray, digests: list | None) -> pa.Table:
    column = lambda name: table.column(name).to_numpy()[rows]
    return _table(
        [column("block"), column("id"), column("seq"), column("start") + offset, n, digests or [None] * len(rows)],
        _FOUND_TYPES,
    )


def _remove(length: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def remove(texts: pa.Table, repeats: pa.Table) -> pa.Table:
        block = _Block(texts)
        place = {key: i for i, key in enumerate(zip(block.ids.tolist(), block.seq.tolist(), strict=True))}
        change = np.zeros(len(block.data) + 1, np.int32)
        if repeats.num_rows:
            row = np.array([place[key] for key in zip(repeats.column("id").to_pylist(), repeats.column("seq").to_pylist(), strict=True)])
            first = block.starts[row] + repeats.column("start").to_numpy()
            np.add.at(change, first, 1)
            np.add.at(change, first + repeats.column("n").to_numpy() + length - 1, -1)
        gone = np.cumsum(change[:-1]) > 0
        results = []
        for i in range(len(block.ids)):
            flags = gone[block.starts[i] : block.ends[i]]
            a, z = spans_of(flags) if flags.any() else ((), ())
            kept = block.data[block.starts[i] : block.ends[i]]
            kept = kept[~flags].tobytes() if len(a) else kept.tobytes()
            results.append((len(flags), kept, [{"start": s, "end": e} for s, e in zip(a, z, strict=True)]))
        return pa.table(
            {
                "id": block.ids,
                "copies": block.copies,
                "n_bytes": pa.array([r[0] for r in results], pa.int64()),
                "kept": pa.array([r[1] for r in results], pa.binary()),
                "spans": pa.array([r[2] for r in results], kind),
            }
        )

    return remove
