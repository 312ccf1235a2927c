"""Near duplicates by DartMinHash signatures, banded joining and an exact check.

A document is the set of its shingles (runs of five words, ASCII case ignored; all its words if there are fewer).
``signatures`` takes weighted sets, in which a shingle found c times weighs 1 + log2(c) / 8. Darts fall on the plane of weight
and rank as a Poisson process that depends on the shingle alone: the region of its i-th repeat, as wide as that repeat
weighs, gets hashed exponential waiting times. A document keeps the darts below a rank at which it expects about
k ln k + 2k of them, whatever its size, deals them to k coordinates by hash, and the earliest dart of each coordinate
is the signature. Should a coordinate stay empty, the rank doubles. Two signatures agree in a coordinate with the
probability of the weighted Jaccard similarity.

Five coordinates make a band, 25 bands a signature: a pair at 0.8 shares a band but in 1 of 20,000 cases. Links take
each shingle once, so a text that repeats shingles has the bands of its signature without repeats as well, which are
those it shares with texts that repeat others or none.

Copies count once. Each bucket of a band pairs its members with one of them, chosen by lot in every bucket, and each
text is checked against the two likeliest of those it met. Where a bucket then still holds several components, what is
outside the largest is compared with all that is not of its component; members of one component need no further link.
So copies in a bucket cost as many checks as there are copies, and yet every pair that shares a bucket is checked or
already connected. Most of the last comparisons end inside the join: the parities of 1024 counters tell in how many
shingles two sets differ at least. The check compares whole shingle sets (32-bit hashes): a link is a plain Jaccard
similarity of ``threshold`` or more. Texts that share buckets with a large group and are similar to none of it cost one
comparison of parities with each of its members; no exact method is known to spare these.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nestframe.llm.bytesets import batched, buffer_of, mix, shingles
from nestframe.llm.components import components
from nestframe.operators.durable import durable

NO_ID = -(2**63)
#: Words of 64 bits in a sketch.
SKETCH = 16


def near_duplicates(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: float = 0.8,
    width: int = 5,
    bands: int = 25,
    rows: int = 5,
) -> DataFrame:
    """``id, class_id, n_members, n_texts``, a row per document.

    ``class_id`` is the smallest id of the documents that are linked, directly or in steps; ``n_members`` counts them,
    ``n_texts`` their different texts. Links themselves are not counted: members of a class need not all be compared.
    A null id comes before all others.
    A null text or one without words is in no relation to others, copies of it included: its class is its own id.
    """
    classes = _classes(documents, id_column, text_column, threshold, width, bands, rows)
    named = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(id_column if c == "id" else c)
    return classes.select(named("id"), named("class_id"), "n_members", "n_texts")


def keep_one(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The documents, all columns, without those of which a near duplicate with a smaller id is there.

    Of repeated rows (same id and text) one stays. Documents without words all stay.
    """
    classes = _classes(documents, id_column, text_column, **_defaults(options))
    first = classes.where("digest IS NOT NULL").groupBy("class_id").agg(F.min(F.struct("id", "digest")).alias("first"))
    first = first.select("first.*")
    names = documents.columns
    place = lambda c: F.col(f"_{names.index(c)}")
    # Columns by number: any name may be there already.
    plain = documents.toDF(*(f"_{i}" for i in range(len(names))))
    marked = plain.withColumn("id", F.coalesce(place(id_column).cast("long"), F.lit(NO_ID))).withColumn(
        "digest", F.when(place(text_column).rlike(_WORD), _digest(place(text_column)))
    )
    once = F.row_number().over(Window.partitionBy("digest", "id").orderBy("id"))
    kept = marked.where("digest IS NOT NULL").join(first, ["digest", "id"]).withColumn("copy", once).where("copy = 1")
    wordless = marked.where("digest IS NULL")
    columns = [f"_{i}" for i in range(len(names))]
    return kept.select(columns).unionByName(wordless.select(columns)).toDF(*names)


_WORD = "[^\\x20\\x09-\\x0D]"


def _defaults(options: dict) -> dict:
    return {"threshold": 0.8, "width": 5, "bands": 25, "rows": 5} | options


def _digest(text) -> F.Column:
    return F.unhex(F.md5(text))


def _classes(documents: DataFrame, id_column: str, text_column: str, threshold, width, bands, rows) -> DataFrame:
    texts = documents.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_column).alias("text")
    )
    texts = texts.select("id", F.when(F.col("text").rlike(_WORD), _digest(F.col("text"))).alias("digest"), "text")
    members = durable(texts.mapInArrow(batched(_sign(width, bands, rows), rows=256), "id long, digest binary, bands array<long>"))
    nodes = members.where("digest IS NOT NULL").groupBy("digest").agg(F.first("bands").alias("bands"))
    nodes = durable(nodes)
    entries = nodes.select("digest", F.explode(F.array_distinct("bands")).alias("bucket"))
    full = entries.groupBy("bucket").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).where("low <> high")
    placed = durable(entries.join(full.select("bucket"), "bucket", "left_semi").withColumnRenamed("digest", "node"))
    chosen = placed.select(F.col("node").alias("digest")).distinct()
    chosen = texts.select("digest", "text").join(chosen, "digest", "left_semi").dropDuplicates(["digest"])
    sets = "digest binary, size long, sketch array<long>, elements binary"
    sets = durable(chosen.mapInArrow(batched(_sets(width), rows=256), sets))

    links = durable(_check(_by_leader(placed), sets, threshold, most=2))
    roots = components(links)
    more = durable(_check(_all_apart(_mixed(placed, roots), sets, threshold), sets, threshold))
    if not more.isEmpty():
        links = durable(links.unionByName(more).distinct())
        roots = components(links)

    rooted = (
        members.select("id", "digest")
        .join(roots.withColumnRenamed("node", "digest"), "digest", "left")
        .select("id", "digest", F.coalesce("root", "digest").alias("root"))
    )
    # Copies are counted first, so that a class is summed up from its texts.
    by_text = rooted.where("digest IS NOT NULL").groupBy("root", "digest").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    classes = by_text.groupBy("root").agg(
        F.min("least").alias("class_id"), F.sum("n").alias("n_members"), F.count("*").alias("n_texts")
    )
    one = lambda c: F.coalesce(c, F.lit(1).cast("long")).alias(c)
    return rooted.join(classes, "root", "left").select(
        "id", "digest", F.coalesce("class_id", "id").alias("class_id"), one("n_members"), one("n_texts")
    )


def _by_leader(placed: DataFrame) -> DataFrame:
    """Each node with one of its bucket, which the hash of both chooses, so that buckets alike have different ones."""
    dice = F.struct(F.xxhash64("node", "bucket"), "node")
    leader = placed.groupBy("bucket").agg(F.min(dice)["node"].alias("leader"))
    pairs = placed.join(leader, "bucket").where("node <> leader")
    return pairs.select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()


def _mixed(placed: DataFrame, roots: DataFrame) -> DataFrame:
    """``bucket, node, root, main`` of the buckets that hold several components; ``main`` is the largest there."""
    rooted = placed.join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
    parts = rooted.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    parts = parts.groupBy("bucket").agg(F.count("*").alias("parts"), F.max(F.struct("n", "root"))["root"].alias("main"))
    return rooted.join(parts.where("parts > 1").drop("parts"), "bucket")


def _all_apart(mixed: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """All pairs of a bucket in different components that sizes and sketches do not rule out.

    Members of the largest component are not paired with each other.
    """
    known = sets.select(F.col("digest").alias("node"), "size", "sketch")
    left = durable(mixed.join(known, "node"))
    right = left.select(
        "bucket", *(F.col(c).alias(f"{c}_") for c in ("node", "root", "size", "sketch")), (F.col("root") == F.col("main")).alias("major")
    )
    minor = left.where("root <> main")
    apart = (F.col("root") != F.col("root_")) & _possible("size", "sketch", "size_", "sketch_", threshold)
    once = F.col("major") | (F.col("node") < F.col("node_"))
    pairs = minor.join(right, "bucket").where(apart & once)
    return pairs.select(F.least("node", "node_").alias("a"), F.greatest("node", "node_").alias("b")).distinct()


def _bits(sketch: str, other: str) -> F.Column:
    """In how many bits two sketches differ, and so in how many elements their sets do at least."""
    one = lambda i: F.bit_count(F.col(sketch)[i].bitwiseXOR(F.col(other)[i]))
    return sum((one(i) for i in range(1, SKETCH)), one(0))


def _possible(size: str, sketch: str, other_size: str, other_sketch: str, threshold: float) -> F.Column:
    """Whether sizes and sketches let the similarity be as high."""
    bits, both = _bits(sketch, other_sketch), F.col(size) + F.col(other_size)
    near = F.least(size, other_size) >= F.greatest(size, other_size) * threshold
    return near & (both - bits >= (both + bits) * threshold)


def _check(pairs: DataFrame, sets: DataFrame, threshold: float, most: int | None = None) -> DataFrame:
    """The pairs whose texts' shingle sets have the similarity.

    With ``most``, of the pairs that a node is first in only those as many with the nearest sketches are looked at;
    what this leaves out must be looked at otherwise.
    """
    known = lambda at: sets.select(
        F.col("digest").alias(at), F.col("size").alias(f"size_{at}"), F.col("sketch").alias(f"sketch_{at}")
    )
    pairs = pairs.join(known("b"), "b").join(known("a"), "a")
    pairs = pairs.where(_possible("size_a", "sketch_a", "size_b", "sketch_b", threshold))
    if most is not None:
        nearest = Window.partitionBy("a").orderBy(_bits("sketch_a", "sketch_b"), "b")
        pairs = pairs.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= most)
    pairs = pairs.select("a", "b")
    left = sets.select(F.col("digest").alias("a"), F.col("elements").alias("first"))
    right = sets.select(F.col("digest").alias("b"), F.col("elements").alias("second"))

    def similar(batches):
        for batch in batches:
            first, second = batch.column("first"), batch.column("second")
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x = np.frombuffer(first[i].as_buffer(), np.uint32)
                y = np.frombuffer(second[i].as_buffer(), np.uint32)
                both = np.concatenate((x, y))
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep[i] = common >= threshold * (len(x) + len(y) - common)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "first", "second")
    return joined.mapInArrow(similar, "a binary, b binary")


def weighted_shingles(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of each row in order of row and hash, repeats included: hash (44 bits), row, number of the repeat."""
    value, row = shingles(*buffer_of(table.column("text")), width)
    joined = (row.astype(np.uint64) << np.uint64(44)) | (value >> np.uint64(20))
    joined.sort()
    fresh = np.ones(len(joined), bool)
    fresh[1:] = joined[1:] != joined[:-1]
    at = np.arange(len(joined))
    repeat = at - np.maximum.accumulate(np.where(fresh, at, 0)) if len(joined) else at
    return joined & np.uint64((1 << 44) - 1), (joined >> np.uint64(44)).astype(np.int64), repeat


def signatures(value: np.ndarray, row: np.ndarray, repeat: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows that have shingles, and their signatures (rows x size, unsigned)."""
    span = np.ones(len(value))
    again = repeat > 0
    span[again] = np.log2((repeat[again] + 1) / repeat[again]) / 8
    rows, row = np.unique(row, return_inverse=True)
    weight = np.bincount(row, span, minlength=len(rows))
    region = mix(value + repeat.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    result = np.full(len(rows) * size, np.iinfo(np.uint64).max)
    height = (size * np.log(size) + 2 * size) / np.maximum(weight, 1e-9)
    todo = np.arange(len(rows))
    while len(todo):
        wanted = np.zeros(len(rows), bool)
        wanted[todo] = True
        here = wanted[row]
        dart, rank, owner, wide = region[here], np.zeros(here.sum()), row[here], span[here]
        darts, ranks, owners = [], [], []
        while len(dart):
            dart = mix(dart + np.uint64(0xE7037ED1A0B428DB))
            uniform = ((dart >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
            rank = rank - np.log(uniform) / wide
            low = rank < height[owner]
            dart, rank, owner, wide = dart[low], rank[low], owner[low], wide[low]
            darts.append(dart), ranks.append(rank), owners.append(owner)
        dart, rank, owner = (np.concatenate(x) for x in (darts, ranks, owners))
        name = mix(dart ^ np.uint64(0x589965CC75374CC3))
        slot = owner * size + (name % np.uint64(size)).astype(np.int64)
        earliest = np.full(len(result), np.inf)
        np.minimum.at(earliest, slot, rank)
        first = rank == earliest[slot]
        of_todo = (todo[:, None] * size + np.arange(size)).reshape(-1)
        result[of_todo] = np.iinfo(np.uint64).max
        np.minimum.at(result, slot[first], name[first])
        todo = todo[np.isinf(earliest[of_todo].reshape(-1, size)).any(axis=1)]
        height[todo] *= 2
    return rows, result.reshape(-1, size)


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1)))


def _sign(width: int, bands: int, rows: int) -> Callable[[pa.Table], pa.Table]:
    def buckets(shingle: np.ndarray, row: np.ndarray, repeat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        filled, signature = signatures(shingle, row, repeat, bands * rows)
        value = np.zeros((len(filled), bands), np.uint64)
        for i in range(rows):
            value = mix(value * np.uint64(5) + signature[:, i::rows])
        return filled, mix(value + np.arange(bands, dtype=np.uint64)).view(np.int64)

    def sign(table: pa.Table) -> pa.Table:
        shingle, row, repeat = weighted_shingles(table, width)
        weighted, of_weights = buckets(shingle, row, repeat)
        # Without repeats both signatures are the same.
        once = np.isin(row, row[repeat > 0]) & (repeat == 0)
        plain, of_sets = buckets(shingle[once], row[once], repeat[once])
        filled = np.concatenate((weighted, plain))
        value = np.concatenate((of_weights, of_sets))[np.argsort(filled, kind="stable")]
        return pa.table(
            {
                "id": table.column("id"),
                "digest": table.column("digest"),
                "bands": _lists(value, np.bincount(filled, minlength=table.num_rows) * bands),
            }
        )

    return sign


def _sets(width: int) -> Callable[[pa.Table], pa.Table]:
    def collect(table: pa.Table) -> pa.Table:
        shingle, row, repeat = weighted_shingles(table, width)
        shingle, row = shingle[repeat == 0] >> np.uint64(12), row[repeat == 0]
        size = np.bincount(row, minlength=table.num_rows)
        # A bit of the sketch is the parity of the number of elements that fall on it.
        at = row * (64 * SKETCH) + (shingle % np.uint64(64 * SKETCH)).astype(np.int64)
        parity = np.bincount(at, minlength=table.num_rows * 64 * SKETCH) & 1
        sketch = np.packbits(parity.astype(np.uint8).reshape(table.num_rows, -1), axis=1).view(np.int64)
        offsets = np.concatenate(([0], np.cumsum(size) * 4)).astype(np.int32)
        elements = pa.py_buffer(shingle.astype(np.uint32))
        return pa.table(
            {
                "digest": table.column("digest"),
                "size": size,
                "sketch": _lists(sketch, np.full(table.num_rows, SKETCH)),
                "elements": pa.Array.from_buffers(pa.binary(), table.num_rows, [None, pa.py_buffer(offsets), elements]),
            }
        )

    return collect
