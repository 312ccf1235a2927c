"""A Merkle manifest of rows: one tree per group, one tree over the groups' roots, and a version for each changed leaf.

The tree is persistent: a change makes a version that shares every node it leaves untouched and has copies of the
ancestors of its leaf only. Runs of 16 nodes become one node of the next level, so three levels make aligned blocks of
4096 leaves: a task builds a block from its rows and hands on the block's node, and so on with blocks of these, as long
as trees have more than one node. Downwards, each block learns the nodes beside its ancestors, as text to their left and
right by level. They are the same for all leaves of a block; versions stay where their leaf's block is, copy their path
within it, and continue it upwards over the shared nodes, spread over as many tasks as there are blocks of leaves.

Groups are numbered by slices of a sort over the cluster, so that a group with most of the rows is many tasks' work.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce
from hashlib import sha256
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from nestframe.operators.durable import durable

#: Nodes that become one of the next level.
FANOUT = 16
#: Levels that a task builds.
LEVELS = 3
_NODE = "tree string, pos long, n long, digest string"
_PATH = "path array<string>, subroot string, root string"
_HEAD = f"tree string, block long, {_PATH}"


def framed(column: Column) -> Column:
    """A value as text that cannot run into the next: its bytes counted, a colon and itself; a dash for null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    """The leaf of a row with these values."""
    return F.sha2(F.concat(*map(framed, columns)), 256)


def lower_ascii(column: Column) -> Column:
    """The text with the letters A to Z, and no others, in lower case."""
    return F.translate(column, ascii_uppercase, ascii_lowercase)


def manifest(
    leaves: DataFrame, order: Sequence[str] = ("id",), fanout: int = FANOUT, levels: int = LEVELS
) -> DataFrame:
    """The proof of each leaf, and the version that its change makes.

    ``leaves`` has ``id``, ``group`` (text), ``leaf`` (a digest as hexadecimal text) and ``changed`` (another one, or
    null). Leaves of a group ascend by ``order`` and then by digest, nulls first, so that ties are equal rows; a null
    group is a group of its own, before the others. The result has ``id, leaf, subroot, root`` (of group and of all),
    ``proof`` (digest of the nodes beside the leaf's ancestors, left to right, from the leaf up), ``copies`` (the nodes
    the version of a changed leaf has for itself, the leaf first and its root last; null without a change) and ``folded``
    (the root made from the changed leaf, or else from the leaf, and its proof's nodes). No rows give no rows; other
    columns are not looked at.

    Sorted slices and the nodes of every third level are written to the shared folder, so lost tasks find the same.
    """
    size = fanout**levels
    tree = F.coalesce(F.concat(F.lit("="), F.col("group").cast("string")), F.lit(""))
    rows = durable(leaves.select(tree.alias("tree"), *dict.fromkeys(["id", *order]), "leaf", "changed"))
    rows = _numbered(rows, [*order, "leaf", "changed"]).withColumnRenamed("leaf", "digest")
    rows = durable(rows.select("tree", "pos", "n", "digest", "changed", "id"))

    groups = _climb_all(rows.select("tree", "pos", "n", "digest"), fanout, levels, size)
    tops = _union([stage.where("n = 1").select("tree", "digest", F.lit(i).alias("stage")) for i, stage in enumerate(groups) if i])
    tops = durable(tops)
    over = _numbered(tops.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest", "stage"), ["of"])
    over = durable(over.select("tree", "pos", "n", "digest", "of", "stage"))
    above = _climb_all(over.select("tree", "pos", "n", "digest"), fanout, levels, size)

    # Downwards: first through the tree over the groups, whose root has nothing beside it, then through the groups.
    nothing = F.array().cast("array<string>").alias("path")
    root = F.col("digest").alias("root")
    heads = above[-1].select("tree", F.col("pos").alias("block"), nothing, F.lit(None).cast("string").alias("subroot"), root)
    for stage in reversed(above[1:-1]):
        heads = _descend(stage.where("n > 1"), heads, fanout, levels, size)
    paths = durable(_descend(over.select("tree", "pos", "n", "digest"), heads, fanout, levels, size))
    entries = over.join(paths.select(F.col("block").alias("pos"), "path", "root"), "pos")
    entries = durable(
        entries.select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("block"), "path", F.col("digest").alias("subroot"), "root", "stage")
    )
    heads = None
    for number in reversed(range(len(groups) - 1)):
        top = entries.where(F.col("stage") == number + 1).drop("stage")
        heads = top if heads is None else heads.unionByName(top)
        if number:
            heads = durable(_descend(groups[number].where("n > 1"), heads, fanout, levels, size))

    kind = rows.schema["id"].dataType.simpleString()
    blocks = _blocks(rows, heads, size, "changed", "id")
    result = f"id {kind}, leaf string, subroot string, root string, proof string, copies array<string>, folded string"
    return blocks.mapInArrow(_each_block(_proved(fanout, levels), result), result)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``pos``, the place of a row in its tree, and ``n``, the rows of the tree, by slices of a sort of all rows."""
    ordering = ["tree", *order]
    sliced = durable(
        rows.repartitionByRange(*ordering)
        .sortWithinPartitions(*ordering)
        .select("*", F.spark_partition_id().alias("slice"), F.monotonically_increasing_id().alias("row"))
    )
    runs = sliced.groupBy("tree", "slice").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    earlier = Window.partitionBy("tree").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    shifts = runs.select("tree", "slice", (before - F.col("first")).alias("shift"), F.sum("n").over(Window.partitionBy("tree")).alias("n"))
    placed = sliced.join(shifts, ["tree", "slice"])
    return placed.withColumn("pos", F.col("row") + F.col("shift")).drop("slice", "row", "shift")


def _climb_all(nodes: DataFrame, fanout: int, levels: int, size: int) -> list[DataFrame]:
    """The nodes given, those of their blocks, those of the blocks of these, until all trees have only one."""
    stages = [nodes]
    while True:
        blocks = _blocks(stages[-1].where("n > 1") if len(stages) > 1 else stages[-1], None, size)
        stages.append(durable(blocks.mapInArrow(_each_block(_climbed(fanout, levels), _NODE), _NODE)))
        if stages[-1].where("n > 1").isEmpty():
            return stages


def _descend(nodes: DataFrame, heads: DataFrame, fanout: int, levels: int, size: int) -> DataFrame:
    """What is beside the ancestors of each node, the heads of the blocks below, from the heads of the nodes' blocks."""
    return _blocks(nodes, heads, size).mapInArrow(_each_block(_passed_on(fanout, levels), _HEAD), _HEAD)


def _blocks(nodes: DataFrame, heads: DataFrame | None, size: int, *more: str) -> DataFrame:
    """Nodes dealt by block and in order, the block's head before them."""
    fields = {f.name: f.dataType for f in nodes.schema}
    block = F.floor(F.col("pos") / size).cast("long").alias("block")
    rows = nodes.select("tree", block, "pos", "n", "digest", *more)
    if heads is not None:
        absent = [F.lit(None).cast(fields[name]).alias(name) for name in ("pos", "n", "digest", *more)]
        first = heads.select("tree", "block", *absent, "path", "subroot", "root")
        missing = [F.lit(None).cast(kind).alias(name) for name, kind in (("path", "array<string>"), ("subroot", "string"), ("root", "string"))]
        rows = rows.select("*", *missing).unionByName(first)
    # A head has no place and so comes first.
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")


def _each_block(work: Callable[[list[dict]], list[tuple]], result: str) -> Callable:
    """A function for ``mapInArrow`` that hands whole blocks to ``work``, however they lie in batches."""
    schema = to_arrow_schema(StructType.fromDDL(result))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) or [()] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        held: pa.Table | None = None
        for part in batches:
            rows = pa.Table.from_batches([part])
            if not rows.num_rows:
                continue
            rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
            tree, block = rows.column("tree"), rows.column("block")
            new = pc.or_(pc.not_equal(tree[1:], tree[:-1]), pc.not_equal(block[1:], block[:-1]))
            cuts = [0, *(np.flatnonzero(np.asarray(new)) + 1).tolist()]
            held = rows.slice(cuts[-1])
            if len(cuts) > 1:
                whole = rows.slice(0, cuts[-1]).to_pylist()
                yield batch([row for a, b in zip(cuts, cuts[1:], strict=False) for row in work(whole[a:b])])
        if held is not None:
            yield batch(work(held.to_pylist()))

    return run


def _digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _levels_of(nodes: list[dict], fanout: int, levels: int) -> list[list[str]]:
    """The block's nodes by level: all levels of a block, or if the tree is no larger than one, up to its root."""
    built = [[node["digest"] for node in nodes]]
    whole = nodes[0]["n"] <= fanout**levels
    while len(built[-1]) > 1 if whole else len(built) <= levels:
        last = built[-1]
        built.append([_digest("".join(last[i : i + fanout])) for i in range(0, len(last), fanout)])
    return built


def _beside(built: list[list[str]], place: int, fanout: int) -> list[str]:
    """The nodes to the left and right of a leaf's ancestors in the block, two texts for each level."""
    texts = []
    for nodes in built[:-1]:
        begin = place - place % fanout
        texts += ["".join(nodes[begin:place]), "".join(nodes[place + 1 : begin + fanout])]
        place //= fanout
    return texts


def _climbed(fanout: int, levels: int) -> Callable[[list[dict]], list[tuple]]:
    def work(nodes: list[dict]) -> list[tuple]:
        first = nodes[0]
        return [(first["tree"], first["block"], -(-first["n"] // fanout**levels), _levels_of(nodes, fanout, levels)[-1][0])]

    return work


def _passed_on(fanout: int, levels: int) -> Callable[[list[dict]], list[tuple]]:
    def work(rows: list[dict]) -> list[tuple]:
        head, *nodes = rows
        built = _levels_of(nodes, fanout, levels)
        return [
            (node["tree"], node["pos"], [*_beside(built, i, fanout), *head["path"]], head["subroot"], head["root"])
            for i, node in enumerate(nodes)
        ]

    return work


def _proved(fanout: int, levels: int) -> Callable[[list[dict]], list[tuple]]:
    def work(rows: list[dict]) -> list[tuple]:
        head, *nodes = rows
        built = _levels_of(nodes, fanout, levels)
        above = "".join(head["path"]).encode()
        found = []
        for i, node in enumerate(nodes):
            path = _beside(built, i, fanout)
            proof = sha256("".join(path).encode())
            proof.update(above)
            path += head["path"]
            copies = [node["changed"] or node["digest"]]
            for left, right in zip(path[::2], path[1::2], strict=True):
                copies.append(_digest(left + copies[-1] + right))
            changed = copies if node["changed"] else None
            found.append((node["id"], node["digest"], head["subroot"], head["root"], proof.hexdigest(), changed, copies[-1]))
        return found

    return work
