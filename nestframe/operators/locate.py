"""Where two sets of documents differ: digests of all that is below each row, compared from the root down."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestframe.functions.keys import row_text
from nestframe.operators.durable import durable
from nestframe.plans.layout import POS, Kind, Table
from nestframe.plans.tables import DocumentTables

_POSITION = T.StructField(POS, T.LongType())
# Places for owners to set a bit at, a power of two.
_BITS = 1 << 26


def digest_tree(tables: DocumentTables) -> dict[str, DataFrame]:
    """By table ``key, parent, pos, a, b`` and ``below_0, below_1...`` of its rows.

    ``a, b`` are two hashes of a row's attributes and position, ``below_i`` stands for all rows of
    the i-th child table and what is below them: hashes of a count and of sums of the halves of two hashes, so
    that rows are added up before they are shuffled and a long list weighs no more there than a short one.

    Rows with tables below them are written once. Of a table with none, which has by far the most rows,
    only what they come to for each owner is written; the rows are hashed again if they are looked at.
    """
    tree: dict[str, DataFrame] = {}

    def visit(table: Table) -> DataFrame:
        """What the rows of a table come to for each owner; of the root, its rows."""
        given = tables[table.name]
        if table.is_list and not tables.has_pos(table) or table.kind is not Kind.VALUES and not tables.has_key(table):
            raise ValueError(f"{table.name!r} has no keys or positions to name its rows by.")
        names = {"key": table.key if tables.has_key(table) else None, "parent": table.parent_key}
        rows = given.select(
            *((F.col(c) if c else F.lit(None)).cast("string").alias(name) for name, c in names.items()),
            (F.col(POS) if table.is_list else F.lit(None)).cast("long").alias("pos"),
            _own_hash(given, table, 0).alias("a"),
            _own_hash(given, table, 1).alias("b"),
        )
        none = F.struct(*(F.lit(0).cast("long").alias(name) for name in ("a", "b")))
        for name, child in zip(_below(table), table.children):
            sums = visit(child).withColumnRenamed("below", name)
            rows = rows.join(sums, "key", "left").withColumn(name, F.coalesce(name, none))
        tree[table.name] = rows = durable(rows) if table.children else rows
        if not table.parent:
            return rows
        whole = [F.xxhash64(F.lit(seed), "a", "b", *_below(table)) for seed in (0, 1)]
        # Sums of 32 bits each fit into a long for two thousand million rows, and are faster than decimals.
        halves = [half for h in whole for half in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF)))]
        counted = [F.count("*"), *(F.sum(half) for half in halves)]
        sums = rows.groupBy(F.col("parent").alias("key")).agg(
            F.struct(*(F.xxhash64(F.lit(seed), *counted).alias(name) for seed, name in enumerate("ab"))).alias("below")
        )
        return sums if table.children else durable(sums)

    visit(tables.layout)
    return tree


def _own_hash(rows: DataFrame, table: Table, seed: int) -> Column:
    """A hash of the attributes and position of a row; texts are hashed as they are, others as JSON."""
    names = [f.name for f in table.scalars]
    if all(rows.schema[name].dataType == T.StringType() for name in names):
        values = [part for n in names for part in (F.lit(n), F.isnull(f"`{n}`"), F.coalesce(f"`{n}`", F.lit("")))]
        pos = F.coalesce(F.col(POS).cast("long"), F.lit(-1)) if table.is_list else F.lit(-1)
        return F.xxhash64(F.lit(seed), *values, pos)
    return F.xxhash64(F.lit(seed), row_text([*table.scalars, *([_POSITION] if table.is_list else [])]))


def _below(table: Table) -> list[str]:
    return [f"below_{i}" for i in range(len(table.children))]


def locate_differences(expected: DocumentTables, actual: DocumentTables) -> DataFrame:
    """``document, path, key, pos, kind``: the rows that are ``missing``, ``extra`` or ``changed``.

    ``document`` is the root key, ``path`` the dotted attributes down to the table (empty for the
    root), ``key`` the row's key, or for values in lists, which go by position, that of the row
    they belong to. An object that one side lacks stands for all below it. Rows are compared by
    key, so keys must be natural or functions of the content, as those made here are; of a key that
    several rows have, what they hold together is compared. NULL equals NULL.

    Each table is read once for its digests. From there on only tables below rows whose digests differ are
    read, those with tables below them as written digests. Only rows below such rows, and few others, are
    shuffled; the rows of both sides are added up by key, not joined.
    """
    layout, trees = expected.layout, (digest_tree(expected), digest_tree(actual))
    found: list[DataFrame] = []

    def visit(table: Table, path: str, owners: DataFrame | None) -> None:
        below = _below(table)
        rows = reduce(
            DataFrame.unionByName,
            (tree[table.name].withColumn("sign", F.lit(sign)) for tree, sign in zip(trees, (1, -1))),
        )
        if owners is None:
            rows = rows.withColumn("document", F.col("key"))
        else:
            rows = _of_owners(rows, owners).join(owners.withColumnRenamed("key", "parent"), "parent")
        values = table.kind is Kind.VALUES
        sums = [_surplus(F.col(c)).alias(c) for c in ("a", "b")] + [_surplus(F.xxhash64(c)).alias(c) for c in below]
        compared = rows.groupBy("document", *(["parent", "pos"] if values else ["key"])).agg(
            *sums,
            F.count_if(F.col("sign") > 0).alias("n_expected"),
            F.count_if(F.col("sign") < 0).alias("n_actual"),
            *([] if values else [F.min("pos").alias("pos")]),
        )
        if values:
            compared = compared.withColumnRenamed("parent", "key")
        own = reduce(Column.__or__, (F.col(c) != 0 for c in ("a", "b")), F.col("n_expected") != F.col("n_actual"))
        compared = durable(compared.where(reduce(Column.__or__, (F.col(c) != 0 for c in below), own)))
        kind = F.when(F.col("n_actual") == 0, "missing").when(F.col("n_expected") == 0, "extra").otherwise("changed")
        found.append(compared.where(own).select("document", F.lit(path).alias("path"), "key", "pos", kind.alias("kind")))
        shared = compared.where("n_expected > 0 AND n_actual > 0")
        for name, child in zip(below, table.children):
            differing = shared.where(F.col(name) != 0).select("key", "document")
            if not differing.isEmpty():
                visit(child, f"{path}.{child.attr}".lstrip("."), differing)

    visit(layout, "", None)
    return reduce(DataFrame.unionByName, found)


def _of_owners(rows: DataFrame, owners: DataFrame) -> DataFrame:
    """The rows whose parent may be one of the owners, found without a shuffle; few others pass as well.

    Each owner sets a bit, and the bits, in at most a million longs however many owners there are, go to the rows.
    """

    def placed(frame: DataFrame, key: str) -> DataFrame:
        place = F.xxhash64(key).bitwiseAND(F.lit(_BITS - 1))
        return frame.withColumns({"_word": F.shiftright(place, 6), "_bit": place.bitwiseAND(F.lit(63)).cast("int")})

    set_ = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bit"))
    words = placed(owners, "key").groupBy("_word").agg(F.bit_or(set_).alias("_bits"))
    found = placed(rows, "parent").join(F.broadcast(words), "_word").where(F.getbit("_bits", "_bit") == 1)
    return found.select(*rows.columns)


def _surplus(hashed: Column) -> Column:
    return F.sum(hashed.cast("decimal(20,0)") * F.col("sign"))
