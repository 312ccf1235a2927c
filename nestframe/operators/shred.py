"""Nested documents -> flat, keyed tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestframe.functions.keys import child_key, path_key, row_key
from nestframe.operators.durable import durable
from nestframe.plans.layout import ITEM, PART, POS, Kind, Table, table_layout
from nestframe.plans.tables import DocumentTables


def shred(
    documents: DataFrame,
    root: str,
    key: str | Sequence[str] | None = None,
    model: T.StructType | str | None = None,
    names: Mapping[str, str] | None = None,
    keep_id: bool = False,
    drop_all_null: bool = False,
    bad_keys: str = "raise",
    keys: str = "digest",
) -> DocumentTables:
    """Takes documents apart into one table per object-valued or list-valued attribute.

    Every table is a lazy projection of ``documents``: no shuffle, and each reads only the columns
    it needs. ``key`` names the natural key of a document: one column that is used as it is, or
    several of which a digest is taken. Without a natural key the key is a digest of the whole row.
    Copies are then one document; the documents are shuffled to find them and written to the
    shared folder once.

    A natural key of one column must not be NULL, and no key may occur twice, or documents would be
    rebuilt with each other's lists. The keys, and nothing else, are counted for that when this is
    called. ``bad_keys`` says what happens to such documents: ``"raise"`` refuses all, ``"reject"``
    leaves them out, with their keys and the reason in ``rejected`` of the result, and ``"trust"``
    does not look, for documents that were grouped by their key.

    NULL objects and NULL list items that are objects make no row; ``drop_all_null`` also drops
    objects whose attributes are all NULL. NULL values in lists of values are kept. Documents in
    pieces, as ``assemble`` gives them, are taken apart as if they were whole, with ``key="id"`` or
    their natural key.

    Keys below the root are digests, or with ``keys="path"`` the paths to the objects: these sort as
    the documents do, and all below an object have keys that begin with its key.
    """
    if keys not in ("digest", "path"):
        raise ValueError(f"keys is 'digest' or 'path', not {keys!r}.")
    if bad_keys not in ("raise", "reject", "trust"):
        raise ValueError(f"bad_keys is 'raise', 'reject' or 'trust', not {bad_keys!r}.")
    pieces = PART in documents.columns
    if pieces and key is None:
        raise ValueError(f"Documents in pieces (column {PART!r}) need a key.")
    names_of = [f for f in documents.schema.fields if f.name != PART]
    layout = table_layout(model or T.StructType(names_of), root, names, keep_id)
    if key is None:
        # Written, or each table would look for the copies again.
        documents = durable(documents.distinct())
    if isinstance(key, str):
        root_key = F.col(key)
    else:
        root_key = row_key(documents.schema[name] for name in key or documents.columns)
    keyed = documents.select("*", root_key.alias(layout.key))
    part = F.split(F.coalesce(PART, F.lit("0")), "\\.").cast("array<int>") if pieces else None
    if pieces:
        keyed = keyed.withColumn(PART, part)
    first = keyed.where(F.col(PART) == F.array(F.lit(0))) if pieces else keyed
    rejected = None
    if key is not None and bad_keys != "trust":
        rejected = _bad_keys(first, layout.key)
        if rejected is not None and bad_keys == "raise":
            example = rejected.first()
            raise ValueError(f"Documents cannot be told apart: key {example[0]!r} is {example[1]}.")
        if rejected is not None:
            keyed = _without_keys(keyed, rejected, layout.key)
            first = _without_keys(first, rejected, layout.key)
    frames = {
        layout.name: first.select(*(F.col(f.name) for f in layout.scalars), F.col(layout.key))
    }
    lists: dict[str, tuple[DataFrame, DataFrame]] = {}
    for child in layout.children:
        _shred_attribute(child, keyed, F.col(child.attr), frames, lists, drop_all_null, 0, pieces, keys)
    return DocumentTables(layout, frames, rows_fit=not pieces, numbered=True, rejected=rejected, lists=lists)


def _bad_keys(documents: DataFrame, key: str) -> DataFrame | None:
    """The keys that are NULL or repeated, with the reason; None if there are none."""
    counts = documents.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    reason = F.when(F.col(key).isNull(), "missing").when(F.col("n") > 1, "repeated")
    bad = counts.select(key, reason.alias("reason"), "n").where("reason IS NOT NULL")
    return None if bad.isEmpty() else durable(bad)


def _without_keys(documents: DataFrame, bad: DataFrame, key: str) -> DataFrame:
    return documents.where(F.col(key).isNotNull()).join(bad.select(key), key, "left_anti")


def _shred_attribute(
    table: Table,
    owners: DataFrame,
    value: Column,
    frames: dict[str, DataFrame],
    lists: dict[str, tuple[DataFrame, DataFrame]],
    drop_all_null: bool,
    level: int,
    pieces: bool,
    keys: str,
) -> None:
    """Adds the table of one attribute, and below it those of the attributes of its objects.

    ``owners`` has the key of the owning objects, ``value`` is the attribute in it, ``level`` the
    number of lists above. Each table unpacks only the part of the attribute it stores, so that the
    scan can leave out the rest. The outer explode, whose empty rows go again, spares a derived
    attribute the second evaluation in the filter that Spark puts before an inner one. In a piece,
    positions go on from where its part says, and objects that are there for the sake of their
    lists only are those of another piece.
    """
    owner_key = table.parent_key
    carried = [PART] if pieces else []

    def place() -> Column:
        begin = F.coalesce(F.get(F.col(PART), F.lit(level)), F.lit(0)) if pieces else F.lit(0)
        return (F.col(POS) + begin).alias(POS) if pieces else F.col(POS)

    if table.kind is Kind.VALUES:
        exploded = F.posexplode_outer(value).alias(POS, table.attr)
        values = owners.select(exploded, F.col(owner_key), *carried)
        values = values.where(F.col(POS).isNotNull())
        frames[table.name] = values.select(table.attr, owner_key, place())
        if not pieces:
            lists[table.name] = frames[table.name], owners.select(value.alias(table.attr), owner_key)
        return

    def unpacked(part: Column) -> DataFrame:
        if table.kind is Kind.SINGLE:
            items = owners.select(owner_key, F.lit(0).alias(POS), part.alias(ITEM), *carried)
            position = F.col(POS)
        else:
            exploded = F.posexplode_outer(part).alias(POS, ITEM)
            items = owners.select(owner_key, exploded, *carried)
            position = place()
        owner_type = owners.schema[owner_key].dataType
        items = items.where(F.col(ITEM).isNotNull()).select(owner_key, position, ITEM, *carried)
        if keys == "path":
            root_type = owner_type if table.parent_is_root else None
            key = path_key(F.col(owner_key), table.attr, F.col(POS), root_type)
        else:
            key = child_key(F.col(owner_key), table.attr, F.col(POS), owner_type)
        return items.select(key.alias(table.key), owner_key, POS, ITEM, *carried)

    item = F.col(ITEM)
    objects = unpacked(value)
    if pieces:
        fresh = F.size(PART) <= level + 1
        if table.kind is Kind.SINGLE:
            fresh = fresh & (F.coalesce(F.get(F.col(PART), F.lit(level)), F.lit(0)) == 0)
        objects = objects.where(fresh)
    if drop_all_null:
        present = (item.getField(name).isNotNull() for name in table.fields)
        objects = objects.where(reduce(Column.__or__, present))
    columns = [item.getField(f.name).alias(f.name) for f in table.scalars]
    frames[table.name] = objects.select(*columns, table.key, owner_key, POS)
    deeper = level + (table.kind is Kind.OBJECTS)
    for child in table.children:
        below = unpacked(value.getField(child.attr))
        _shred_attribute(child, below, item, frames, lists, drop_all_null, deeper, pieces, keys)
