"""Selected documents, rebuilt without reading the rows of the others where that can be told."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestframe.operators.assemble import assemble
from nestframe.operators.restrict import LITERAL_KEYS, restrict
from nestframe.plans.tables import DocumentTables


def fetch(
    tables: DocumentTables,
    name: str | None = None,
    matching: DataFrame | None = None,
    max_rows: int | None = 10,
    fields: Iterable[str] | None = None,
    list_size: int | None = None,
) -> DataFrame:
    """The documents of table ``name`` (the root by default), those of least key first.

    ``matching`` is any DataFrame with the key column of the table, such as a filtered join;
    each document comes once however often its key occurs there. ``max_rows`` bounds the documents,
    ``None`` takes all; the lists inside are never cut. A document is one row, unless it has more
    items than a row should hold or ``list_size`` asks for pieces; see ``assemble``.
    """
    if name is not None:
        tables = tables.subtree(name)
    root = tables.layout
    if matching is None and max_rows is None:
        return assemble(tables, fields, list_size)

    keys = None if matching is None else matching.select(root.key).distinct()
    if max_rows is not None:
        stored = tables[root.name].select(root.key)
        found = stored if keys is None else stored.join(keys, root.key, "left_semi")
        keys = found.orderBy(root.key).limit(max_rows)
    if max_rows is None or max_rows > LITERAL_KEYS:
        return assemble(restrict(tables, keys), fields, list_size)
    literal = [row[0] for row in keys.collect()]
    return assemble(restrict(tables, literal), fields, list_size)


def fetch_by_id(
    tables: DocumentTables,
    key: Any,
    name: str | None = None,
    fields: Iterable[str] | None = None,
) -> DataFrame:
    """The document with the given key."""
    if name is not None:
        tables = tables.subtree(name)
    return assemble(restrict(tables, [key]), fields)


def owner_keys(tables: DocumentTables, name: str, condition: Column) -> DataFrame:
    """Keys of the root documents with a row in table ``name`` that meets the condition.

    Duplicates go before each step up, and before the shuffle, so that a document with very many
    such rows weighs no more than another.
    """
    *above, table = tables.layout.lineage(name)
    if not above:
        return tables[name].where(condition).select(table.key)
    keys = tables[name].where(condition).select(table.parent_key).distinct()
    for step in reversed(above[1:]):
        owners = tables[step.name].join(keys, step.key, "left_semi")
        keys = owners.select(step.parent_key).distinct()
    return keys
