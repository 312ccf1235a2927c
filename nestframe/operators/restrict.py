"""The rows of chosen documents on every level."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestframe.plans.layout import Table
from nestframe.plans.tables import DocumentTables

# Up to this many keys are written into the scan filters of the tables they link to.
LITERAL_KEYS = 1_000


def restrict(tables: DocumentTables, keys: DataFrame | list[Any]) -> DocumentTables:
    """The rows, on every level, of the documents with the given root keys.

    A short list of keys becomes a filter of the scans of the root and of its child tables, and
    further down as long as the keys stay few. Beyond that, and for a DataFrame of distinct keys,
    it is a semi-join on the key.
    """
    root = tables.layout
    frames: dict[str, DataFrame] = {}
    whole: dict[str, DataFrame] = {}

    def keep(name: str, column: str, wanted: DataFrame | list[Any]) -> DataFrame:
        rows = tables[name]
        if isinstance(wanted, list):
            return rows.where(F.col(column).isin(wanted) if wanted else F.lit(False))
        whole[name] = tables.whole.get(name, rows)
        return rows.join(wanted, column, "left_semi")

    def visit(table: Table, wanted: DataFrame | list[Any]) -> None:
        for child in table.children:
            frames[child.name] = keep(child.name, child.parent_key, wanted)
            if child.children:
                below = frames[child.name].select(child.key)
                visit(child, _literal(below) if isinstance(wanted, list) else below)

    frames[root.name] = keep(root.name, root.key, keys)
    visit(root, keys)
    return tables.with_frames(frames, whole={**tables.whole, **whole})


def _literal(keys: DataFrame) -> DataFrame | list[Any]:
    """The keys themselves if they are few."""
    found = [row[0] for row in keys.limit(LITERAL_KEYS + 1).collect()]
    return found if len(found) <= LITERAL_KEYS else keys


def without(tables: DocumentTables, keys: DataFrame) -> DocumentTables:
    """The rows, on every level, of all documents but those with the given root keys.

    Rows that belong to no document stay.
    """
    chosen = restrict(tables, keys)
    frames = {}
    for table in tables.layout.walk():
        column = table.parent_key or table.key
        if table.parent is None:
            gone = keys
        else:
            owner = tables.layout.find(table.parent)
            gone = chosen[owner.name].select(owner.key) if owner.parent else keys
        frames[table.name] = tables[table.name].join(gone, column, "left_anti")
    whole = {name: tables.whole.get(name, tables[name]) for name in frames}
    return tables.with_frames(frames, whole={**tables.whole, **whole})
