"""A root table joined with its descendants into one wide table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame

from nestframe.plans.layout import Table
from nestframe.plans.tables import DocumentTables


def join_renamed(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    rename: str = "{name}_right",
    how: str = "inner",
) -> DataFrame:
    """Equi-join that keeps every column: those of the right side whose names clash are renamed."""
    keys = [on] if isinstance(on, str) else list(on)
    taken = {column.lower() for column in left.columns}
    clashing = {
        column: rename.format(name=column)
        for column in right.columns
        if column not in keys and column.lower() in taken
    }
    return left.join(right.withColumnsRenamed(clashing), keys, how)


def flatten(
    tables: DocumentTables,
    branch: str | None = None,
    how: str = "inner",
    skip_empty: bool = False,
) -> DataFrame:
    """One row per chain of linked rows; clashing columns get their table name as a prefix.

    With ``skip_empty`` a table without rows is left out, and all below it with it; which columns
    there are then hangs on the data. Sibling lists
    are not combined, as that would give every pair of their items: a model with several lists
    side by side needs ``branch``, the table at the end of the wanted chain of lists.
    """
    layout = tables.layout
    skipped: set[str] = set()
    if skip_empty:
        _skip_empty(tables, layout, skipped)
    ends = _list_ends(layout, skipped)
    if branch is None and len(ends) > 1:
        raise ValueError(f"Several lists side by side; name one as branch: {ends}.")
    if branch is None:
        chain = {table.name for end in ends for table in layout.lineage(end)}
    else:
        chain = {table.name for table in layout.lineage(branch)}

    joined = tables[layout.name]

    def visit(table: Table) -> None:
        nonlocal joined
        for child in table.children:
            if child.name in skipped or (child.is_list and child.name not in chain):
                continue
            rename = f"{child.name}_{{name}}"
            joined = join_renamed(joined, tables[child.name], child.parent_key, rename, how)
            visit(child)

    visit(layout)
    return joined


def flatten_branches(
    tables: DocumentTables, how: str = "inner", skip_empty: bool = False
) -> dict[str, DataFrame]:
    """One flattened table for each chain of lists, by the name of the table at its end."""
    skipped: set[str] = set()
    if skip_empty:
        _skip_empty(tables, tables.layout, skipped)
    kept = tables.with_frames({}, layout=_without(tables.layout, skipped))
    return {
        end: flatten(kept, end, how, skip_empty=False) for end in _list_ends(kept.layout, set())
    }


def _skip_empty(tables: DocumentTables, table: Table, skipped: set[str]) -> None:
    for child in table.children:
        if tables[child.name].isEmpty():
            skipped.update(below.name for below in child.walk())
        else:
            _skip_empty(tables, child, skipped)


def _without(table: Table, skipped: set[str]) -> Table:
    children = tuple(_without(c, skipped) for c in table.children if c.name not in skipped)
    return replace(table, children=children)


def _has_list(table: Table, skipped: set[str]) -> bool:
    return any(below.is_list and below.name not in skipped for below in table.walk())


def _list_ends(layout: Table, skipped: set[str]) -> list[str]:
    """The list tables with no further list table below them."""
    lists = [t for t in layout.walk() if t.is_list and t.name not in skipped]
    return [t.name for t in lists if not any(_has_list(c, skipped) for c in t.children)]
