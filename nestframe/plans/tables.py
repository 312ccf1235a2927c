"""A set of flat tables together with the layout that says how they hang together."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestframe.plans.layout import POS, Kind, Table


@dataclass(frozen=True)
class DocumentTables:
    """Flat DataFrames by table name.

    ``order`` gives the sort columns of list tables that have no ``_pos`` column. ``rows_fit``
    promises that every document fits one row, as is the case for tables shredded from rows; it
    saves ``assemble`` the look for over-long lists. ``numbered`` promises that ``_pos`` tells the
    rows of a parent apart, as in tables made or stored by this library; else they are counted.
    ``clustered`` names the tables stored in buckets by the key of their parent, ``buckets`` has the
    number of buckets of those stored by their own key. ``whole`` has the
    full tables of those in ``frames`` that are selections by a join. ``rejected`` has the keys of
    documents that were not taken apart, with the reason. ``lists`` has, of tables of values, the
    frame and the rows it was unpacked from, one for each list.
    """

    layout: Table
    frames: Mapping[str, DataFrame]
    order: Mapping[str, Sequence[str]] = field(default_factory=dict)
    rows_fit: bool = False
    numbered: bool = False
    clustered: frozenset[str] = frozenset()
    buckets: Mapping[str, int] = field(default_factory=dict)
    whole: Mapping[str, DataFrame] = field(default_factory=dict)
    rejected: DataFrame | None = None
    lists: Mapping[str, tuple[DataFrame, DataFrame]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        missing = [t.name for t in self.layout.walk() if t.name not in self.frames]
        if missing:
            raise ValueError(f"Tables {missing} of the layout are not given.")
        for table in self.layout.walk():
            if table.children and not self.has_key(table):
                raise ValueError(f"{table.name!r} has child tables and needs column {table.key!r}.")

    def __getitem__(self, name: str) -> DataFrame:
        return self.frames[name]

    def has_key(self, table: Table) -> bool:
        return table.key in self.frames[table.name].columns

    def has_pos(self, table: Table) -> bool:
        return POS in self.frames[table.name].columns

    def lists_of(self, table: Table) -> DataFrame | None:
        """The values of a table as the lists they come from, with the key of the parent; None if not known."""
        frame, lists = self.lists.get(table.name, (None, None))
        return lists if frame is self.frames[table.name] else None

    def order_columns(self, table: Table) -> list[str]:
        """What sorts the rows of one parent: ``_pos``, the given columns, or key and values."""
        positions = [POS] if self.has_pos(table) else []
        if table.name in self.order:
            return [*positions, *self.order[table.name]]
        if positions:
            return positions
        return [table.key] if self.has_key(table) else [f.name for f in table.scalars]

    def order_column(self, table: Table) -> Column:
        columns = self.order_columns(table)
        return F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)

    def subtree(self, name: str) -> DocumentTables:
        """The table ``name`` and those below it, as documents of their own."""
        table = self.layout.find(name)
        return self if table.kind is Kind.ROOT else replace(self, layout=table.as_root())

    def with_frames(self, frames: Mapping[str, DataFrame], **changes) -> DocumentTables:
        return replace(self, frames={**self.frames, **frames}, **changes)
