"""The flat tables a nested model is stored in, worked out from its StructType alone."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, replace
from enum import Enum

from pyspark.sql import types as T

from nestframe.plans.model import model_schema

POS = "_pos"
PART = "_part"
KEY, UP, ORDER, ITEM, GIVEN = "_key", "_up", "_order", "_item", "_given"
RESERVED = (POS, PART, KEY, UP, ORDER, ITEM, GIVEN)


class Kind(Enum):
    ROOT = "root"
    SINGLE = "single object"
    OBJECTS = "list of objects"
    VALUES = "list of values"


@dataclass(frozen=True)
class Table:
    """One flat table, with the tables of its list and object attributes below it.

    ``fields`` keeps the attribute order of the model, ``scalars`` are the attributes stored as
    columns here. ``expose_id`` says whether a rebuilt object shows its key as ``id``,
    ``parent_is_root`` that the table hangs directly below the root.
    """

    name: str
    kind: Kind
    attr: str | None
    parent: str | None
    fields: tuple[str, ...]
    scalars: tuple[T.StructField, ...]
    children: tuple[Table, ...] = ()
    expose_id: bool = True
    parent_is_root: bool = False

    @property
    def key(self) -> str:
        return f"{self.name}_id"

    @property
    def parent_key(self) -> str | None:
        return f"{self.parent}_id" if self.parent else None

    @property
    def is_list(self) -> bool:
        return self.kind in (Kind.OBJECTS, Kind.VALUES)

    def walk(self) -> Iterator[Table]:
        """This table and all below it, parents first."""
        yield self
        for child in self.children:
            yield from child.walk()

    def find(self, name: str) -> Table:
        for table in self.walk():
            if table.name == name:
                return table
        raise ValueError(f"No table {name!r} in the layout of {self.name!r}.")

    def lineage(self, name: str) -> list[Table]:
        """The tables from this one down to ``name``, both included."""
        if self.name == name:
            return [self]
        for child in self.children:
            if any(table.name == name for table in child.walk()):
                return [self, *child.lineage(name)]
        raise ValueError(f"No table {name!r} in the layout of {self.name!r}.")

    def as_root(self) -> Table:
        """The same table as the root of its own documents."""
        if self.kind is Kind.VALUES:
            raise ValueError(f"{self.name!r} holds plain values, which have no documents.")
        return replace(self, kind=Kind.ROOT, attr=None, parent=None)

    def only(self, fields: Iterable[str]) -> Table:
        """The layout cut down to dotted field paths; a path to an object takes all of it."""
        wanted: dict[str, list[str]] = {}
        for path in fields:
            head, _, rest = path.partition(".")
            wanted.setdefault(head, []).append(rest)
        unknown = set(wanted) - set(self.fields) - {"id"}
        if unknown:
            raise ValueError(f"{self.name!r} has no fields {sorted(unknown)}.")
        children = []
        for child in self.children:
            if child.attr in wanted:
                rests = wanted[child.attr]
                children.append(child if "" in rests else child.only(rests))
        return replace(
            self,
            fields=tuple(f for f in self.fields if f in wanted),
            scalars=tuple(f for f in self.scalars if f.name in wanted),
            children=tuple(children),
            expose_id=self.expose_id and (self.kind is Kind.ROOT or "id" in wanted),
        )


def table_layout(
    model: T.StructType | str,
    root: str,
    names: Mapping[str, str] | None = None,
    keep_id: bool = False,
) -> Table:
    """Lays a model out as tables.

    Tables are named by path, ``{parent table}_{attribute}``; ``names`` maps dotted paths to other
    names. An attribute ``id`` is replaced by the generated key unless ``keep_id``, in which case
    rebuilt objects show their own ``id`` and not their key.
    """
    names = dict(names or {})
    layout = _object_table(model_schema(model), root, Kind.ROOT, None, None, (), names, keep_id)
    if names:
        raise ValueError(f"No attributes at the named paths {sorted(names)}.")
    _require_distinct([table.name for table in layout.walk()], "table names")
    return layout


def _object_table(struct, name, kind, attr, parent, path, names, keep_id) -> Table:
    fields = [f for f in struct.fields if keep_id or f.name != "id"]
    scalars, children = [], []
    for f in fields:
        child_path = (*path, f.name)
        child_name = names.pop(".".join(child_path), f"{name}_{f.name}")
        if isinstance(f.dataType, T.StructType):
            children.append(
                _object_table(
                    f.dataType, child_name, Kind.SINGLE, f.name, name, child_path, names, keep_id
                )
            )
        elif isinstance(f.dataType, T.ArrayType):
            element = f.dataType.elementType
            if isinstance(element, T.StructType):
                children.append(
                    _object_table(
                        element, child_name, Kind.OBJECTS, f.name, name, child_path, names, keep_id
                    )
                )
            else:
                _reject_maps(element, child_path)
                value = T.StructField(f.name, element, f.dataType.containsNull, f.metadata)
                children.append(
                    Table(
                        child_name,
                        Kind.VALUES,
                        f.name,
                        name,
                        (f.name,),
                        (value,),
                        parent_is_root=not path,
                    )
                )
        else:
            _reject_maps(f.dataType, child_path)
            scalars.append(f)
    odd = [f.name for f in fields if set(f.name) & set(".`")]
    if odd:
        raise ValueError(f"Names with dots or backticks have no column form: {odd}.")
    columns = [f.name for f in fields] + list(RESERVED) + [f"{name}_id"]
    _require_distinct(columns + ([f"{parent}_id"] if parent else []), f"columns of {name!r}")
    return Table(
        name=name,
        kind=kind,
        attr=attr,
        parent=parent,
        fields=tuple(f.name for f in fields),
        scalars=tuple(scalars),
        children=tuple(children),
        expose_id=not keep_id or (kind is Kind.ROOT and "id" not in struct.names),
        parent_is_root=len(path) == 1,
    )


def _reject_maps(dtype: T.DataType, path: tuple[str, ...]) -> None:
    if isinstance(dtype, T.MapType):
        raise ValueError(f"{'.'.join(path)!r} is a map, which has no table form.")


def _require_distinct(names: list[str], what: str) -> None:
    seen = [name.lower() for name in names]
    clashing = sorted({name for name in seen if seen.count(name) > 1})
    if clashing:
        raise ValueError(f"Clashing or reserved {what}: {clashing}.")
