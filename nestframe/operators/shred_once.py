"""Nested documents -> flat, keyed tables, in one pass over the documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestframe.functions.keys import child_key, path_key, row_key
from nestframe.operators.durable import durable, shared_path
from nestframe.operators.restrict import without
from nestframe.operators.shred import _bad_keys
from nestframe.plans.layout import ITEM, KEY, PART, POS, UP, Kind, Table, table_layout
from nestframe.plans.tables import DocumentTables

TABLE = "_table"
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def shred_once(
    documents: DataFrame,
    root: str,
    key: str | Sequence[str] | None = None,
    model: T.StructType | str | None = None,
    names: Mapping[str, str] | None = None,
    keep_id: bool = False,
    drop_all_null: bool = False,
    bad_keys: str = "raise",
    keys: str = "digest",
    path: str | None = None,
) -> DocumentTables:
    """The tables of ``shred``, written by one job that evaluates ``documents`` once.

    ``shred`` reads the documents again for each table, which is best where they lie in columns and
    few of the tables are used. Where they are parsed, joined or otherwise derived, or all tables are
    stored, this does that work once: each document becomes its rows of all tables, each row under
    the name of its table, and these are written to one folder per table. Without a natural key
    the documents are shuffled to find copies, else nothing is. A task keeps a file open for each table,
    so that it need not sort its rows by table, which spilled all of them.

    ``path`` is a new folder for the tables, by default one in the shared folder. The arguments
    besides and the keys are those of ``shred``. Root keys are looked at where they are written, so
    refused documents are written as well, and left out by ``"reject"`` when tables are read.
    Documents in pieces are refused. No documents give empty tables.
    """
    if bad_keys not in ("raise", "reject", "trust"):
        raise ValueError(f"bad_keys is 'raise', 'reject' or 'trust', not {bad_keys!r}.")
    if PART in documents.columns:
        raise ValueError(f"Documents in pieces (column {PART!r}) cannot be taken apart at once.")
    layout = table_layout(model or documents.schema, root, names, keep_id)
    spark = documents.sparkSession
    path = path or shared_path(spark)
    rows = tagged_rows(documents, layout, key, drop_all_null, keys)
    _write_by_table(rows, path, len(list(layout.walk())))
    written = spark.read.schema(rows.schema).parquet(path)

    def stored(table: Table) -> DataFrame:
        return written.where(F.col(TABLE) == table.name).select(f"`{table.name}`.*")

    frames = {table.name: stored(table) for table in layout.walk()}
    tables = DocumentTables(layout, frames, rows_fit=True, numbered=True)
    if key is None or bad_keys == "trust":
        return tables
    rejected = _bad_keys(tables[layout.name], layout.key)
    if rejected is None:
        return tables
    if bad_keys == "raise":
        example = rejected.first()
        raise ValueError(f"Documents cannot be told apart: key {example[0]!r} is {example[1]}.")
    # Documents without a key have only their root row.
    present = tables[layout.name].where(F.col(layout.key).isNotNull())
    repeated = durable(rejected.where(F.col(layout.key).isNotNull()).select(layout.key))
    kept = without(tables.with_frames({layout.name: present}), repeated)
    frames = {name: rows.select(*frames[name].columns) for name, rows in kept.frames.items()}
    return DocumentTables(layout, frames, rows_fit=True, numbered=True, rejected=rejected)


def _write_by_table(rows: DataFrame, path: str, n_tables: int) -> None:
    """A folder per table, by tasks that have the files of all tables open at once."""
    conf = rows.sparkSession.conf
    given = conf.get(OPEN_FILES)
    conf.set(OPEN_FILES, str(max(int(given), n_tables)))
    try:
        rows.write.partitionBy(TABLE).parquet(path)
    finally:
        conf.set(OPEN_FILES, given)


def tagged_rows(
    documents: DataFrame,
    layout: Table,
    key: str | Sequence[str] | None = None,
    drop_all_null: bool = False,
    keys: str = "digest",
) -> DataFrame:
    """The rows of all tables in one DataFrame: ``_table``, and a column per table that holds its row.

    Only the column of the table in ``_table`` is not NULL. The objects on each level are a column
    of their own, so that their keys are computed once for them and all below them.
    """
    if keys not in ("digest", "path"):
        raise ValueError(f"keys is 'digest' or 'path', not {keys!r}.")
    if key is None:
        documents = documents.distinct()
    if isinstance(key, str):
        root_key = F.col(key)
    else:
        root_key = row_key(documents.schema[name] for name in key or documents.columns)
    attributes = F.struct(*(F.col(name) for name in layout.fields))
    rows = documents.select(root_key.alias(KEY), attributes.alias(ITEM))
    root_type = rows.schema[KEY].dataType
    root_item, root_value = F.col(ITEM), F.col(KEY)
    own = F.struct(*(root_item.getField(f.name).alias(f.name) for f in layout.scalars), root_value.alias(layout.key))
    found = {layout.name: F.array(own)}
    numbers = {table.name: f"_objects_{i}" for i, table in enumerate(layout.walk())}

    def objects_of(table: Table, value: Column, owner_key: Column) -> Column:
        """The objects in an attribute of one owner, with their keys; empty if it is NULL."""

        def made(item: Column, pos: Column) -> Column:
            if keys == "path":
                own_key = path_key(owner_key, table.attr, pos, root_type if table.parent_is_root else None)
            else:
                own_key = child_key(owner_key, table.attr, pos, root_type if table.parent_is_root else None)
            return F.struct(own_key.alias(KEY), owner_key.alias(UP), pos.alias(POS), item.alias(ITEM))

        if table.kind is Kind.SINGLE:
            listed = F.array(made(value, F.lit(0)))
        else:
            listed = F.transform(value, made)
        return F.filter(listed, lambda made_object: made_object.getField(ITEM).isNotNull())

    def values_of(table: Table, value: Column, owner_key: Column) -> Column:
        return F.transform(
            value, lambda item, pos: F.struct(item.alias(table.attr), owner_key.alias(table.parent_key), pos.alias(POS))
        )

    def row_of(table: Table, made: Column) -> Column:
        item = made.getField(ITEM)
        scalars = [item.getField(f.name).alias(f.name) for f in table.scalars]
        links = made.getField(KEY).alias(table.key), made.getField(UP).alias(table.parent_key)
        return F.struct(*scalars, *links, made.getField(POS).alias(POS))

    def kept(table: Table, made: Column) -> Column:
        present = (made.getField(ITEM).getField(name).isNotNull() for name in table.fields)
        return reduce(Column.__or__, present)

    def add(table: Table, owner: Table) -> None:
        nonlocal rows
        make = values_of if table.kind is Kind.VALUES else objects_of

        def of_owner(made: Column) -> Column:
            # A NULL list has no items; without this it would make the whole NULL.
            listed = make(table, made.getField(ITEM).getField(table.attr), made.getField(KEY))
            return F.coalesce(listed, F.array())

        if owner is layout:
            listed = F.when(root_value.isNotNull(), make(table, root_item.getField(table.attr), root_value))
        else:
            listed = F.flatten(F.transform(numbers[owner.name], of_owner))
        rows = rows.withColumn(numbers[table.name], listed)
        made = F.col(numbers[table.name])
        if table.kind is Kind.VALUES:
            found[table.name] = made
            return
        chosen = F.filter(made, lambda made_object: kept(table, made_object)) if drop_all_null else made
        found[table.name] = F.transform(chosen, lambda made_object: row_of(table, made_object))
        for child in table.children:
            add(child, table)

    for child in layout.children:
        add(child, layout)
    types = rows.select(*(column.alias(name) for name, column in found.items())).schema
    empty = {name: F.lit(None).cast(types[name].dataType.elementType) for name in found}

    def tagged(name: str, column: Column) -> Column:
        def tag(row: Column) -> Column:
            columns = [(row if other == name else nothing).alias(other) for other, nothing in empty.items()]
            return F.struct(F.lit(name).alias(TABLE), *columns)

        return F.coalesce(F.transform(column, tag), F.array())

    return rows.select(F.inline(F.concat(*(tagged(name, column) for name, column in found.items()))))
