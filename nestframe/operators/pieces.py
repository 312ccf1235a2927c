"""Documents in pieces, treated as the documents they are: counted, chosen, sorted and compared.

``assemble`` gives a document whose lists are too long for a row in several rows. What is here gives
the same answer for it as for the document in one row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestframe.functions.keys import row_text
from nestframe.functions.nested import canonical as canonical_rows
from nestframe.functions.nested import exact
from nestframe.operators.assemble import FIRST_PIECE, assemble
from nestframe.operators.shred import shred
from nestframe.plans.layout import PART, POS, Table
from nestframe.plans.tables import DocumentTables

_HITS, _ITEMS, _ID = "_hits", "_items", "id"


def may_be_pieces(documents: DataFrame) -> bool:
    """Whether a document may have several rows. ``assemble`` says so by the column's schema."""
    return PART in documents.columns and documents.schema[PART].nullable


def count_documents(documents: DataFrame) -> int:
    """The number of documents, each counted once."""
    if PART in documents.columns:
        documents = documents.where(F.col(PART) == FIRST_PIECE)
    return documents.count()


def having(
    documents: DataFrame,
    path: str,
    test: Callable[[Column], Column],
    at_least: int = 1,
    every: bool = False,
    key: str = _ID,
) -> DataFrame:
    """The documents, with all their rows, of which enough values at a dotted path pass a test.

    The path may lead through any number of lists; the values of all their items count, ``at_least``
    so many must pass, or with ``every`` all of them (as is so if there are none). A test that
    gives NULL is not passed. Hits in the pieces of a document are added up by ``key``, so only
    keys and numbers are shuffled and a document in many pieces weighs no more than another.
    """
    names = path.split(".")
    field = documents.schema[names[0]]
    lists = _lists_on(field.dataType, names[1:])
    hits, items = _counts(F.col(names[0]), field.dataType, names[1:], test)

    def enough(hits: Column, items: Column) -> Column:
        return hits == items if every else hits >= at_least

    if not may_be_pieces(documents):
        return documents.where(enough(hits, items))
    # Objects that are repeated for the sake of their longer lists have been counted before.
    parts = F.size(F.split(PART, "\\."))
    fresh = parts <= lists if lists else F.col(PART) == FIRST_PIECE
    counted = documents.where(fresh).select(key, hits.alias(_HITS), items.alias(_ITEMS))
    sums = counted.groupBy(key).agg(F.sum(_HITS).alias(_HITS), F.sum(_ITEMS).alias(_ITEMS))
    chosen = sums.where(enough(F.col(_HITS), F.col(_ITEMS))).select(key)
    return documents.join(chosen, key, "left_semi")


def _lists_on(dtype: T.DataType, names: list[str]) -> int:
    lists = 0
    while True:
        if isinstance(dtype, T.ArrayType):
            lists, dtype = lists + 1, dtype.elementType
        elif names:
            dtype, names = dtype[names[0]].dataType, names[1:]
        else:
            return lists


def _counts(
    value: Column, dtype: T.DataType, names: list[str], test: Callable[[Column], Column]
) -> tuple[Column, Column]:
    """How many values at the path pass, and how many there are."""
    zero = F.lit(0).cast("long")
    if isinstance(dtype, T.ArrayType):

        def total(which: int) -> Column:
            def add(sum_: Column, item: Column) -> Column:
                return sum_ + _counts(item, dtype.elementType, names, test)[which]

            return F.coalesce(F.aggregate(value, zero, add), zero)

        return total(0), total(1)
    if names:
        inner = _counts(value.getField(names[0]), dtype[names[0]].dataType, names[1:], test)
        return tuple(F.when(value.isNull(), zero).otherwise(count) for count in inner)
    return F.when(test(value), 1).otherwise(0).cast("long"), F.lit(1).cast("long")


def canonical(
    documents: DataFrame, by: str | None = None, list_size: int | None = None
) -> DataFrame:
    """Sorts every list at every level, so that documents equal up to list order become equal.

    Objects are sorted by their field ``by`` where they have it, then by their scalars and by the
    content of their lists, values by themselves; NULL comes first. Documents in pieces are taken
    apart, sorted over the cluster and put together again, in pieces of ``list_size`` if given.
    Generated keys do not count.
    """
    if not may_be_pieces(documents):
        return canonical_rows(documents, by)
    renamed = documents.withColumnRenamed(_ID, "_id")
    tables = shred(renamed, "_document", key="_id", bad_keys="trust")
    fields = [path for path in _paths(documents.schema) if path not in (_ID, PART)]
    return assemble(canonical_tables(tables, by), fields, list_size).select(*documents.columns)


def _paths(fields: T.StructType) -> list[str]:
    """The dotted paths of all values."""
    found = []
    for f in fields:
        inner = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
        nested = isinstance(inner, T.StructType)
        found += [f"{f.name}.{path}" for path in _paths(inner)] if nested else [f.name]
    return found


def canonical_tables(tables: DocumentTables, by: str | None = None) -> DocumentTables:
    """The tables of the same documents with every list in canonical order."""
    frames, order = {}, {}

    def visit(table: Table) -> list[str]:
        """Orders the lists below a table and adds their content to its rows; the names of that."""
        rows, contents = tables[table.name], []
        for child in table.children:
            below = visit(child)
            sums = _content(frames[child.name], child, below)
            name = f"_in_{child.attr}"
            owner = F.col(child.parent_key).alias(table.key)
            rows = rows.join(sums.select(owner, F.col("_sum").alias(name)), table.key, "left")
            rows = rows.withColumn(name, F.coalesce(name, F.lit(0).cast("decimal(38,0)")))
            contents.append(name)
        if table.is_list:
            first = [by] if by in [f.name for f in table.scalars] else []
            order[table.name] = [*dict.fromkeys([*first, *(f.name for f in table.scalars)]), *contents]
            rows = rows.drop(POS)
        frames[table.name] = rows
        return contents

    visit(tables.layout)
    return tables.with_frames(frames, order=order, rows_fit=False)


def _content(rows: DataFrame, table: Table, contents: list[str]) -> DataFrame:
    """What the rows of each parent hold, as a sum over them that no order changes."""
    scalars = row_text(table.scalars) if table.scalars else F.lit("")
    own = F.xxhash64(F.lit(table.attr), scalars, *(F.col(c).cast("string") for c in contents))
    return rows.groupBy(table.parent_key).agg(F.sum(own.cast("decimal(20,0)")).cast("decimal(38,0)").alias("_sum"))


def content_digests(documents: DataFrame, fields: list[T.StructField]) -> DataFrame:
    """Two columns ``a, b`` of 64 bits, one row per document, equal for equal documents only.

    Every object and value is hashed with the path and the positions that lead to it. As no two of a
    document share these, the hashes can be combined by exclusive or in any order: those of the
    items in a row first, then those of the rows of a document.
    """
    pieces = may_be_pieces(documents)
    part = F.split(PART, "\\.").cast("array<int>") if pieces else F.array(F.lit(0))
    first = F.col(PART) == FIRST_PIECE if pieces else F.lit(True)
    found = [_hash_object(None, fields, "", [], first, part, 0, seed) for seed in (0, 1)]
    if not pieces:
        return documents.select(found[0].alias("a"), found[1].alias("b"))
    rows = documents.select(_ID, found[0].alias("a"), found[1].alias("b"))
    return rows.groupBy(_ID).agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b")).select("a", "b")


def _none() -> Column:
    return F.lit(0).cast("long")


def _hash_object(value, fields, path, at, fresh, part, level, seed) -> Column:
    """The hash of an object and all below it; of itself only where it is ``fresh``, not repeated."""

    def get(name: str) -> Column:
        return F.col(f"`{name}`") if value is None else value.getField(name)

    nested = [f for f in fields if isinstance(f.dataType, (T.StructType, T.ArrayType))]
    plain = [f for f in fields if f not in nested]
    scalars = [exact(get(f.name), f.dataType).alias(f.name) for f in plain]
    text = F.to_json(F.struct(*scalars), {"ignoreNullFields": "false"}) if plain else F.lit("")
    result = F.when(fresh, F.xxhash64(F.lit(seed), F.lit(path), *at, text)).otherwise(_none())
    for f in nested:
        below = _hash_attribute(get(f.name), f.dataType, f"{path}/{f.name}", at, fresh, part, level, seed)
        result = result.bitwiseXOR(below)
    return result


def _hash_attribute(value, dtype, path, at, fresh, part, level, seed) -> Column:
    def hashed(*what: Column) -> Column:
        return F.xxhash64(F.lit(seed), F.lit(path), *at, *what)

    if isinstance(dtype, T.StructType):
        inner = _hash_object(value, dtype.fields, path, at, fresh, part, level, seed)
        return F.when(value.isNull(), _none()).otherwise(inner)
    element = dtype.elementType
    begin = F.coalesce(F.get(part, F.lit(level)), F.lit(0))
    here = F.size(part) <= level + 1

    def item(x: Column, i: Column) -> Column:
        place = [*at, i + begin]
        if isinstance(element, T.StructType):
            missing = F.when(here, F.xxhash64(F.lit(seed), F.lit(path), *place, F.lit("null"))).otherwise(_none())
            inner = _hash_object(x, element.fields, path, place, here, part, level + 1, seed)
            return F.when(x.isNull(), missing).otherwise(inner)
        text = F.to_json(F.struct(exact(x, element).alias("v")), {"ignoreNullFields": "false"})
        return F.xxhash64(F.lit(seed), F.lit(path), *place, text)

    items = F.aggregate(F.transform(value, item), _none(), lambda a, b: a.bitwiseXOR(b))
    known = F.when(fresh & value.isNotNull(), hashed(F.lit("list"))).otherwise(_none())
    return known.bitwiseXOR(F.coalesce(items, _none()))
