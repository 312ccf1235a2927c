"""Flat tables -> nested documents."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestframe.functions.nested import holds_texts, packed_texts, unpacked_texts
from nestframe.operators.durable import durable
from nestframe.operators.numbering import TIE, long_parents, number_long_lists
from nestframe.operators.restrict import restrict, without
from nestframe.plans.layout import GIVEN, ITEM, KEY, ORDER, PART, POS, UP, Kind, Table
from nestframe.plans.tables import DocumentTables

FIRST_PIECE = "0"
_N = "_n"
# Items that one row holds at most, of any list of lists.
ROWS_PER_DOCUMENT = 200_000
LIST_SIZE = 1_000


def assemble(
    tables: DocumentTables,
    fields: Iterable[str] | None = None,
    list_size: int | None = None,
) -> DataFrame:
    """Rebuilds the nested documents, one join per attribute whatever the number of rows.

    Objects show their key as ``id``. Lists come in the order of ``_pos``, empty if there are no
    rows; an object without a row is NULL, and the first row counts if there are several.
    ``fields`` limits the work to dotted paths: other columns and tables are not read.

    A document is one row. Only one of which a list, or the lists in a list, have more items than a
    row should hold (``ROWS_PER_DOCUMENT``) comes in several rows, its pieces, each with the same
    ``id`` and scalars and a stretch of its lists; nothing is left out. With ``list_size`` all
    documents with longer lists come in pieces, on every level. Whether there are such documents
    is found out by a Spark job when this is called.

    ``_part`` says where a piece belongs. "0", "1000"... is the position of its first item in each
    list of the root. "7.1000" has the items at position 7 of the root's lists again, whose own
    lists begin at position 1000. So rows without a dot have the first piece of each item exactly
    once, and every value in a list comes once. ``nestframe.operators.pieces`` treats pieces as one
    document. The column can only be NULL, by its schema, where there may be pieces.
    """
    layout = tables.layout.only(fields) if fields is not None else tables.layout
    if list_size is not None:
        longest = _longest_lists(tables, _lists(layout))
        if any(length > list_size for length in longest.values()):
            return _split(tables, layout, list_size, longest)
    elif not tables.rows_fit and (large := _large_documents(tables, layout)) is not None:
        others = _assembled(without(tables, large), layout)
        pieces = _assembled(restrict(tables, large), layout, _default_list_size(layout))
        return others.unionByName(pieces)
    return _assembled(tables, layout)


def _assembled(tables: DocumentTables, layout: Table, list_size: int | None = None) -> DataFrame:
    if list_size is not None:
        tables = _with_positions(tables, layout, list_size)
    plan = _Plan(tables, list_size or 0, list_size is not None)
    documents = _objects(layout, plan)
    part = F.when(F.col(PART).isNotNull(), F.col(PART)) if plan.split else F.lit(FIRST_PIECE)
    return documents.select(*_attributes(layout, documents), part.alias(PART))


def _split(tables: DocumentTables, layout: Table, list_size: int, longest: dict[str, int]) -> DataFrame:
    """Documents in pieces. Those that fit a row are rebuilt whole and cut where they are.

    That evaluates each table once and shuffles each row as often as for whole documents. Those with
    more items, and documents with lists side by side, are put together piece by piece.
    """
    if any(len(table.children) > 1 for table in layout.walk()):
        return _assembled(tables, layout, list_size)
    large = None if tables.rows_fit else _large_documents(tables, layout, longest)
    if large is None:
        return _cut(_assembled(_with_ties(tables, layout), layout), layout, list_size)
    others = _cut(_assembled(_with_ties(without(tables, large), layout), layout), layout, list_size)
    return others.unionByName(_assembled(restrict(tables, large), layout, list_size))


def _with_ties(tables: DocumentTables, layout: Table) -> DocumentTables:
    """Items without key or position, equal in order, stay as they are stored: pieces are told by order.

    The numbers need not be written: all pieces of a document are cut from one row.
    """
    frames, order = {}, {}
    for table in _lists(layout):
        if not (tables.numbered and tables.has_pos(table)) and not tables.has_key(table):
            order[table.name] = [*(c for c in tables.order_columns(table) if c != POS), TIE]
            frames[table.name] = tables[table.name].withColumn(TIE, F.monotonically_increasing_id())
    return tables.with_frames(frames, order={**tables.order, **order})


def _cut(documents: DataFrame, layout: Table, size: int) -> DataFrame:
    """Cuts whole documents, of which no object has lists side by side, into their pieces."""

    def stretches(items: Column) -> Column:
        def stretch(begin: Column) -> Column:
            return F.struct(begin.cast("string").alias(PART), F.slice(items, begin + 1, size).alias(ITEM))

        begins = F.sequence(F.lit(0), F.size(items) - 1, F.lit(size))
        return F.when(F.size(items) > 0, F.transform(begins, stretch))

    def attribute(table: Table, value: Column) -> Column:
        """The pieces an attribute comes in, that without a dot and of position 0 first."""
        if table.kind is Kind.SINGLE:
            return F.when(value.isNotNull(), of_object(table, value))
        if not table.children:
            return stretches(value)

        def gathered(cut: Column) -> Column:
            first = stretches(F.transform(cut, lambda pieces: pieces[0][ITEM]))

            def later(pieces: Column, pos: Column) -> Column:
                def named(piece: Column) -> Column:
                    part = F.concat_ws(".", pos.cast("string"), piece[PART])
                    return F.struct(part.alias(PART), F.array(piece[ITEM]).alias(ITEM))

                return F.transform(F.slice(pieces, 2, F.size(pieces)), named)

            return F.concat(first, F.flatten(F.transform(cut, later)))

        # In a list of one, so that what is cut is evaluated once.
        cut = F.array(F.transform(value, lambda item: of_object(table, item)))
        return F.when(F.size(value) > 0, F.transform(cut, gathered)[0])

    def of_child(table: Table, value: Column) -> Column:
        whole = F.array(F.struct(F.lit(FIRST_PIECE).alias(PART), value.alias(ITEM)))
        return F.coalesce(attribute(table, value), whole)

    def of_object(table: Table, item: Column) -> Column:
        if not table.children:
            return F.array(F.struct(F.lit(FIRST_PIECE).alias(PART), item.alias(ITEM)))
        (child,) = table.children

        def with_piece(piece: Column) -> Column:
            return F.struct(piece[PART].alias(PART), item.withField(f"`{child.attr}`", piece[ITEM]).alias(ITEM))

        return F.transform(of_child(child, item[child.attr]), with_piece)

    (child,) = layout.children
    others = [c for c in documents.columns if c not in (PART, child.attr)]
    pieces = F.inline(of_child(child, F.col(f"`{child.attr}`"))).alias(PART, child.attr)
    cut = documents.select(*(f"`{c}`" for c in others), pieces)
    # NULL by its schema, as for all documents in pieces.
    part = F.when(F.col(PART).isNotNull(), F.col(PART)).alias(PART)
    return cut.select(*(part if c == PART else f"`{c}`" for c in documents.columns))


@dataclass(frozen=True)
class _Plan:
    tables: DocumentTables
    list_size: int
    split: bool

    @property
    def link(self) -> list[str]:
        return [KEY, PART] if self.split else [KEY]


def _default_list_size(layout: Table) -> int:
    """Bounds the product of list lengths along the deepest path."""
    depth = max(_lists_above(layout, table) for table in layout.walk())
    return min(LIST_SIZE, int(ROWS_PER_DOCUMENT ** (1 / max(depth, 1)) + 1e-9))


def _lists_above(layout: Table, table: Table) -> int:
    return sum(step.is_list for step in layout.lineage(table.name))


def _large_documents(tables: DocumentTables, layout: Table, longest: dict[str, int] | None = None) -> DataFrame | None:
    """Keys of the documents with more items than a row should hold; None if there are none.

    If not even the longest lists of all levels together make too many, nothing is joined.
    """
    lists = _lists(layout)
    longest = longest or _longest_lists(tables, lists)
    found = []
    for table in lists:
        chain = [step for step in layout.lineage(table.name) if step.is_list]
        if prod(longest[step.name] for step in chain) <= ROWS_PER_DOCUMENT:
            continue
        counts = _whole(tables, table).groupBy(table.parent_key).agg(F.count(F.lit(1)).alias(_N))
        for step in reversed(layout.lineage(table.name)[1:-1]):
            owners = _whole(tables, step).select(step.key, step.parent_key)
            counts = owners.join(counts, step.key).groupBy(step.parent_key).agg(F.sum(_N).alias(_N))
        found.append(counts.where(F.col(_N) > ROWS_PER_DOCUMENT).select(layout.key))
    if not found:
        return None
    large = durable(reduce(DataFrame.union, found).distinct())
    return None if large.isEmpty() else large


def _longest_lists(tables: DocumentTables, lists: list[Table]) -> dict[str, int]:
    """The length of the longest list in each table, found by one job.

    Positions that are known to number the rows tell it without counting.
    """
    if not lists:
        return {}
    found = []
    for table in lists:
        rows = _whole(tables, table)
        if tables.numbered and tables.has_pos(table):
            length = rows.agg((F.max(POS) + 1).cast("long").alias(_N))
        else:
            counts = rows.groupBy(table.parent_key).agg(F.count(F.lit(1)).alias(_N))
            length = counts.agg(F.max(_N).alias(_N))
        found.append(length.select(F.lit(table.name).alias("name"), _N))
    return {row["name"]: row[_N] or 0 for row in reduce(DataFrame.union, found).collect()}


def _lists(layout: Table) -> list[Table]:
    return [table for table in layout.walk() if table.is_list]


def _linked(rows: DataFrame, table: Table) -> DataFrame:
    """The rows that have a parent; those without belong to no document, however many they are."""
    return rows.where(F.col(table.parent_key).isNotNull()) if table.parent_key else rows


def _whole(tables: DocumentTables, table: Table) -> DataFrame:
    """Where to count the rows of a parent: before a join that would bring them together."""
    return _linked(tables.whole.get(table.name, tables[table.name]), table)


def _any_list_over(tables: DocumentTables, layout: Table, size: int) -> bool:
    return any(length > size for length in _longest_lists(tables, _lists(layout)).values())


def _with_positions(tables: DocumentTables, layout: Table, size: int) -> DocumentTables:
    """Numbers the long lists whose positions are not known; the other lists keep to one stretch."""
    numbered, order = {}, {}
    for table in _lists(layout):
        if not (tables.numbered and tables.has_pos(table)):
            rows = _linked(tables[table.name], table)
            parents = long_parents(_whole(tables, table), table.parent_key, size)
            order[table.name] = tables.order_columns(table)
            unique = table.key if tables.has_key(table) else None
            numbered[table.name] = number_long_lists(
                rows.withColumnRenamed(POS, GIVEN) if tables.has_pos(table) else rows,
                parents,
                table.parent_key,
                [GIVEN if c == POS else c for c in order[table.name]],
                unique,
            )
            order[table.name] = [GIVEN if c == POS else c for c in order[table.name]]
    return tables.with_frames(numbered, order={**tables.order, **order})


def _objects(table: Table, plan: _Plan) -> DataFrame:
    """One row per object, or per piece of one, with its attributes and its link upwards."""
    tables = plan.tables
    rows = _linked(tables[table.name], table)
    columns = [F.col(f.name) for f in table.scalars]
    if tables.has_key(table):
        columns.append(F.col(table.key).alias(KEY))
    if table.parent_key:
        columns += [
            F.col(table.parent_key).alias(UP),
            tables.order_column(table).alias(ORDER),
        ]
    if plan.split and table.kind is Kind.OBJECTS:
        columns.append(F.col(POS))
    objects = rows.select(*columns)
    if table.kind is Kind.SINGLE:
        others = [c for c in objects.columns if c not in (UP, ORDER)]
        first = F.min(F.struct(ORDER, *others)).alias(ITEM)
        objects = objects.groupBy(UP).agg(first).select(UP, f"{ITEM}.*")

    gathered = [_gather(child, plan) for child in table.children]
    if plan.split:
        objects = _in_pieces(objects, [pieces for _, pieces in gathered])
    for child, (items, _) in zip(table.children, gathered):
        objects = objects.join(items, plan.link, "left")
        if child.is_list:
            empty = F.array().cast(items.schema[child.attr].dataType)
            objects = objects.withColumn(child.attr, F.coalesce(child.attr, empty))
    return objects


def _in_pieces(objects: DataFrame, pieces: list[DataFrame]) -> DataFrame:
    """Repeats each object for the later pieces its attributes come in."""
    whole = objects.withColumn(PART, F.lit(FIRST_PIECE))
    if not pieces:
        return whole
    later = reduce(DataFrame.union, (p.where(F.col(PART) != FIRST_PIECE) for p in pieces))
    return whole.unionByName(objects.join(later.distinct(), KEY))


def _gather(table: Table, plan: _Plan) -> tuple[DataFrame, DataFrame]:
    """The attribute ``table`` stands for, one row per parent object or piece of one.

    Also the rows it is made from cut down to their link, which tells the pieces there are.
    """
    if table.kind is Kind.VALUES:
        rows = _linked(plan.tables[table.name], table)
        order = plan.tables.order_column(table)
        columns = [F.col(table.parent_key).alias(KEY), order.alias(ORDER)]
        if plan.split:
            columns.append(_stretch(plan).alias(PART))
        rows = rows.select(*columns, F.col(table.attr).alias(ITEM))
    else:
        rows = _objects(table, plan)
        item = F.struct(*_attributes(table, rows)).alias(ITEM)
        columns = [F.col(UP).alias(KEY), item]
        if table.kind is Kind.SINGLE:
            rows = rows.select(*columns, *([PART] if plan.split else []))
            return rows.withColumnRenamed(ITEM, table.attr), rows.select(*plan.link)
        columns.append(F.struct(*(c for c in (ORDER, KEY) if c in rows.columns)).alias(ORDER))
        if plan.split:
            own, stretch = F.col(PART), _stretch(plan)
            again = F.concat_ws(".", F.col(POS).cast("string"), own)
            piece = F.when(own == FIRST_PIECE, stretch).otherwise(again)
            columns.append(piece.alias(PART))
        rows = rows.select(*columns)

    links = rows.select(*plan.link)
    if table.name not in plan.tables.clustered:
        # Collecting before the shuffle would cost a sort and save nothing: all items go through.
        rows = _repartitioned(rows, _dealing(rows, table, plan))
    listed = F.sort_array(F.collect_list(F.struct(ORDER, ITEM))).getField(ITEM)
    return rows.groupBy(*plan.link).agg(listed.alias(table.attr)), links


def _dealing(rows: DataFrame, table: Table, plan: _Plan) -> list[int | str]:
    """What to deal the items by. As the buckets of their owners are, if these are more than the session's
    partitions: there Spark would shuffle what was gathered once more, to join it to the buckets."""
    buckets = 0 if plan.split else plan.tables.buckets.get(table.parent, 0)
    session = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return [buckets, *plan.link] if buckets > session else plan.link


def _repartitioned(rows: DataFrame, dealing: list[int | str]) -> DataFrame:
    """The rows dealt anew; lists of texts in the items take less room on the way."""
    item = rows.schema[ITEM].dataType
    texts = [f.name for f in item.fields if holds_texts(f.dataType)] if isinstance(item, T.StructType) else []

    def rewritten(rows: DataFrame, form: Callable[[Column], Column]) -> DataFrame:
        items = reduce(lambda new, name: new.withField(f"`{name}`", form(F.col(ITEM).getField(name))), texts, F.col(ITEM))
        return rows.withColumn(ITEM, items)

    if not texts:
        return rows.repartition(*dealing)
    return rewritten(rewritten(rows, packed_texts).repartition(*dealing), unpacked_texts)


def _stretch(plan: _Plan) -> Column:
    """The position at which the stretch of an item begins."""
    return (F.col(POS) - F.col(POS) % plan.list_size).cast("string")


def _attributes(table: Table, objects: DataFrame) -> list[Column]:
    """The fields of the rebuilt object in the order of the model, its key first."""
    columns = [F.col(name) for name in table.fields]
    if table.expose_id and KEY in objects.columns:
        columns.insert(0, F.col(KEY).alias("id"))
    return columns
