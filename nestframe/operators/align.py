"""Lists side by side in one table, aligned by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nestframe.operators.durable import durable
from nestframe.plans.layout import POS, Kind, Table
from nestframe.plans.tables import DocumentTables

ROW = "_row"
_OWNER, _AT, _SLICE, _SIZE, _BEFORE, _TIE = "_owner", "_at", "_slice", "_size", "_before", "_tie"


def running_sums(
    rows: DataFrame, group: str, order: Sequence[str], value: str, name: str
) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows of the same group that come before.

    Rows are sorted over the cluster. A window never holds more than the rows that a slice of the
    sort has of a group, so a group with most of the rows is the work of as many tasks as its share
    asks for. Slices are written out, and rows of equal order numbered before, so that a task done
    again sees the same.
    """
    ordering = [group, *order, _TIE]
    tied = durable(rows.withColumn(_TIE, F.monotonically_increasing_id()))
    sliced = tied.repartitionByRange(*ordering).withColumn(_SLICE, F.spark_partition_id())
    sliced = durable(sliced)
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    within = earlier.partitionBy(_SLICE, group).orderBy(*order, _TIE)
    sums = sliced.groupBy(group, _SLICE).agg(F.sum(value).alias(_SIZE))
    shifts = sums.withColumn(_BEFORE, F.sum(_SIZE).over(earlier.partitionBy(group).orderBy(_SLICE)))
    zero = F.lit(0).cast("long")
    shifts = shifts.select(group, _SLICE, F.coalesce(_BEFORE, zero).alias(_BEFORE))
    summed = sliced.withColumn(name, F.coalesce(F.sum(value).over(within), zero))
    placed = summed.join(shifts, [group, _SLICE]).withColumn(name, F.col(name) + F.col(_BEFORE))
    return placed.drop(_SLICE, _BEFORE, _TIE)


def flatten_aligned(tables: DocumentTables) -> DataFrame:
    """One wide table in which the lists of an object run side by side.

    Row ``i`` of a document has item ``i`` of each of its lists, NULL where a list is shorter, so a
    document has as many rows as its longest list (one if it has none) and every item comes once.
    An item with lists of its own takes as many rows as the longest of these, and is repeated on
    them; the next item follows below. ``_row`` numbers the rows of a document. Columns of a
    child table that clash with columns to their left get its name as a prefix; keys of parents
    are not repeated. Rows without a parent belong to no document and are left out.

    Lists stored with positions are aligned by these; where a position is vacant in all lists, as
    after NULL items, there is no row. Others go by their order. Nothing is collected: the lists of
    an object are joined on its key and the row.
    """
    layout = tables.layout
    taken = {c.lower() for c in _own_columns(tables, layout)} | {ROW}
    rows, columns = _sequence(tables, layout, taken)
    own = _own_columns(tables, layout)
    return rows.select(*own, F.col(_AT).alias(ROW), *(c for c in columns if c not in own))


def _own_columns(tables: DocumentTables, table: Table) -> list[str]:
    keys = [table.key] if tables.has_key(table) else []
    return [*(f.name for f in table.scalars), *keys]


def _sequence(tables: DocumentTables, table: Table, taken: set[str]) -> tuple[DataFrame, list[str]]:
    """The rows of each object of a table, ``_at`` 0, 1, 2..., with the columns of all below it.

    ``_owner`` is the key of the object's parent; for a list, ``_at`` runs over all its items.
    """
    own = _own_columns(tables, table)
    rows = tables[table.name]
    names = {}
    for column in own:
        clash = table.parent is not None and column.lower() in taken
        names[column] = f"{table.name}_{column}" if clash else column
        taken.add(names[column].lower())
    key = "_key"
    selected = [F.col(c).alias(n) for c, n in names.items()]
    if table.parent:
        rows = rows.where(F.col(table.parent_key).isNotNull())
        selected.append(F.col(table.parent_key).alias(_OWNER))
        if tables.has_pos(table):
            selected.append(F.col(POS).cast("long").alias(POS))
        order = [c for c in tables.order_columns(table) if c != POS]
        selected += [F.col(c).alias(f"_by{i}") for i, c in enumerate(order)]
    if table.children:
        selected.append(F.col(table.key).alias(key))
    objects = rows.select(*selected)
    columns = list(names.values())
    by = [c for c in objects.columns if c == POS or c.startswith("_by")]
    if table.kind is Kind.SINGLE:
        # The first row counts if there are several.
        first = F.min(F.struct(*by, *(c for c in objects.columns if c not in (*by, _OWNER)))).alias("_first")
        objects = objects.groupBy(_OWNER).agg(first).select(_OWNER, "_first.*")

    below = None
    for child in table.children:
        sequence, more = _sequence(tables, child, taken)
        sequence = sequence.select(F.col(_OWNER).alias(key), _AT, *more)
        columns += more
        below = sequence if below is None else below.join(sequence, [key, _AT], "full")
    if below is not None:
        filled = below.join(objects, key)
        empty = objects.join(below.select(key).distinct(), key, "left_anti")
        size = below.groupBy(key).agg((F.max(_AT) + 1).alias(_SIZE))
        zero = F.lit(0).cast("long")
        objects_rows = filled.unionByName(empty.withColumn(_AT, zero), allowMissingColumns=True)
    else:
        objects_rows = objects
    if not table.parent:
        return objects_rows if below is not None else objects.withColumn(_AT, F.lit(0).cast("long")), columns
    if table.kind is Kind.SINGLE:
        at = F.col(_AT) if below is not None else F.lit(0).cast("long")
        return objects_rows.select(_OWNER, at.alias(_AT), *columns), columns
    if below is None:
        if tables.numbered and tables.has_pos(table):
            placed = objects.withColumn(_AT, F.col(POS))
        else:
            placed = running_sums(objects.withColumn(_SIZE + "1", F.lit(1)), _OWNER, by, _SIZE + "1", _AT)
        return placed.select(_OWNER, _AT, *columns), columns
    sized = objects.select(key, _OWNER, *by).join(size, key, "left")
    sized = sized.withColumn(_SIZE, F.coalesce(_SIZE, F.lit(1)))
    begins = running_sums(sized, _OWNER, by, _SIZE, "_begin").select(key, "_begin")
    placed = objects_rows.join(begins, key)
    return placed.select(_OWNER, (F.col("_begin") + F.col(_AT)).alias(_AT), *columns), columns
