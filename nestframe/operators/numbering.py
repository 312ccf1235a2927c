"""Positions in lists that are too long for one task and were stored without positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nestframe.operators.durable import durable
from nestframe.plans.layout import POS

_COUNT, TIE, _SLICE, _ROW, _SHIFT = "_count", "_tie", "_slice", "_row", "_shift"
BROADCAST_ROWS = 100_000


def long_parents(rows: DataFrame, parent_key: str, list_size: int) -> DataFrame:
    """Keys of the parents with more than ``list_size`` rows."""
    counts = rows.groupBy(parent_key).agg(F.count(F.lit(1)).alias(_COUNT))
    return counts.where(F.col(_COUNT) > list_size).select(parent_key)


def number_long_lists(
    rows: DataFrame,
    parents: DataFrame,
    parent_key: str,
    order: Sequence[str],
    unique: str | None = None,
) -> DataFrame:
    """Adds ``_pos``: the position 0, 1, 2... of a row in the lists of ``parents``, and 0 in others.

    No task sees a whole long list. Their rows are sorted over the cluster by parent and order, so
    that each slice of the sort holds a stretch of a few lists, and numbered from the row number
    in the slice and the rows of the parent in earlier slices. A tie-breaker lets a run of equal
    rows be cut too: the column ``unique``, or else a running number. The running numbers and the
    slices are written out, as a retried task must see the same.
    """
    first = F.lit(0).cast("long")
    parents = durable(parents)
    if parents.isEmpty():
        return rows.withColumn(POS, first)
    others = rows.join(parents, parent_key, "left_anti").withColumn(POS, first)

    tied = rows.join(parents, parent_key, "left_semi")
    if unique is None:
        tied = durable(tied.withColumn(TIE, F.monotonically_increasing_id()))
    ordering = [parent_key, *order, unique or TIE]
    sliced = durable(
        tied.repartitionByRange(*ordering)
        .sortWithinPartitions(*ordering)
        .select(
            *rows.columns,
            F.spark_partition_id().alias(_SLICE),
            F.monotonically_increasing_id().alias(_ROW),
        )
    )
    earlier = (
        Window.partitionBy(parent_key)
        .orderBy(_SLICE)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    runs = sliced.groupBy(parent_key, _SLICE).agg(
        F.count(F.lit(1)).alias(_COUNT), F.min(_ROW).alias(_ROW)
    )
    before = F.coalesce(F.sum(_COUNT).over(earlier), F.lit(0))
    shifts = runs.select(parent_key, _SLICE, (before - F.col(_ROW)).alias(_SHIFT))
    if shifts.count() <= BROADCAST_ROWS:
        shifts = F.broadcast(shifts)
    numbered = sliced.join(shifts, [parent_key, _SLICE]).withColumn(
        POS, F.col(_ROW) + F.col(_SHIFT)
    )
    columns = [*rows.columns, POS]
    return others.select(columns).unionByName(numbered.select(columns))
