"""Documents chosen by conditions on several branches at once, without rebuilding any."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestframe.operators.durable import durable
from nestframe.plans.tables import DocumentTables

_HITS = "_hits"


@dataclass(frozen=True)
class Condition:
    """A condition on the rows that a document has in a table on any level.

    ``at_least`` so many must meet ``test``, or with ``every`` all of them, as is so if there are
    none. A test that gives NULL is not met.
    """

    table: str
    test: Column
    at_least: int = 1
    every: bool = False


def matching_keys(
    tables: DocumentTables, conditions: Sequence[Condition], match: str = "all"
) -> DataFrame:
    """Keys of the documents that meet all of the conditions, or any with ``match="any"``.

    For each condition rows are counted by their parent, and the counts added up level by level, so
    a document with very many hits is one number after the first step. The keys found are written;
    with ``"all"`` the fewest come first, and each condition is a semi-join with those left. No
    conditions are met by all documents. The result goes into ``fetch(matching=...)``.
    """
    if match not in ("all", "any"):
        raise ValueError(f"match is 'all' or 'any', not {match!r}.")
    layout = tables.layout
    every = tables[layout.name].select(layout.key).where(F.col(layout.key).isNotNull()).distinct()
    if not conditions:
        return every
    found = [durable(_keys(tables, condition, every)) for condition in conditions]
    if match == "any":
        return reduce(DataFrame.union, found).distinct()
    found.sort(key=DataFrame.count)
    return reduce(lambda left, right: left.join(right, layout.key, "left_semi"), found)


def _keys(tables: DocumentTables, condition: Condition, every: DataFrame) -> DataFrame:
    """The distinct keys of the documents that meet one condition."""
    key = tables.layout.key
    test = F.coalesce(condition.test, F.lit(False))
    if condition.every:
        misses = _counts(tables, condition.table, ~test)
        return every.join(misses.select(key), key, "left_anti")
    if condition.at_least < 1:
        return every
    counts = _counts(tables, condition.table, test).where(F.col(_HITS) >= condition.at_least)
    return counts.select(key).join(every, key, "left_semi")


def _counts(tables: DocumentTables, name: str, test: Column) -> DataFrame:
    """Root keys with the number of their rows in a table that meet a test, where there are any."""
    above = tables.layout.lineage(name)
    table = above[-1]
    column = table.parent_key or table.key
    counts = tables[name].where(test).groupBy(column).agg(F.count(F.lit(1)).alias(_HITS))
    for step in reversed(above[1:-1]):
        owners = tables[step.name].select(step.key, step.parent_key)
        sums = owners.join(counts, step.key).groupBy(step.parent_key)
        counts = sums.agg(F.sum(_HITS).alias(_HITS))
    return counts
