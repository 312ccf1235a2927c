"""Filter conditions."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def equals(frame: DataFrame, column: str, value: Any) -> Column:
    """Equality of a column with a value."""
    return frame[column] == F.lit(value)


def any_item_equals(path: str, value: Any) -> Column:
    """Whether any item reached by a dotted path equals ``value``.

    The last step may pass through one list of objects (``lines.status``); further list levels
    are named by ``[]`` (``orders[].lines.status``).
    """
    outer, *inner = path.split("[].")

    def check(column: Column, rest: list[str]) -> Column:
        if not rest:
            return F.array_contains(column, F.lit(value))
        step, *deeper = rest
        names = step.split(".")

        def item(element: Column) -> Column:
            for name in names:
                element = element.getField(name)
            return check(element, deeper)

        return F.exists(column, item)

    return F.coalesce(check(F.col(outer), inner), F.lit(False))
