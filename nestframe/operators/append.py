"""Adding only rows whose key is new."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def absent_rows(new: DataFrame, existing: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The rows of ``new`` whose key ``existing`` lacks, one for each key.

    Of several new rows with one key the least is taken, so that a repeated run picks the same.
    The keys of ``existing`` are first cut down to those that also occur in ``new``: against a
    small batch Spark then scans a large table without shuffling it.
    """
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in new.columns if c not in keys]
    if others:
        least = F.min(F.struct(*others)).alias("_least")
        unique = new.groupBy(*keys).agg(least).select(*keys, "_least.*").select(*new.columns)
    else:
        unique = new.distinct()

    def same(left: DataFrame, right: DataFrame):
        return [left[k].eqNullSafe(right[f"_{k}"]) for k in keys]

    def renamed(frame: DataFrame) -> DataFrame:
        return frame.select(*(F.col(k).alias(f"_{k}") for k in keys))

    stored = existing.select(*keys)
    present = stored.join(wanted := renamed(new).distinct(), same(stored, wanted), "left_semi")
    present = renamed(present)
    return unique.join(present, same(unique, present), "left_anti")
