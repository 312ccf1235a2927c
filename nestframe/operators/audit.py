"""Checks of what a database would enforce: required values, primary keys and foreign keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestframe.functions.keys import row_text
from nestframe.operators.pieces import content_digests, may_be_pieces
from nestframe.plans.layout import PART, Kind, Table
from nestframe.plans.model import nullable_type
from nestframe.plans.tables import DocumentTables


def required_columns(table: Table) -> list[str]:
    """The columns of a table that may not be NULL: its key and its required attributes."""
    required = [f.name for f in table.scalars if not f.nullable]
    return required if table.kind is Kind.VALUES else [*required, table.key]


def audit_not_null(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of NULLs in each column, counted in one pass."""
    nulls = rows.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return nulls.select(
        F.inline(
            F.array(
                *(F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null")) for c in columns)
            )
        )
    )


def audit_primary_key(rows: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the number of their rows."""
    keys = [key] if isinstance(key, str) else list(key)
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.where(F.col("n_rows") > 1)


def audit_foreign_key(
    rows: DataFrame, column: str, parents: DataFrame, parent_key: str
) -> DataFrame:
    """Values without a parent row, with the number of rows that have them; NULL links nothing.

    Rows are counted per value before the join, so that a frequent value costs no more there than
    a rare one.
    """
    counts = (
        rows.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    keys = parents.select(F.col(parent_key).alias(column))
    return counts.join(keys, column, "left_anti")


def audit_model(tables: DocumentTables) -> DataFrame:
    """All checks of a layout: ``table_name, column, fault, n_rows``, a row for each that fails.

    Faults are ``missing`` (a required value), ``repeated`` (rows beyond the first of a key) and
    ``no parent`` (a row whose parent key no parent has).
    """
    found = []

    def add(table: Table, column: str, fault: str, rows: DataFrame, count: str) -> None:
        named = rows.agg(F.coalesce(F.sum(count), F.lit(0)).cast("long").alias("n_rows"))
        labels = (F.lit(v).alias(n) for n, v in (("table_name", table.name), ("column", column), ("fault", fault)))
        found.append(named.select(*labels, "n_rows"))

    for table in tables.layout.walk():
        rows = tables[table.name]
        missing = audit_not_null(rows, [c for c in required_columns(table) if c in rows.columns])
        found.append(
            missing.select(
                F.lit(table.name).alias("table_name"), "column", F.lit("missing").alias("fault"), F.col("n_null").alias("n_rows")
            )
        )
        if tables.has_key(table):
            repeated = audit_primary_key(rows.where(F.col(table.key).isNotNull()), table.key)
            add(table, table.key, "repeated", repeated.select((F.col("n_rows") - 1).alias("n")), "n")
        if table.parent:
            parents = tables[table.parent]
            orphans = audit_foreign_key(rows, table.parent_key, parents, table.parent_key)
            add(table, table.parent_key, "no parent", orphans, "n_rows")
    return reduce(DataFrame.unionByName, found).where("n_rows > 0")


def table_counts(tables: DocumentTables) -> DataFrame:
    """Number of rows of each table."""
    counts = [
        tables[table.name].agg(
            F.lit(table.name).alias("table_name"), F.count(F.lit(1)).alias("n_rows")
        )
        for table in tables.layout.walk()
    ]
    return reduce(DataFrame.unionByName, counts)


def difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """One row: how many documents of each side the other lacks, copies counted.

    Documents are compared by a digest of their content, so that not they but their digests are
    shuffled, summed up before; one aggregation does for both directions. A document in pieces,
    which needs its ``id`` for that, is compared as a whole. The columns of ``expected`` are compared,
    but for the numbers of pieces, and for generated keys unless both sides have them and no pieces.
    """
    sides = expected, actual
    in_pieces = any(may_be_pieces(side) for side in sides)
    skipped = {PART} if not in_pieces and all("id" in side.columns for side in sides) else {PART, "id"}
    fields = [f for f in expected.schema.fields if f.name not in skipped]

    def alike(rows: DataFrame) -> DataFrame:
        # Cast, so that the other side's text is written from the same types.
        columns = [F.col(f"`{f.name}`").cast(nullable_type(f.dataType)).alias(f.name) for f in fields]
        return rows.select(*columns, *({PART, "id"} & set(rows.columns) if may_be_pieces(rows) else []))

    def digests(rows: DataFrame, side: int) -> DataFrame:
        if in_pieces:
            content = F.struct("a", "b")
            rows = content_digests(alike(rows), fields)
        else:
            content = F.unhex(F.sha2(row_text(fields), 256))
            rows = alike(rows)
        return rows.select(content.alias("_row"), F.lit(side).alias("_side"))

    both = digests(expected, 1).unionByName(digests(actual, -1))
    surplus = both.groupBy("_row").agg(F.sum("_side").alias("_surplus"))
    zero = F.lit(0).cast("long")
    return surplus.agg(
        F.coalesce(F.sum(F.greatest(F.col("_surplus"), zero)), zero).alias("n_missing"),
        F.coalesce(F.sum(F.greatest(-F.col("_surplus"), zero)), zero).alias("n_extra"),
    )
