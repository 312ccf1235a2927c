"""The tables of a model in a relational database, through Spark's JDBC source."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from nestframe.plans.layout import Kind, Table
from nestframe.plans.tables import DocumentTables


def key_slices(column: str, slices: int) -> list[str]:
    """Conditions that divide a table by its hex keys for parallel reading, each row in just one."""
    if not 1 <= slices <= 256:
        raise ValueError(f"Between 1 and 256 slices, not {slices}.")
    bounds = [f"{256 * i // slices:02x}" for i in range(1, slices)]
    if not bounds:
        return ["1 = 1"]
    conditions = [f"{column} < '{bounds[0]}' OR {column} IS NULL"]
    for low, high in zip(bounds, bounds[1:]):
        conditions.append(f"{column} >= '{low}' AND {column} < '{high}'")
    return [*conditions, f"{column} >= '{bounds[-1]}'"]


def read_database(
    spark: SparkSession,
    layout: Table,
    url: str,
    properties: Mapping[str, str],
    slices: int = 16,
) -> DocumentTables:
    """The stored tables of a layout, each read in ``slices`` parallel parts.

    The parts are by the own key of a row, which is spread evenly however long the lists are; only
    values in lists, which have none, go by that of their parent.
    """
    frames = {}
    for table in layout.walk():
        column = table.parent_key if table.kind is Kind.VALUES else table.key
        predicates = key_slices(column, slices)
        frames[table.name] = spark.read.jdbc(
            url, table.name, predicates=predicates, properties=dict(properties)
        )
    return DocumentTables(layout, frames)


def write_database(tables: DocumentTables, url: str, properties: Mapping[str, str]) -> None:
    """Appends all rows, parents first so that foreign keys hold."""
    for table in tables.layout.walk():
        tables[table.name].write.jdbc(url, table.name, mode="append", properties=dict(properties))
