"""Telling versions of a document apart by the content of all their rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestframe.functions.keys import row_text
from nestframe.operators.fetch import owner_keys
from nestframe.plans.layout import POS, Kind, Table
from nestframe.plans.tables import DocumentTables

_TEXT, _BAD = "_row_text", "_bad"


def row_columns(table: Table) -> list[str]:
    """The columns that name a row: values in lists have no key and go by parent and position."""
    return [table.parent_key, POS] if table.kind is Kind.VALUES else [table.key]


def _content(rows: DataFrame, table: Table) -> Column:
    """All attributes of a row and its position as one text; NULL is the same as no such column."""
    linking = {table.key, table.parent_key}
    return row_text(sorted((f for f in rows.schema if f.name not in linking), key=lambda f: f.name), nulls=False)


def document_digests(tables: DocumentTables) -> DataFrame:
    """The root key and ``digest`` of each document, the same for equal documents only.

    Rows are hashed and summed up by the row they belong to, level by level; sums of two 64-bit
    hashes and a count stand for the rows of a list, whose positions are part of what is hashed.
    """

    def digested(table: Table) -> DataFrame:
        rows = tables[table.name].withColumn(_TEXT, _content(tables[table.name], table))
        parts = [F.col(_TEXT)]
        for child in table.children:
            below = digested(child).groupBy(child.parent_key).agg(
                F.sum(F.xxhash64(_TEXT).cast("decimal(20,0)")).alias("a"),
                F.sum(F.xxhash64(_TEXT, F.lit(1)).cast("decimal(20,0)")).alias("b"),
                F.count("*").alias("n"),
            )
            name = f"_{child.name}"
            below = below.select(
                F.col(child.parent_key).alias("_owner"), F.concat_ws(" ", "a", "b", "n").alias(name)
            )
            rows = rows.join(below, rows[table.key] == F.col("_owner"), "left").drop("_owner")
            parts.append(F.concat(F.lit(f"{child.name}="), F.coalesce(name, F.lit(""))))
        keys = [k for k in (table.key, table.parent_key) if k in rows.columns]
        return rows.select(*dict.fromkeys(keys), F.concat_ws("|", *parts).alias(_TEXT))

    layout = tables.layout
    return digested(layout).select(layout.key, F.sha2(_TEXT, 256).alias("digest"))


def single_versions(tables: DocumentTables) -> tuple[DocumentTables, DataFrame]:
    """The tables with equal rows once, and the root keys of documents with different rows of a key.

    Rows are only compared if a count of keys finds some more than once.
    """
    layout = tables.layout
    frames, bad = {}, [tables[layout.name].select(layout.key).limit(0)]
    for table in layout.walk():
        rows, names = tables[table.name], row_columns(table)
        if not rows.groupBy(*names).count().where("count > 1").isEmpty():
            rows = rows.distinct()
            several = rows.groupBy(*names).agg((F.count("*") > 1).alias(_BAD))
            marked = tables.with_frames({table.name: rows.join(several, names)})
            bad.append(_roots(marked, table))
        frames[table.name] = rows
    keys = reduce(DataFrame.unionByName, bad).distinct()
    several = tables.with_frames(frames)
    return several, keys


def _roots(marked: DocumentTables, table: Table) -> DataFrame:
    layout = marked.layout
    keys = owner_keys(marked, table.name, F.col(_BAD))
    return keys.toDF(layout.key).distinct()


def foreign_rows(stored: DocumentTables, offered: DocumentTables) -> DataFrame:
    """Root keys under which child rows are stored that the offered documents do not have."""
    layout = stored.layout
    found = [stored[layout.name].select(layout.key).limit(0)]
    for table in layout.walk():
        if not table.parent:
            continue
        names = [*dict.fromkeys([*row_columns(table), table.parent_key])]
        rows, wanted = (
            t[table.name].select(*names, _content(t[table.name], table).alias(_TEXT)) for t in (stored, offered)
        )
        rows = rows.join(wanted.withColumn(_BAD, F.lit(False)), [*names, _TEXT], "left")
        rows = rows.withColumn(_BAD, F.coalesce(_BAD, F.lit(True)))
        # Owners are looked up among the offered rows as well: those stored may lack some.
        above = {
            t.name: stored[t.name].select(t.key, *([t.parent_key] if t.parent else [])).unionByName(
                offered[t.name].select(t.key, *([t.parent_key] if t.parent else []))
            )
            for t in layout.lineage(table.name)[:-1]
        }
        found.append(_roots(stored.with_frames({**above, table.name: rows}), table))
    return reduce(DataFrame.unionByName, found).distinct()
