"""Documents stored in the order of their keys, in slices that are replaced one by one.

The tables have path keys (``shred(..., keys="path")``): the key of an object begins with the label of
its document, so on every level the rows of a document are one range of keys, and their document is
told without a join. Documents lie in *slots*, ranges of labels with about equally many of them when
the store was made, and are sorted by label in a slot. Each write puts its rows into new partitions,
one per slot and write. Which partitions count is written in one property of the root table, last
and at once for all tables: a write that stops before is not seen, whatever it left behind.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestframe.functions.keys import LABEL_END, label_of, root_label
from nestframe.operators.assemble import assemble
from nestframe.operators.durable import durable
from nestframe.operators.versions import document_digests
from nestframe.plans.layout import POS, Table
from nestframe.plans.tables import DocumentTables

SLICE, LABEL, SLOT = "_slice", "_label", "_slot"
PROPERTY = "nestframe.slices"
SLOTS = 64
# Up to this many documents are looked up by a range of keys each.
RANGES = 32
# Up to this many documents are looked for where the rows are, without a shuffle of these.
FEW_LABELS = 1_000_000


@dataclass(frozen=True)
class Store:
    """Documents in the tables of a database; see the functions of this module."""

    spark: SparkSession
    layout: Table
    database: str
    key_type: T.DataType

    # What counts.

    def _state(self) -> dict[str, Any]:
        """Upper labels of the slots but the last, documents and partitions of each slot."""
        name = f"{self.database}.{self.layout.name}"
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == PROPERTY)
        found = rows.first()
        if found is None:
            raise ValueError(f"{name} is not the root table of a finished store.")
        return json.loads(zlib.decompress(bytes.fromhex(found["value"])))

    def _publish(self, state: dict[str, Any]) -> None:
        name = f"{self.database}.{self.layout.name}"
        # Hexadecimal, as it goes through SQL text and logs that blot out what looks like a secret.
        text = zlib.compress(json.dumps(state).encode()).hex()
        self.spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{PROPERTY}' = '{text}')")

    # Reading.

    def tables(self, slots: Iterable[int] | None = None) -> DocumentTables:
        """The stored tables, or the part of them in some slots."""
        state = self._state()
        wanted = range(len(state["slices"])) if slots is None else slots
        slices = [name for slot in wanted for name in state["slices"][slot]]
        frames = {}
        for table in self.layout.walk():
            rows = self.spark.table(f"{self.database}.{table.name}")
            frames[table.name] = rows.where(F.col(SLICE).isin(slices)).drop(SLICE)
        return DocumentTables(self.layout, frames, numbered=True)

    def _rows_of(self, keys: Sequence[Any]) -> DocumentTables:
        """The rows of the documents with the given keys, found by ranges of keys in their slots."""
        values = self.spark.createDataFrame([(key,) for key in keys], T.StructType([T.StructField("key", self.key_type)]))
        labels = sorted(row[0] for row in values.select(root_label(F.col("key"), self.key_type)).collect())
        bounds = self._state()["bounds"]
        tables = self.tables(sorted({sum(bound < label for bound in bounds) for label in labels}))
        frames = {}
        for table in self.layout.walk():
            rows = tables[table.name]
            column = F.col(table.parent_key or table.key)
            if table.parent is None or table.parent_is_root:
                chosen = column.isin(list(keys))
            elif len(labels) <= RANGES:
                chosen = F.lit(False)
                for label in labels:
                    chosen = chosen | ((column >= f"{label}/") & (column < f"{label}{LABEL_END}"))
            else:
                chosen = label_of(column).isin(labels)
            frames[table.name] = rows.where(chosen)
        return tables.with_frames(frames)

    def get(self, keys: Sequence[Any], fields: Iterable[str] | None = None) -> DataFrame:
        """The documents with the given keys. Only their slots are read, and of these the ranges of their keys."""
        return assemble(self._rows_of(keys), fields)

    def first(self, max_rows: int = 10, fields: Iterable[str] | None = None) -> DataFrame:
        """The documents of least label, as many as there are up to ``max_rows``.

        As slots are in the order of labels, the first ones that together have as many documents are
        all that is read; their number is known without looking.
        """
        state = self._state()
        slots, found = 0, 0
        while slots < len(state["slices"]) and found < max_rows:
            found += state["documents"][slots]
            slots += 1
        root = self.tables(range(slots))[self.layout.name]
        order = root_label(F.col(self.layout.key), self.key_type)
        keys = [row[0] for row in root.select(self.layout.key).orderBy(order).limit(max_rows).collect()]
        if not keys:
            return assemble(self.tables([]), fields)
        return self.get(keys, fields)

    # Writing.

    def put(self, tables: DocumentTables) -> dict[str, int]:
        """Adds documents; those of a stored key take the place of the stored ones, whole.

        Documents equal to the stored ones are left alone. Only the slots with replaced documents
        are written anew; the others get one more partition. Returns the numbers of documents
        ``added``, ``replaced`` and ``same`` and of slots ``rewritten``. One writer at a time.
        """
        state, key = self._state(), self.layout.key
        for table in self.layout.walk():
            stored = self.spark.table(f"{self.database}.{table.name}").columns
            if odd := sorted(set(tables[table.name].columns) - set(stored)):
                raise ValueError(f"{table.name!r} of the store has no columns {odd}.")
        label = root_label(F.col(key), self.key_type)
        offered = document_digests(tables).withColumn(LABEL, label).withColumn(SLOT, _slot(F.col(LABEL), state["bounds"]))
        offered = durable(offered)
        touched = [row[0] for row in offered.select(SLOT).distinct().collect()]
        near = self.tables(touched)
        if offered.count() <= FEW_LABELS:
            near = _of_documents(near, self.key_type, offered.select(LABEL))
        # Of many, all in their slots are digested: rows are added up where they are read, and not shuffled.
        stored = document_digests(near).select(label.alias(LABEL), F.col("digest").alias("stored"))
        states = offered.join(stored, LABEL, "left").withColumn(
            "state", F.when(F.col("stored").isNull(), "added").when(F.col("stored") != F.col("digest"), "replaced").otherwise("same")
        )
        states = durable(states.select(LABEL, SLOT, "state"))
        counts = {(row[SLOT], row["state"]): row["count"] for row in states.groupBy(SLOT, "state").count().collect()}
        again = sorted({slot for slot, kind in counts if kind == "replaced"})
        # Written apart, so that their number is known.
        changed = durable(states.where("state <> 'same'"))
        fresh = _of_documents(tables, self.key_type, changed.select(LABEL))
        written = uuid.uuid4().hex[:12]
        replaced = durable(changed.where("state = 'replaced'").select(LABEL))
        kept = _of_documents(self.tables(again), self.key_type, replaced, keep=False) if again else None
        self._write(fresh, kept, state["bounds"], written)

        for slot in sorted({slot for slot, kind in counts if kind != "same"}):
            name = _slice_name(slot, written)
            state["slices"][slot] = [name] if slot in again else [*state["slices"][slot], name]
            state["documents"][slot] += counts.get((slot, "added"), 0)
        self._publish(state)
        total = {kind: sum(n for (_, k), n in counts.items() if k == kind) for kind in ("added", "replaced", "same")}
        return {**total, "rewritten": len(again)}

    def _write(self, fresh: DocumentTables, kept: DocumentTables | None, bounds: list[str], written: str) -> None:
        """New partitions with the given rows, sorted by key within their slots."""
        for table in self.layout.walk():
            name = f"{self.database}.{table.name}"
            rows = fresh[table.name]
            if kept is not None:
                rows = rows.unionByName(kept[table.name], allowMissingColumns=True)
            column = table.parent_key or table.key
            label = _label(table, self.key_type)
            rows = rows.withColumn(SLOT, _slot(label, bounds))
            rows = rows.withColumn(SLICE, F.concat(F.lpad(F.col(SLOT).cast("string"), 5, "0"), F.lit(f"-{written}")))
            order = [SLICE, label, column, *([POS] if POS in rows.columns else [])]
            rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop(SLOT)
            if not self.spark.catalog.tableExists(name):
                rows.write.format("parquet").partitionBy(SLICE).saveAsTable(name)
            else:
                columns = self.spark.table(name).columns
                rows.select(*columns).write.insertInto(name)

    def vacuum(self) -> list[str]:
        """Drops the partitions that no longer count, those of stopped writes among them."""
        state = self._state()
        live = {name for slices in state["slices"] for name in slices}
        dropped = set()
        for table in self.layout.walk():
            name = f"{self.database}.{table.name}"
            for row in self.spark.sql(f"SHOW PARTITIONS {name}").collect():
                slice_name = row[0].partition("=")[2]
                if slice_name not in live:
                    self.spark.sql(f"ALTER TABLE {name} DROP PARTITION ({SLICE} = '{slice_name}')")
                    dropped.add(slice_name)
        return sorted(dropped)


def create_store(tables: DocumentTables, database: str, slots: int = SLOTS) -> Store:
    """Stores the documents of tables with path keys; the tables must not exist yet.

    A store of another layout or with other attributes is another store. Slots hold about equally
    many documents; a label may end only one slot, so few documents make few slots.
    """
    layout = tables.layout
    spark = tables[layout.name].sparkSession
    key_type = tables[layout.name].schema[layout.key].dataType
    store = Store(spark, layout, database, key_type)
    if spark.catalog.tableExists(f"{database}.{layout.name}"):
        raise ValueError(f"There is a table {layout.name!r} in {database!r} already.")
    labels = tables[layout.name].select(_label(layout, key_type).alias(LABEL))
    labels = durable(labels)
    bounds = _bounds(labels, slots)
    written = uuid.uuid4().hex[:12]
    store._write(tables, None, bounds, written)
    counts = labels.groupBy(_slot(F.col(LABEL), bounds).alias(SLOT)).count().collect()
    documents = [0] * (len(bounds) + 1)
    for row in counts:
        documents[row[SLOT]] = row["count"]
    slices = [[_slice_name(slot, written)] if n else [] for slot, n in enumerate(documents)]
    store._publish({"bounds": bounds, "documents": documents, "slices": slices})
    return store


def open_store(spark: SparkSession, layout: Table, database: str) -> Store:
    """A store made before, by the layout of its documents."""
    key_type = spark.table(f"{database}.{layout.name}").schema[layout.key].dataType
    return Store(spark, layout, database, key_type)


def _slice_name(slot: int, written: str) -> str:
    return f"{slot:05}-{written}"


def _bounds(labels: DataFrame, slots: int) -> list[str]:
    """The last label of each slot but the last one, from a sort of all labels."""
    ordered = labels.repartitionByRange(slots, LABEL)
    lasts = ordered.groupBy(F.spark_partition_id().alias("p")).agg(F.max(LABEL).alias(LABEL))
    return sorted(row[LABEL] for row in lasts.collect() if row[LABEL] is not None)[:-1]


def _slot(label: Column, bounds: list[str]) -> Column:
    """The number of bounds below a label, found by halving."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(label > bounds[middle], search(middle + 1, high)).otherwise(search(low, middle))

    return search(0, len(bounds))


def _label(table: Table, key_type: T.DataType) -> Column:
    """The label of the document a row belongs to."""
    column = F.col(table.parent_key or table.key)
    if table.parent is None or table.parent_is_root:
        return root_label(column, key_type)
    return label_of(column)


def _of_documents(tables: DocumentTables, key_type: T.DataType, labels: DataFrame, keep: bool = True) -> DocumentTables:
    """The rows, on every level, of the documents with the given labels, or of all others.

    Few labels are sent to the rows, which then stay where they are.
    """
    if labels.count() <= FEW_LABELS:
        labels = F.broadcast(labels)
    frames = {}
    for table in tables.layout.walk():
        rows = tables[table.name]
        marked = rows.withColumn(LABEL, _label(table, key_type))
        chosen = marked.join(labels.select(LABEL), LABEL, "left_semi" if keep else "left_anti")
        frames[table.name] = chosen.select(*rows.columns)
    return tables.with_frames(frames)
