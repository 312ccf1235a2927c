"""The tables of a model in Spark's table catalog."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestframe.functions.nested import holds_texts, packed_texts, unpacked_texts
from nestframe.operators.durable import durable
from nestframe.operators.restrict import restrict
from nestframe.operators.versions import (
    document_digests,
    foreign_rows,
    row_columns,
    single_versions,
)
from nestframe.plans.layout import POS, Kind, Table
from nestframe.plans.tables import DocumentTables

# What one bucket should hold at most of a table, before compression. The task that reads it sorts it,
# where rows of a few bytes take some four times as much memory, or are spilled.
BUCKET_BYTES = 64 * 1024 * 1024


def list_tables(spark: SparkSession, database: str = "default") -> list[str]:
    return sorted(table.name for table in spark.catalog.listTables(database))


def table_schema(table: Table, root_key: T.DataType = T.StringType()) -> T.StructType:
    """The columns a table is stored with: its attributes, its key, that of its parent, ``_pos``.

    Keys are strings but for that of a root with a natural key, which is of type ``root_key``.
    """

    def key(owner_is_root: bool) -> T.DataType:
        return root_key if owner_is_root else T.StringType()

    columns = [T.StructField(f.name, f.dataType) for f in table.scalars]
    if table.kind is not Kind.VALUES:
        columns.append(T.StructField(table.key, key(table.parent is None)))
    if table.parent:
        columns.append(T.StructField(table.parent_key, key(table.parent_is_root)))
        columns.append(T.StructField(POS, T.IntegerType()))
    return T.StructType(columns)


def create_tables(
    spark: SparkSession,
    layout: Table,
    database: str = "default",
    root_key: T.DataType = T.StringType(),
) -> list[str]:
    """Creates the empty tables of a layout; those that exist are left as they are."""
    created = []
    for table in layout.walk():
        name = f"{database}.{table.name}"
        if not spark.catalog.tableExists(name):
            empty = spark.createDataFrame([], table_schema(table, root_key))
            empty.write.format("parquet").saveAsTable(name)
            created.append(table.name)
    return created


def load_tables(spark: SparkSession, layout: Table, database: str = "default") -> DocumentTables:
    """The stored tables of a layout."""
    frames = {t.name: spark.table(f"{database}.{t.name}") for t in layout.walk()}
    clustered = frozenset(t.name for t in layout.walk() if t.parent_key in _bucket_columns(spark, f"{database}.{t.name}"))
    names = {t.name: f"{database}.{t.name}" for t in layout.walk() if t.kind is not Kind.VALUES}
    buckets = {n: _buckets(spark, name) for n, name in names.items() if layout.find(n).key in _bucket_columns(spark, name)}
    return DocumentTables(layout, frames, numbered=True, clustered=clustered, buckets=buckets)


def save_tables(
    tables: DocumentTables, database: str = "default", buckets: int | None = None
) -> list[str]:
    """Creates the tables of a layout and fills them; a table that exists is an error.

    With ``buckets`` a table is bucketed by the key it is joined on: its own if it has child
    tables, else that of its parent. Rebuilding then needs no shuffle between these two. A bucket is
    read by one task, so ``buckets`` is the least number: where the largest table has more than
    ``BUCKET_BYTES`` for each, all tables get as many times more. A table with more rows of one key
    than an even bucket holds stays unbucketed, since its largest bucket would be read by one task;
    the names of such tables are returned. Tables are compressed with zstd.
    """
    columns = {t.name: t.key if t.children else t.parent_key for t in tables.layout.walk()}
    measured = {name: _measured(tables[name], column) for name, column in columns.items() if buckets and column}
    if measured:
        largest = max(size for _, _, size in measured.values())
        buckets *= max(1, ceil(largest / (buckets * BUCKET_BYTES)))
    uneven = []
    for table in tables.layout.walk():
        rows = tables[table.name]
        column = columns[table.name]
        if buckets and column and not _spreads_evenly(*measured[table.name][:2], buckets):
            uneven.append(table.name)
        even = buckets and column and table.name not in uneven
        dealt = _dealt(tables, table, buckets, column) if even else rows
        writer = dealt.write.mode("errorifexists").format("parquet").option("compression", "zstd")
        if even:
            writer = writer.bucketBy(buckets, column).sortBy(column)
        writer.saveAsTable(f"{database}.{table.name}")
    return uneven


def _dealt(tables: DocumentTables, table: Table, buckets: int, column: str) -> DataFrame:
    """The rows of a table, dealt to buckets; values go there in their lists, if these are known."""
    rows, lists = tables[table.name], tables.lists_of(table)
    if lists is None:
        return rows.repartition(buckets, column)
    items, texts = F.col(f"`{table.attr}`"), holds_texts(lists.schema[table.attr].dataType)
    packed = lists.select((packed_texts(items) if texts else items).alias(table.attr), column)
    exploded = F.posexplode_outer(unpacked_texts(items) if texts else items).alias(POS, table.attr)
    values = packed.repartition(buckets, column).select(exploded, column).where(F.col(POS).isNotNull())
    return values.select(*(f"`{c}`" for c in rows.columns))


def _measured(rows: DataFrame, column: str) -> tuple[int, int, int]:
    """The rows of the most frequent key, all rows, and about how many bytes these have."""
    widths = [
        F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) if isinstance(f.dataType, (T.StringType, T.BinaryType)) else F.lit(8)
        for f in rows.schema
    ]
    width = sum(widths, F.lit(0).cast("long"))
    # Hashes of the keys take less room than these; two that are alike make a count too high at most.
    counts = rows.groupBy(F.xxhash64(column)).agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("size"))
    found = counts.agg(F.max("n"), F.sum("n"), F.sum("size")).first()
    return tuple(value or 0 for value in found)


def _spreads_evenly(largest: int, total: int, buckets: int) -> bool:
    return largest * buckets <= max(total, 1_000_000)


def insert(
    tables: DocumentTables, database: str = "default", on_conflict: str = "keep"
) -> DataFrame:
    """Stores whole documents and returns the key of each that was refused, with the reason.

    A document stored before with the same content is left alone. With other content it is a
    conflict: ``"keep"`` refuses the new version, ``"replace"`` puts it in the place of the old
    one. A document offered in several versions is refused, as is one of which rows of another
    version, but not the document itself, are stored. Child rows are written first and the root
    last: a document is stored once its root row is, and repeating an insert that failed half-way
    adds what is missing. Attributes that the stored tables lack are added to them.
    """
    if on_conflict not in ("keep", "replace"):
        raise ValueError(f"on_conflict is 'keep' or 'replace', not {on_conflict!r}.")
    layout = tables.layout
    key, spark = layout.key, tables[layout.name].sparkSession
    if not tables[layout.name].where(F.col(key).isNull()).isEmpty():
        raise ValueError(f"Documents without {key!r} cannot be stored.")
    tables, refused = single_versions(tables)
    known = _stored_tables(spark, tables, database)
    offered = document_digests(tables)
    stored = document_digests(restrict(known, offered.select(key)))
    paired = offered.join(stored.withColumnRenamed("digest", "stored"), key, "left")
    other_version = F.col("stored").isNotNull() & (F.col("stored") != F.col("digest"))
    state = F.when(other_version, "conflict").when(F.col("stored").isNull(), "new").otherwise("same")
    states = durable(paired.select(key, state.alias("state")))
    leftover = foreign_rows(restrict(known, states.where("state = 'new'").select(key)), tables)
    reasons = refused.select(key, F.lit("offered in several versions").alias("reason"))
    reasons = reasons.unionByName(
        leftover.select(key, F.lit("rows of another version are stored").alias("reason"))
    )
    if on_conflict == "keep":
        conflicts = states.where("state = 'conflict'")
        reasons = reasons.unionByName(
            conflicts.select(key, F.lit("another version is stored").alias("reason"))
        )
    # Written, as what is stored changes from here on.
    reasons = durable(reasons.groupBy(key).agg(F.min("reason").alias("reason")))
    wanted = states.where("state <> 'same'").select(key).join(reasons, key, "left_anti")
    wanted = durable(wanted)
    if on_conflict == "replace":
        replaced = states.where("state = 'conflict'").join(wanted, key, "left_semi").select(key)
        _remove(known, durable(replaced), database)
    rows = restrict(tables, wanted)
    for table in reversed(list(layout.walk())):
        _append(spark, f"{database}.{table.name}", rows[table.name], row_columns(table))
    return reasons


def _stored_tables(spark: SparkSession, like: DocumentTables, database: str) -> DocumentTables:
    """The stored tables of a layout, with no rows for those that do not exist yet."""

    def stored(table: Table) -> DataFrame:
        name = f"{database}.{table.name}"
        if spark.catalog.tableExists(name):
            return spark.table(name)
        return like[table.name].limit(0)

    return DocumentTables(like.layout, {t.name: stored(t) for t in like.layout.walk()}, numbered=True)


def _remove(stored: DocumentTables, keys: DataFrame, database: str) -> None:
    """Takes documents out of the stored tables, the root first, so that none is left in part."""
    if keys.isEmpty():
        return
    layout = stored.layout
    gone = restrict(stored, keys)
    spark = keys.sparkSession
    owners = {table.name: durable(gone[table.name].select(table.parent_key).distinct()) for table in layout.walk() if table.parent}
    for table in layout.walk():
        column, rows = (table.parent_key, owners[table.name]) if table.parent else (table.key, keys)
        name = f"{database}.{table.name}"
        if spark.catalog.tableExists(name):
            kept = durable(stored[table.name].join(rows, column, "left_anti").select(*stored[table.name].columns))
            _bucketed(spark, name, kept).write.insertInto(name, overwrite=True)


def _append(spark: SparkSession, name: str, rows: DataFrame, key: list[str]) -> None:
    if not spark.catalog.tableExists(name):
        rows.write.format("parquet").saveAsTable(name)
        return
    stored = spark.table(name)
    new = [f for f in rows.schema if f.name not in stored.columns]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
        stored = spark.table(name)
    lacking = {f.name: F.lit(None).cast(f.dataType) for f in stored.schema if f.name not in rows.columns}
    rows = rows.withColumns(lacking).select(*stored.columns)
    absent = rows.join(stored.select(*key), key, "left_anti").select(*stored.columns)
    _bucketed(spark, name, absent).write.insertInto(name)


def _bucketed(spark: SparkSession, name: str, rows: DataFrame) -> DataFrame:
    """Dealt as the table's buckets are, so that each bucket gets one more file and not many."""
    columns = _bucket_columns(spark, name)
    return rows.repartition(_buckets(spark, name), *columns) if columns else rows


def _bucket_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isBucket]


def _buckets(spark: SparkSession, name: str) -> int:
    about = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'").first()
    return int(about["data_type"])
