"""Documents that arrive as files, stored as they come."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from nestframe.operators.durable import durable
from nestframe.operators.shred import shred
from nestframe.plans.layout import table_layout
from nestframe.plans.model import model_schema
from nestframe.sources.documents import REJECT, parse_documents
from nestframe.sources.store import SLOTS, create_store, open_store

BATCH = "batch"


def store_stream(
    spark: SparkSession,
    folder: str,
    model: T.StructType | str,
    root: str,
    key: str | Sequence[str],
    database: str,
    checkpoint: str,
    one_per_file: bool = True,
    files_per_batch: int | None = None,
    slots: int = SLOTS,
    until_empty: bool = True,
) -> StreamingQuery:
    """Stores the JSON documents of a folder, and of files added to it, in the store of a database.

    One document per file, or per line. Files are taken in batches of ``files_per_batch``; which
    have been taken is kept in ``checkpoint``. Each batch is put into the store at once: a document
    of a stored key takes the stored one's place if it is another, so a batch that is repeated after
    a failure stores nothing twice. What does not fit the model, and documents of a batch without
    key or of one key, come in the table ``{root}_rejects`` with their batch, also once. With
    ``until_empty`` the query ends when all files there are have been taken, else it goes on.

    The first batch makes the store and its slots. A store has one writer at a time.
    """
    model = model_schema(model)
    lines = spark.readStream.format("text").option("wholetext", one_per_file)
    if files_per_batch:
        lines = lines.option("maxFilesPerTrigger", files_per_batch)

    def take(batch: DataFrame, number: int) -> None:
        store_batch(batch, number, model, root, key, database, slots)

    writer = lines.load(folder).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if until_empty else writer).start()


def store_batch(
    batch: DataFrame,
    number: int,
    model: T.StructType,
    root: str,
    key: str | Sequence[str],
    database: str,
    slots: int = SLOTS,
) -> None:
    """Stores one batch of documents, JSON text in ``value``; see ``store_stream``."""
    spark = batch.sparkSession
    # Written, so that texts are parsed once for all tables.
    parsed = durable(parse_documents(batch.select("value"), "value", model))
    good = parsed.where(F.col(REJECT).isNull()).drop(REJECT)
    tables = shred(good, root, key=key, model=model, bad_keys="reject", keys="path")
    rejects = parsed.where(F.col(REJECT).isNotNull()).select(
        F.lit("does not fit the model").alias("reason"), F.col(REJECT).alias("content")
    )
    if tables.rejected is not None:
        bad = tables.rejected.select(
            F.concat(F.lit("key "), "reason").alias("reason"), F.col(tables.layout.key).cast("string").alias("content")
        )
        rejects = rejects.unionByName(bad)
    _keep(spark, rejects, f"{database}.{root}_rejects", number)
    if spark.catalog.tableExists(f"{database}.{root}"):
        open_store(spark, table_layout(model, root), database).put(tables)
    else:
        create_store(tables, database, slots)


def _keep(spark: SparkSession, rejects: DataFrame, name: str, number: int) -> None:
    """The rejects of a batch in a partition of their own, which a repeated batch writes anew."""
    rows = rejects.withColumn(BATCH, F.lit(number).cast("long"))
    if not spark.catalog.tableExists(name):
        rows.limit(0).write.format("parquet").partitionBy(BATCH).saveAsTable(name)
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({BATCH} = {number})")
    rows.write.insertInto(name)
