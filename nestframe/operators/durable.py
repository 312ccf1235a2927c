"""Cutting the lineage of rows that must not be computed a second time with another outcome."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def durable(frame: DataFrame, compression: str | None = None) -> DataFrame:
    """Writes the rows to the shared checkpoint folder and reads them from there.

    A written table, unlike a checkpoint, is read column by column and has a known size. ``compression``
    is the session's if not given; "zstd" takes less disk for wide texts.
    """
    spark = frame.sparkSession
    path = shared_path(spark)
    frame.write.parquet(path, compression=compression)
    return spark.read.schema(frame.schema).parquet(path)


def shared_path(spark: SparkSession) -> str:
    """A new path in the shared folder."""
    return f"{_folder(spark)}/nestframe-{uuid.uuid4().hex}"


def _folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or for a local session without it a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder all executors share.")
        folder = tempfile.mkdtemp(prefix="nestframe-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")
