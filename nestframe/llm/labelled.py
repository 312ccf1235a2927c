"""Labelled documents for learning: which rows may teach, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows a classifier learns from at most; they are chosen by a hash of the id.
LABELLED_ROWS = 20_000


def held_out(id_column: str = "doc_id") -> Column:
    """Whether a row takes no part in learning: the crc32 of its id, written out, leaves 1 when divided by 3.

    A null id is not held out, but has no labels either.
    """
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 3 == 1, F.lit(False))


def by_lot(share: float, *columns: str) -> Column:
    """Whether a row is in a sample of about this share, which the hash of the columns decides."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) < int(share * (1 << 40))


def teaching_rows(
    documents: DataFrame, labels: DataFrame, label: Column, id_column: str = "doc_id", text_column: str = "text",
    rows: int = LABELLED_ROWS,
) -> DataFrame:
    """``text, label`` of about ``rows`` labelled documents that are not held out.

    Of several labels for an id the largest counts; rows without label or id do not count. As their number is bounded,
    the chosen ids are broadcast and the documents are not shuffled.
    """
    known = labels.select(F.col(id_column).alias("labelled"), label.alias("label")).where(
        "labelled IS NOT NULL AND label IS NOT NULL"
    )
    known = known.where(~held_out("labelled")).groupBy("labelled").agg(F.max("label").alias("label"))
    share = min(1.0, rows / max(known.count(), 1))
    known = known.where(by_lot(share, "labelled"))
    texts = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return texts.join(F.broadcast(known), F.col("id") == F.col("labelled")).select("text", "label")
