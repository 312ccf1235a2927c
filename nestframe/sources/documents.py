"""Documents given as JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestframe.plans.model import model_schema

REJECT = "_reject"


def _with_reject(model: T.StructType | str) -> T.StructType:
    return T.StructType([*model_schema(model).fields, T.StructField(REJECT, T.StringType())])


def read_documents(
    spark: SparkSession,
    paths: str | Sequence[str],
    model: T.StructType | str,
    one_per_file: bool = True,
) -> DataFrame:
    """JSON files as nested documents, either one document per file or one per line.

    The text of what does not fit the model comes in ``_reject``, which is NULL for good documents.
    Provenance such as a ``__source__`` object is read like any other attribute of the model.
    """
    return (
        spark.read.schema(_with_reject(model))
        .option("multiLine", one_per_file)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECT)
        .json(paths)
    )


def parse_documents(rows: DataFrame, column: str, model: T.StructType | str) -> DataFrame:
    """Replaces a column of JSON text by the attributes of the model and ``_reject``."""
    parsed = F.from_json(
        F.col(column),
        _with_reject(model),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECT},
    )
    others = [c for c in rows.columns if c != column]
    return rows.select(*others, parsed.alias(column)).select(*others, f"{column}.*")
