"""Declaring the model of a document: a StructType with constraints in the field metadata."""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import Any

from pyspark.sql import types as T

# The type names a model may use, and the Spark type that stores each.
MODEL_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "float": T.DoubleType(),
    "integer": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "datetime": T.TimestampType(),
    "bytes": T.BinaryType(),
    "ndarray": T.ArrayType(T.DoubleType()),
    "PositiveFloat": T.DoubleType(),
    "PositiveInt": T.LongType(),
    "StrictBool": T.BooleanType(),
}

POSITIVE_TYPES = ("PositiveFloat", "PositiveInt")


def spark_type(name: str) -> T.DataType:
    """The Spark type of a model type name."""
    try:
        return MODEL_TYPES[name]
    except (KeyError, TypeError):
        raise ValueError(f"Unsupported model type {name!r}; use one of {sorted(MODEL_TYPES)}.")


def field(
    name: str,
    dtype: str | T.DataType,
    required: bool = False,
    allowed: Sequence[Any] | None = None,
) -> T.StructField:
    """A model attribute.

    ``allowed`` lists the values of an enumeration; its members must share one type. Required
    attributes are declared not nullable, the other constraints travel in the metadata, where
    ``conform`` and the audits find them.
    """
    metadata: dict[str, Any] = {}
    if isinstance(dtype, str):
        if dtype in POSITIVE_TYPES:
            metadata["positive"] = True
        dtype = spark_type(dtype)
    if allowed is not None:
        kinds = {type(value) for value in allowed}
        if len(kinds) != 1:
            raise ValueError(f"The values allowed for {name!r} must share one type, got {kinds}.")
        metadata["allowed"] = list(allowed)
    return T.StructField(name, dtype, nullable=not required, metadata=metadata)


def model_schema(model: T.StructType | str) -> T.StructType:
    """Reads a model given as a StructType, as its JSON form, or as a DDL string."""
    if isinstance(model, T.StructType):
        return model
    if model.lstrip().startswith("{"):
        return T.StructType.fromJson(json.loads(model))
    return T.StructType.fromDDL(model)


def nullable_type(dtype: T.DataType) -> T.DataType:
    """The type without required parts, as values that lack them are cast as well."""
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(nullable_type(dtype.elementType))
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, nullable_type(f.dataType)) for f in dtype.fields])
    return dtype
