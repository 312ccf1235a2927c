"""Surrogate keys derived from content, so that a repeated or retried run gives the same keys."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestframe.functions.nested import exact

# 128 bits as hex: about as collision-free as a random UUID at half the width of a full digest,
# and short enough for a VARCHAR(36) key column.
KEY_LENGTH = 32


def _digest(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, KEY_LENGTH)


def child_key(
    parent_key: Column, attr: str, pos: Column, parent_type: T.DataType | None = None
) -> Column:
    """Key of the object at ``pos`` in attribute ``attr`` of its parent.

    ``parent_type`` is needed for keys whose text loses something, such as times.
    """
    text = exact(parent_key, parent_type or T.StringType()).cast("string")
    return _digest(F.concat_ws("/", text, F.lit(attr), pos.cast("string")))


# The character after the one that ends a label: labels of what is below an object lie between them.
LABEL_END = chr(ord("/") + 1)


def root_label(key: Column, key_type: T.DataType) -> Column:
    """A natural or generated key as text without ``/``, in the order of the key for whole numbers and text."""
    if isinstance(key_type, T.IntegralType):
        # Sixteen hexadecimal digits, the sign turned round, so that negative numbers come first.
        return F.lpad(F.hex(key.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    text = exact(key, key_type).cast("string")
    return F.replace(F.replace(text, F.lit("%"), F.lit("%25")), F.lit("/"), F.lit("%2F"))


def label_of(path: Column) -> Column:
    """The label of the document that the object with a path key belongs to."""
    return F.substring_index(path, "/", 1)


def path_key(
    parent_key: Column, attr: str, pos: Column, root_type: T.DataType | None = None
) -> Column:
    """Key of the object at ``pos`` in attribute ``attr``: the path to it, in the order of documents.

    ``root_type`` is given if the parent is a document. Positions are preceded by a letter for
    their number of digits, so that text sorts them as numbers.
    """
    label = parent_key if root_type is None else root_label(parent_key, root_type)
    digits = pos.cast("string")
    size = F.char(F.length(digits) + F.lit(ord("a") - 1))
    name = attr.replace("%", "%25").replace("/", "%2F")
    return F.concat(label, F.lit(f"/{name}/"), size, digits)


def row_text(fields: Iterable[T.StructField], nulls: bool = True) -> Column:
    """The columns of a row as one text that equal rows share and no others."""
    values = [exact(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in fields]
    return F.to_json(F.struct(*values), {"ignoreNullFields": str(not nulls).lower()})


def row_key(fields: Iterable[T.StructField]) -> Column:
    """Key of a row without a natural key; equal rows get equal keys."""
    return _digest(row_text(fields))
