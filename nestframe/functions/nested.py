"""Rewrites that reach into every level of a nested column."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rebuild(
    column: Column,
    dtype: T.DataType,
    leaf: Callable[[Column, T.DataType], Column],
    array: Callable[[Column, T.DataType], Column] = lambda column, element: column,
) -> Column:
    """``rewrite`` for one column."""
    if isinstance(dtype, T.StructType):
        rebuilt = F.struct(
            *(
                rebuild(column.getField(f.name), f.dataType, leaf, array).alias(f.name)
                for f in dtype.fields
            )
        )
        return F.when(column.isNotNull(), rebuilt)
    if isinstance(dtype, T.ArrayType):
        element = dtype.elementType
        if isinstance(element, (T.StructType, T.ArrayType)) or leaf(column, element) is not column:
            column = F.transform(column, lambda x: rebuild(x, element, leaf, array))
        return array(column, element)
    return leaf(column, dtype)


def exact(column: Column, dtype: T.DataType) -> Column:
    """A value as text and JSON tell it apart from all others, whatever the session's time zone.

    Times count microseconds and dates days, bytes are hexadecimal, zero has no sign.
    """

    def leaf(value: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.TimestampType):
            return F.unix_micros(value)
        if isinstance(kind, T.DateType):
            return F.unix_date(value)
        if isinstance(kind, (T.TimestampNTZType, T.DecimalType)):
            return value.cast("string")
        if isinstance(kind, T.BinaryType):
            return F.hex(value)
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            return F.when(value == 0, F.lit(0.0).cast(kind)).otherwise(value)
        return value

    return rebuild(column, dtype, leaf)


# Parts texts that are joined, being rare in texts itself.
_PART = "\x1f"


def packed_texts(items: Column) -> Column:
    """A list of texts in a form that takes less room in a shuffle; ``unpacked_texts`` gives the list again.

    The texts are joined. A list that could not be parted again as it was stays as it is: one with NULL, with the
    separator in a text or with bytes that are not UTF-8, and an empty one.
    """
    joined = F.array_join(items, _PART, _PART)
    separators = F.octet_length(joined) - F.octet_length(F.replace(joined, F.lit(_PART), F.lit("")))
    exact_ = (separators == F.size(items) - 1) & F.is_valid_utf8(joined)
    return F.struct(F.when(exact_, joined).alias("joined"), F.when(~exact_, items).alias("items"))


def unpacked_texts(packed: Column) -> Column:
    return F.coalesce(F.split(packed["joined"], _PART, -1), packed["items"])


def holds_texts(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.ArrayType) and dtype.elementType == T.StringType()


def rewrite(
    frame: DataFrame,
    leaf: Callable[[Column, T.DataType], Column],
    array: Callable[[Column, T.DataType], Column] = lambda column, element: column,
) -> DataFrame:
    """Applies ``leaf`` to the values and ``array`` to the lists of every level.

    ``leaf`` returns its own argument for values it leaves alone.
    """
    return frame.select(
        *(
            rebuild(F.col(f"`{f.name}`"), f.dataType, leaf, array).alias(f.name)
            for f in frame.schema.fields
        )
    )


def canonical(frame: DataFrame, by: str | None = None) -> DataFrame:
    """Sorts every list of every row; see ``nestframe.operators.pieces.canonical``."""

    def visit(column: Column, dtype: T.DataType) -> Column:
        if isinstance(dtype, T.StructType):
            inner = (visit(column.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields)
            return F.when(column.isNotNull(), F.struct(*inner))
        if not isinstance(dtype, T.ArrayType):
            return column
        element = dtype.elementType
        if not isinstance(element, T.StructType):
            return F.sort_array(F.transform(column, lambda x: visit(x, element)))

        def keyed(item: Column) -> Column:
            plain, nested = _parts(element.fields)
            plain.sort(key=lambda f: f.name != by)
            keys = [item.getField(f.name) for f in plain]
            keys += [_content(item.getField(f.name), f.dataType, f.name) for f in nested]
            # Generated keys hang on the old order, so they come last.
            keys += [item.getField("id")] * ("id" in element.names)
            keys = [key.alias(f"k{i}") for i, key in enumerate(keys)]
            return F.struct(F.struct(*keys).alias("by"), item.alias("x"))

        inner = F.transform(column, lambda x: visit(x, element))
        return F.sort_array(F.transform(inner, keyed)).getField("x")

    return frame.select(
        *(visit(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in frame.schema.fields)
    )


def _parts(fields: Sequence[T.StructField]) -> tuple[list[T.StructField], list[T.StructField]]:
    """The scalars and the nested attributes of an object, without its generated key."""
    nested = [f for f in fields if isinstance(f.dataType, (T.StructType, T.ArrayType))]
    return [f for f in fields if f not in nested and f.name != "id"], nested


def _content(value: Column, dtype: T.DataType, name: str) -> Column:
    """What an attribute holds, as a sum over its items that no order changes."""
    kind = "decimal(38,0)"
    zero = F.lit(0).cast(kind)

    def of_object(item: Column, fields: Sequence[T.StructField]) -> Column:
        plain, nested = _parts(fields)
        scalars = [exact(item.getField(f.name), f.dataType).alias(f.name) for f in plain]
        text = F.to_json(F.struct(*scalars), {"ignoreNullFields": "false"}) if plain else F.lit("")
        below = (_content(item.getField(f.name), f.dataType, f.name).cast("string") for f in nested)
        return F.when(item.isNotNull(), F.xxhash64(F.lit(name), text, *below).cast(kind))

    def of_value(item: Column) -> Column:
        text = F.to_json(F.struct(exact(item, dtype.elementType).alias(name)), {"ignoreNullFields": "false"})
        return F.xxhash64(F.lit(name), text).cast(kind)

    if isinstance(dtype, T.StructType):
        return F.coalesce(of_object(value, dtype.fields), zero)
    if isinstance(dtype.elementType, T.StructType):
        items = F.transform(value, lambda x: F.coalesce(of_object(x, dtype.elementType.fields), zero))
    else:
        items = F.transform(value, of_value)
    return F.coalesce(F.aggregate(items, zero, lambda a, b: (a + b).cast(kind)), zero)


def nan_as_null(frame: DataFrame) -> DataFrame:
    """Replaces NaN by NULL in every floating-point value, nested ones included."""

    def clean(column: Column, dtype: T.DataType) -> Column:
        if isinstance(dtype, (T.FloatType, T.DoubleType)):
            return F.when(~F.isnan(column), column)
        return column

    return rewrite(frame, clean)
