"""Checking and casting flat rows against declared types, values and ranges."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestframe.functions.nested import rewrite
from nestframe.plans.model import nullable_type

REJECT = "_reject"


def conform(
    rows: DataFrame, model: T.StructType | Iterable[T.StructField], temporal: str = "native"
) -> DataFrame:
    """Casts the columns of the model and lists what is wrong with each row in ``_reject``.

    Values that do not parse become NULL, with the text kept in ``_reject``. A value that says less
    after the cast is listed with what it was (decimals rounded, digits or times cut off, numbers
    out of range), as is one outside its enumeration or range, which is kept, and a missing
    required one. All of that goes for every level, objects and lists included. Columns outside
    the model pass through, good rows have an empty list. ``temporal="string"`` gives dates and
    timestamps as text.
    """
    if temporal not in ("native", "string"):
        raise ValueError(f"temporal is 'native' or 'string', not {temporal!r}.")
    fields = {f.name: f for f in model}
    missing = [name for name in fields if name not in rows.columns]
    if missing:
        raise ValueError(f"Columns {missing} of the model are not in the rows.")
    columns, faults, nested = [], [], []
    for name in rows.columns:
        if name not in fields:
            columns.append(F.col(name))
            continue
        field = fields[name]
        value = F.col(name).try_cast(nullable_type(field.dataType))
        nested.append(_changes(field.name, F.col(name), value, rows.schema[name].dataType, field.dataType))
        faults += _faults(field, F.col(name), value)
        nested.append(_inner_faults(field, value))
        if temporal == "string" and isinstance(field.dataType, (T.DateType, T.TimestampType)):
            value = value.cast("string")
        columns.append(value.alias(name))
    reject = F.array_compact(F.array(*faults)) if faults else _nothing()
    found = [changes for changes in nested if changes is not None]
    return rows.select(*columns, F.concat(reject, *found).alias(REJECT))


def _nothing() -> Column:
    return F.array().cast("array<string>")


def _text(name: str, *parts: Column | str) -> Column:
    shown = [F.lit(part) if isinstance(part, str) else part.cast("string") for part in parts]
    return F.concat(F.lit(f"{name}: "), *shown)


def _faults(field: T.StructField, raw: Column, value: Column) -> list[Column]:
    """Broken rules of a value, which are null where there are none."""
    faults = []
    if not field.nullable:
        faults.append(F.when(raw.isNull(), _text(field.name, "missing")))
    if "allowed" in field.metadata:
        wrong = ~value.isin(field.metadata["allowed"])
        faults.append(F.when(wrong, _text(field.name, "not allowed: ", value)))
    if field.metadata.get("positive"):
        faults.append(F.when(~(value > 0), _text(field.name, "not positive: ", value)))
    return faults


def _changes(
    name: str, raw: Column, value: Column, raw_type: T.DataType, dtype: T.DataType
) -> Column | None:
    """What a cast changed or could not read, on every level; None if it keeps all there is."""
    if isinstance(raw_type, T.StructType) and isinstance(dtype, T.StructType):
        found = []
        for old, new in zip(raw_type.fields, dtype.fields):
            inner = raw.getField(old.name), value.getField(new.name)
            found.append(_changes(f"{name}.{new.name}", *inner, old.dataType, new.dataType))
        present = [changes for changes in found if changes is not None]
        return F.concat(*present) if present else None
    if isinstance(raw_type, T.ArrayType) and isinstance(dtype, T.ArrayType):
        old, new = raw_type.elementType, dtype.elementType
        if _changes(name, F.lit(None).cast(old), F.lit(None).cast(new), old, new) is None:
            return None
        of_items = F.transform(raw, lambda x, i: _changes(name, x, F.get(value, i), old, new))
        return F.coalesce(F.flatten(of_items), _nothing())
    if raw_type == dtype:
        return None
    kind = dtype.simpleString()
    fault = F.when(raw.isNotNull() & value.isNull(), _text(name, f"no {kind}: ", raw))
    lost = _lost(raw, value, raw_type, dtype)
    if lost is not None:
        lost = F.coalesce(lost, F.lit(False))
        fault = fault.when(value.isNotNull() & lost, _text(name, "loses: ", raw))
    return F.array_compact(F.array(fault))


def _lost(raw: Column, value: Column, raw_type: T.DataType, dtype: T.DataType) -> Column | None:
    """Whether a value says less than what it was made from; None for casts that keep all there is."""
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return None
    if not isinstance(raw_type, T.StringType):
        return ~value.try_cast(raw_type).eqNullSafe(raw)
    if isinstance(dtype, T.IntegralType):
        return value.cast("double") != raw.try_cast("double")
    if isinstance(dtype, T.DecimalType):
        # As many whole digits, and all others for decimals.
        wide = f"decimal(38,{38 - dtype.precision + dtype.scale})"
        return value.cast(wide) != raw.try_cast(wide)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        endless = F.isnotnull(value) & (F.abs(value) == float("inf")) & ~F.lower(raw).contains("inf")
        shown = value.cast("string").try_cast("decimal(38,18)")
        return endless | F.coalesce(shown != raw.try_cast("decimal(38,18)"), F.lit(False))
    if isinstance(dtype, T.DateType):
        return raw.try_cast("timestamp_ntz") != value.cast("timestamp_ntz")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return raw.rlike("[.][0-9]{6}[0-9]*[1-9]")
    return None


def _inner_faults(field: T.StructField, value: Column) -> Column | None:
    """The faults below a column, each with the names on the way; None if nothing is checked there."""
    dtype = field.dataType
    if isinstance(dtype, T.StructType):
        found = []
        for inner in dtype.fields:
            own = value.getField(inner.name)
            named = T.StructField(f"{field.name}.{inner.name}", inner.dataType, inner.nullable, inner.metadata)
            if faults := _faults(named, own, own):
                present = [F.when(value.isNotNull(), fault) for fault in faults]
                found.append(F.array_compact(F.array(*present)))
            if (deeper := _inner_faults(named, own)) is not None:
                found.append(deeper)
        return F.concat(*found) if found else None
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        item = T.StructField(field.name, dtype.elementType, True)
        if _inner_faults(item, F.lit(None).cast(dtype.elementType)) is None:
            return None
        of_items = F.transform(value, lambda x: _inner_faults(item, x))
        return F.coalesce(F.flatten(of_items), F.array().cast("array<string>"))
    return None


def text_output(documents: DataFrame, model: T.StructType | None = None) -> DataFrame:
    """Documents for text-only readers: bytes as base64, enumerations of any level as strings."""

    def leaf(column: Column, dtype: T.DataType) -> Column:
        if isinstance(dtype, T.BinaryType):
            # Spark breaks the text into lines.
            return F.replace(F.base64(column), F.lit("\r\n"), F.lit(""))
        return column

    plain = rewrite(documents, leaf)
    declared = [f for f in model or [] if f.name in plain.columns]
    return plain.withColumns({f.name: _enumerations(F.col(f.name), f) for f in declared})


def _enumerations(value: Column, field: T.StructField) -> Column:
    """The value with what the model enumerates in it as strings."""
    dtype = field.dataType
    if "allowed" in field.metadata:
        return value.cast("array<string>" if isinstance(dtype, T.ArrayType) else "string")
    if not _has_enumeration(dtype):
        return value
    if isinstance(dtype, T.ArrayType):
        item = T.StructField(field.name, dtype.elementType)
        return F.transform(value, lambda x: _enumerations(x, item))
    inner = (_enumerations(value.getField(f.name), f).alias(f.name) for f in dtype.fields)
    return F.when(value.isNotNull(), F.struct(*inner))


def _has_enumeration(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _has_enumeration(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any("allowed" in f.metadata or _has_enumeration(f.dataType) for f in dtype.fields)
    return False
