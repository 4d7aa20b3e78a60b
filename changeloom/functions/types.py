"""Declared type names and the Spark types they stand for."""

from __future__ import annotations

import logging

from pyspark.sql import types as T

logger = logging.getLogger(__name__)

# Declared type name -> Spark type. smallint and float are widened, and a
# decimal keeps 18 fraction digits whatever precision was declared.
DECLARED_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "varchar": T.StringType(),
    "char": T.StringType(),
    "bigint": T.LongType(),
    "integer": T.IntegerType(),
    "int": T.IntegerType(),
    "smallint": T.IntegerType(),
    "double": T.DoubleType(),
    "float": T.DoubleType(),
    "decimal": T.DecimalType(38, 18),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "timestamptz": T.TimestampType(),
    "date": T.DateType(),
}


def resolve_type(declared: str) -> T.DataType:
    """Spark type for a declared name; anything after ``(`` is ignored, unknown means string."""
    base, _, _ = declared.lower().partition("(")
    found = DECLARED_TYPES.get(base)
    if found is None:
        logger.warning("unknown type %r is read as string", declared)
        return T.StringType()
    return found


class TypeDrift(ValueError):
    """A batch brings a column in a type that the table's column can't hold without loss."""


def check_types(incoming: T.StructType, stored: T.StructType) -> None:
    """Lossless widening is fine; anything else would turn values into NULL unseen."""
    held = {field.name: field.dataType for field in stored.fields}
    for field in incoming.fields:
        to = held.get(field.name)
        if to is not None and to != field.dataType and not _widens(field.dataType, to):
            raise TypeDrift(f"{field.name}: {field.dataType.simpleString()} does not fit {to.simpleString()}")


def _widens(kind: T.DataType, to: T.DataType) -> bool:
    whole = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
    if isinstance(kind, T.NullType) or type(kind) is type(to) and not isinstance(kind, T.DecimalType):
        return isinstance(kind, T.NullType) or not isinstance(kind, (T.StructType, T.ArrayType, T.MapType))
    if type(kind) in whole:
        at = whole.index(type(kind))
        digits = (3, 5, 10, 19)[at]
        return (
            type(to) in whole[at:]
            or isinstance(to, T.DecimalType) and to.precision - to.scale >= digits
            or isinstance(to, T.DoubleType) and at < 3
        )
    if isinstance(kind, T.DecimalType) and isinstance(to, T.DecimalType):
        return to.scale >= kind.scale and to.precision - to.scale >= kind.precision - kind.scale
    return (isinstance(kind, T.FloatType) and isinstance(to, T.DoubleType)) or (
        isinstance(kind, T.DateType) and isinstance(to, T.TimestampType)
    )
