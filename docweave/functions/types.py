"""Metadata types, literals cast to a field's type at compile time, and what a type can be compared by."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal, InvalidOperation

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import INVALID_VALUE, DocumentError

#: Metadata type names and their Spark types. Arrays, objects and references are built by the catalog.
TYPES: dict[str, T.DataType] = {
    "string": T.StringType(), "integer": T.LongType(), "double": T.DoubleType(), "biginteger": T.DecimalType(38, 0),
    "bigdecimal": T.DecimalType(38, 18), "boolean": T.BooleanType(), "date": T.TimestampType(), "uid": T.StringType(),
}
_DATES = ("%Y%m%dT%H:%M:%S.%f%z", "%Y-%m-%dT%H:%M:%S.%f%z", "%Y-%m-%dT%H:%M:%S%z", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d")


def _date(value: object) -> datetime:
    if isinstance(value, datetime):
        return value
    for form in _DATES:
        try:
            return datetime.strptime(str(value).replace("Z", "+0000"), form)
        except ValueError:
            continue
    raise ValueError(value)


def _boolean(value: object) -> bool:
    if isinstance(value, bool):
        return value
    text = str(value).lower()
    if text not in ("true", "false", "1", "0"):
        raise ValueError(value)
    return text in ("true", "1")


def literal(value: object, kind: T.DataType) -> Column:
    """A JSON value as a literal of the field's type, so the column itself is never cast and filters reach the scan."""
    if value is None:
        return F.lit(None).cast(kind)
    try:
        if isinstance(kind, T.StringType):
            return F.lit(value if isinstance(value, str) else str(value).lower() if isinstance(value, bool) else str(value))
        if isinstance(kind, T.BooleanType):
            return F.lit(_boolean(value))
        if isinstance(kind, T.IntegralType):
            number = Decimal(str(value))
            if number != number.to_integral_value():
                raise ValueError(value)
            return F.lit(int(number)).cast(kind)
        if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
            return F.lit(float(value)).cast(kind)
        if isinstance(kind, T.DecimalType):
            return F.lit(Decimal(str(value))).cast(kind)
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return F.lit(_date(value)).cast(kind)
    except (ValueError, TypeError, InvalidOperation) as e:
        raise DocumentError(INVALID_VALUE, f"{value!r} is no {kind.simpleString()}") from e
    raise DocumentError(INVALID_VALUE, f"no literals of type {kind.simpleString()}")


def is_simple(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.StructType, T.ArrayType, T.MapType))


def can_order(kind: T.DataType) -> bool:
    """Whether <, <=, > and >= are defined: booleans, objects and arrays have no order."""
    return is_simple(kind) and not isinstance(kind, (T.BooleanType, T.BinaryType))


def empty_struct(kind: T.StructType) -> Column:
    """An object of that type with every field missing."""
    return F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in kind.fields]).cast(kind)
