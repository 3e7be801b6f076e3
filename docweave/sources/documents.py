"""Documents as JSON text: read along a schema, written again, and read without one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: How dates stand in documents.
DATE = "yyyyMMdd'T'HH:mm:ss.SSSZ"


def _kind(kind: T.DataType) -> T.DataType:
    """The kind that JSON text is read as: dates are read as text first."""
    if isinstance(kind, T.TimestampType):
        return T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_kind(kind.elementType), True)
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _kind(f.dataType), True) for f in kind.fields])
    return kind


def _dated(column: Column, kind: T.DataType) -> Column:
    """A read value with its dates parsed; what is no date is missing."""
    if isinstance(kind, T.TimestampType):
        return F.try_to_timestamp(column, F.lit(DATE))
    if isinstance(kind, T.ArrayType) and _kind(kind) != kind:
        return F.transform(column, lambda e: _dated(e, kind.elementType))
    if isinstance(kind, T.StructType) and _kind(kind) != kind:
        fields = [_dated(column.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    return column


def decode(df: DataFrame, text: str, schema: T.StructType) -> DataFrame:
    """The declared fields of each row's JSON; undeclared ones are left out, and text that is no object gives missing fields."""
    read = df.select(F.from_json(F.col(f"`{text}`"), _kind(schema)).alias("_d"))
    return read.select(*[_dated(F.col("_d").getField(f.name), f.dataType).alias(f.name) for f in schema.fields])


def encode(df: DataFrame, into: str = "json") -> DataFrame:
    """Each row as one JSON object; missing fields aren't written, dates in the documents' form."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"timestampFormat": DATE}).alias(into))


def loose(df: DataFrame, text: str, into: str = "value") -> DataFrame:
    """JSON of any shape, without a schema, as a variant; null where it can't be read."""
    return df.withColumn(into, F.try_parse_json(F.col(f"`{text}`")))
