"""Sort keys and inclusive ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import INVALID_QUERY, DocumentError
from ..functions.paths import parse, root, values
from ..operators.coordination import numbered


def sort_keys(sort: list | dict | None, schema: T.StructType, last: str | None = None) -> list[Column]:
    """Keys in order: missing sorts lowest; an array sorts by its smallest element ascending, its largest descending.

    last, usually the id, makes the order total so that pages don't overlap.
    """
    out, named = [], []
    for item in [] if sort is None else [sort] if isinstance(sort, dict) else sort:
        for path, way in item.items():
            if way not in ("$asc", "$desc"):
                raise DocumentError(INVALID_QUERY, f"sort {way}")
            node = values(root(schema), parse(path))
            if isinstance(node.kind, T.ArrayType):
                column = F.array_min(node.column) if way == "$asc" else F.array_max(node.column)
            else:
                column = node.column
            out.append(column.asc_nulls_first() if way == "$asc" else column.desc_nulls_last())
            named.append(path)
    if last and last in schema.names and last not in named:
        out.append(F.col(f"`{last}`").asc_nulls_first())
    return out


def page(df: DataFrame, sort: list | dict | None = None, first: int | None = None, to: int | None = None, last: str | None = None) -> DataFrame:
    """Rows first..to, both inclusive and from 0, in sorted order. A negative start is 0; to before first gives none; no end gives all.

    Without a sort and a range nothing is sorted. A range without an end numbers the rows by parts, so that no task
    skips over all of them.
    """
    start = max(0, first or 0)
    if to is not None and to < start:
        return df.limit(0)
    if not sort and to is None and not start:
        return df
    keys = sort_keys(sort, df.schema, last)
    if to is not None:
        df = df.orderBy(*keys) if keys else df
        return (df.offset(start) if start else df).limit(to - start + 1)
    if not start:
        return df.orderBy(*keys)
    if not keys:
        return df.offset(start)  # any rows but so many: there is no order to keep
    return numbered(df, keys, "_rank").where(F.col("_rank") >= start).orderBy("_rank").drop("_rank")
