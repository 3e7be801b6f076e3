"""Projections in JSON as a select list, minus what the caller's roles can't read."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.paths import parse
from ..functions.types import is_simple

Path = tuple[str, ...]


def _names(path: str) -> Path:
    return tuple("*" if isinstance(s, int) else s for s in parse(path))


def _fits(pattern: Path, path: Path) -> bool:
    return len(pattern) == len(path) and all(p in ("*", x) for p, x in zip(pattern, path, strict=True))


def _covers(pattern: Path, path: Path) -> bool:
    """Whether the pattern names the path itself, or with array steps left out."""
    return _fits(pattern, path) or _fits(pattern, tuple(x for x in path if x != "*"))


def included(path: Path, kind: T.DataType, items: list[dict]) -> bool:
    """Later items override earlier ones. An item takes the place it names; recursive ones all below too, others the simple fields directly below."""
    out = False
    for item in items:
        pattern, deep = _names(item["field"]), bool(item.get("recursive"))
        own = _covers(pattern, path)
        if pattern[-1] == "*" and own and not is_simple(kind) and not deep:
            own = False  # * alone stands for simple children
        below = any(_covers(pattern, path[:k]) for k in range(1, len(path)))
        flat = tuple(x for x in path if x != "*")
        direct = is_simple(kind) and pattern[-1] != "*" and any(_covers(pattern, flat[:k]) for k in (len(flat) - 1,) if k > 0)
        if own or (deep and below) or direct:
            out = bool(item.get("include", True))
    return out


def project(df: DataFrame, projection: list | dict | None, hidden: Iterable[str] = ()) -> DataFrame:
    """The rows with only the projected fields, nested ones rebuilt; no projection gives rows without columns' content.

    hidden lists paths that the caller may not read: they and all below them are left out whatever the projection says.
    """
    items = [] if projection is None else [projection] if isinstance(projection, dict) else list(projection)
    deny = [_names(p) for p in hidden]
    columns = []
    for f in df.schema.fields:
        built = _build(F.col(f"`{f.name}`"), f.dataType, (f.name,), items, deny)
        if built is not None:
            columns.append(built.alias(f.name))
    sizes = [i["field"] for i in items if str(i["field"]).endswith("#") and "." not in i["field"] and i.get("include", True)]
    for name in sizes:
        if name not in df.columns and isinstance(df.schema[name[:-1]].dataType, T.ArrayType):
            columns.append(F.size(F.col(f"`{name[:-1]}`")).cast("long").alias(name))
    return df.select(*columns)


def _build(column: Column, kind: T.DataType, path: Path, items: list[dict], deny: list[Path]) -> Column | None:
    if any(_covers(d, path[:k]) for d in deny for k in range(1, len(path) + 1)):
        return None
    if isinstance(kind, T.ArrayType) and is_simple(kind.elementType):
        return column if included(path, kind.elementType, items) or included((*path, "*"), kind.elementType, items) else None
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        if not any(_build(F.lit(None), f.dataType, (*path, "*", f.name), items, deny) is not None for f in kind.elementType.fields):
            return None
        if _whole(kind.elementType, (*path, "*"), items, deny):
            return column
        return F.transform(column, lambda e: _struct(e, kind.elementType, (*path, "*"), items, deny))
    if isinstance(kind, T.StructType):
        if _whole(kind, path, items, deny):
            return column
        return _struct(column, kind, path, items, deny)
    return column if included(path, kind, items) else None


def _whole(kind: T.StructType, path: Path, items: list[dict], deny: list[Path]) -> bool:
    """Whether every field at every depth is taken, so that the column can stay as it is."""
    for f in kind.fields:
        p = (*path, f.name)
        if any(_covers(d, p[:k]) for d in deny for k in range(1, len(p) + 1)):
            return False
        inner = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
        if isinstance(inner, T.StructType):
            if not _whole(inner, (*p, "*") if isinstance(f.dataType, T.ArrayType) else p, items, deny):
                return False
        elif not (included(p, inner, items) or isinstance(f.dataType, T.ArrayType) and included((*p, "*"), inner, items)):
            return False
    return True


def _struct(column: Column, kind: T.StructType, path: Path, items: list[dict], deny: list[Path]) -> Column | None:
    parts = [(f.name, _build(column.getField(f.name), f.dataType, (*path, f.name), items, deny)) for f in kind.fields]
    parts = [p.alias(name) for name, p in parts if p is not None]
    return F.when(column.isNotNull(), F.struct(*parts)) if parts else None
