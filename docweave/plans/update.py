"""Updates in JSON compiled to new columns of a document: $set, $add, $unset, $append, $insert, $foreach and lists of them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import INVALID_FIELD, INVALID_QUERY, DocumentError
from ..functions.paths import Node, Segment, parse, values
from ..functions.types import empty_struct, literal
from .query import _query

Change = Callable[[Column, T.DataType], Column]


@dataclass
class Document:
    """A working document: later changes see what earlier ones made."""

    fields: dict[str, Column]
    kind: T.StructType
    parent: Node | None = None

    def node(self) -> Node:
        """The document as a place that queries and valueof paths can start from."""
        return Node(F.struct(*[c.alias(n) for n, c in self.fields.items()]), self.kind, self.parent)

    def change(self, path: list[Segment], change: Change) -> None:
        name = path[0]
        if name not in self.fields:
            raise DocumentError(INVALID_FIELD, str(name))
        self.fields[name] = _apply(self.fields[name], self.kind[name].dataType, path[1:], change)


def root_document(schema: T.StructType) -> Document:
    return Document({f.name: F.col(f"`{f.name}`") for f in schema.fields}, schema)


def _apply(column: Column, kind: T.DataType, path: list[Segment], change: Change) -> Column:
    if not path:
        return change(column, kind)
    step, rest = path[0], path[1:]
    if isinstance(kind, T.ArrayType):
        if step == "*":
            return F.transform(column, lambda e: _apply(e, kind.elementType, rest, change))
        if isinstance(step, int):
            at = F.lit(step) if step >= 0 else F.size(column) + step
            return F.transform(column, lambda e, i: F.when(i == at, _apply(e, kind.elementType, rest, change)).otherwise(e))
    if isinstance(kind, T.StructType) and step in kind.names:
        inner = _apply(column.getField(step), kind[step].dataType, rest, change)
        return F.coalesce(column, empty_struct(kind)).withField(step, inner.cast(kind[step].dataType))
    raise DocumentError(INVALID_FIELD, str(step))


def _value(value: object, kind: T.DataType, doc: Document) -> Column:
    """A right-hand value: a literal, '$null', {} for an object without fields, or {valueof: path}."""
    if isinstance(value, dict) and set(value) == {"valueof"}:
        return values(doc.node(), parse(value["valueof"])).column.cast(kind)
    if value is None or value == "$null":
        return F.lit(None).cast(kind)
    if isinstance(kind, T.StructType) and isinstance(value, dict):
        parts = [_value(value.get(f.name), f.dataType, doc).alias(f.name) for f in kind.fields]
        return F.struct(*parts).cast(kind)
    if isinstance(kind, T.ArrayType) and isinstance(value, list):
        return F.array(*[_value(v, kind.elementType, doc) for v in value]).cast(kind)
    return literal(value, kind)


def apply_update(doc: Document, update: dict | list) -> Document:
    """The document with every change of the update made, in order."""
    for item in update if isinstance(update, list) else [update]:
        for key, argument in item.items():
            if key in ("$set", "$add"):
                for path, value in argument.items():
                    doc.change(parse(path), _set(value, doc) if key == "$set" else _add(value, doc))
            elif key == "$unset":
                for path in argument if isinstance(argument, list) else [argument]:
                    _unset(doc, parse(path))
            elif key in ("$append", "$insert"):
                for path, value in argument.items():
                    _extend(doc, parse(path), value, key == "$insert")
            elif key == "$foreach":
                _foreach(doc, argument)
            else:
                raise DocumentError(INVALID_QUERY, f"update {key}")
    return doc


def _set(value: object, doc: Document) -> Change:
    return lambda _, kind: _value(value, kind, doc)


def _add(value: object, doc: Document) -> Change:
    return lambda column, kind: (F.coalesce(column, F.lit(0).cast(kind)) + _value(value, kind, doc)).cast(kind)


def _unset(doc: Document, path: list[Segment]) -> None:
    last = path[-1]
    if isinstance(last, int):
        keep = lambda column: F.filter(column, lambda e, i: i != (F.lit(last) if last >= 0 else F.size(column) + last))
        doc.change(path[:-1], lambda column, kind: keep(column))
    elif last == "*":
        doc.change(path[:-1], lambda column, kind: F.when(column.isNotNull(), F.array().cast(kind)))
    else:
        doc.change(path, lambda column, kind: F.lit(None).cast(kind))


def _extend(doc: Document, path: list[Segment], value: object, insert: bool) -> None:
    at = path.pop() if insert else None
    if insert and not isinstance(at, int):
        raise DocumentError(INVALID_FIELD, "$insert needs an index")

    def change(column: Column, kind: T.DataType) -> Column:
        if not isinstance(kind, T.ArrayType):
            raise DocumentError(INVALID_FIELD, "no array")
        new = F.array(*[_value(v, kind.elementType, doc) for v in (value if isinstance(value, list) else [value])]).cast(kind)
        old = F.coalesce(column, F.array().cast(kind))
        if at is None:
            return F.concat(old, new)
        place = F.lit(at) if at >= 0 else F.greatest(F.size(old) + at, F.lit(0))
        return F.concat(F.slice(old, F.lit(1), place), new, F.slice(old, place + 1, F.size(old)))

    doc.change(path, change)


def _foreach(doc: Document, argument: dict) -> None:
    what = argument["$update"]
    paths = [k for k in argument if k != "$update"]
    if len(paths) != 1:
        raise DocumentError(INVALID_QUERY, "$foreach takes one array")
    ask = argument[paths[0]]
    holder = doc.node()

    def change(column: Column, kind: T.DataType) -> Column:
        if not isinstance(kind, T.ArrayType):
            raise DocumentError(INVALID_FIELD, f"{paths[0]} is no array")
        array = Node(column, kind, holder)
        hit = lambda e: F.lit(True) if ask == "$all" else _query(ask, Node(e, kind.elementType, array))
        if what == "$remove":
            return F.filter(column, lambda e: ~hit(e))

        def changed(e: Column) -> Column:
            if not isinstance(kind.elementType, T.StructType):
                element = Document({"$this": e}, T.StructType([T.StructField("$this", kind.elementType)]), array)
                return apply_update(element, what).fields["$this"]
            own = Document({f.name: e.getField(f.name) for f in kind.elementType.fields}, kind.elementType, array)
            apply_update(own, what)
            return F.struct(*[c.alias(n) for n, c in own.fields.items()]).cast(kind.elementType)

        return F.transform(column, lambda e: F.when(hit(e), changed(e)).otherwise(e))

    doc.change(parse(paths[0]), change)
