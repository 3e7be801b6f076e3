"""Dotted paths over nested columns: names, element indexes, any element (*), $this and $parent."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import INVALID_FIELD, DocumentError

Segment = str | int


def parse(path: str) -> list[Segment]:
    """Segments of a path; integers are element indexes, negative ones count from the end."""
    parts = [p for p in str(path).split(".") if p]
    if not parts:
        raise DocumentError(INVALID_FIELD, repr(path))
    return [int(p) if p.lstrip("-").isdigit() else p for p in parts]


def two_valued(c: Column) -> Column:
    """Missing counts as no match, so that a negation of any predicate is again match or no match."""
    return F.coalesce(c, F.lit(False))


@dataclass(frozen=True)
class Node:
    """A place in a document: its column (None at the root), type, and the place that holds it."""

    column: Column | None
    kind: T.DataType
    parent: Node | None = None

    def child(self, name: str) -> Node:
        if name.endswith("#") and isinstance(self.kind, T.StructType) and name not in self.kind.names:
            array = self.child(name[:-1])
            if isinstance(array.kind, T.ArrayType):
                return Node(F.size(array.column).cast("long"), T.LongType(), self)
        if not isinstance(self.kind, T.StructType) or name not in self.kind.names:
            raise DocumentError(INVALID_FIELD, name)
        column = F.col(f"`{name}`") if self.column is None else self.column.getField(name)
        return Node(column, self.kind[name].dataType, self)

    def element(self, index: int) -> Node:
        if not isinstance(self.kind, T.ArrayType):
            raise DocumentError(INVALID_FIELD, f"index {index} outside an array")
        column = F.get(self.column, F.lit(index)) if index >= 0 else F.try_element_at(self.column, F.lit(index))
        return Node(column, self.kind.elementType, self)


def root(schema: T.StructType) -> Node:
    return Node(None, schema)


def bind(node: Node, path: list[Segment], predicate: Callable[[Node], Column]) -> Column:
    """The predicate of the place that the path leads to; across arrays, whether it holds for any element."""
    for i, segment in enumerate(path):
        if segment == "$this":
            continue
        if segment == "$parent":
            if node.parent is None:
                raise DocumentError(INVALID_FIELD, "$parent of the document")
            node = node.parent
        elif isinstance(segment, int):
            node = node.element(segment)
        elif segment == "*":
            return _any(node, path[i + 1 :], predicate)
        elif isinstance(node.kind, T.ArrayType):
            return _any(node, path[i:], predicate)
        else:
            node = node.child(segment)
    return predicate(node)


def _any(array: Node, rest: list[Segment], predicate: Callable[[Node], Column]) -> Column:
    """Whether any element satisfies; one field is taken out of all elements first, so that a scan reads only that."""
    if not isinstance(array.kind, T.ArrayType):
        raise DocumentError(INVALID_FIELD, "* outside an array")
    kind = array.kind.elementType
    if isinstance(kind, T.StructType) and rest and isinstance(rest[0], str) and rest[0] in kind.names and "$parent" not in rest:
        return _any(Node(array.column.getField(rest[0]), T.ArrayType(kind[rest[0]].dataType), array.parent), rest[1:], predicate)
    return two_valued(F.exists(array.column, lambda e: bind(Node(e, kind, array), rest, predicate)))


def values(node: Node, path: list[Segment]) -> Node:
    """The place that the path leads to as one value; across an array with *, the array of all its values."""
    for i, segment in enumerate(path):
        if segment == "*" or (isinstance(node.kind, T.ArrayType) and isinstance(segment, str) and segment[0] != "$"):
            if not isinstance(node.kind, T.ArrayType):
                raise DocumentError(INVALID_FIELD, "* outside an array")
            rest = path[i + 1 :] if segment == "*" else path[i:]
            if not rest:
                return node
            inner = values(Node(F.lit(None), node.kind.elementType, node), rest).kind
            many = isinstance(inner, T.ArrayType)
            taken = F.transform(node.column, lambda e: values(Node(e, node.kind.elementType, node), rest).column)  # noqa: B023
            return Node(F.flatten(taken), inner, node) if many else Node(taken, T.ArrayType(inner), node)
        node = node.parent if segment == "$parent" else node if segment == "$this" else node.element(segment) if isinstance(segment, int) else node.child(segment)
        if node is None:
            raise DocumentError(INVALID_FIELD, "$parent of the document")
    return node
