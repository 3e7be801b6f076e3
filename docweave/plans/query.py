"""Queries in JSON compiled to one Spark column each, match or no match, never null."""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import INVALID_COMPARISON, INVALID_FIELD, INVALID_QUERY, DocumentError
from ..functions.paths import Node, bind, parse, root, two_valued, values
from ..functions.types import can_order, is_simple, literal

#: The written forms of each comparison.
OPERATORS = {"=": "=", "$eq": "=", "!=": "!=", "$neq": "!=", "<": "<", "$lt": "<", "<=": "<=", "$lte": "<=", ">": ">", "$gt": ">", ">=": ">=", "$gte": ">="}
MEMBERSHIP = {"$in": True, "$nin": False, "$not_in": False}
TURNED = {"<": ">", "<=": ">=", ">": "<", ">=": "<=", "=": "=", "!=": "!="}


def _compare(a: Column, op: str, b: Column) -> Column:
    return {"=": a == b, "!=": a != b, "<": a < b, "<=": a <= b, ">": a > b, ">=": a >= b}[op]


def compile_query(query: dict | str | None, schema: T.StructType, loose: bool = False) -> Column:
    """The query over rows of that schema; None matches everything. Unknown fields and bad comparisons raise before any job.

    loose: null may stand for no match, which is enough for a filter; comparisons then stay bare and can reach the scan.
    """
    query = json.loads(query) if isinstance(query, str) else query
    return F.lit(True) if query is None else _query(query, root(schema), loose)


def matching(df: DataFrame, query: dict | str | None) -> DataFrame:
    """The rows that match; the cheap conjuncts reach the scan, as Catalyst splits the condition."""
    return df if query is None else df.where(compile_query(query, df.schema, loose=True))


def _query(q: dict, at: Node, loose: bool = False) -> Column:
    if not isinstance(q, dict) or not q:
        raise DocumentError(INVALID_QUERY, repr(q))
    if "$and" in q or "$or" in q:
        key = "$and" if "$and" in q else "$or"
        parts = [_query(x, at, loose) for x in q[key]]
        if not parts:
            raise DocumentError(INVALID_QUERY, f"{key} of nothing")
        return reduce((lambda a, b: a & b) if key == "$and" else (lambda a, b: a | b), parts)
    if "$not" in q:
        return ~_query(q["$not"], at)
    if "elemMatch" in q:
        return _element(q, at)
    if "contains" in q:
        return _contains(q, at)
    if "regex" in q:
        return _regex(q, at, loose)
    if "field" not in q or "op" not in q:
        raise DocumentError(INVALID_QUERY, json.dumps(q))
    op = q["op"]
    if op in MEMBERSHIP:
        inside = _in_field(q, at) if "rfield" in q else _in_values(q, at, loose and MEMBERSHIP[op])
        return inside if MEMBERSHIP[op] else ~inside
    if op not in OPERATORS:
        raise DocumentError(INVALID_QUERY, f"operator {op}")
    return _fields(q, OPERATORS[op], at) if "rfield" in q else _value(q, OPERATORS[op], at, loose)


def _each(node: Node, test) -> Column:
    """The test of a simple value, or of any element where the place is an array of simple values."""
    if isinstance(node.kind, T.ArrayType) and is_simple(node.kind.elementType):
        return two_valued(F.exists(node.column, lambda e: test(Node(e, node.kind.elementType, node))))
    if not is_simple(node.kind):
        raise DocumentError(INVALID_COMPARISON, node.kind.simpleString())
    return test(node)


def _id(path: list, value: object) -> object:
    """Ids of 24 hex digits are stored in lower case, so literals for them are compared so."""
    return value.lower() if path[-1] == "_id" and isinstance(value, str) and re.fullmatch(r"[0-9a-fA-F]{24}", value) else value


def _value(q: dict, op: str, at: Node, loose: bool) -> Column:
    path = parse(q["field"])
    value = _id(path, q.get("rvalue"))
    if value is None:
        if op not in ("=", "!="):
            raise DocumentError(INVALID_COMPARISON, "order against null")
        missing = bind(at, path, lambda n: n.column.isNull())
        whole = values(at, path)
        if isinstance(whole.kind, T.ArrayType) and "*" in path:
            missing = missing | whole.column.isNull()
        return missing if op == "=" else ~missing

    def test(node: Node) -> Column:
        if op not in ("=", "!=") and not can_order(node.kind):
            raise DocumentError(INVALID_COMPARISON, f"{op} of {node.kind.simpleString()}")
        known = literal(value, node.kind)
        if op == "!=" or (op == "=" and not loose):
            return node.column.eqNullSafe(known)  # never null, and the scan can use it negated too
        found = _compare(node.column, op, known)
        return found if loose else two_valued(found)

    found = bind(at, path, lambda n: _each(n, test))
    return ~found if op == "!=" else found


def _in_values(q: dict, at: Node, loose: bool) -> Column:
    listed = q.get("values")
    if not isinstance(listed, list):
        raise DocumentError(INVALID_QUERY, "values must be a list")

    path = parse(q["field"])

    def test(node: Node) -> Column:
        known = [literal(_id(path, v), node.kind) for v in listed if v is not None]
        found = (node.column.isin(*known) if loose else two_valued(node.column.isin(*known))) if known else F.lit(False)
        return found | node.column.isNull() if None in listed else found

    return bind(at, path, lambda n: _each(n, test))


def _in_field(q: dict, at: Node) -> Column:
    right = values(at, parse(q["rfield"]))
    if not isinstance(right.kind, T.ArrayType):
        raise DocumentError(INVALID_FIELD, f"{q['rfield']} is no array")
    return bind(at, parse(q["field"]), lambda n: _each(n, lambda x: two_valued(F.exists(right.column, lambda e: e == x.column))))


def _fields(q: dict, op: str, at: Node) -> Column:
    left, right = parse(q["field"]), parse(q["rfield"])
    a, b = values(at, left), values(at, right)
    arrays = [isinstance(n.kind, T.ArrayType) and "*" not in p for n, p in ((a, left), (b, right))]
    if all(arrays):
        return _arrays(a, b, op)

    def both(x: Node, y: Node) -> Column:
        if op not in ("=", "!=") and not (can_order(x.kind) and can_order(y.kind)):
            raise DocumentError(INVALID_COMPARISON, f"{op} of {x.kind.simpleString()} and {y.kind.simpleString()}")
        return two_valued(_compare(x.column, op, y.column))

    return bind(at, left, lambda x: _each(x, lambda u: bind(at, right, lambda y: _each(y, lambda v: both(u, v)))))


def _arrays(a: Node, b: Node, op: str) -> Column:
    """Two arrays: of equal length and the comparison at every place; != is the negation of =, and holds if one is missing."""
    ask = "=" if op == "!=" else op
    same = F.size(a.column) == F.size(b.column)
    every = F.forall(F.zip_with(a.column, b.column, lambda x, y: two_valued(_compare(x, ask, y))), lambda p: p)
    found = two_valued(same & every)
    return ~found if op == "!=" else found


def _regex(q: dict, at: Node, loose: bool) -> Column:
    named = {"caseInsensitive": "i", "case_insensitive": "i", "multiline": "m", "extended": "x", "dotall": "s"}
    flags = {v for k, v in named.items() if q.get(k)} | (set(q.get("options") or "") & set("imxs"))
    pattern = (f"(?{''.join(sorted(flags))})" if flags else "") + q["regex"]

    def test(node: Node) -> Column:
        if not isinstance(node.kind, T.StringType):
            raise DocumentError(INVALID_COMPARISON, f"regex of {node.kind.simpleString()}")
        found = node.column.rlike(pattern)
        return found if loose else two_valued(found)

    return bind(at, parse(q["field"]), lambda n: _each(n, test))


def _contains(q: dict, at: Node) -> Column:
    array = values(at, parse(q["array"]))
    if not isinstance(array.kind, T.ArrayType) or not is_simple(array.kind.elementType):
        raise DocumentError(INVALID_FIELD, f"{q['array']} is no array of simple values")
    kind = array.kind.elementType
    listed = [literal(v, kind) for v in q.get("values", [])]
    if q["contains"] not in ("$all", "$any", "$none"):
        raise DocumentError(INVALID_QUERY, f"contains {q['contains']}")
    if not listed:
        return F.lit(q["contains"] != "$any")
    wanted = F.array(*listed)
    if q["contains"] == "$all":
        return two_valued(F.size(F.array_except(wanted, array.column)) == 0)
    some = two_valued(F.size(F.array_intersect(array.column, wanted)) > 0)
    return ~some if q["contains"] == "$none" else some


def _first_names(q: object, kind: T.StructType) -> set[str] | None:
    """The element's own fields that a query reads, or None if it leaves the element."""
    out: set[str] = set()
    if isinstance(q, list):
        parts = [_first_names(x, kind) for x in q]
        return None if None in parts else set().union(*parts)
    if not isinstance(q, dict):
        return out
    for key, value in q.items():
        if key in ("field", "rfield", "array"):
            name = parse(value)[0]
            if name not in kind.names:
                return None
            out.add(name)
        elif key == "elemMatch":
            if "$parent" in json.dumps(value):
                return None
        elif key in ("$and", "$or", "$not"):
            inner = _first_names(value, kind)
            if inner is None:
                return None
            out |= inner
    return out


def _element(q: dict, at: Node) -> Column:
    array = values(at, parse(q["array"]))
    if not isinstance(array.kind, T.ArrayType):
        raise DocumentError(INVALID_FIELD, f"{q['array']} is no array")
    kind = array.kind.elementType
    if isinstance(kind, T.StructType):
        names = _first_names(q["elemMatch"], kind)
        if names and len(names) < len(kind.names):  # zip only what is read: a scan skips the other fields
            ordered = [n for n in kind.names if n in names]
            zipped = F.arrays_zip(*[array.column.getField(n).alias(n) for n in ordered])
            view = T.StructType([kind[n] for n in ordered])
            return two_valued(F.exists(zipped, lambda e: _query(q["elemMatch"], Node(e, view, array))))
    return two_valued(F.exists(array.column, lambda e: _query(q["elemMatch"], Node(e, kind, array))))


def fields_read(query: dict | None, projection: list | dict | None = None, sort: list | dict | None = None) -> list[str]:
    """The root fields that a request needs, for explain; Catalyst prunes columns by itself."""
    out: set[str] = set()

    def walk(q: object) -> None:
        if isinstance(q, list):
            for x in q:
                walk(x)
        elif isinstance(q, dict):
            for key, value in q.items():
                if key in ("field", "rfield", "array"):
                    out.add(str(parse(value)[0]))
                elif key == "elemMatch":
                    leaving(value, 1)
                elif key in ("$and", "$or", "$not"):
                    walk(value)

    def leaving(q: object, depth: int) -> None:
        """Fields that an element's query reads outside the element: one $parent leaves it for the array, another for what holds it."""
        if isinstance(q, list):
            for x in q:
                leaving(x, depth)
        elif isinstance(q, dict):
            for key, value in q.items():
                if key in ("field", "rfield", "array"):
                    path = parse(value)
                    up = next((i for i, s in enumerate(path) if s != "$parent"), len(path))
                    if up == 2 * depth and up < len(path):
                        out.add(str(path[up]))
                leaving(value, depth + (key == "elemMatch"))

    walk(query)
    walk(projection)
    for item in sort if isinstance(sort, list) else [sort] if sort else []:
        out |= {str(parse(k)[0]) for k in item}
    return sorted(out - {"*", "$this", "$parent"})
