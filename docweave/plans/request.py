"""Whole requests: entity, query, projection, sort and range in one JSON object, what they read, and a time limit."""

from __future__ import annotations

import contextlib
import io
import json
import re
import threading
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import Any, TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import INVALID_QUERY, NO_ACCESS, DocumentError
from ..operators.mutate import Constraints, delete, hidden_upper, insert, save, update, with_ids
from ..operators.versions import stamp
from ..sources.catalog import Version
from ..sources.documents import decode
from .ordering import page
from .projection import project
from .query import fields_read, matching

R = TypeVar("R")
#: Milliseconds that a query may take where a request says nothing.
TIME_LIMIT = 75_000
PREFERENCES = ("nearest", "primary", "primaryPreferred", "secondary", "secondaryPreferred")


def guarded(query: dict | None, entity: str) -> dict:
    """The query for documents of one entity only, where several share a collection."""
    guard = {"field": "objectType", "op": "=", "rvalue": entity}
    if query is None:
        return guard
    return {"$and": [*query["$and"], guard]} if list(query) == ["$and"] else {"$and": [query, guard]}


@dataclass
class Hooks:
    """Callbacks around requests, by operation (insert, save, update, delete, find).

    before: DataFrame to DataFrame, on the documents that come in (insert, save) or that the request starts from (the others).
    after: called with the result rows once the collection is made; what it returns is ignored.
    """

    before: dict[str, list[Callable[[DataFrame], DataFrame]]] = field(default_factory=dict)
    after: dict[str, list[Callable[[DataFrame], object]]] = field(default_factory=dict)

    def prepare(self, operation: str, df: DataFrame) -> DataFrame:
        for call in self.before.get(operation, []):
            df = call(df)
        return df

    def tell(self, operation: str, result: DataFrame) -> None:
        for call in self.after.get(operation, []):
            call(result)


def find(documents: DataFrame, request: dict | str, version: Version | None = None, roles: set[str] = frozenset(), key: str = "_id", hooks: Hooks | None = None) -> tuple[DataFrame, DataFrame]:
    """A request's page of projected documents, and all documents that match, for their count.

    Documents that have objectType are guarded by the request's. A version of the entity gives the fields that are seen
    and what the roles may read: none of a hidden field reaches the output. No projection gives rows without columns.
    """
    request = json.loads(request) if isinstance(request, str) else request
    if version is not None and not version.allows("find", set(roles)):
        raise DocumentError(NO_ACCESS, f"find {version.name}")
    query = request.get("query")
    if "objectType" in documents.columns and (name := request.get("objectType") or request.get("entity")):
        query = guarded(query, name)
    documents = hooks.prepare("find", documents) if hooks else documents
    found = matching(version.view(documents) if version is not None else documents, query)
    first, to = [*(request.get("range") or [None, None]), None][:2]
    paged = page(found, request.get("sort"), first, to, key)
    return project(paged, request.get("projection", request.get("returning")), version.hidden("find", set(roles)) if version is not None else ()), found


@dataclass
class Written:
    """What a write request makes: the collection after it, a result row for each document with _errors, and the rows that the client sees."""

    collection: DataFrame
    result: DataFrame
    output: DataFrame


def write(documents: DataFrame, request: dict | str, operation: str, version: Version | None = None, roles: set[str] = frozenset(), key: str = "_id", rules: Constraints | None = None, identity: list[str] | None = None, mark: str | None = None, upper: list[str] = (), hooks: Hooks | None = None, order: str | None = None) -> Written:
    """An insert, save, update or delete request on a collection, as a plan: a Store commits the collection.

    data holds new documents: a list of JSON objects, or a DataFrame. Roles that may not do the operation raise; root
    fields that they may not write are an error of each document that fills or changes them. An insert gives documents without a key one. With mark, what is
    written gets a new entry in docver (an array of struct(version, ms)), and of upper's paths new hidden copies.
    An object type guards updates and deletes. Output: what the projection takes of each document written, nothing
    without one (an empty row for an insert or save), and of a failed one the key only.
    """
    request = json.loads(request) if isinstance(request, str) else request
    hooks, roles = hooks or Hooks(), set(roles)
    if version is not None and not version.allows({"save": "update"}.get(operation, operation), roles):
        raise DocumentError(NO_ACCESS, f"{operation} {version.name}")
    shut = version.hidden({"save": "update"}.get(operation, operation), roles) if version is not None else []
    names = [c for c in documents.columns if c != "docver" and not c.startswith("upper_")]
    writable = {c for c in names if c not in {p.split(".")[0] for p in shut}} if shut else None
    query = request.get("query")
    if operation in ("update", "delete") and query is not None and "objectType" in documents.columns and (entity := request.get("objectType") or request.get("entity")):
        query = guarded(query, entity)

    def finished(df: DataFrame) -> DataFrame:
        if mark is not None:
            kind = "array<struct<version:string,ms:bigint>>"
            df = df.withColumn("docver", stamp(F.col("docver") if "docver" in df.columns else F.lit(None).cast(kind), mark))
        return hidden_upper(df, list(upper)) if upper else df

    if operation in ("insert", "save"):
        new = hooks.prepare(operation, _data(request, documents, names, version))
        if operation == "insert":
            after, result = insert(documents, finished(with_ids(new, key)), key, rules, None if writable is None else writable | {"docver"} | {f"upper_{p.split('.')[0]}" for p in upper}, order)
            seen = result.withColumn("_failed", F.size("_errors") > 0)
        else:
            after, result = save(documents, finished(new), identity or [key], bool(request.get("upsert")), rules, None if writable is None else writable | {"docver"}, order)
            seen = result.where("_op <> 'superseded'").withColumn("_failed", F.size("_errors") > 0)
    elif operation == "update":
        changed = update(hooks.prepare(operation, documents), query, request["update"], rules, None if writable is None else writable | {c for c in documents.columns if c not in names})
        again, told = finished(changed), F.col("_changed")
        added = [c for c in again.columns if c == "docver" and mark is not None or c.startswith("upper_") and upper]
        # Written anew is only what has changed: its version and copies, not those of the rest.
        own = lambda c: F.col(f"_was_{c}") if c in changed.columns else F.lit(None)
        held = finished(changed.select("*", *[F.col(f"`{c}`").alias(f"_was_{c}") for c in added if c in changed.columns]))
        after = held.select(*[F.when(told, F.col(f"`{c}`")).otherwise(own(c)).alias(c) if c in added else F.col(f"`{c}`") for c in again.columns if c not in ("_matched", "_changed", "_errors")])
        result = changed.where("_matched")
        seen = result.withColumn("_failed", F.size("_errors") > 0)
    elif operation == "delete":
        after, gone = delete(hooks.prepare(operation, documents), query)
        result, seen = gone.withColumn("_errors", F.array().cast("array<string>")), gone.where("false").withColumn("_failed", F.lit(False))
    else:
        raise DocumentError(INVALID_QUERY, operation)
    hooks.tell(operation, result)
    projection = request.get("projection", request.get("returning"))
    hidden = version.hidden("find", roles) if version is not None else ()
    return Written(after, result, _output(seen, names, projection, hidden, key, operation))


def _data(request: dict, documents: DataFrame, names: list[str], version: Version | None) -> DataFrame:
    """The new documents of a request, with the collection's fields."""
    data = request.get("data")
    if isinstance(data, DataFrame):
        return data
    schema = version.struct() if version is not None else T.StructType([documents.schema[n] for n in names])
    listed = [data] if isinstance(data, dict) else list(data or [])
    spark = documents.sparkSession
    return decode(spark.createDataFrame([(json.dumps(d),) for d in listed], "json string"), "json", schema)


def _output(seen: DataFrame, names: list[str], projection: list | dict | None, hidden: Iterable[str], key: str, operation: str) -> DataFrame:
    """What the client sees of result rows: the projected fields, of failed documents the key only."""
    if projection is None and operation in ("update", "delete"):
        return seen.select().limit(0)
    shown = project(seen.select(*[c for c in names if c in seen.columns]), projection, hidden).columns
    kinds = project(seen.select(*[c for c in names if c in seen.columns], "_failed"), [*([projection] if isinstance(projection, dict) else projection or []), {"field": "_failed"}, {"field": key}], hidden)
    columns = [F.col(f"`{c}`") if c == key else F.when(~F.col("_failed"), F.col(f"`{c}`")).alias(c) for c in kinds.columns if c != "_failed" and (c in shown or c == key and projection is not None)]
    return kinds.select(*columns)


def explain(documents: DataFrame, query: dict | None, projection: list | dict | None = None, sort: list | dict | None = None, version: Version | None = None, roles: set[str] = frozenset()) -> dict[str, Any]:
    """The fields that a request reads, those of them whose filters reach the scan, and Spark's plan; only for roles that may find."""
    if version is not None and not version.allows("find", set(roles)):
        raise DocumentError(NO_ACCESS, f"explain {version.name}")
    found = matching(documents, query)
    told = io.StringIO()
    with contextlib.redirect_stdout(told):
        found.explain("formatted")
    plan = told.getvalue()
    pushed = " ".join(re.findall(r"^PushedFilters: (\[.*\])$", plan, re.MULTILINE))
    fields = fields_read(query, projection, sort)
    return {"fields": fields, "pushed": [f for f in fields if re.search(rf"\W{re.escape(f)}\b", pushed)], "plan": plan}


def preference(text: str) -> tuple[str, list[dict]]:
    """A read preference: its name and tag sets. Files have no replicas, so it is checked and otherwise ignored."""
    m = re.fullmatch(r"\s*(\w+)\s*(?:\((.*)\))?\s*", text, re.DOTALL)
    if not m or m[1] not in PREFERENCES:
        raise DocumentError(INVALID_QUERY, f"read preference {text!r}")
    return m[1], json.loads(f"[{m[2]}]") if m[2] else []


def limited(spark: SparkSession, run: Callable[[], R], limit_ms: int | str | None = None) -> R:
    """run(), with the Spark jobs that it starts in this thread cancelled when the limit is over; a limit that is no number is ignored."""
    try:
        limit = int(limit_ms) if limit_ms is not None else TIME_LIMIT
    except ValueError:
        limit = TIME_LIMIT
    tag = f"limit-{uuid.uuid4().hex}"
    timer = threading.Timer(limit / 1000, lambda: spark.sparkContext.cancelJobsWithTag(tag))
    spark.sparkContext.addJobTag(tag)
    timer.start()
    try:
        return run()
    finally:
        timer.cancel()
        spark.sparkContext.removeJobTag(tag)
