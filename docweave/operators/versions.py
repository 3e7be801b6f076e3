"""Optimistic versions: who wrote a document last, updates only if it is the one read, and lost updates found."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import CONFLICT, DocumentError
from ..plans.query import compile_query


@dataclass(frozen=True)
class Conflicts:
    """Detection on or off, how often an update is tried again, and whether a document must still match the query then."""

    detection: bool = True
    retries: int = 3
    reevaluate: bool = True

    @staticmethod
    def of(options: dict) -> Conflicts:
        return Conflicts(bool(options.get("detection", True)), int(options.get("failureRetryCount", 3)), bool(options.get("reevaluateQueryForRetry", True)))


def text(key: Column, version: Column) -> Column:
    """id:version, with an empty version for none."""
    return F.concat(key.cast("string"), F.lit(":"), F.coalesce(version.cast("string"), F.lit("")))


def split(column: Column) -> tuple[Column, Column]:
    """The id up to the first colon, and the version after it (null if empty)."""
    at = F.instr(column, ":")
    version = F.substring(column, at + 1, F.length(column))
    return F.substring(column, F.lit(1), at - 1), F.when(version != "", version)


def stamp(versions: Column, version: str, now_ms: int | None = None, keep_ms: int = 60_000) -> Column:
    """The version array with a new entry in front: struct(version, ms); entries older than a minute go."""
    now = int(time.time() * 1000) if now_ms is None else now_ms
    kind = "array<struct<version:string,ms:bigint>>"
    fresh = F.filter(F.coalesce(versions, F.array().cast(kind)), lambda v: v["ms"] >= now - keep_ms)
    return F.array_prepend(fresh, F.struct(F.lit(version).alias("version"), F.lit(now).cast("long").alias("ms")))


def same_version(current: DataFrame, read: DataFrame, key: str, version: str) -> DataFrame:
    """Rows of current that are still as `read` (key, version) saw them; two missing versions agree."""
    seen = read.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{version}`").alias("_version"))
    return current.join(seen, (F.col(f"`{key}`") == F.col("_key")) & F.col(f"`{version}`").eqNullSafe(F.col("_version")), "left_semi")


def lost_updates(current: DataFrame, written: DataFrame, key: str, versions: str, version: str) -> DataFrame:
    """Rows of current that we wrote but whose version array lacks our entry: another writer came between."""
    ours = written.select(F.col(f"`{key}`").alias("_key")).distinct()
    missing = ~F.coalesce(F.exists(F.col(f"`{versions}`"), lambda v: v["version"] == version), F.lit(False))
    return current.where(missing).join(ours, F.col(f"`{key}`") == F.col("_key"), "left_semi")


def outcomes(attempted: DataFrame, current: DataFrame, key: str, versions: str, version: str, query: dict | None = None, options: Conflicts = Conflicts()) -> DataFrame:
    """What became of each document that an update wrote: rows (key, outcome) for the keys of attempted.

    updated: the stored one has our version entry. lost: another writer came between, and the document is gone or, with
    reevaluate, no longer matches the query; that is no error and isn't tried again. failed: it is to be tried again.
    """
    ours = F.coalesce(F.exists(F.col(f"`{versions}`"), lambda v: v["version"] == version), F.lit(False))
    match = compile_query(query, current.schema) if options.reevaluate else F.lit(True)
    now = current.select(F.col(f"`{key}`").alias("_key"), ours.alias("_ours"), match.alias("_match"))
    keys = attempted.select(F.col(f"`{key}`")).distinct()
    found = keys.join(now, F.col(f"`{key}`") == F.col("_key"), "left")
    told = F.when(F.col("_ours") | F.lit(not options.detection), "updated").when(F.col("_key").isNull() | ~F.col("_match"), "lost").otherwise("failed")
    return found.select(F.col(f"`{key}`"), told.alias("outcome"))


def skipped(current: DataFrame, read: DataFrame, key: str, version: str) -> DataFrame:
    """The keys of read (key, version) that same_version leaves out: gone, or written since; an update of them counts as failed."""
    same = same_version(current, read, key, version).select(F.col(f"`{key}`").alias("_key"))
    return read.join(same, F.col(f"`{key}`") == F.col("_key"), "left_anti").select(F.col(f"`{key}`"))


def with_retries(attempt: Callable[[int], bool], options: Conflicts = Conflicts()) -> int:
    """Call attempt(n) until it reports success; how many tries that took. Raises a conflict when they run out."""
    for n in range(options.retries + 1):
        if attempt(n) or not options.detection:
            return n + 1
    raise DocumentError(CONFLICT, f"{options.retries + 1} tries")
