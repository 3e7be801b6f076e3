"""Locks and sequences: small keyed state, as transitions of an event table and as batches of numbers."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import CONFLICT, INVALID_METADATA, DocumentError
from ..functions.files import Files, ensure_checkpoint_dir

#: Time to live of a lock in milliseconds, where a request names none.
TTL = 3_600_000


def transitions(ttl: int = TTL) -> Callable[[dict[str, Any] | None, str, str, int], tuple[dict[str, Any] | None, bool | None, int]]:
    """The transition function for a time to live. It is made here, so that it travels to executors that lack this package."""

    def step(state: dict[str, Any] | None, caller: str, action: str, now: int) -> tuple[dict[str, Any] | None, bool | None, int]:
        """One transition of one resource's lock: its state after, whether the call succeeded (None: the lock isn't held), and the count.

        acquire is reentrant for its caller and takes over a lock that has expired; release frees it at the last count;
        ping extends it; count asks.
        """
        mine = state is not None and state["caller"] == caller and state["until"] > now
        if action == "acquire":
            if mine:
                state = state | {"count": state["count"] + 1, "until": now + ttl}
            elif state is None or state["until"] <= now or state["count"] <= 0:
                state = {"caller": caller, "count": 1, "until": now + ttl}
            else:
                return state, False, 0
            return state, True, state["count"]
        if not mine:
            return state, None, 0
        if action == "release":
            if state["count"] <= 1:
                return None, True, 0
            state = state | {"count": state["count"] - 1}
            return state, False, state["count"]
        if action == "ping":
            state = state | {"until": now + ttl}
        return state, True, state["count"]

    return step


def replay(events: DataFrame, ttl: int = TTL) -> DataFrame:
    """Outcome of every lock event, in order of (ms, seq) for each resource: resource, seq, caller, action, ok, count.

    events has resource, seq, ms, caller, action. A resource's events follow one another, so they are one group: it is
    streamed in sorted batches and only the lock's state is held.
    """
    dealt = events.select("resource", "seq", "ms", "caller", "action").repartition("resource").sortWithinPartitions("resource", "ms", "seq")

    step = transitions(ttl)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource, state = None, None
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                if r.resource != resource:
                    resource, state = r.resource, None
                state, ok, count = step(state, r.caller, r.action, r.ms)
                rows.append((r.resource, r.seq, r.caller, r.action, ok, count))
            yield pd.DataFrame(rows, columns=["resource", "seq", "caller", "action", "ok", "count"]).astype({"ok": object})

    return dealt.mapInPandas(run, "resource string, seq long, caller string, action string, ok boolean, count long")


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df with the rank of each row, from 0, in the given total order.

    Rows are split by range, counted by part, and numbered within each part, so no task sees them all.
    """
    ensure_checkpoint_dir(df.sparkSession)
    spread = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()).checkpoint()
    parts = spread.groupBy("_part").agg(F.count("*").alias("_n"))
    parts = parts.withColumn("_ahead", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return spread.join(parts, "_part").withColumn(name, (F.col("_ahead") + rank).cast("long")).drop("_part", "_ahead")


def sequence(df: DataFrame, order: list[str], name: str, initial: int = 1, increment: int = 1) -> DataFrame:
    """df with a column of consecutive numbers in the given total order, initial + increment * rank; increment 0 is 1."""
    return numbered(df, [F.col(f"`{c}`") for c in order], name).withColumn(name, F.lit(initial) + (increment or 1) * F.col(name))


class Sequences:
    """Named counters that outlive a session: <path>/<name>/<n> holds the value after the n-th call, created so that it must not exist."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.files = Files(spark, path)

    def take(self, name: str, initial: int = 1, increment: int = 1, count: int = 1, tries: int = 100) -> int:
        """The first of `count` values, increment (0 is 1) apart; the name's first call fixes initial and increment, later ones go on from there."""
        for _ in range(tries):
            known = self.files.numbers(name)
            at = json.loads(self.files.text(f"{name}/{known[-1]:09d}")) if known else {"next": initial, "increment": increment or 1}
            after = at | {"next": at["next"] + count * at["increment"]}
            if self.files.create(f"{name}/{(known[-1] + 1 if known else 0):09d}", json.dumps(after)):
                return at["next"]
        raise DocumentError(CONFLICT, f"sequence {name}")


def domains(config: dict[str, Any], datasources: dict[str, str]) -> dict[str, str]:
    """The folder of each locking domain, from extensions.locking[] with domain, datasource and collection."""
    out = {}
    for item in config.get("extensions", {}).get("locking", []):
        if not item.get("domain") or item.get("datasource") not in datasources or not item.get("collection"):
            raise DocumentError(INVALID_METADATA, f"locking domain {item}")
        out[item["domain"]] = f"{datasources[item['datasource']].rstrip('/')}/{item['collection']}"
    return out
