"""Associations: documents of another entity fetched by a reference, as joins on equal keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.paths import parse, root, values


def associate(parents: DataFrame, children: DataFrame, key: str, field: str, rfield: str, into: str, columns: list[str] | None = None) -> DataFrame:
    """parents with a column `into`: the children whose `field` equals, or is in, the parent's `rfield`; null without any.

    key is the parents' unique id; columns names the children's fields that are wanted (all), so others are neither
    read nor shuffled. An array on the parent's side is exploded, so the join is by hash of equal keys and never pairs all
    rows; children keep their order by field. Parents with many children are grouped by key only.
    """
    node = values(root(parents.schema), parse(rfield.removeprefix("$parent.")))
    keys = parents.select(F.col(f"`{key}`").alias("_key"), (F.explode(F.array_distinct(node.column)) if isinstance(node.kind, T.ArrayType) else node.column).alias("_ref"))
    child = children.select(F.struct(*[F.col(f"`{c}`") for c in columns or children.columns]).alias("_child"), values(root(children.schema), parse(field)).column.alias("_own"))
    found = keys.join(child, F.col("_ref") == F.col("_own")).groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("_own", "_child"))).alias("_found"))
    joined = parents.join(found, F.col(f"`{key}`") == F.col("_key"), "left")
    return joined.select(*parents.columns, F.transform("_found", lambda x: x["_child"]).alias(into))


def associate_elements(parents: DataFrame, children: DataFrame, key: str, array: str, field: str, rfield: str, into: str, columns: list[str] | None = None) -> DataFrame:
    """parents with `into` added to every element of `array`: the one child whose `field` equals the element's `rfield`, or null.

    Of several such children the smallest is taken, field by field. columns names the children's fields that are wanted (all).
    """
    rest = [c for c in parents.columns if c != array]
    exploded = parents.select(F.col(f"`{key}`").alias("_key"), F.posexplode(array).alias("_pos", "_e"))
    child = children.select(F.struct(*[F.col(f"`{c}`") for c in columns or children.columns]).alias("_child"), F.col(f"`{field}`").alias("_own")).groupBy("_own").agg(F.min("_child").alias("_child"))
    joined = exploded.join(child, F.col("_e").getField(rfield) == F.col("_own"), "left")
    grown = joined.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("_pos", F.col("_e").withField(into, F.col("_child")).alias("_e")))).alias("_all"))
    back = parents.join(grown, F.col(f"`{key}`") == F.col("_key"), "left")
    return back.select(*rest, F.coalesce(F.transform("_all", lambda x: x["_e"]), F.when(F.col(array).isNotNull(), F.array())).alias(array))
