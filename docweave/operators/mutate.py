"""Insert, save, update and delete as transforms from DataFrame to DataFrame; a store commits their results."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import DUPLICATE, NO_UPSERT, NULL_QUERY, TOO_LARGE, DocumentError
from ..functions.files import ensure_checkpoint_dir
from ..functions.paths import parse, root, values
from ..plans.query import compile_query
from ..plans.update import apply_update, root_document


@dataclass(frozen=True)
class Constraints:
    """What every written document must satisfy: field paths and their bounds."""

    required: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    min_length: dict[str, int] = field(default_factory=dict)
    enums: dict[str, tuple[str, ...]] = field(default_factory=dict)


def errors(schema: T.StructType, rules: Constraints) -> Column:
    """An array of code:path for each constraint that a document breaks; empty if none."""

    def broken(path: str, test) -> Column:
        node = values(root(schema), parse(path))
        if isinstance(node.kind, T.ArrayType) and "*" in path:
            return F.coalesce(F.exists(node.column, lambda e: F.coalesce(test(e), F.lit(False))), F.lit(False))
        return F.coalesce(test(node.column), F.lit(False))

    checks = [(f"required:{p}", broken(p, lambda c: c.isNull())) for p in rules.required]
    checks += [(f"maxLength:{p}", broken(p, lambda c, n=n: F.length(c) > n)) for p, n in rules.max_length.items()]
    checks += [(f"minLength:{p}", broken(p, lambda c, n=n: F.length(c) < n)) for p, n in rules.min_length.items()]
    checks += [(f"enum:{p}", broken(p, lambda c, v=v: ~c.isin(*v))) for p, v in rules.enums.items()]
    if not checks:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(bad, F.lit(code)) for code, bad in checks]))


def _document(columns: list[str]) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in columns])


def update(df: DataFrame, query: dict | None, change: dict | list, rules: Constraints | None = None, writable: set[str] | None = None) -> DataFrame:
    """Every row of df after the update, with _matched, _changed and _errors.

    Rows that match get the change; if it breaks a constraint, or touches a root field outside `writable`, the row
    stays as it was and _errors says why. A row that the change leaves equal is matched but not changed.
    """
    if query is None:
        raise DocumentError(NULL_QUERY, "update")
    names = df.columns
    after = apply_update(root_document(df.schema), change).fields
    staged = df.withColumn("_matched", compile_query(query, df.schema))
    made = F.struct(*[c.cast(df.schema[n].dataType).alias(n) for n, c in after.items()])
    staged = staged.select(*names, "_matched", F.when(F.col("_matched"), made).alias("_after"))  # made only for what matches
    bad = _nested_errors("_after", df.schema, rules or Constraints())
    if writable is not None:
        denied = [F.when(~F.col(f"`{n}`").eqNullSafe(F.col("_after").getField(n)), F.lit(f"no-access:{n}")) for n in names if n not in writable]
        bad = F.concat(bad, F.array_compact(F.array(*denied))) if denied else bad
    staged = staged.withColumn("_errors", F.when(F.col("_matched"), bad).otherwise(F.array().cast("array<string>")))
    taken = F.col("_matched") & (F.size("_errors") == 0)
    staged = staged.withColumn("_changed", taken & ~F.col("_after").eqNullSafe(_document(names)))
    return staged.select(*[F.when(F.col("_changed"), F.col("_after").getField(n)).otherwise(F.col(f"`{n}`")).alias(n) for n in names], "_matched", "_changed", "_errors")


def _nested_errors(column: str, schema: T.StructType, rules: Constraints) -> Column:
    """errors() of the document in a struct column."""
    prefix = lambda d: {f"{column}.{k}": v for k, v in d.items()}
    moved = Constraints(tuple(f"{column}.{p}" for p in rules.required), prefix(rules.max_length), prefix(rules.min_length), prefix(rules.enums))
    found = errors(T.StructType([T.StructField(column, schema)]), moved)
    return F.transform(found, lambda e: F.regexp_replace(e, f":{column}\\.", ":"))


def counts(result: DataFrame) -> DataFrame:
    """One row: how many documents the update matched, changed and failed on."""
    return result.agg(F.count_if("_matched").alias("matched"), F.count_if("_changed").alias("updated"), F.count_if(F.size("_errors") > 0).alias("failed"))


def delete(df: DataFrame, query: dict | None) -> tuple[DataFrame, DataFrame]:
    """What stays, and what goes."""
    if query is None:
        raise DocumentError(NULL_QUERY, "delete")
    hit = compile_query(query, df.schema)
    return df.where(~hit), df.where(hit)


def duplicates(df: DataFrame, keys: list[str], where: dict | None = None) -> DataFrame:
    """Key values that more than one document has: rows (keys, count). Rows with a null key, or outside the filter, don't count."""
    named = [F.col(f"`{k}`") for k in keys]
    part = df if where is None else df.where(compile_query(where, df.schema))
    present = reduce(lambda a, b: a & b, [c.isNotNull() for c in named])
    return part.where(present).groupBy(*named).agg(F.count("*").alias("count")).where("count > 1")


def with_ids(new: DataFrame, key: str = "_id") -> DataFrame:
    """new with an id of 24 hex digits where the key, a string, is missing.

    Ids are drawn at random, so the rows are written down once: whatever reads them later sees the same ids.
    """
    if not isinstance(new.schema[key].dataType, T.StringType):
        return new
    ensure_checkpoint_dir(new.sparkSession)
    drawn = F.substring(F.sha2(F.expr("uuid()"), 256), 1, 24)
    return new.withColumn(key, F.coalesce(F.col(f"`{key}`"), drawn)).checkpoint()


def _turned(new: DataFrame, keys: list[str], last_first: bool, order: str | None) -> DataFrame:
    """new with _turn: 1 for the row that counts among those of one key, by the order column or, without one, by position.

    Rows whose key is null throughout are each their own; they are dealt out by position, so they don't meet in one task.
    """
    position = F.col(f"`{order}`") if order else F.col("_at")
    some = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNotNull() for k in keys])
    placed = new.withColumn("_at", F.monotonically_increasing_id())
    way = [position.desc_nulls_last(), F.col("_at").desc()] if last_first else [position.asc_nulls_first(), F.col("_at").asc()]
    rows = Window.partitionBy(*[F.col(f"`{k}`") for k in keys], F.when(~some, F.col("_at"))).orderBy(*way)
    return placed.withColumn("_turn", F.row_number().over(rows)).drop("_at")


def _denied(columns: list[str], writable: set[str] | None) -> Column:
    """no-access:field for each root field outside `writable` that a new document fills."""
    shut = [] if writable is None else [c for c in columns if c not in writable]
    none = F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(F.col(f"`{c}`").isNotNull(), F.lit(f"no-access:{c}")) for c in shut])) if shut else none


def insert(base: DataFrame, new: DataFrame, key: str = "_id", rules: Constraints | None = None, writable: set[str] | None = None, order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The collection with the valid new documents, and the new ones with _errors.

    A new document fails if it breaks a constraint, fills a root field outside `writable`, if its key is taken, or if an
    earlier row of the batch (by the order column, else by position) has its key. Rows without a key are no duplicates
    of each other; see with_ids for giving them one.
    """
    taken = base.select(F.col(f"`{key}`").alias("_taken")).distinct()
    staged = _turned(new, [key], False, order).join(taken, F.col(f"`{key}`") == F.col("_taken"), "left")
    again = F.col("_taken").isNotNull() | (F.col("_turn") > 1)
    found = F.concat(errors(new.schema, rules or Constraints()), _denied(new.columns, writable), F.when(again, F.array(F.lit(f"{DUPLICATE}:{key}"))).otherwise(F.array().cast("array<string>")))
    result = staged.select(*new.columns, found.alias("_errors"))
    return base.unionByName(result.where(F.size("_errors") == 0).drop("_errors"), allowMissingColumns=True), result


def save(base: DataFrame, new: DataFrame, keys: list[str], upsert: bool, rules: Constraints | None = None, writable: set[str] | None = None, order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The collection after replacing documents by identity, and the new ones with _op and _errors.

    Identity fields are compared so that two nulls agree, but a document whose identity is null throughout is new. Of
    several new documents with one identity the last wins, by the order column or else by position; the others are
    superseded and not written. _op is saved, inserted, superseded or error: errors are unknown documents without
    upsert, broken constraints, and fields outside `writable` that are filled.
    """
    have = base.select(*[F.col(f"`{k}`").alias(f"_b{i}") for i, k in enumerate(keys)], F.lit(True).alias("_known")).distinct()
    same = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"_b{i}")) for i, k in enumerate(keys)])
    some = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNotNull() for k in keys])
    staged = _turned(new, keys, True, order).join(have, same & some, "left")
    unknown = F.when(F.col("_known").isNull() & F.lit(not upsert), F.array(F.lit(NO_UPSERT))).otherwise(F.array().cast("array<string>"))
    found = F.concat(unknown, errors(new.schema, rules or Constraints()), _denied(new.columns, writable))
    staged = staged.withColumn("_errors", F.when(F.col("_turn") == 1, found).otherwise(F.array().cast("array<string>")))
    op = F.when(F.col("_turn") > 1, "superseded").when(F.size("_errors") > 0, "error").when(F.col("_known"), "saved").otherwise("inserted")
    result = staged.select(*new.columns, op.alias("_op"), "_errors")
    written = result.where("_op in ('saved', 'inserted')").drop("_op", "_errors")
    gone = result.where("_op = 'saved'").select(*[F.col(f"`{k}`").alias(f"_b{i}") for i, k in enumerate(keys)])
    stays = base.join(gone, same, "left_anti")
    return stays.unionByName(written, allowMissingColumns=True), result


def tally(result: DataFrame) -> DataFrame:
    """One row for the result of insert or save: how many documents were inserted, saved and superseded, and how many failed."""
    op = F.col("_op") if "_op" in result.columns else F.when(F.size("_errors") == 0, "inserted").otherwise("error")
    return result.agg(*[F.count_if(op == name).alias(as_name) for name, as_name in (("inserted", "inserted"), ("saved", "saved"), ("superseded", "superseded"), ("error", "failed"))])


def merge_invisible(old: DataFrame, new: DataFrame, key: str, arrays: dict[str, str] | None = None) -> DataFrame:
    """new with what old holds beside the visible fields: fields, at any depth, that new's schema lacks.

    arrays names, by path (a.b for an array b in an object a), the field that identifies the elements of an array of
    objects, so hidden fields follow elements that moved; elements that went stay away, and elements without a partner
    get missing values. Elements of an array that isn't named, and those of one in which an identity is missing or stands twice,
    on either side, are matched by their position.
    """
    held = old.select(F.struct(*[F.col(f"`{c}`") for c in old.columns]).alias("_old"))
    joined = new.join(held, F.col(f"`{key}`") == F.col("_old").getField(key), "left")
    columns = []
    for f in new.schema.fields:
        was = old.schema[f.name].dataType if f.name in old.columns else None
        columns.append(_merged(F.col(f"`{f.name}`"), f.dataType, F.col("_old").getField(f.name) if was is not None else None, was, arrays or {}, f.name).alias(f.name))
    return joined.select(*columns, *[F.col("_old").getField(c).alias(c) for c in old.columns if c not in new.columns])


def _lacks(kind: T.DataType, was: T.DataType | None) -> bool:
    """Whether the old type has a field, at any depth, that the new one lacks."""
    if isinstance(kind, T.ArrayType) and isinstance(was, T.ArrayType):
        return _lacks(kind.elementType, was.elementType)
    if isinstance(kind, T.StructType) and isinstance(was, T.StructType):
        return any(n not in kind.names for n in was.names) or any(_lacks(f.dataType, was[f.name].dataType) for f in kind.fields if f.name in was.names)
    return False


def _merged(column: Column, kind: T.DataType, old: Column | None, was: T.DataType | None, arrays: dict[str, str], path: str) -> Column:
    """A value with the hidden fields of the old one."""
    if old is None or not _lacks(kind, was):
        return column
    if isinstance(kind, T.StructType):
        own = [_merged(column.getField(f.name), f.dataType, old.getField(f.name) if f.name in was.names else None, was[f.name].dataType if f.name in was.names else None, arrays, f"{path}.{f.name}").alias(f.name) for f in kind.fields]
        return F.when(column.isNotNull(), F.struct(*own, *[old.getField(n).alias(n) for n in was.names if n not in kind.names]))
    inner, before = kind.elementType, was.elementType

    def grown(partner):  # noqa: ANN001, ANN202
        return F.transform(column, lambda n, i: _merged(n, inner, partner(n, i), before, arrays, path))

    at_place = grown(lambda n, i: F.get(old, i))
    ident = arrays.get(path)
    if ident is None:
        return at_place

    def sound(array: Column) -> Column:
        ids = F.transform(array, lambda e: e.getField(ident))
        return F.size(F.array_distinct(F.array_compact(ids))) == F.size(array)

    by_ident = grown(lambda n, i: F.get(F.filter(old, lambda o: o.getField(ident).eqNullSafe(n.getField(ident))), F.lit(0)))
    return F.when(F.coalesce(sound(column) & sound(old), F.lit(True)), by_ident).otherwise(at_place)


def hidden_upper(df: DataFrame, paths: list[str]) -> DataFrame:
    """df with an upper-cased copy of each path for searches without case: a column named upper_<path>, element by element for arrays.

    The copies are made anew from what the paths hold now: a copy of what has gone is missing too.
    """
    out = df
    for path in paths:
        node = values(root(df.schema), parse(path))
        name = "upper_" + path.replace(".*", "").replace(".", "_")
        up = F.transform(node.column, lambda x: F.upper(x.cast("string"))) if isinstance(node.kind, T.ArrayType) else F.upper(node.column.cast("string"))
        out = out.withColumn(name, up)
    return out


def data_size(df: DataFrame) -> Column:
    """Bytes of each document as JSON text."""
    return F.octet_length(F.to_json(_document(df.columns))).cast("long")


def reindex(df: DataFrame, paths: list[str], query: dict | None = None) -> DataFrame:
    """df with the hidden_upper copies of the documents that match made anew; those of others stay as they are."""
    fresh = hidden_upper(df, paths)
    hit = compile_query(query, df.schema)
    names = [c for c in fresh.columns if c.startswith("upper_")]
    old = lambda n: F.col(f"`{n}`") if n in df.columns else F.lit(None)
    kept = df.select("*", hit.alias("_hit"), *[old(n).alias(f"_old_{n}") for n in names])
    made = hidden_upper(kept, paths)
    return made.select(*[F.when(F.col("_hit"), F.col(n)).otherwise(F.col(f"_old_{n}")).alias(n) if n in names else F.col(f"`{n}`") for n in fresh.columns])


def check_size(df: DataFrame, most: int, warn: int | None = None) -> int:
    """Bytes of all documents; raises before anything is written if they are more than allowed, and warns past `warn`."""
    total = df.agg(F.coalesce(F.sum(data_size(df)), F.lit(0))).first()[0]
    if warn is not None and total > warn:
        warnings.warn(f"{total} bytes of documents, more than {warn}", stacklevel=2)
    if total > most:
        raise DocumentError(TOO_LARGE, f"{total} bytes, {most} allowed")
    return total
