"""Operator 1: mix sources to target weights by systematic sampling, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Rows of one source and one size class go to so many cells by a hash of their id, so no task holds a whole source.
CELLS = 4096
#: No source is taken more often than this.
MOST = 3


def _digest(value: Column, digits: int) -> Column:
    """The first hex digits of an MD5 as a long: the same in every SQL engine."""
    return F.conv(F.substring(F.md5(value), 1, digits), 16, 10).cast("long")


def _size_class(size: Column) -> Column:
    """Number of decimal digits and the leading two: at most 90 classes a power of ten."""
    text = size.cast("string")
    return F.length(text).cast("long") * 100 + F.substring(text, 1, 2).cast("long")


def running(df: DataFrame, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """Add rank (from 1) and, for each name -> column of sums, the sum over all rows before, in the given total order.

    Rows are split by range and the split is written down, so that only one row per range meets in one task.
    """
    spread = common.stored(df.repartitionByRange(common.tasks(df.sparkSession), *order).withColumn("_part", F.spark_partition_id()))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = spread.groupBy("_part").agg(F.count("*").alias("_n"), *[F.sum(c).alias(f"_s_{k}") for k, c in sums.items()])
    parts = parts.select("_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_n0"), *[F.coalesce(F.sum(f"_s_{k}").over(ahead), F.lit(0)).alias(f"_s0_{k}") for k in sums])
    own = Window.partitionBy("_part").orderBy(*order)
    here = own.rowsBetween(Window.unboundedPreceding, -1)
    out = spread.join(parts, "_part").withColumn("rank", F.row_number().over(own) + F.col("_n0"))
    for k, c in sums.items():
        out = out.withColumn(k, F.coalesce(F.sum(c).over(here), F.lit(0)) + F.col(f"_s0_{k}"))
    return out.drop("_part", "_n0", *[f"_s0_{k}" for k in sums])


def targets(sized: DataFrame) -> DataFrame:
    """Rows (source, source_size, target) from rows (source, size).

    Sources by code point, null last, weigh 1, 2, 3, repeating, and share the total of all sizes; a target stops at
    MOST times its source's size and the excess is shared anew by weight. In the order of size / weight the stopped
    sources come first, so the level is read off running sums in one pass; no source loop is needed.
    """
    # Each step is written down, so that the plan of a step does not hold those of all steps before, several times over.
    by_source = common.stored(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    named = running(by_source, [F.col("source").isNull(), F.col("source")], {})
    named = named.withColumn("weight", ((F.col("rank") - 1) % 3 + 1).cast("long")).drop("rank")
    named = common.stored(named.withColumn("most", F.col("source_size") * MOST))
    ratio = F.col("most").cast("double") / F.col("weight")
    filled = running(named, [ratio, F.col("source").isNull(), F.col("source")], {"most_before": "most", "weight_before": "weight"})
    sums = named.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("total"), F.coalesce(F.sum("weight"), F.lit(0)).alias("weights"), F.lit(1).alias("one"))
    filled = filled.withColumn("one", F.lit(1)).join(F.broadcast(sums), "one")  # one row
    level = (F.col("total") - F.col("most_before")).cast("double") / (F.col("weights") - F.col("weight_before"))
    filled = common.stored(filled.withColumn("level", level))
    first = filled.where(F.col("level") <= F.col("most").cast("double") / F.col("weight")).agg(F.min_by("level", "rank").alias("share"), F.lit(1).alias("one"))
    share = F.col("share") * F.col("weight")
    return filled.join(F.broadcast(first), "one").select("source", "source_size", F.least(F.col("most").cast("double"), share).alias("target"))


def copies(docs: DataFrame, seed: int = 1) -> DataFrame:
    """How often the mix takes each document: doc_id, size, source, source_size, target, copies.

    Size is the number of words (null text: 0). Every document of a source expects target / source_size copies;
    the running sum of these over the source, plus one random offset in [0, 1) that the seed and the source fix,
    crosses integers, and a document is emitted once for each that it crosses. Documents of a source stand in the
    order of size class, then of a hash of the id, so each size class is taken in proportion and the words taken
    come near the target. No document is taken more than MOST times.

    A null doc_id is replaced by a hash of the text there. Repeated rows are separate documents. A source whose texts
    have no words has target 0 and none of it is taken; an empty table gives no rows. Other columns are ignored.
    """
    return _copies(docs, seed).drop("tag")


def _copies(docs: DataFrame, seed: int) -> DataFrame:
    """copies(), and tag: a hash of the text of rows without an id, which tells these apart."""
    tag = F.when(F.col("doc_id").isNull(), F.md5(F.coalesce("text", F.lit(""))))
    sized = docs.select("doc_id", "source", common.word_count(F.col("text")).alias("size"), tag.alias("tag"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("n"), "tag"))
    sized = common.stored(sized.withColumn("cell", _size_class(F.col("size")) * CELLS + _digest(key, 8) % CELLS))
    goal = targets(sized)
    goal = goal.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
    name = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))
    goal = goal.withColumn("offset", _digest(F.concat(F.lit(f"{seed}:"), name), 8) / F.lit(4294967296.0))
    # One source may hold most cells, so the documents ahead of each are counted over all sources and the source's start is taken off.
    cells = common.stored(running(sized.groupBy("source", "cell").agg(F.count("*").alias("n")), [F.col("source").isNull(), F.col("source"), F.col("cell")], {"ahead": "n"}))
    starts = cells.groupBy("source").agg(F.min("ahead").alias("start"))
    goal = common.stored(goal.alias("g").join(starts.alias("s"), F.col("g.source").eqNullSafe(F.col("s.source"))).select("g.*", "start"))
    same = cells["source"].eqNullSafe(goal["source"])
    cells = cells.join(goal, same).select(goal["source"], "cell", (F.col("ahead") - F.col("start")).alias("ahead"), "source_size", "target", "rate", "offset")
    rows = sized.alias("d").join(cells.alias("c"), (F.col("d.cell") == F.col("c.cell")) & F.col("d.source").eqNullSafe(F.col("c.source")))
    rows = rows.select("d.doc_id", "d.source", "d.size", "d.tag", "d.cell", "source_size", "target", "rate", "offset", "ahead")
    own = Window.partitionBy("source", "cell").orderBy("doc_id", "tag", "size")
    rank = F.col("ahead") + F.row_number().over(own)
    crossed = F.floor(rank * F.col("rate") + F.col("offset")) - F.floor((rank - 1) * F.col("rate") + F.col("offset"))
    return rows.select("doc_id", "size", "source", "tag", "source_size", "target", crossed.cast("long").alias("copies"))


def mix(docs: DataFrame, seed: int = 1) -> DataFrame:
    """The mixed documents: every row as often as copies() says, with all columns of docs, whatever their names.

    Rows with equal ids and sources are told apart by their size only, rows without an id by their text; where a row is
    repeated whole, its copies add up.
    """
    # Repeats of an id within a source share the mean: the k-th of n repeats takes its part of the sum.
    taken = common.stored(_copies(docs, seed).groupBy("doc_id", "source", "size", "tag").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows")))
    packed = docs.select(F.struct("*").alias("row"), common.word_count(F.col("text")).alias("words"), F.when(F.col("doc_id").isNull(), F.md5(F.coalesce("text", F.lit("")))).alias("own"))
    on = F.col("row.doc_id").eqNullSafe(F.col("r.doc_id")) & F.col("row.source").eqNullSafe(F.col("r.source")) & (F.col("words") == F.col("r.size")) & F.col("own").eqNullSafe(F.col("r.tag"))
    joined = packed.join(taken.alias("r"), on).where("copies > 0").select("row", "words", "own", "copies", "rows")
    times = lambda df: df.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("row.*")
    out = times(joined.where("rows = 1"))
    if not taken.where("rows > 1").isEmpty():
        turn = Window.partitionBy("row.doc_id", "row.source", "words", "own").orderBy(F.xxhash64("row.text"))
        rest = F.pmod(F.col("copies"), F.col("rows"))
        repeated = joined.where("rows > 1").withColumn("copies", F.floor(F.col("copies") / F.col("rows")) + (F.row_number().over(turn) <= rest).cast("long"))
        out = out.unionByName(times(repeated.where("copies > 0")))
    return out
