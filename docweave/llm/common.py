"""Pieces that several operators share: the word rule, shared storage and connected components."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Unset, as in tests, a local session gets its own."""
    conf, sc = spark.sparkContext.getConf(), spark.sparkContext
    folder = conf.get("spark.checkpoint.dir", None)
    if not folder:
        checkpoint = sc._jsc.sc().getCheckpointDir()
        if checkpoint.isDefined():
            return checkpoint.get()
        if not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="docweave-")
        sc.setCheckpointDir(folder)
        return sc._jsc.sc().getCheckpointDir().get()
    return folder


def ship(spark: SparkSession) -> None:
    """Send this package's source to the executors' Python workers, once a session, for where it is not installed."""
    sc = spark.sparkContext
    if getattr(sc, "_docweave_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    file = Path(tempfile.mkdtemp(prefix="docweave-")) / "docweave-source.zip"
    with zipfile.ZipFile(file, "w") as z:
        for p in sorted((root / "docweave").rglob("*.py")):
            z.write(p, p.relative_to(root))
    sc.addPyFile(str(file))
    sc._docweave_shipped = True


def stored(df: DataFrame) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts lineage, and survives the loss of executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def release(df: DataFrame) -> None:
    """Delete what stored() wrote for df, once nothing reads it any more."""
    jvm, spark = df.sparkSession._jvm, df.sparkSession
    path = jvm.org.apache.hadoop.fs.Path(df._stored_at)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def tasks(spark: SparkSession) -> int:
    """Partitions for an explicit repartition: what the session shuffles to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sampled(df: DataFrame, size: int) -> DataFrame:
    """About `size` rows of df, or all if it has no more, by a hash of doc_id: nothing is sorted, shuffled or drawn anew."""
    total = df.count()
    share = 1.0 if total <= size else size / total
    return df.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))


#: Edges that one task of components() holds: 16 bytes each, and a few arrays of that size.
EDGES = 1 << 20


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of undirected edges (a, b), sorted, and the smallest node that each reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        low = np.minimum(root[x], root[y])
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        while (root != (up := root[root])).any():
            root = up
        keep = root[x] != root[y]
        x, y = x[keep], y[keep]
    return nodes, nodes[root]


def components(edges: DataFrame, per_task: int = EDGES) -> DataFrame:
    """Connected components of undirected edges (a, b): rows (id, component) with the smallest id reachable, for ids with an edge.

    Alternates large-star and small-star steps until the edges stand still or are so few that one task of bounded size
    can join them up; each round is one written table. Sums are formed before the shuffle and the joins may be split, so
    one node may hold any share of the edges.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(batch.column(0).to_numpy(), batch.column(1).to_numpy()) for batch in batches]
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in forest(*(np.concatenate(x) for x in zip(*held, strict=True)))], names=["id", "component"])

    pairs, mark = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()), None
    while True:
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or now[0] <= per_task:
            break
        mark = now
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stored(small.unionByName(small_low.withColumnRenamed("m", "v")).distinct())
        release(pairs)
        pairs = after
    if now[0] <= per_task:
        out = stored(pairs.coalesce(1).mapInArrow(run, "id long, component long"))
        release(pairs)
        return out
    rows = pairs.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return rows.unionByName(rows.select(F.col("component").alias("id"), "component").distinct())
