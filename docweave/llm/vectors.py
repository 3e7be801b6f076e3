"""Operator 7: near-duplicate embeddings by Euclidean p-stable hashing and exact cosine checks."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Width of a quantised projection of unit vectors; at least so many projections make a bucket.
WIDTH, LEAST = 2.0, 10
#: Vectors of a bucket that meet in one block.
BLOCK = 500


def _same(distance: float) -> float:
    """Chance that one quantised projection of two points at this distance agrees."""
    r = WIDTH / distance
    return 1 - math.erfc(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan(rows: int, threshold: float) -> tuple[int, int]:
    """Projections a table and tables, for so many vectors.

    Unrelated unit vectors are sqrt(2) apart; buckets of more projections keep their number in a bucket near 500 as the
    rows grow. Tables are as many as find a pair at the threshold with a chance of 1 - exp(-3.3), about 0.96; closer
    pairs have a higher one.
    """
    near, far = _same(math.sqrt(2 - 2 * threshold)), _same(math.sqrt(2))
    k = max(LEAST, math.ceil(math.log(max(1, rows) / 500 + 1) / -math.log(far)))
    return k, math.ceil(3.3 / near**k)


def _units(vectors: DataFrame) -> DataFrame:
    """vec_id, label, dims, raw (the components' bytes, as floats where nothing is lost; null if the vector links with nothing), hi and lo: a digest of label and vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, rows = (batch.column(i) for i in range(3))
            raws, his, los = [], [], []
            for i, label, v in zip(ids.to_pylist(), labels.to_pylist(), rows.to_pylist(), strict=True):
                raw = None
                if i is not None and label is not None and v and None not in v:
                    x = np.array(v, dtype=np.float64)
                    if np.isfinite(x).all() and np.any(x):
                        with np.errstate(over="ignore"):
                            single = x.astype(np.float32)
                        raw = (single if (single.astype(np.float64) == x).all() else x).tobytes()
                raws.append(raw)
                hi, lo = np.frombuffer(xxhash.xxh3_128_digest(repr(label).encode() + b"|" + (np.array(v, dtype=np.float64).tobytes() if raw else b"")), dtype=np.int64).tolist()
                his.append(hi)
                los.append(lo)
            dims = pa.array([len(v) if v else 0 for v in rows.to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([ids, labels.cast(pa.string()), dims, pa.array(raws, pa.binary()), pa.array(his, pa.int64()), pa.array(los, pa.int64())], names=["vec_id", "label", "dims", "raw", "hi", "lo"])

    return vectors.select("vec_id", "label", "embedding").mapInArrow(run, "vec_id long, label string, dims int, raw binary, hi long, lo long")


def units(raws: list[bytes], dims: list[int]) -> np.ndarray | list[np.ndarray]:
    """The vectors at length 1, in double precision: a matrix where all have one length, else a list."""
    if len({(len(r), d) for r, d in zip(raws, dims, strict=True)}) > 1:
        return [units([r], [d])[0] for r, d in zip(raws, dims, strict=True)]
    x = np.frombuffer(b"".join(raws), dtype=np.float32 if raws and len(raws[0]) == 4 * dims[0] else np.float64).astype(np.float64).reshape(len(raws), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("nd,nd->n", x, x))[:, None]


def _hashed(reps: DataFrame, k: int, tables: int, seed: int) -> DataFrame:
    """reps with buckets: of each table in order, the vector's bucket, a digest of label, table and quantised projections."""
    names = [*reps.columns, "buckets"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            out = []
            for label, dims, raw in zip(*(batch.column(c).to_pylist() for c in ("label", "dims", "raw")), strict=True):
                if dims not in drawn:
                    r = np.random.default_rng([seed, dims])
                    drawn[dims] = r.standard_normal((k * tables, dims)), r.uniform(0, WIDTH, k * tables)
                a, b = drawn[dims]
                codes = np.floor((a @ units([raw], [dims])[0] + b) / WIDTH).astype(np.int32).reshape(tables, k)
                head = f"{label}|{dims}|".encode()
                out.append(np.array([xxhash.xxh3_64_intdigest(head + t.to_bytes(4) + codes[t].tobytes()) for t in range(tables)], dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int64()))], names=names)

    return reps.mapInArrow(run, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in reps.schema.fields)}, buckets array<long>")


def block_links(i: int, j: int, table: int, own: np.ndarray, kinds: np.ndarray, x: np.ndarray | list[np.ndarray], buckets: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The links between the vectors of blocks i and j of a bucket, as places of both ends, of which no earlier table's buckets know."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for kind in np.unique(kinds):  # a digest may put unlike vectors in one bucket
        a, b = (np.flatnonzero((own == side) & (kinds == kind)) for side in (i, j))
        if len(a) and len(b):
            p, q = np.nonzero(np.stack([x[k] for k in a]) @ np.stack([x[k] for k in b]).T >= threshold)
            p, q = a[p], b[q]
            found.append((p[p < q], q[p < q]) if i == j else (p, q))
    p, q = (np.concatenate(side) for side in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2
    new = np.ones(len(p), dtype=bool)
    for t in range(table):
        new &= buckets[p, t] != buckets[q, t]
    return p[new], q[new]


def _linked(blocks: DataFrame, threshold: float) -> DataFrame:
    """For each vector with a link in a pair of blocks: id, others (how many vectors, copies counted, it is linked with there) and root (the smallest id that these links reach).

    A link is counted in the first table whose bucket both ends share, so once; links themselves are not put out.
    """
    keys = ["bucket", "i", "j"]
    dealt = blocks.select(*keys, "t", "own", "id", "copies", "label", "dims", "raw", "buckets").repartition(common.tasks(blocks.sparkSession), *keys).sortWithinPartitions(*keys)

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        """The rows of whole groups."""
        bucket, i, j, t, own, ids, copies = (batch.column(k).to_numpy() for k in range(7))
        dims, raws = batch.column(8), batch.column(9).to_pylist()
        kinds = np.unique(batch.column(7).dictionary_encode().indices.to_numpy().astype(np.int64) << 32 | dims.to_numpy(), return_inverse=True)[1]
        x, buckets = units(raws, dims.to_pylist()), batch.column(10).flatten().to_numpy().reshape(batch.num_rows, -1)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        cuts = _cuts(bucket, i, j)
        for a, b in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
            if b - a < 2:
                continue
            p, q = block_links(i[a], j[a], t[a], own[a:b], kinds[a:b], x[a:b], buckets[a:b], threshold)
            if len(p):
                n, size, weight = ids[a:b], b - a, copies[a:b]
                others = np.bincount(p, weight[q], size) + np.bincount(q, weight[p], size)
                nodes, roots = common.forest(n[p], n[q])
                met = np.flatnonzero(others)
                out.append((nodes, others[met[np.argsort(n[met])]].astype(np.int64), roots))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if out else [], pa.int64()) for c in (zip(*out, strict=True) if out else [()] * 3)], names=["id", "others", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []  # of a group that may go on
        for batch in batches:
            last = _cuts(*(batch.column(k).to_numpy() for k in range(3)))[-1] if batch.num_rows else 0
            same = bool(rest) and last == 0 and all(rest[-1].column(k)[0] == batch.column(k)[0] for k in range(3))
            if same or not batch.num_rows:
                rest.append(batch)
                continue
            yield rows(pa.concat_batches([*rest, batch.slice(0, last)]))
            rest = [batch.slice(last)]
        if rest:
            yield rows(pa.concat_batches(rest))

    return dealt.mapInArrow(run, "id long, others long, root long")


def _cuts(*keys: np.ndarray) -> list[int]:
    """Where each run of equal keys begins."""
    first = np.ones(len(keys[0]), dtype=bool)
    first[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(first).tolist()


def near(vectors: DataFrame, threshold: float = 0.93, seed: int = 7, block: int = BLOCK) -> DataFrame:
    """One row a vector: vec_id, n_links, component_id, kept.

    Two vectors with equal labels are linked when the cosine, in double precision, is the threshold or more. Null
    labels or vectors, zero vectors and those with null or non-finite components link with nothing; vectors of
    different length don't link. Equal vectors of a label are one class, whose members are linked with each other and
    count in n_links without being paired. Other pairs are found by hashing (see plan for the chance) and then
    checked exactly, so no false link is made; a bucket of any size is compared in blocks and none is cut.
    component_id is the smallest vec_id reachable by links; kept says whether it is the row's own. A null vec_id links
    with nothing and has a null component and kept false. Repeated rows with one vec_id are one vector with repeated
    result rows. An empty table gives no rows; other columns are ignored.
    """
    units = common.stored(_units(vectors))
    able = units.where("raw is not null")
    reps = able.groupBy("hi", "lo").agg(F.min("vec_id").alias("id"), F.count_distinct("vec_id").alias("copies"), *[F.first(c).alias(c) for c in ("label", "dims", "raw")])
    reps = common.stored(reps)
    k, tables = plan(reps.count(), threshold)
    hashed = common.stored(_hashed(reps.select("id", "copies", "label", "dims", "raw"), k, tables, seed))
    members = hashed.select("id", F.posexplode("buckets").alias("t", "bucket"))
    counts = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    n = F.ceil(F.col("n") / block).cast("int")
    shared = members.join(counts, "bucket").withColumn("blocks", n).withColumn("own", F.pmod(F.xxhash64("id"), n).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    blocks = shared.select("bucket", "t", "id", "own", other).withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    links = common.stored(_linked(blocks.join(hashed, "id"), threshold))
    degree = links.groupBy(F.col("id").alias("a")).agg(F.sum("others").alias("others"))
    whole = common.components(links.select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = reps.select("hi", "lo", "id", "copies").join(degree, F.col("a") == F.col("id"), "left").join(whole, "id", "left")
    named = named.select("hi", "lo", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    salts = 16  # a class of equal vectors may hold any share of the rows
    spread = named.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    keyed = able.select("vec_id", "hi", "lo", F.pmod(F.xxhash64("vec_id"), F.lit(salts)).cast("int").alias("salt"))
    linked = keyed.join(spread, ["hi", "lo", "salt"]).select("vec_id", "n_links", "component_id")
    single = units.where("raw is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(single).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
