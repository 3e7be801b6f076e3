"""Operator 6: documents whose sets of word shingles have a Jaccard similarity of at least 0.75, by a metric-space join.

1 - Jaccard is a metric. Documents without a common shingle are all at distance 1 from each other, where no pivot can
tell them apart, so the join goes by three levels:

1. The pivots are the sets of one shingle each. All shingles stand in one global order, the more frequent the later. If two
   sets share three quarters, the first shingle in this order that both hold is among the first n - ceil(3n/4) + 1 of
   either, so a document is replicated to the regions of these pivots and to no more.
2. Each region takes two of its members as pivots. Members that could be linked to them, by sizes, places in the order and
   counts of shingles by class of a hash (no two sets differ by less than their counts do), join them in one group. Where
   a region's members then are of several groups, small ones go to a group that holds half of it, and what is still of
   different groups is compared in blocks by the same bounds.
3. A group is a region of whole sets. A task joins one exactly: what lies within 0.25 of a pivot is linked, the rest is
   compared only inside the windows that the triangle inequality leaves. A group over the byte budget is split into the
   Voronoi cells of several of its members; a document is replicated to each cell whose pivot is at most 0.5 farther than
   its nearest. Cells are split again while that makes them smaller; one that stays too large is compared in blocks.

No step drops a pair that could be linked.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, words
from .frequent import frequent, levels
from .tokens import blocks

#: Words of a shingle.
SHINGLE = 5
#: Members of a region in one block.
BLOCK = 512
#: Shingles of a group, of 8 bytes each, that one task holds, and the documents that split a larger one into cells.
REGION, PIVOTS = 1 << 22, 8
#: Members of a region of which a group with half of them takes in the small groups, of less than a quarter as many documents.
DENSE = 16
#: Levels of cells before what is still too large is compared in blocks.
DEPTH = 4


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted 64-bit hashes of each text's set: 5-word shingles, or the whole sequence if it has fewer words."""
    for s in words.slices(texts, lower=True):
        grams = words.grams(s.hashes, SHINGLE)
        for a, b in zip(s.bounds[:-1].tolist(), s.bounds[1:].tolist(), strict=True):
            n = b - a
            if n >= SHINGLE:
                yield np.unique(grams[a : b - SHINGLE + 1])
            elif n:
                yield words.mix(words.grams(s.hashes[a:b], n) + np.uint64(n))
            else:
                yield s.hashes[:0]


def _key(own: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit halves of a digest of the set."""
    hi, lo = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), dtype=np.int64).tolist()
    return hi, lo


def _classes(own: np.ndarray) -> bytes:
    """How many hashes fall in each of 16 to 4096 classes, by their leading bits; at most 255 is noted."""
    bits = min(12, max(4, int(len(own) // 4).bit_length()))
    return np.minimum(np.bincount((own >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8).tobytes()


def _regions(docs: DataFrame, often: bytes) -> DataFrame:
    """A row a document (h null) and a row for each of its pivots: h, hi, lo, n, pos, hot, doc_id, classes."""
    shared = docs.sparkSession.sparkContext.broadcast(often)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[tuple[int, int]] = set()
        for batch in (part for whole in batches for part in blocks(whole)):
            nodes, tokens, owners, places, hots = [], [], [], [], []
            for own in shingle_sets(batch.column(1)):
                n, key = len(own), _key(own)
                nodes.append((n, *key, _classes(own)))
                if not n or key in done:
                    continue
                done.add(key)
                level = levels(shared.value, own)
                first = n - (3 * n + 3) // 4 + 1
                order = np.argsort(level, kind="stable")[:first]
                tokens.append(own[order])
                owners.append((*key, n, first))
                places.append(np.arange(first, dtype=np.int32))
                hots.append(level[order] > 0)
            n, hi, lo, classes = zip(*nodes, strict=True) if nodes else ((), (), (), ())
            void = [pa.nulls(len(nodes), t) for t in (pa.int64(), pa.int32(), pa.bool_())]
            yield pa.RecordBatch.from_arrays([void[0], pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(n, pa.int64()), void[1], void[2], batch.column(0), pa.array(classes, pa.binary())], names=_NAMES)
            if owners:
                times = [x[3] for x in owners]
                h = np.concatenate(tokens).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h), *[pa.array(np.repeat([x[k] for x in owners], times)) for k in range(3)], pa.array(np.concatenate(places)), pa.array(np.concatenate(hots)), pa.nulls(len(h), pa.int64()), pa.nulls(len(h), pa.binary())], names=_NAMES)

    return docs.select("doc_id", "text").mapInArrow(run, "h long, hi long, lo long, n long, pos int, hot boolean, doc_id long, classes binary")


_NAMES = ["h", "hi", "lo", "n", "pos", "hot", "doc_id", "classes"]


def _could(a: str, b: str):
    """Whether sets of a.n and b.n members whose pivots a.pos and b.pos are one shingle could share enough.

    Sharing three quarters of the union is sharing 3/7 of the sum of sizes; after the first common pivot no more is
    left than the shorter rest. A pair that is linked passes at its first common pivot at least.
    """
    na, nb, pa_, pb = (F.col(x) for x in (f"{a}.n", f"{b}.n", f"{a}.pos", f"{b}.pos"))
    return (4 * na >= 3 * nb) & (4 * nb >= 3 * na) & (7 * F.least(na - pa_, nb - pb) >= 3 * (na + nb))


def _near(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The distinct pairs (a, b) whose class counts differ by no more than linked sets may differ."""
    left, right = reps.select(F.col("node").alias("a"), F.col("classes").alias("ca"), F.col("n").alias("na")), reps.select(F.col("node").alias("b"), F.col("classes").alias("cb"), F.col("n").alias("nb"))
    both = pairs.select("a", "b").distinct().join(left, "a").join(right, "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(k, 500) for whole in batches for k in range(0, whole.num_rows, 500)):
            keep = []
            for x, y, n, m in zip(*(batch.column(c).to_pylist() for c in ("ca", "cb", "na", "nb")), strict=True):
                p, q = np.frombuffer(x, dtype=np.uint8).astype(np.int32), np.frombuffer(y, dtype=np.uint8).astype(np.int32)
                if len(p) > len(q):
                    p, q = q, p
                q = q.reshape(len(p), -1).sum(axis=1)
                keep.append(max(p.max(), q.max()) >= 255 or 7 * int(np.abs(p - q).sum()) <= n + m)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return common.stored(both.select("a", "b", "ca", "cb", "na", "nb").mapInArrow(run, "a long, b long"))


def _folded(counts: np.ndarray, size: int) -> np.ndarray:
    """Rows of class counts as counts of so many, wider classes."""
    return counts.reshape(len(counts), size, -1).sum(axis=2)


def block_pairs(node: np.ndarray, n: np.ndarray, pos: np.ndarray, part: np.ndarray, own: np.ndarray, i: int, j: int, classes: list[bytes]) -> list[tuple[int, int]]:
    """The pairs of members of blocks i and j, of different groups, that pass the bounds on sizes, places and class counts.

    Of each pair one at least is outside the largest group, so only those outside are compared with all.
    """
    out, by_length = [], {}
    for k, c in enumerate(classes):
        by_length.setdefault(len(c), []).append(k)
    tables = {size: (np.array(ks), np.frombuffer(b"".join(classes[k] for k in ks), dtype=np.uint8).reshape(len(ks), size).astype(np.int32)) for size, ks in by_length.items()}
    names, which, counts = np.unique(part, return_inverse=True, return_counts=True)
    outside = which != counts.argmax()
    for size, (left, x) in tables.items():
        asks = outside[left]
        if not asks.any():
            continue
        for other in (size // 2, size, 2 * size):  # of linked sets one has at most twice the classes of the other
            if other not in tables:
                continue
            right, y = tables[other]
            mine, theirs = _folded(x[asks], min(size, other)), _folded(y, min(size, other))
            full = theirs.max(axis=1) >= 255
            for k, row in zip(left[asks].tolist(), mine, strict=True):
                able = (part[right] != part[k]) & (4 * n[right] >= 3 * n[k]) & (4 * n[k] >= 3 * n[right]) & (7 * np.minimum(n[right] - pos[right], n[k] - pos[k]) >= 3 * (n[right] + n[k]))
                able &= (own[right] == j) if own[k] == i else (own[right] == i)
                able &= ~outside[right] | (right > k)
                at = np.flatnonzero(able)
                if len(at):
                    far = 7 * np.abs(theirs[at] - row).sum(axis=1) > n[right[at]] + n[k]
                    at = at[~far | full[at] | (row.max() >= 255)]
                    out += [(min(int(node[k]), b), max(int(node[k]), b)) for b in node[right[at]].tolist()]
    return out


def _mixed(named: DataFrame) -> DataFrame:
    """The rows of named (h, node, n, pos, part) in regions of several groups, with c, the region's members.

    Of regions with the same members the first in the global order stays: there any two of them have their first common
    pivot, if it is one of these. Passages that documents share make many such regions.
    """
    # With two pivots, all pairs of up to three members have been looked at.
    several = named.groupBy("h").agg(F.count("*").alias("c"), F.min("part").alias("low"), F.max("part").alias("high"), F.sum("pos").alias("place"), *[F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"who{k}") for k in range(2)])
    several = several.where("c > 3 and low < high").groupBy("who0", "who1", "c").agg(F.min_by("h", F.struct("place", "h")).alias("h"))
    return named.join(several.select("h", "c"), "h")


def _taken_in(mixed: DataFrame, groups: DataFrame) -> DataFrame:
    """Small groups (part) that go to the group (main) with half of a region's members or more, from rows of _mixed().

    A group is a region of the next level, where the join is exact, so one too large loses nothing; and a near copy of so
    many documents costs less there than if it were compared with nearly all of them at each shingle. Each goes to one
    group, and that one is not small, so groups are not strung together.
    """
    parts = mixed.where(F.col("c") >= DENSE).groupBy("h", "part").agg(F.count("*").alias("k"), F.first("c").alias("c"))
    main = parts.groupBy("h").agg(F.max(F.struct("k", "part")).alias("top"), F.first("c").alias("c")).where("2 * top.k >= c").select("h", "top")
    moved = parts.join(main, "h").where("part <> top.part").groupBy("part").agg(F.max("top").alias("top")).select("part", F.col("top.part").alias("main"))
    large = groups.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") * 4 >= DENSE)
    return moved.join(large, F.col("part") == F.col("component"), "left_anti")


def _renamed(mixed: DataFrame, moved: DataFrame) -> DataFrame:
    """Rows of _mixed() with the groups that _taken_in() gives, of regions that are still of several."""
    rows = mixed.join(moved, "part", "left").withColumn("part", F.coalesce("main", "part")).drop("main")
    return rows.join(rows.groupBy("h").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("h"), "h")


def _across(mixed: DataFrame, block: int) -> DataFrame:
    """Pairs (a, b) between the groups of each region that could be linked, from rows (h, c, node, n, pos, part, classes); c: the region's members."""
    keys = ["h", "i", "j"]
    count = F.ceil(F.col("c") / block).cast("int")
    cut = mixed.withColumns({"blocks": count, "own": F.pmod(F.xxhash64("node"), count).cast("int")})
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    dealt = cut.select(*keys, "own", "node", "n", "pos", "part", "classes").repartition(common.tasks(mixed.sparkSession), *keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, out = None, [], set()

        def compare() -> None:
            if len(held) > 1:
                own, node, n, pos, part, classes = zip(*held, strict=True)
                out.update(block_pairs(np.array(node), np.array(n), np.array(pos), np.array(part), np.array(own), now[1], now[2], classes))

        for batch in batches:
            for h, i, j, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (h, i, j) != now:
                    compare()
                    now, held = (h, i, j), []
                    if len(out) > 200_000:
                        yield _pairs(out)
                        out = set()
                held.append(row)
        compare()
        yield _pairs(out)

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _pairs(out: Collection[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])


class _Sets:
    """Sets of one region, and how many members each shares with a given one.

    Values that more than a sixteenth of the sets hold are columns of bits, the others lists of the sets that hold them: near
    copies have most of their values in common, and a list of each would be as long as the region.
    """

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.size = np.array([len(s) for s in sets])
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.int32), self.size)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        first = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]][: len(flat)])
        self.values, count = flat[first], np.diff(np.r_[first, len(flat)])
        often = count > max(64, len(sets) // 16)
        self.column = np.where(often, np.cumsum(often) - 1, -1)
        self.bits = np.zeros((-(-int(often.sum()) // 64), len(sets)), dtype=np.uint64)
        held, column = np.repeat(often, count), np.repeat(self.column[often], count[often])
        np.bitwise_or.at(self.bits, (column >> 6, owner[held]), np.uint64(1) << (column & 63).astype(np.uint64))
        self.owner, self.count = owner[~held], np.where(often, 0, count)
        self.start = np.cumsum(self.count) - self.count

    def shared(self, own: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.values, own)
        at = at[self.values[np.minimum(at, len(self.values) - 1)] == own] if len(self.values) else at[:0]
        n = self.count[at]
        listed = np.repeat(self.start[at] - np.cumsum(n) + n, n) + np.arange(n.sum())
        out = np.bincount(self.owner[listed], minlength=len(self.size))
        column = self.column[at]
        column = column[column >= 0]
        if len(column):
            asked = np.zeros(len(self.bits), dtype=np.uint64)
            np.bitwise_or.at(asked, column >> 6, np.uint64(1) << (column & 63).astype(np.uint64))
            used = np.flatnonzero(asked)
            out += np.bitwise_count(self.bits[used] & asked[used, None]).sum(axis=0, dtype=np.int64)
        return out


def _linked(shared: np.ndarray, n: int, sizes: np.ndarray) -> np.ndarray:
    return 100 * shared >= 75 * (n + sizes - shared)


def region_links(ids: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect what is connected among the documents of one region, exactly.

    The first document is the pivot. All within 0.25 of it are one component, so pairs among these need no look. Of the
    others only those no more than 0.25 farther than the farthest of this ball can be linked to one in it, and only those
    of other components matter. What is outside the ball goes on with the next pivot. A document that has been compared
    with all is done, so none is compared twice.
    """
    index, out = _Sets(sets), []
    root = np.arange(len(ids))
    active = np.ones(len(ids), dtype=bool)

    def look(x: int) -> tuple[np.ndarray, np.ndarray]:
        """Join x with all that is linked to it: the distances from it, and what is linked."""
        active[x] = False
        shared = index.shared(sets[x])
        linked = _linked(shared, len(sets[x]), index.size)
        for y in np.flatnonzero(linked & (root != root[x])).tolist():
            if root[y] != root[x]:
                out.append((ids[x], ids[y]))
                root[root == root[y]] = root[x]
        return 1 - shared / (len(sets[x]) + index.size - shared), linked

    for p in range(len(ids)):
        if not active[p]:
            continue
        far, linked = look(p)
        inside = active & linked
        active &= ~inside
        if inside.any():
            for y in np.flatnonzero(active & (root != root[p]) & (far <= far[inside].max() + 0.25 + 1e-9)).tolist():
                if root[y] != root[p]:
                    look(y)
    return out


def _in_region(rows: DataFrame) -> DataFrame:
    """Links (a, b) inside the regions of rows (region, node, hi, lo, text); every region fits a task."""
    spread = rows.select("region", "node", "hi", "lo", "text").repartition(common.tasks(rows.sparkSession), "region").sortWithinPartitions("region", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}
        for batch in (part for whole in batches for part in blocks(whole, "text")):
            for c, node, hi, lo, own in zip(*(batch.column(k).to_pylist() for k in range(4)), shingle_sets(batch.column(4)), strict=True):
                if c != now:
                    if len(held) > 1:
                        yield _pairs(region_links(list(held), list(held.values())))
                    now, held = c, {}
                if _key(own) == (hi, lo):  # another text under the same id is no member
                    held[node] = own
        if len(held) > 1:
            yield _pairs(region_links(list(held), list(held.values())))

    return spread.mapInArrow(run, "a long, b long")


def _cells(rows: DataFrame, level: int) -> DataFrame:
    """The Voronoi cells of each region of rows (region, node, n, hi, lo, text, bytes), with the documents in their windows.

    Rows (region, node, n, hi, lo, text, pivot, far, linked, before): far is the distance to the cell's pivot, before the shingles of the region that was split.
    """
    salts = 64  # a region may hold any share of the rows
    pick = F.array_distinct(F.array(*[F.min_by("node", F.xxhash64("node", F.lit(level * PIVOTS + k))) for k in range(PIVOTS)]))
    chosen = rows.groupBy("region").agg(pick.alias("nodes")).select("region", F.explode("nodes").alias("node"))
    pivots = rows.select("region", "node", "hi", "lo", "text").join(chosen, ["region", "node"])
    pivots = pivots.groupBy("region").agg(F.collect_set(F.struct("node", "hi", "lo", "text")).alias("pivots"))  # at most PIVOTS
    pivots = pivots.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    joined = rows.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(salts)).cast("int")).join(pivots, ["region", "salt"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[tuple[int, np.ndarray]]] = {}
        for batch in (whole.slice(k, 200) for whole in batches for k in range(0, whole.num_rows, 200)):
            out: list[tuple] = []
            rest = zip(*(batch.column(k).to_pylist() for k in range(7)), batch.column(7), strict=True)
            for (region, node, n, hi, lo, text, before, listed), own in zip(rest, shingle_sets(batch.column(5)), strict=True):
                if _key(own) != (hi, lo):
                    continue
                if region not in known:
                    known = {region: [(p["node"], s) for p in listed.as_py() for s in shingle_sets(pa.array([p["text"]])) if _key(s) == (p["hi"], p["lo"])]}
                shared = [len(np.intersect1d(s, own, assume_unique=True)) for _, s in known[region]]
                far = [1 - b / (len(s) + n - b) for b, (_, s) in zip(shared, known[region], strict=True)]
                for b, d, (pivot, s) in zip(shared, far, known[region], strict=True):
                    if d <= min(far) + 0.5 + 1e-9:
                        out.append((f"{region}/{pivot}", node, n, hi, lo, text, pivot, d, 100 * b >= 75 * (len(s) + n - b), before))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * 10, kinds, strict=True)], names=_CELL)

    made = joined.select("region", "node", "n", "hi", "lo", "text", "bytes", "pivots").mapInArrow(run, "region string, node long, n long, hi long, lo long, text string, pivot long, far double, linked boolean, before long")
    return common.stored(made.dropDuplicates(["region", "node"]))


_CELL = ["region", "node", "n", "hi", "lo", "text", "pivot", "far", "linked", "before"]


def _in_blocks(rows: DataFrame, block: int) -> DataFrame:
    """Links between the documents outside each cell's ball and the whole cell, in blocks, from rows of _cells()."""
    counts = rows.groupBy("region").agg(F.count_if(~F.col("linked")).alias("n_out"), F.count("*").alias("n_all"))
    i, j, own = F.ceil(F.col("n_out") / block).cast("int"), F.ceil(F.col("n_all") / block).cast("int"), F.xxhash64("node")
    kept = rows.join(counts, "region").withColumns({"ni": i, "nj": j, "i": F.pmod(own, i).cast("int"), "j": F.pmod(own, j).cast("int")})
    cols = ["region", "node", "text", "far"]
    query = kept.where("not linked").select(*cols, "i", F.explode(F.sequence(F.lit(0), F.col("nj") - 1)).alias("j"), F.lit(True).alias("asks"))
    other = kept.select(*cols, F.explode(F.sequence(F.lit(0), F.col("ni") - 1)).alias("i"), "j", F.lit(False).alias("asks"))

    def compare(part: pa.Table) -> pa.Table:
        asks = part["asks"].to_numpy(zero_copy_only=False)
        nodes, far = part["node"].to_numpy(), part["far"].to_numpy()
        sets, theirs = list(shingle_sets(part["text"].combine_chunks())), np.flatnonzero(~asks)
        out: list[tuple[int, int]] = []
        if len(theirs):
            index, size = _Sets([sets[k] for k in theirs]), np.array([len(sets[k]) for k in theirs])
            for q in np.flatnonzero(asks):
                window = np.abs(far[theirs] - far[q]) <= 0.25 + 1e-9
                hit = window & _linked(index.shared(sets[q]), len(sets[q]), size)
                out += [(int(nodes[q]), int(x)) for x in nodes[theirs[hit]] if x != nodes[q]]
        return pa.Table.from_batches([_pairs(out)])

    return query.unionByName(other).groupBy("region", "i", "j").applyInArrow(compare, "a long, b long")


def _large_regions(rows: DataFrame, budget: int, block: int = BLOCK) -> DataFrame:
    """Links inside regions that no task should hold, from rows (region, node, n, hi, lo, text, bytes).

    Members of a cell within 0.25 of its pivot are linked to it, so only pairs with one outside this ball are looked
    at, and of the ball only the part in the window of what is outside. Cells that fit a task are joined there.
    """
    rows, found = rows.withColumn("region", F.col("region").cast("string")), []
    for level in range(DEPTH):
        cells = _cells(rows, level)
        found.append(cells.where("linked and node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")))
        outside = cells.where("not linked").groupBy("region").agg(F.min("far").alias("nearest"))
        kept = cells.join(outside, "region").where("not linked or far >= nearest - 0.250000001").drop("nearest")
        kept = common.stored(kept.join(kept.groupBy("region").agg(F.sum("n").alias("bytes")), "region"))
        found.append(_in_region(kept.where(F.col("bytes") <= budget)))
        stuck = (F.col("bytes") * 10 > F.col("before") * 7) if level < DEPTH - 1 else F.lit(True)
        found.append(_in_blocks(kept.where((F.col("bytes") > budget) & stuck), block))
        rows = kept.where((F.col("bytes") > budget) & ~stuck).drop("before", "pivot", "far", "linked")
        if rows.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def similar(docs: DataFrame, region: int = REGION, block: int = BLOCK) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, and hi and lo, a digest of its set.

    Words are as in the contract (A-Z lower-cased). Two documents are linked when 100 * shared >= 75 * union of their
    sets; component_id is the smallest doc_id reachable by links, itself included. Null or wordless texts have an empty
    set and are linked with nothing. Equal sets are one class from the start, so copies are never paired. Repeated rows
    give repeated rows, and different texts under one doc_id are documents of their own; a null doc_id links with nothing
    and has a null component. An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    made = _regions(docs, frequent(docs, shingle_sets))
    # Frequent shingles are split over tasks by document; of the others a row that stands alone is dropped on arrival.
    salt = F.when(F.col("h").isNull(), F.xxhash64("lo", "doc_id")).when(F.col("hot"), F.pmod("lo", F.lit(64))).otherwise(F.lit(0))
    dealt = made.withColumn("salt", salt).repartition(common.tasks(spark), "h", "salt")
    dealt = dealt.withColumn("c", F.count("*").over(Window.partitionBy("h", "salt")))
    made = common.stored(dealt.where("c > 1 or hot or h is null").drop("salt", "c"))
    nodes = made.where("h is null").select("doc_id", "n", "lo", "hi", "classes")
    reps = nodes.where("n > 0 and doc_id is not null").groupBy("lo", "hi").agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("classes").alias("classes"))
    reps = common.stored(reps.withColumn("node", F.monotonically_increasing_id()))
    members = common.stored(made.where("h is not null").select("h", "hi", "lo", "n", "pos").join(reps.select("hi", "lo", "node"), ["hi", "lo"]).select("h", "node", "n", "pos").distinct())
    one = F.struct("node", "n", "pos")
    pivots = members.groupBy("h").agg(F.min(one).alias("x"), F.max(one).alias("y"), F.count("*").alias("c")).where("c > 1")
    x, y = pivots.select("h", F.explode(F.array("x", "y")).alias("p")).select("h", "p.*").alias("x"), members.alias("y")
    stars = x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.node") != F.col("y.node")) & _could("x", "y"))
    near = _near(stars.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")), reps)
    groups = common.components(near)
    named = members.join(groups, F.col("node") == F.col("id"), "left").select("h", "node", "n", "pos", F.coalesce("component", "node").alias("part"))
    mixed = common.stored(_mixed(named))
    moved = common.stored(_taken_in(mixed, groups))
    mixed = _renamed(mixed, moved).join(reps.select("node", "classes"), "node")
    edges = groups.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(moved.select(F.col("part").alias("a"), F.col("main").alias("b")))
    groups = common.components(edges.unionByName(_across(mixed, block)))
    wanted = groups.join(reps, F.col("node") == groups["id"]).select(F.col("component").alias("region"), "node", "n", "hi", "lo", reps["id"].alias("own"))
    wanted = wanted.join(wanted.groupBy("region").agg(F.sum("n").alias("bytes")), "region")
    texts = common.stored(docs.join(wanted, F.col("doc_id") == F.col("own")).select("region", "node", "n", "hi", "lo", "text", "bytes"))
    links, large = _in_region(texts.where(F.col("bytes") <= region)), texts.where(F.col("bytes") > region)
    if not large.isEmpty():
        links = links.unionByName(_large_regions(large, region, block))
    whole = common.components(links).withColumnRenamed("id", "at")
    least = whole.join(reps, F.col("at") == F.col("node")).groupBy("component").agg(F.min("id").alias("component_id"))
    whole = whole.join(least, "component").select("at", "component_id")
    named = reps.join(whole, F.col("node") == F.col("at"), "left").select("lo", "hi", F.coalesce("component_id", "id").alias("component_id"))
    # Classes of equal sets may hold any share of the documents, so their rows are spread before the join.
    salts = 16
    spread = named.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    keyed = nodes.drop("classes").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    linked = keyed.where("n > 0 and doc_id is not null").join(spread, ["lo", "hi", "salt"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id", "hi", "lo")
    single = keyed.where("n = 0 or doc_id is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "hi", "lo")
    return linked.unionByName(single)


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns, without near duplicates: of each group of similar() one document stays, that of the smallest doc_id.

    Where several rows have that id, one stays: of the set with the smallest digest, the text with the smallest hash, so
    repeated rows become one. Rows without an id link with nothing and all stay; so does one row for each id whose text
    has no words. An empty table gives no rows.
    """
    own = F.when(F.col("doc_id") == F.col("component_id"), F.struct("hi", "lo"))
    first = similar(docs).where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"), F.min(own).alias("key"))
    first = common.stored(first.where("key is not null").select(F.col("doc_id").alias("first"), "n", "key.hi", "key.lo"))
    packed = docs.select(F.struct("*").alias("row"))
    same = F.col("row.doc_id") == F.col("first")
    out = packed.join(first.where("n = 1").select("first"), same, "left_semi").unionByName(packed.where("row.doc_id is null"))
    repeated = first.where("n > 1")
    if not repeated.isEmpty():

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in (part for whole in batches for part in blocks(whole, "text")):
                keys = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
                right = [_key(s) == key for s, key in zip(shingle_sets(batch.column(4)), keys, strict=True)]
                yield batch.select(["row", "first", "text"]).filter(pa.array(right, pa.bool_()))

        rows = packed.join(repeated, same).select("row", "first", "hi", "lo", F.col("row.text").alias("text"))
        rows = rows.mapInArrow(run, T.StructType([packed.schema["row"], T.StructField("first", T.LongType()), T.StructField("text", T.StringType())]))
        out = out.unionByName(rows.groupBy("first").agg(F.min_by("row", F.xxhash64("text")).alias("row")).select("row"))
    return out.select("row.*")
