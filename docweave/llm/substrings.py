"""Operator 5: remove passages that stand earlier in the corpus, by minimiser anchors and sorted or hashed windows.

A window is WINDOW consecutive words. Windows that are equal also have equal anchors: an anchor is the smallest hash of
the GRAM-word sequences inside. Neighbouring windows mostly share one, so a document is a few runs of windows by anchor,
and only runs whose anchor stands elsewhere too can hold a repeat. The windows of such runs are split over tasks by the
anchor where one task can hold all of them, and by a hash of the window itself where not. A task sorts the windows of each
group: of equal neighbours all but the first in the corpus are removed. In groups split by the window's hash the first is
a minimum over equal keys. No suffix tree is built.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, words
from .frequent import frequent, levels

WINDOW, GRAM = 20, 8
#: Runs of one anchor that a task holds at once, with WINDOW - GRAM + 1 windows each; an anchor with more is split by whole windows.
GROUP = 4000


def _runs(s: words.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: anchor, document of the slice, first window, number of windows, and whether the run may repeat itself."""
    span = WINDOW - GRAM + 1
    grams = words.grams(s.hashes, GRAM)
    if len(grams) < span:
        none = np.zeros(0, np.int64)
        return grams[:0], none, none, none, none.astype(bool)
    low = words.lowest(grams, span)
    often = np.zeros(len(low), dtype=np.int8)
    for j in range(span):
        often += grams[j : j + len(low)] == low
    n = np.maximum(0, np.diff(s.bounds) - WINDOW + 1)
    total = int(n.sum())
    owner = np.repeat(np.arange(len(n)), n)
    place = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
    at = np.repeat(s.bounds[:-1], n) + place
    low, often = low[at], often[at]
    first = np.ones(total, dtype=bool)
    first[1:] = (low[1:] != low[:-1]) | (owner[1:] != owner[:-1])
    begin = np.flatnonzero(first)
    size = np.diff(np.r_[begin, total])
    own = (size > span) | (np.maximum.reduceat(often, begin) > 1 if total else np.zeros(0, bool))
    return low[begin], owner[begin], place[begin], size, own


def _anchors(texts: pa.Array) -> Iterator[np.ndarray]:
    for s in words.slices(texts, lower=False):
        anchor, owner, *_ = _runs(s)
        cut = np.searchsorted(owner, np.arange(len(s.bounds)))
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            yield np.unique(anchor[a:b])


def _key(s: words.Words, a: int, b: int) -> tuple[int, int]:
    """Two signed 64-bit parts of a digest of the words themselves."""
    return _halves(hashlib.sha256(_joined(s, a, b)).digest())


def _halves(digest: bytes) -> tuple[int, int]:
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:16], "little", signed=True)


def _survey(docs: DataFrame, often: bytes) -> DataFrame:
    """A row a document (anchor null): hi, lo, doc_id, n_words, sha; and a row a run: anchor, hot, hi, lo, first, size, own."""
    shared = docs.sparkSession.sparkContext.broadcast(often)  # of fixed size
    names = ["anchor", "hot", "hi", "lo", "first", "size", "own", "doc_id", "n_words", "sha"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, done = shared.value, set()
        for batch in batches:
            for s in words.slices(batch.column(1), lower=False):
                bounds = s.bounds.tolist()
                digests = [hashlib.sha256(_joined(s, a, b)) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                keys = [_halves(d.digest()) for d in digests]
                n = len(keys)
                void = lambda t, n=n: pa.nulls(n, t)
                hi, lo = (np.array([k[side] for k in keys], dtype=np.int64) for side in (0, 1))
                yield pa.RecordBatch.from_arrays([void(pa.int64()), void(pa.bool_()), pa.array(hi), pa.array(lo), void(pa.int32()), void(pa.int32()), void(pa.bool_()), batch.column(0).slice(s.first, n), pa.array(np.diff(s.bounds).astype(np.int64)), pa.array([d.hexdigest() for d in digests], pa.string())], names=names)
                anchor, owner, first, size, own = _runs(s)
                fresh = np.array([k not in done and not done.add(k) for k in keys], dtype=bool)
                keep = fresh[owner]
                anchor, owner, first, size, own = (x[keep] for x in (anchor, owner, first, size, own))
                void = lambda t, n=len(anchor): pa.nulls(n, t)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(levels(often, anchor) > 0), pa.array(hi[owner]), pa.array(lo[owner]), pa.array(first.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(own), void(pa.int64()), void(pa.int64()), void(pa.string())], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, "anchor long, hot boolean, hi long, lo long, first int, size int, own boolean, doc_id long, n_words long, sha string")


def _joined(s: words.Words, a: int, b: int, keep: np.ndarray | None = None) -> bytes:
    """Words a..b-1 (those of them that keep marks), joined by one space."""
    if b <= a:
        return b""
    own = s.data[s.starts[a] : s.ends[b - 1]].tobytes().split()
    return b" ".join(own if keep is None else [own[i] for i in np.flatnonzero(keep)])


def _spans(held: DataFrame) -> DataFrame:
    """Rows (anchor, large, id, hi, lo, first, size, span) from rows (id, hi, lo, text, runs): the words that the windows of each run cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, his, los, lists = (batch.column(k).to_pylist() for k in (0, 1, 2, 4))
            for s in words.slices(batch.column(3), lower=False):
                out: list[tuple] = []
                for k, (a, b) in enumerate(zip(s.bounds[:-1].tolist(), s.bounds[1:].tolist(), strict=True), s.first):
                    if b <= a or _key(s, a, b) != (his[k], los[k]):
                        continue
                    whole = s.data[s.starts[a] : s.ends[b - 1]].tobytes().split()
                    for r in lists[k]:
                        out.append((r["anchor"], r["large"], ids[k], his[k], los[k], r["first"], r["size"], b" ".join(whole[r["first"] : r["first"] + r["size"] + WINDOW - 1])))
                kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                columns = zip(*out, strict=True) if out else [()] * 8
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["anchor", "large", "id", "hi", "lo", "first", "size", "span"])

    return held.select("id", "hi", "lo", "text", "runs").mapInArrow(run, "anchor long, large boolean, id long, hi long, lo long, first int, size int, span binary")


def _windows(span: bytes, size: int) -> list[bytes]:
    """The suffixes that start at each of the span's windows, cut at the window's end."""
    data = np.frombuffer(span, dtype=np.uint8)
    gaps = np.flatnonzero(data == 32).tolist()
    starts, ends = [0, *[g + 1 for g in gaps]], [*gaps, len(span)]
    return [span[starts[i] : ends[i + WINDOW - 1]] for i in range(size)]


def subtree_repeats(suffixes: list[tuple[bytes, int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Of the suffixes (words cut at depth WINDOW, document, its text's digest in two, place) of one prefix, the places below a node of that depth that are not its first."""
    suffixes = sorted(set(suffixes))
    return [x[1:] for before, x in zip(suffixes, suffixes[1:], strict=False) if before[0] == x[0]]


def _small_groups(spans: DataFrame) -> DataFrame:
    """Removed windows (id, hi, lo, at) of anchors whose runs fit a task."""
    dealt = spans.select("anchor", "id", "hi", "lo", "first", "size", "span").repartition(common.tasks(spans.sparkSession), "anchor").sortWithinPartitions("anchor")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, out = None, [], []
        for batch in batches:
            for a, i, hi, lo, first, size, span in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if a != now:
                    out += subtree_repeats(held)
                    now, held = a, []
                held += [(w, i, hi, lo, first + k) for k, w in enumerate(_windows(span, size))]
            if len(out) > 100_000:
                yield _places(out)
                out = []
        yield _places(out + subtree_repeats(held))

    return dealt.mapInArrow(run, "id long, hi long, lo long, at int")


def _places(out: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.int32()))], names=["id", "hi", "lo", "at"])


def _large_groups(spans: DataFrame) -> DataFrame:
    """The same for the rest, split by whole windows: a node's first place is a minimum formed before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(hashlib.sha256(w).digest()[:24], i, hi, lo, first + k) for i, hi, lo, first, size, span in zip(*(c.to_pylist() for c in batch.columns), strict=True) for k, w in enumerate(_windows(span, size))]
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["key", "id", "hi", "lo", "at"])

    made = common.stored(spans.select("id", "hi", "lo", "first", "size", "span").mapInArrow(run, "key binary, id long, hi long, lo long, at int"))
    salts, place = 16, F.struct("id", "hi", "lo", "at")
    firsts = made.groupBy("key").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts = firsts.select("key", "first", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    again = made.withColumn("salt", F.pmod(F.xxhash64("id", "at"), F.lit(salts)).cast("int")).join(firsts, ["key", "salt"])
    return again.where(place != F.col("first")).select("id", "hi", "lo", "at")


def _groups(runs: DataFrame, group: int) -> DataFrame:
    """Anchors whose runs may hold a repeat, and whether they are too large for a task: a run of a periodic text may have any number of windows."""
    counts = runs.groupBy("anchor").agg(F.count("*").alias("n"), F.sum("size").alias("windows"), F.max("size").alias("longest"))
    large = (F.col("n") > group) | (F.col("windows") > group * (WINDOW - GRAM + 1))
    return counts.where((F.col("n") > 1) | (F.col("longest") > 1)).select("anchor", large.alias("large"))


def _removed(docs: DataFrame, group: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Documents (doc_id, n_words, hi, lo, sha); texts (id, hi, lo, text) that may hold repeats; the first document (id) of each word sequence (hi, lo); cuts (id, hi, lo, places)."""
    spark = docs.sparkSession
    made = _survey(docs, frequent(docs, _anchors))
    salt = F.when(F.col("anchor").isNull(), F.xxhash64("lo", "doc_id")).when(F.col("hot"), F.pmod("lo", F.lit(64))).otherwise(F.lit(0))
    dealt = made.withColumn("salt", salt).repartition(common.tasks(spark), "anchor", "salt")
    same = Window.partitionBy("anchor", "salt")
    dealt = dealt.withColumn("n", F.count("*").over(same))
    dealt = dealt.where("anchor is null or hot or own or n > 1").drop("salt", "n", "own")
    made = common.stored(dealt)
    nodes = made.where("anchor is null").select("doc_id", "n_words", "hi", "lo", "sha")
    reps = nodes.where("doc_id is not null and n_words > 0").groupBy("lo", "hi").agg(F.min("doc_id").alias("id"))
    reps = common.stored(reps)
    runs = made.where("anchor is not null").select("anchor", "hi", "lo", "first", "size").distinct().join(reps, ["hi", "lo"])
    runs = common.stored(runs)
    lists = runs.join(_groups(runs, group), "anchor").groupBy("id", "hi", "lo").agg(F.collect_list(F.struct("anchor", "large", "first", "size")).alias("runs"))
    texts = docs.select("doc_id", "text").join(lists, F.col("doc_id") == F.col("id"))
    texts = common.stored(texts.select("id", "hi", "lo", "text", "runs"))
    spans = common.stored(_spans(texts))
    found = _small_groups(spans.where("not large")).unionByName(_large_groups(spans.where("large")))
    cuts = found.groupBy("id", "hi", "lo").agg(F.collect_set("at").alias("places"))
    return nodes, texts.select("id", "hi", "lo", "text"), reps, cuts


def _gone(places: list[int], n: int) -> np.ndarray:
    """Which of n words the windows at these places cover."""
    edge = np.zeros(n + 1, dtype=np.int32)
    at = np.array(places, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, np.minimum(at + WINDOW, n), -1)
    return np.cumsum(edge[:n]) > 0


def digests(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """One row a document: doc_id, n_words, n_removed, kept_sha256.

    Words stand as they are, of whole texts. A word goes if a window over it has a word sequence that also starts
    earlier: in a document with a smaller doc_id, or before it in the same one; windows are those of the input. The
    kept words, joined by one space, give the digest. Documents with the same words as an earlier one lose all of
    them if they fill a window, and are no candidates themselves. Null and empty texts have no words. Rows repeated
    with one doc_id and text are one document to each other; different texts under one doc_id are documents of their own,
    in the order of a hash; a null doc_id is left whole and nothing is removed for its
    sake. An empty table gives no rows; other columns are ignored.
    """
    nodes, texts, reps, cuts = _removed(docs, group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, his, los, lists = (batch.column(k).to_pylist() for k in (0, 1, 2, 4))
            rows = []
            for s in words.slices(batch.column(3), lower=False):
                for k, (a, b) in enumerate(zip(s.bounds[:-1].tolist(), s.bounds[1:].tolist(), strict=True), s.first):
                    if b > a and _key(s, a, b) == (his[k], los[k]):
                        gone = _gone(lists[k], b - a)
                        rows.append((ids[k], his[k], los[k], int(gone.sum()), hashlib.sha256(_joined(s, a, b, ~gone)).hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 5, kinds, strict=True)], names=["id", "hi", "lo", "cut", "cut_sha"])

    after = texts.join(cuts, ["id", "hi", "lo"]).select("id", "hi", "lo", "text", "places").mapInArrow(run, "id long, hi long, lo long, cut long, cut_sha string")
    after = after.dropDuplicates(["id", "hi", "lo"])
    return _results(nodes, reps, after)


def _results(nodes: DataFrame, reps: DataFrame, after: DataFrame) -> DataFrame:
    named = reps.join(after, ["id", "hi", "lo"], "left")
    salts = 16  # a class of equal documents may hold any share of them
    named = named.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    keyed = nodes.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    able = F.col("doc_id").isNotNull() & (F.col("n_words") > 0)
    rows = keyed.where(able).join(named, ["lo", "hi", "salt"])
    copy = (F.col("doc_id") > F.col("id")) & (F.col("n_words") >= WINDOW)
    empty = hashlib.sha256(b"").hexdigest()
    rows = rows.select("doc_id", "n_words", F.when(copy, F.col("n_words")).otherwise(F.coalesce("cut", F.lit(0))).alias("n_removed"), F.when(copy, F.lit(empty)).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"))
    rest = nodes.where(~able).select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"))
    return rows.unionByName(rest)


def remove_repeats(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """docs, all columns, with repeated passages cut from the text, and without documents of which no word is left.

    What goes is as in digests(). A text that loses nothing stays as it is; in others the white space after a removed
    word goes with it. Documents that had no word before stay.
    """
    nodes, _, reps, cuts = _removed(docs, group)
    able = nodes.where("doc_id is not null and n_words > 0").select("doc_id", "n_words", "lo", "hi").distinct()
    salts = 16
    named = reps.join(cuts, ["id", "hi", "lo"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    keyed = able.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int")).join(named, ["lo", "hi", "salt"])
    copy = (F.col("doc_id") > F.col("id")) & (F.col("n_words") >= WINDOW)
    plan = keyed.select(F.col("doc_id").alias("of"), "hi", "lo", copy.alias("copy"), F.when(F.col("doc_id") == F.col("id"), F.col("places")).alias("places")).where("copy or places is not null")
    packed = docs.select(F.struct("*").alias("row"))  # so that no column of docs meets one of ours
    at, kind = docs.columns.index("text"), packed.schema["row"]

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[tuple[int | None, int | None]] = [(None, None)] * batch.num_rows
            for s in words.slices(batch.column(0).field(at), lower=False):
                for k, (a, b) in enumerate(zip(s.bounds[:-1].tolist(), s.bounds[1:].tolist(), strict=True), s.first):
                    keys[k] = _key(s, a, b) if b > a else (None, None)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([x[side] for x in keys], pa.int64()) for side in (0, 1)]], names=["row", "own_hi", "own_lo"])

    keyed = packed.mapInArrow(key, T.StructType([kind, T.StructField("own_hi", T.LongType()), T.StructField("own_lo", T.LongType())]))
    joined = keyed.join(plan, (F.col("row.doc_id") == F.col("of")) & (F.col("own_hi") == F.col("hi")) & (F.col("own_lo") == F.col("lo")), "left").select("row", "of", "copy", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, copies, lists = (batch.column(c).to_pylist() for c in ("of", "copy", "places"))
            rows = batch.column(0)
            fields = [rows.field(k) for k in range(rows.type.num_fields)]
            texts, keep = fields[at].to_pylist(), [True] * batch.num_rows
            for s in words.slices(fields[at], lower=False):
                for k, (a, b) in enumerate(zip(s.bounds[:-1].tolist(), s.bounds[1:].tolist(), strict=True), s.first):
                    if ids[k] is None:
                        continue
                    gone = np.ones(b - a, bool) if copies[k] else _gone(lists[k], b - a)
                    keep[k] = not gone.all()
                    edges = np.r_[s.starts[a:b], s.ends[b - 1]]
                    texts[k] = b"".join(s.data[edges[i] : edges[i + 1]].tobytes() for i in np.flatnonzero(~gone)).decode()
            fields[at] = pa.array(texts, rows.type.field(at).type)
            out = pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(fields, fields=list(rows.type))], names=["row"])
            yield out.filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(run, T.StructType([kind])).select("row.*")
