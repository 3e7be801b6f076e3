"""Operator 4: language identification by interpolated Kneser-Ney character models in sorted hash arrays.

Counts, continuation counts, probabilities and back-off weights are Spark aggregations and joins over all rows. The arrays
lie in the shared folder, split by ranges of the hash, and tasks map them into memory: nothing that grows with the corpus
passes through the driver or is broadcast.
"""

from __future__ import annotations

import os
import unicodedata
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, words

#: Characters of a gram, and bits of a character: a whole code point.
ORDER, BITS = 4, 21
#: Sharpnesses of the scores to choose from.
LADDER = [2.0**k for k in range(-1, 8)]
#: Calibration takes entropies in units of 2**-UNIT nats and logarithms of likelihoods in units of 2**-FIT.
UNIT, FIT = 36, 44
#: Bits of an entropy that are told apart at a time where one is looked for by its rank.
ROUND = 16
UNDETERMINED = "und"
#: Grams that are looked up at once, of many short texts or of a part of a long one.
PART = 1 << 17
#: Different grams that a counting task holds before it passes them on.
HELD = 1 << 20
#: Rows of one file of a table, at most about.
FILE = 1 << 22
#: Logarithms of grams met before that a task remembers.
MEMORY = 1 << 22


def _symbol(c: int) -> int:
    """The lower-case code point of a letter, or of a mark such as a vowel sign; 0 for anything else."""
    x = chr(c)
    if not x.isalpha() and unicodedata.category(x) not in ("Mn", "Mc"):
        return 0
    return ord(x.lower()[0])


class _Symbols:
    """Symbols of code points, looked up in a table that fills as code points are met."""

    def __init__(self) -> None:
        self.table = np.full(0x110000, -1, dtype=np.int32)

    def of(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        found = self.table[codes]
        if len(found) and found.min() < 0:
            for c in np.unique(codes[found < 0]).tolist():
                self.table[c] = _symbol(c)
            found = self.table[codes]
        return found


_SYMBOLS = _Symbols()


def grams(text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each ORDER characters of a text, in parts: the first, and the others as one number of BITS bits a character.

    A border (0) stands for every run of non-letters and at both ends.
    """
    tail = np.zeros(ORDER - 1, dtype=np.int64)
    for k in range(0, max(1, len(text)), PART):
        s = _SYMBOLS.of(text[k : k + PART]).astype(np.int64)
        s = s[(s > 0) | (np.r_[tail[-1:], s[:-1]] > 0)]
        s = np.concatenate([tail, s, np.zeros(int(k + PART >= len(text)), dtype=np.int64)])
        n = len(s) - ORDER + 1
        key = np.zeros(n, dtype=np.int64)
        for j in range(1, ORDER):
            key = (key << BITS) | s[j : n + j]
        tail = s[n:]
        if n:
            yield s[:n], key


def _mask(order: int) -> int:
    return (1 << BITS * order) - 1


def _ids(first: np.ndarray | int, keys: np.ndarray) -> np.ndarray:
    """The 64-bit hash of grams; of those with one first character no two share it."""
    return words.mix(keys.astype(np.uint64) ^ words.mix(np.atleast_1d(first).astype(np.uint64))).view(np.int64)


def gram_counts(docs: DataFrame) -> DataFrame:
    """Counts of grams by language, over all rows (lang, text): lang, first, key, n. Tasks count first, so few rows are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        n = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for first, keys in grams(text):
                    held.setdefault(lang, []).append((first, keys, np.ones(len(keys), np.int64)))
                    n += len(keys)
                if n > HELD:
                    held = {x: [summed(parts)] for x, parts in held.items()}
                    n = sum(len(parts[0][0]) for parts in held.values())
                    if n > HELD // 2:
                        yield from rows(held)
                        held, n = {}, 0
        yield from rows({x: [summed(parts)] for x, parts in held.items()})

    def summed(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        first, keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        ids = _ids(first, keys)
        order = np.argsort(ids)
        begin = np.flatnonzero(np.diff(ids[order], prepend=~ids[order[:1]]))
        return first[order[begin]], keys[order[begin]], np.add.reduceat(n[order], begin)

    def rows(held: dict[str, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]) -> Iterator[pa.RecordBatch]:
        for lang, [(first, keys, n)] in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(first), pa.array(keys), pa.array(n)], names=["lang", "first", "key", "n"])

    made = docs.where("lang is not null and text is not null").select("lang", "text").mapInArrow(run, "lang string, first long, key long, n long")
    return made.groupBy("lang", "first", "key").agg(F.sum("n").alias("n"))


class Table:
    """Rows (id, language, logarithm) in files of the shared folder, a file a range of ids and sorted by id in it, mapped into memory on use."""

    def __init__(self, bits: int, files: dict[int, tuple[str, int]]) -> None:
        self.bits, self.files = bits, files
        self.maps: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def __getstate__(self) -> dict:
        return {"bits": self.bits, "files": self.files, "maps": {}}

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows with one of the ids: the place in ids, the language, the logarithm."""
        found = []
        parts = _part(ids, self.bits)
        for part in np.unique(parts).tolist():
            if part not in self.files:
                continue
            if part not in self.maps:
                name, n = self.files[part]
                load = lambda kind, at, name=name, n=n: np.memmap(name, kind, "r", at, n)
                self.maps[part] = load("<i8", 0), load("<i4", 8 * n), load("<f4", 12 * n)
            keys, langs, logs = self.maps[part]
            own = np.flatnonzero(parts == part)
            low = np.searchsorted(keys, ids[own])
            n = np.searchsorted(keys, ids[own], "right") - low
            at = np.arange(n.sum()) + np.repeat(low - np.cumsum(n) + n, n)
            found.append((np.repeat(own, n), langs[at], logs[at]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.float32)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _part(ids: np.ndarray, bits: int) -> np.ndarray:
    """The range of each id: its upper bits."""
    return (ids.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(len(ids), np.int32)


def _written(rows: DataFrame, languages: list[str], folder: str) -> Table:
    """A table of rows (lang, first, key, log)."""
    bits = (rows.count() // FILE).bit_length()
    shared = rows.sparkSession.sparkContext.broadcast(languages)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _ids(batch.column(1).to_numpy(), batch.column(2).to_numpy())
            lang = pc.index_in(batch.column(0), value_set=pa.array(shared.value, pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(_part(ids, bits)), pa.array(ids), lang, batch.column(3)], names=["part", "id", "lang", "log"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            parts = batch.column(0).to_numpy()
            cuts = np.flatnonzero(np.diff(parts, prepend=-1)).tolist()
            for a, b in zip(cuts, [*cuts[1:], len(parts)], strict=True):
                if parts[a] != now:
                    yield from file(now, held)
                    now, held = int(parts[a]), []
                held.append(batch.slice(a, b - a))
        yield from file(now, held)

    def file(part: int | None, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if held:
            name, table = f"{folder}/{uuid.uuid4().hex}", pa.Table.from_batches(held)  # of a failed task nobody learns the name
            with open(name, "wb") as f:
                for column, kind in (("id", "<i8"), ("lang", "<i4"), ("log", "<f4")):
                    f.write(table[column].to_numpy().astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([name]), pa.array([table.num_rows], pa.int64())], names=["part", "name", "n"])

    dealt = rows.select("lang", "first", "key", F.col("log").cast("float").alias("log")).mapInArrow(place, "part int, id long, lang int, log float")
    dealt = dealt.repartition(min(1 << bits, common.tasks(rows.sparkSession)), "part").sortWithinPartitions("part", "id", "lang")
    return Table(bits, {r.part: (r.name, r.n) for r in dealt.mapInArrow(write, "part int, name string, n long").collect()})


def _tables(counts: DataFrame, languages: list[str], folder: str) -> list[tuple[Table, Table]]:
    """For each order from 1 on, the probability of each gram's last character and the back-off weight of each context, of interpolated Kneser-Ney."""
    by_order = [counts]
    for order in range(ORDER - 1, 0, -1):  # a lower order counts how many characters stand before a gram
        lower = by_order[0].groupBy("lang", F.col("key").bitwiseAND(_mask(order)).alias("key")).agg(F.count("*").alias("n"))
        by_order.insert(0, common.stored(lower.select("lang", F.lit(0).cast("long").alias("first"), "key", "n")))
    out, below = [], None
    for order, rows in enumerate(by_order, 1):
        once, twice = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
        discounts = rows.groupBy("lang").agg(F.when((once > 0) & (twice > 0), once / (once + 2 * twice)).otherwise(0.5).alias("discount"))
        rows = rows.withColumn("context", _context("first", "key"))
        sums = rows.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).join(discounts, "lang")
        contexts = common.stored(sums.select("lang", "context", "discount", "total", (F.col("discount") * F.col("kinds") / F.col("total")).alias("back")))
        rows = rows.join(contexts, ["lang", "context"])
        low = F.lit(2.0**-BITS)
        if below is not None:
            rows = rows.withColumn("end", F.col("key").bitwiseAND(_mask(order - 1))).join(below.select("lang", F.col("key").alias("end"), F.col("p").alias("low")), ["lang", "end"])
            low = F.col("low")
        made = common.stored(rows.select("lang", "first", "key", ((F.col("n") - F.col("discount")) / F.col("total") + F.col("back") * low).alias("p")))
        out.append((_written(made.withColumn("log", F.log("p")), languages, folder), _written(contexts.select("lang", F.lit(0).cast("long").alias("first"), F.col("context").alias("key"), F.log("back").alias("log")), languages, folder)))
        common.release(contexts)
        if below is not None:
            common.release(below)
        below = made
    for made in (below, *by_order[:-1]):
        common.release(made)
    return out


def _context(first: str, key: str) -> Column:
    return F.shiftleft(first, BITS * (ORDER - 2)).bitwiseOR(F.shiftright(key, BITS))


class Model:
    """Probabilities and back-off weights of all languages in tables of gram hashes, one pair an order."""

    def __init__(self, languages: list[str], tables: list[tuple[Table, Table]]) -> None:
        self.languages, self.tables = languages, tables
        self.sharpness, self.most = 1.0, float("inf")
        self.memory: tuple[np.ndarray, np.ndarray] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"memory": None}

    def _log(self, keys: np.ndarray, order: int, first: np.ndarray | int = 0) -> np.ndarray:
        """Natural logarithms of the probability of each gram's last character, a column a language, by binary search.

        A language that lacks a gram keeps what the lower order gave, with its back-off weight if it has the context.
        """
        out = np.full((len(keys), len(self.languages)), -BITS * np.log(2), np.float32)
        for low, (probabilities, contexts) in enumerate(self.tables[:order], 1):
            head = np.int64(0) if low < ORDER else first
            own = keys & _mask(min(low, ORDER - 1))
            at, lang, log = contexts.find(_ids(0, (own >> BITS) | (head << BITS * (ORDER - 2))))
            out[at, lang] += log
            at, lang, log = probabilities.find(_ids(head, own))
            out[at, lang] = log
        return out

    def _remembered(self, first: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """_log of whole grams; those met before are taken from a memory of fixed size with one place for each hash."""
        if self.memory is None:
            size = max(2, 1 << (MEMORY // len(self.languages)).bit_length() - 1)
            self.memory = np.arange(1, size + 1), np.zeros((size, len(self.languages)), np.float32)  # no id fits its place yet
        known, logs = self.memory
        ids = _ids(first, keys)
        place = ids & (len(known) - 1)
        out = logs[place]
        new = np.flatnonzero(known[place] != ids)
        if len(new):
            _, one, back = np.unique(ids[new], return_index=True, return_inverse=True)
            at = new[one]
            fresh = self._log(keys[at], ORDER, first[at])
            out[new] = fresh[back]
            places, pick = np.unique(place[at], return_index=True)
            known[places], logs[places] = ids[at[pick]], fresh[pick]
        return out

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Cross-entropy a character, in nats, of each text (a row) under each language (a column)."""
        total, sizes = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        held: list[tuple[np.ndarray, np.ndarray]] = []
        owners: list[int] = []

        def add() -> None:
            first, keys = (np.concatenate(x) for x in zip(*held, strict=True))
            logs = self._remembered(first, keys).astype(np.float64)
            np.add.at(total, owners, np.add.reduceat(logs, np.r_[0, np.cumsum([len(k) for _, k in held])[:-1]], axis=0))
            held.clear()
            owners.clear()

        n = 0
        for i, text in enumerate(texts):
            for first, keys in grams(text):
                sizes[i] += len(keys)
                held.append((first, keys))
                owners.append(i)
                n += len(keys)
                if n >= PART:
                    add()
                    n = 0
        if held:
            add()
        return -total / sizes[:, None]

    def scores(self, texts: list[str]) -> tuple[list[str], list[float], list[bool]]:
        """The best language of each text (of equals the first by name), its share of the posterior, and whether it is rejected as unlike all."""
        lang, score, no = [UNDETERMINED] * len(texts), [0.0] * len(texts), [True] * len(texts)
        able = [i for i, t in enumerate(texts) if any(map(str.isalpha, t))]
        if not able or not self.languages:
            return lang, score, no
        h = self.entropies([texts[i] for i in able])
        best = h.argmin(axis=1)
        least = h.min(axis=1)
        share = 1 / np.exp(-self.sharpness * (h - least[:, None])).sum(axis=1)
        for i, b, s, e in zip(able, best.tolist(), share.tolist(), least.tolist(), strict=True):
            lang[i], score[i], no[i] = self.languages[b], s, e > self.most
        return lang, score, no


def learn(docs: DataFrame) -> Model:
    """A model of every language in docs (doc_id, lang, text): counts and calibration of all rows with language and text.

    The sharpness of the scores is the one, of a fixed ladder, that gives the labels of all these texts the highest
    likelihood; a text is rejected when its entropy is over their 99.9th percentile by more than a tenth. Texts without
    a letter do not calibrate.
    """
    known = docs.where("lang is not null and text is not null")
    counts = common.stored(gram_counts(known))
    languages = sorted(r.lang for r in counts.select("lang").distinct().collect())
    folder = f"{common.shared_dir(docs.sparkSession).removeprefix('file:')}/{docs.sparkSession.sparkContext.applicationId}/{uuid.uuid4().hex}"
    os.makedirs(folder)
    model = Model(languages, _tables(counts, languages, folder) if languages else [])
    common.release(counts)
    if len(model.languages) > 1:
        _calibrate(known, model)
    return model


def _calibrate(known: DataFrame, model: Model) -> None:
    """Set the model's sharpness and bound of rejection from all rows (lang, text); sums are of whole numbers, so that reruns agree."""
    shared = known.sparkSession.sparkContext.broadcast(model)
    names = [f"fit{k}" for k in range(len(LADDER))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {x: i for i, x in enumerate(shared.value.languages)}
        for batch in batches:
            for k in range(0, batch.num_rows, 200):
                part = batch.slice(k, 200)
                own = [(place[x], t) for x, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True) if any(map(str.isalpha, t))]
                if own:
                    h = shared.value.entropies([t for _, t in own])
                    least = h.min(axis=1)
                    over = h - least[:, None]
                    label = over[np.arange(len(own)), [x for x, _ in own]]
                    fits = [-s * label - np.log(np.exp(-s * over).sum(axis=1)) for s in LADDER]
                    whole = [np.rint(np.maximum(least, 0) * 2.0**UNIT), *(np.rint(x * 2.0**FIT) for x in fits)]
                    yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in whole], names=["least", *names])

    found = common.stored(known.select("lang", "text").mapInArrow(run, ", ".join(f"{x} long" for x in ("least", *names))))
    n, *fit = found.agg(F.count("*"), *(F.sum(F.col(x).cast("decimal(38,0)")) for x in names)).first()
    if n:
        model.sharpness = LADDER[fit.index(max(fit))]
        at, part = divmod(999 * (n - 1), 1000)  # the percentile lies between two ranks
        low, high = (_ranked(found, "least", at + k) for k in (1, 2 if part else 1))
        model.most = (low + (high - low) * part / 1000) * 2.0**-UNIT * 1.1
    common.release(found)


def _ranked(rows: DataFrame, column: str, rank: int) -> int:
    """The rank-th smallest, from 1 on, of a column of longs from 0 to 2**(3 * ROUND) - 1, by counts in ever finer bins.

    Nothing is sorted or gathered: each round brings at most 2**ROUND counts to the driver, whatever the rows.
    """
    found = 0
    for shift in (2 * ROUND, ROUND, 0):
        bins = rows.where(F.shiftright(column, shift + ROUND) == found).groupBy(F.shiftright(column, shift).alias("bin")).count()
        for found, n in sorted(tuple(r) for r in bins.collect()):
            if rank <= n:
                break
            rank -= n
    return found


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """One row a document: doc_id, lang_pred, score (0 to 1), rejected.

    lang_pred is the learned language of the lowest cross-entropy a character over the whole text; `und` with score 0
    if the text is null, has no letter, or nothing was learned. rejected marks texts unlike every language; callers
    that want `und` for them read both columns. Repeated rows give repeated rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 200):
                part = batch.slice(k, 200)
                lang, score, no = shared.value.scores([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang), pa.array(score, pa.float64()), pa.array(no)], names=["doc_id", "lang_pred", "score", "rejected"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")
