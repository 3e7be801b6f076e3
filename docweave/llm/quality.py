"""Operator 3: a quality classifier from weak labels: expectation-maximisation over labellers, then a hashed linear scorer.

Texts are read a few MB at a time as arrays of code points and of word hashes, from which a pass takes both the labellers'
measures and the scorer's features.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, words

#: Hashed features of the scorer, and the documents that it is trained on, about, by a hash of the id.
FEATURES, SAMPLE = 1 << 14, 6000
_SPACE, _UPPER, _LOWER, _LETTER, _DIGIT, _MARK = 1, 2, 4, 8, 16, 32


class _Kinds:
    """Flags of code points, looked up in a table that fills as code points are met."""

    def __init__(self) -> None:
        self.table = np.full(0x110000, 255, dtype=np.uint8)

    def of(self, codes: np.ndarray) -> np.ndarray:
        found = self.table[codes]
        if len(found) and found.max() == 255:
            for c in np.unique(codes[found == 255]).tolist():
                kind = unicodedata.category(chr(c))
                letter = _LETTER if kind[0] == "L" else 0
                self.table[c] = (_SPACE if c in (9, 10, 11, 12, 13, 32) else 0) | letter | {"Lu": _UPPER, "Ll": _LOWER, "Nd": _DIGIT}.get(kind, 0) | (_MARK if kind[0] in "PS" else 0)
            found = self.table[codes]
        return found


_KINDS = _Kinds()
#: Labellers, in the order of the columns of votes().
LABELLERS = ("symbols", "bars", "shouting", "exclamations", "lines again", "vocabulary", "echoes", "prose", "short words", "sentences", "marks")


@dataclass
class Read:
    """Some texts of a batch: first is the place of the first of them; a row of votes each, and features from bounds[i] to bounds[i + 1]."""

    first: int
    votes: np.ndarray
    features: np.ndarray
    bounds: np.ndarray


def read(texts: pa.Array, features: bool = True) -> Iterator[Read]:
    """Votes and features of every text, slice by slice; null is as empty.

    Each labeller votes 1 (good), 0 (bad) or -1 (no vote). One that looks for a single fault abstains where it finds
    none. There are eleven, seven of which only know one fault, so at most 2 ** 7 * 3 ** 4 patterns of votes. Features are
    numbers below FEATURES for each word and for each word's shape (A for an upper-case letter, a for a run of lower-case
    ones, 0 for a digit, the rest as it is).
    """
    for s in words.slices(texts, lower=False):
        whole = s.data.tobytes()
        codes = np.frombuffer(whole.decode().encode("utf-32-le"), dtype="<u4")
        lead = np.zeros(len(s.data) + 1, dtype=np.int64)
        np.cumsum((s.data & 0xC0) != 0x80, out=lead[1:])
        offsets = lead[s.offsets]
        kinds = _KINDS.of(codes)
        starts, ends = words.spans((kinds & _SPACE) > 0, offsets)

        def sums(mask: np.ndarray) -> np.ndarray:
            total = np.zeros(len(mask) + 1, dtype=np.int64)
            np.cumsum(mask, out=total[1:])
            return total

        def of_texts(mask: np.ndarray, at: np.ndarray = offsets) -> np.ndarray:
            return np.diff(sums(mask)[at])

        letters = sums((kinds & _LETTER) > 0)
        own, size, last = letters[ends] - letters[starts], ends - starts, codes[ends - 1]
        full = np.isin(last, [46, 44])  # . ,
        prose = (own == size) | ((own == size - 1) & (own > 0) & (full | np.isin(last, [59, 58, 63])) & ((kinds[ends - 1] & _LETTER) == 0))
        body = size - full
        short = (own == body) & (body >= 1) & (body <= 3)
        again = np.zeros(len(starts), dtype=bool)
        again[1:] = (s.hashes[1:] == s.hashes[:-1]) & (own[1:] == size[1:])
        again[s.bounds[:-1][s.bounds[:-1] < len(again)]] = False
        after = np.ones(len(codes) + 2, dtype=bool)
        after[: len(codes)] = (kinds & _SPACE) > 0
        after[offsets] = True
        stop = np.zeros(len(codes), dtype=bool)
        stop[1:] = ((kinds[:-1] & _LOWER) > 0) & ((codes[1:] == 46) | (codes[1:] == 63)) & after[2 : len(codes) + 1]
        stop[offsets[:-1][offsets[:-1] < len(codes)]] = False
        marks, upper = of_texts((kinds & _MARK) > 0), of_texts((kinds & _UPPER) > 0)
        symbols, bars, exclaimed = of_texts(np.isin(codes, [ord(c) for c in "#*$%&|<>"])), of_texts(codes == 124), of_texts(codes == 33)
        n, size_of = np.maximum(np.diff(s.bounds), 1), np.maximum(np.diff(offsets), 1)
        kinds_of, lines, line_kinds = (np.zeros(len(n), dtype=np.int64) for _ in range(3))
        for i, (a, b) in enumerate(zip(s.bounds[:-1].tolist(), s.bounds[1:].tolist(), strict=True)):
            kinds_of[i] = len(np.unique(s.hashes[a:b]))
            held = [x for x in whole[s.offsets[i] : s.offsets[i + 1]].split(b"\n") if x.strip()]
            lines[i], line_kinds[i] = len(held), len(set(held))
        echoes, plain, little, sentences = of_texts(again, s.bounds), of_texts(prose, s.bounds), of_texts(short, s.bounds), of_texts(stop)
        varied = kinds_of * 6 >= n

        def pick(bad: np.ndarray, good: np.ndarray | None = None) -> np.ndarray:
            return np.where(bad, 0, -1 if good is None else np.where(good, 1, -1))

        votes = np.stack([
            pick(symbols * 25 > size_of), pick(bars * 5 > n), pick(upper * 2 > of_texts((kinds & _LETTER) > 0)), pick(exclaimed * 5 > n), pick((lines > 3) & (line_kinds * 2 < lines)),
            pick((n >= 30) & ~varied, (n >= 30) & (kinds_of * 5 > n * 2)), pick(echoes * 6 > n), pick(plain * 10 < n * 7, (plain * 10 > n * 9) & varied), pick(little * 12 < n, (little * 4 > n) & varied),
            pick(sentences * 100 < n, sentences * 25 > n), pick(marks * 12 > size_of),
        ], axis=1)
        found, bounds = np.zeros(0, dtype=np.int64), s.bounds
        if features:
            plain_byte = np.where(codes < 128, codes, 128 + codes % 127).astype(np.uint8)
            form = np.where(kinds & _UPPER, 65, np.where(kinds & _LOWER, 97, np.where(kinds & _DIGIT, 48, plain_byte))).astype(np.uint8)
            kept = np.ones(len(form), dtype=bool)
            kept[1:] = ~((form[1:] == 97) & (form[:-1] == 97))
            kept[starts] = True
            place = sums(kept)
            shapes = words.hashes(form[kept], place[starts], place[ends])
            both = np.concatenate([s.hashes, words.mix(shapes + np.uint64(1))])
            owner = np.repeat(np.arange(len(n)), np.diff(s.bounds))
            order = np.argsort(np.concatenate([owner, owner]), kind="stable")
            found, bounds = (both % np.uint64(FEATURES)).astype(np.int64)[order], 2 * s.bounds
        yield Read(s.first, votes, found, bounds)


@dataclass
class WeakLabels:
    """What expectation-maximisation found: the share of good documents, and the chance of each labeller's votes 0, 1 and none (columns) on good and on bad ones."""

    prior: float
    good: np.ndarray
    bad: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Chance that a document with these votes (rows of 1, 0, -1) is good; labellers are independent given the class."""
        gap = np.full(len(votes), np.log(self.prior) - np.log(1 - self.prior))
        for i, (g, b) in enumerate(zip(self.good, self.bad, strict=True)):
            gap += (np.log(g) - np.log(b))[votes[:, i]]
        return 1 / (1 + np.exp(np.clip(-gap, -500, 500)))

    def accuracy(self) -> np.ndarray:
        """Chance that a labeller that votes is right."""
        right = self.prior * self.good[:, 1] + (1 - self.prior) * self.bad[:, 0]
        wrong = self.prior * self.good[:, 0] + (1 - self.prior) * self.bad[:, 1]
        return right / (right + wrong)


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> WeakLabels:
    """Fit WeakLabels to patterns of votes and how many documents have each, by expectation-maximisation.

    Starts from the votes themselves, where a vote against counts four times one for; this also settles which class is
    the good one. No chance is taken for less than one in a thousand.
    """
    k = votes.shape[1] if votes.ndim == 2 else 0
    model = WeakLabels(0.5, np.full((k, 3), 1 / 3), np.full((k, 3), 1 / 3))
    if not counts.sum():
        return model
    p = 1 / (1 + np.exp(4.0 * (votes == 0).sum(axis=1) - 1.0 * (votes == 1).sum(axis=1)))

    def shares(weights: np.ndarray) -> np.ndarray:
        sums = np.stack([(weights[:, None] * (votes == v)).sum(axis=0) for v in (0, 1, -1)], axis=1) + 1e-9
        out = np.maximum(sums / sums.sum(axis=1, keepdims=True), 1e-3)
        return out / out.sum(axis=1, keepdims=True)

    for _ in range(rounds):
        after = WeakLabels(float(np.clip((counts * p).sum() / counts.sum(), 0.01, 0.99)), shares(counts * p), shares(counts * (1 - p)))
        moved = abs(after.prior - model.prior) + np.abs(after.good - model.good).sum() + np.abs(after.bad - model.bad).sum()
        model, p = after, after.posterior(votes)
        if moved < 1e-6:
            break
    return model


@dataclass
class Linear:
    """A logistic scorer of hashed counts at length 1."""

    weights: np.ndarray
    bias: float

    def score(self, features: np.ndarray) -> float:
        counts = np.bincount(features, minlength=FEATURES).astype(np.float64)
        gap = self.bias + (counts @ self.weights) / max(1.0, np.sqrt(counts @ counts))
        return float(1 / (1 + np.exp(np.clip(-gap, -500, 500))))


def fit_linear(rows: list[tuple[np.ndarray, np.ndarray]], p: np.ndarray, passes: int = 150, rate: float = 1.0, shrink: float = 1e-5) -> Linear:
    """A scorer fitted to posteriors p of documents, each with its distinct features and their counts.

    A document with posterior p counts as a good one with weight p and as a bad one with the rest. Gradient steps on the
    regularised likelihood, each weight's scaled by its past gradients.
    """
    at = np.concatenate([f for f, _ in rows])
    owner = np.repeat(np.arange(len(rows)), [len(f) for f, _ in rows])
    value = np.concatenate([c / np.sqrt(c @ c) for _, c in ((f, c.astype(np.float64)) for f, c in rows)])
    weights, bias, seen, seen_bias = np.zeros(FEATURES), 0.0, np.full(FEATURES, 1e-12), 1e-12
    for _ in range(passes):
        gap = np.bincount(owner, value * weights[at], len(rows)) + bias
        off = (p - 1 / (1 + np.exp(-gap))) / len(rows)
        grad, grad_bias = np.bincount(at, value * off[owner], FEATURES) - shrink * weights, off.sum()
        seen, seen_bias = seen + grad**2, seen_bias + grad_bias**2
        weights += rate * grad / np.sqrt(seen)
        bias += rate * grad_bias / np.sqrt(seen_bias)
    return Linear(weights, float(bias))


@dataclass
class Scorer:
    weak: WeakLabels
    linear: Linear | None


def _code(votes: np.ndarray) -> np.ndarray:
    """A row of votes as one number, in base 3."""
    return (votes + 1) @ (3 ** np.arange(len(LABELLERS)))


def _votes_of(code: np.ndarray) -> np.ndarray:
    return (code[:, None] // 3 ** np.arange(len(LABELLERS))) % 3 - 1


def fit(docs: DataFrame, sample: int = SAMPLE) -> Scorer:
    """Fit labellers' accuracies to the votes on all documents, and a linear scorer to the posterior labels of a bounded sample.

    Votes are counted by pattern before they reach the driver. Without texts, or if all posteriors agree, there is no
    linear scorer and documents score their posterior.
    """
    known = docs.where("text is not null").select("doc_id", "text")

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in read(batch.column(0), features=False):
                yield pa.RecordBatch.from_arrays([pa.array(_code(part.votes))], names=["code"])

    patterns = known.select("text").mapInArrow(vote, "code long").groupBy("code").agg(F.count("*").alias("n")).toArrow()
    weak = estimate(_votes_of(patterns["code"].to_numpy()), patterns["n"].to_numpy().astype(float))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in read(batch.column(0)):
                cut = [np.unique(part.features[a:b], return_counts=True) for a, b in zip(part.bounds[:-1].tolist(), part.bounds[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(_code(part.votes)), pa.array([f for f, _ in cut], pa.list_(pa.int64())), pa.array([c for _, c in cut], pa.list_(pa.int64()))], names=["code", "features", "counts"])

    drawn = common.sampled(known, sample).select("text").mapInArrow(draw, "code long, features array<long>, counts array<long>").toArrow()
    rows = [(np.array(f.values), np.array(c.values)) for f, c in zip(drawn["features"], drawn["counts"], strict=True)]
    p = weak.posterior(_votes_of(drawn["code"].to_numpy())) if rows else np.zeros(0)
    able = [i for i, (f, _) in enumerate(rows) if len(f)]
    if not able or p[able].min() > 0.5 or p[able].max() < 0.5:
        return Scorer(weak, None)
    return Scorer(weak, fit_linear([rows[i] for i in able], p[able]))


def score(docs: DataFrame, scorer: Scorer, threshold: float = 0.5) -> DataFrame:
    """One row a document: doc_id, posterior (of the labellers' votes), score (of the linear scorer), kept (score >= threshold).

    Whole texts count. A null or empty text, or one without a word, has posterior and score 0 and is not kept. Repeated
    rows give repeated rows, an empty table none; other columns are ignored; a null doc_id stays null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scorer)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weak, linear = shared.value.weak, shared.value.linear
        for batch in batches:
            for part in read(batch.column(1), features=linear is not None):
                posterior = np.where(np.diff(part.bounds) > 0, weak.posterior(part.votes), 0.0)
                scores = posterior
                if linear is not None:
                    scores = np.array([linear.score(part.features[a:b]) if b > a else 0.0 for a, b in zip(part.bounds[:-1].tolist(), part.bounds[1:].tolist(), strict=True)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.first, len(scores)), pa.array(posterior), pa.array(scores, pa.float64()), pa.array(scores >= threshold)], names=["doc_id", "posterior", "score", "kept"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, posterior double, score double, kept boolean")
