"""Operator 2: quality rules by a linear-chain conditional random field over a text's lines."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .tokens import blocks

#: Labelled documents that the field is fitted on, about, by a hash of the id; longer texts than LINES lines are not drawn.
SAMPLE, LINES = 1200, 400
#: Least share of a text's words that must stand in content lines.
SHARE = 0.5
_SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"
FEATURES = ["bias", "symbols over 1 in 50", "symbols over 1 in 12", "bars between words", "shouted words", "exclamations", "words end in symbols", "few distinct words", "earlier line again", "shorter than 4 words", "ends a sentence", "20 words or more"]


def line_features(lines: list[str]) -> np.ndarray:
    """A row of 0 and 1 for each line that has a word, in the order of FEATURES."""
    out, seen = [], set()
    for line in lines:
        w = line.split()
        n, size = max(1, len(w)), max(1, len(line))
        symbols = sum(map(line.count, _SYMBOLS))
        upper = sum(x.isupper() and len(x) > 1 for x in w)
        last = line.rstrip()[-1:]
        out.append((
            1, 50 * symbols > size, 12 * symbols > size, line.count("|") * 4 > n, upper * 2 > n, line.count("!") * 3 > n,
            sum(x[-1] in _SYMBOLS for x in w) * 3 > n, len(w) >= 8 and len(set(w)) * 2 < len(w), line in seen, len(w) < 4, last in (".", "?", "…"), len(w) >= 20,
        ))
        seen.add(line)
    return np.array(out, dtype=np.float64).reshape(-1, len(FEATURES))


@dataclass
class Field:
    """Scores of a line being boilerplate (over content), by feature, and of each step from label to label (0 content, 1 boilerplate)."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES)))
    steps: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def viterbi(self, x: np.ndarray) -> list[int]:
        """The labels of the best path; at a tie, content."""
        if not len(x):
            return []
        (cc, cb), (bc, bb) = self.steps.tolist()
        scores = (x @ self.weights).tolist()
        content, junk, back = 0.0, scores[0], []
        for s in scores[1:]:
            to_c, to_b = bc + junk > content + cc, bb + junk >= content + cb
            content, junk = (bc + junk if to_c else content + cc), s + (bb + junk if to_b else content + cb)
            back.append((to_c, to_b))
        at = int(junk > content)
        out = [at]
        for step in reversed(back):
            at = int(step[at])
            out.append(at)
        return out[::-1]

    def gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the log-likelihood of labels y (texts, lines) given x (texts, lines, features): forward and backward sums in logarithms."""
        k, n, _ = x.shape
        s = np.zeros((k, n, 2))
        s[:, :, 1] = x @ self.weights
        forward, backward = s.copy(), np.zeros((k, n, 2))
        for i in range(1, n):
            forward[:, i] += np.logaddexp.reduce(forward[:, i - 1, :, None] + self.steps, axis=1)
        for i in range(n - 2, -1, -1):
            backward[:, i] = np.logaddexp.reduce(self.steps + (s[:, i + 1] + backward[:, i + 1])[:, None, :], axis=2)
        whole = np.logaddexp.reduce(forward[:, -1], axis=1)
        junk = np.exp(forward[:, :, 1] + backward[:, :, 1] - whole[:, None])
        steps = np.zeros((2, 2))
        np.add.at(steps, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
        if n > 1:
            steps -= np.exp(forward[:, :-1, :, None] + self.steps + (s[:, 1:] + backward[:, 1:])[:, :, None, :] - whole[:, None, None, None]).sum(axis=(0, 1))
        return np.einsum("knd,kn->d", x, y - junk), steps


def fit_field(texts: list[tuple[np.ndarray, int]], rounds: int = 3, passes: int = 60, rate: float = 0.3) -> Field:
    """A field from line features of whole texts and their labels (1 good, 0 bad).

    Lines of good texts are content. Those of bad ones start as boilerplate; after each round the fitted field names
    them anew, except that a bad text keeps its most suspicious line. Fitted by gradient steps on the regularised
    likelihood, each parameter's scaled by its past gradients.
    """
    texts = [(x, q) for x, q in texts if len(x)]
    model = Field()
    if not any(q == 0 for _, q in texts) or not any(q == 1 for _, q in texts):
        return model
    by_length: dict[int, list[int]] = {}
    for i, (x, _) in enumerate(texts):
        by_length.setdefault(len(x), []).append(i)
    stacks = {n: np.stack([texts[i][0] for i in own]) for n, own in by_length.items()}
    labels = [np.full(len(x), int(q == 0)) for x, q in texts]
    lines = sum(len(x) for x, _ in texts)
    for _ in range(rounds):
        model = Field()
        named = {n: np.stack([labels[i] for i in own]) for n, own in by_length.items()}
        seen_w, seen_s = np.full(len(FEATURES), 1e-12), np.full((2, 2), 1e-12)
        for _ in range(passes):
            grads = [model.gradient(stacks[n], named[n]) for n in stacks]
            grad = sum(g for g, _ in grads) / lines - 1e-4 * model.weights
            step = sum(t for _, t in grads) / lines - 1e-4 * model.steps
            seen_w, seen_s = seen_w + grad**2, seen_s + step**2
            model.weights += rate * grad / np.sqrt(seen_w)
            model.steps += rate * step / np.sqrt(seen_s)
            model.steps -= model.steps[0, 0]
        for i, (x, q) in enumerate(texts):
            if q == 0:
                y = np.array(model.viterbi(x))
                y[int(np.argmax(x @ model.weights))] = 1
                labels[i] = y
    return model


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field:
    """A field fitted on about `sample` labelled documents: labels has doc_id and quality (1 good, 0 bad).

    The sample is bounded by this parameter and by LINES lines a text; features are made on the executors. Without
    labels of both kinds the field calls every line content.
    """
    known = common.sampled(labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality")), sample)
    drawn = docs.where("doc_id is not null and text is not null").select("doc_id", "text").join(F.broadcast(known), "doc_id")  # bounded by sample
    drawn = drawn.where(F.regexp_count("text", F.lit("\n")) < LINES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [line_features(_lines(t)).astype(np.int8).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), batch.column(2).cast(pa.int32())], names=["x", "quality"])

    rows = drawn.select("doc_id", "text", "quality").mapInArrow(run, "x binary, quality int").toArrow().to_pylist()
    return fit_field([(np.frombuffer(r["x"], dtype=np.int8).reshape(-1, len(FEATURES)).astype(np.float64), r["quality"]) for r in rows])


def _lines(text: str) -> list[str]:
    """Lines, split at newline characters, that have a word."""
    return [x for x in text.split("\n") if x.strip(_SPACES)]


def base_measures(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    w = text.encode().split()  # splits at exactly the six ASCII white-space characters
    n = len(w)
    chars = len(text) - sum(map(text.count, _SPACES))
    lines = _lines(text)
    threes = Counter(zip(w, w[1:], w[2:], strict=False))
    repeat = 0
    if len(threes) < n - 2:
        hit = np.zeros(n + 3, dtype=bool)
        at = np.flatnonzero(np.fromiter((threes[x] > 1 for x in zip(w, w[1:], w[2:], strict=False)), dtype=bool, count=n - 2))
        hit[at] = hit[at + 1] = hit[at + 2] = True
        repeat = int(hit.sum())
    return n, chars, sum(map(text.count, _SYMBOLS)), len(lines) - len(set(lines)), repeat


def judge(docs: DataFrame, model: Field, share: float = SHARE) -> DataFrame:
    """One row a document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content_words, kept.

    The base measures are those of the contract, of whole texts. base_failed: under 50 words, or more than half of them
    in repeated 3-word windows. The field labels the lines that have a word; content_words are those in content lines.
    kept: not base_failed, and content lines hold at least `share` of the words. Null and empty texts have no words and
    fail. Repeated rows give repeated rows, an empty table none; other columns are ignored, a null doc_id stays null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in blocks(whole)):
            rows = []
            for text in batch.column(1).to_pylist():
                text = text or ""
                n, chars, symbols, again, repeat = base_measures(text)
                failed = n < 50 or 100 * repeat > 50 * n
                lines = _lines(text)
                content = sum(len(x.encode().split()) for x, junk in zip(lines, model.viterbi(line_features(lines)), strict=True) if not junk)
                rows.append((n, chars, symbols, again, repeat, failed, content, not failed and content >= share * n))
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.int64(), pa.bool_()]
            columns = zip(*rows, strict=True) if rows else [()] * 8
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]], names=_NAMES)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_words long, kept boolean")


_NAMES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "content_words", "kept"]


def keep_good(docs: DataFrame, model: Field, share: float = SHARE) -> DataFrame:
    """The rows of docs, all columns, that judge() keeps; each row is judged by its own text, without a join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in blocks(whole, "text")):
            keep = []
            for text in batch.column(batch.schema.names.index("text")).to_pylist():
                n, *_, repeat = base_measures(text or "")
                good = n >= 50 and 100 * repeat <= 50 * n
                if good:
                    lines = _lines(text)
                    content = sum(len(x.encode().split()) for x, junk in zip(lines, model.viterbi(line_features(lines)), strict=True) if not junk)
                    good = content >= share * n
                keep.append(good)
            yield batch.filter(pa.array(keep, pa.bool_()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, schema)
