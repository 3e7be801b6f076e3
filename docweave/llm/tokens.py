"""Operator 8: token counts of whole texts, huge ones by overlapping chunks that are spliced where both agree."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Characters of a chunk, and of the overlap on each side of a cut.
CHUNK, OVERLAP = 1 << 16, 1 << 10
#: Distinct pieces, and characters of them, that a worker remembers before it starts afresh.
REMEMBER, CHARACTERS = 1 << 18, 1 << 23
#: White space by any library's reading.
_BLANK = frozenset(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]))
#: White space before a space: then the space is no stable place.
_LOOSE = [c + " " for c in sorted(_BLANK)]
_LOOSE_ASCII = [x for x in _LOOSE if x.isascii()]


def cuts_at_spaces(path: str) -> bool:
    """Whether a .json file is a byte-level BPE whose tokens never reach over a stable place (see Encoder)."""
    with open(path, encoding="utf-8") as f:
        form = json.load(f)
    split, added = form.get("pre_tokenizer") or {}, form.get("added_tokens", [])
    plain = all(not (a["lstrip"] or a["rstrip"] or a["single_word"]) and " " not in a["content"] for a in added)
    return bool(plain and form.get("normalizer") is None and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True))


class Encoder:
    """Counts and offsets by the library of one vocabulary file: tokenizers for .json, sentencepiece for .model.

    For a byte-level BPE with the usual split pattern and no normalizer, no token reaches over a place where a
    character that is not white space is followed by a space: the pattern takes white space at the start of a piece
    only, and its lookahead looks to the right. So such places are stable, whatever stands around them. Pieces
    between stable places recur, and the library encodes each distinct piece once while the worker remembers it.
    """

    def __init__(self, path: str) -> None:
        self.memo: dict[str, int] = {}
        self.held = 0
        self.stable = False
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.whole = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
            return
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.whole = lambda texts: [len(x.ids) for x in self.library.encode_batch(texts, add_special_tokens=False)]
        self.stable = cuts_at_spaces(path)

    def pieces(self, text: str) -> list[str]:
        """The text cut at every stable place; joined, the pieces are the text."""
        parts = text.split(" ")
        if parts[0] and not any(x in text for x in (_LOOSE_ASCII if text.isascii() else _LOOSE)):
            return [parts[0], *[" " + p for p in parts[1:]]]
        out, held = [], parts[0]
        for part in parts[1:]:
            if held and held[-1] not in _BLANK:
                out.append(held)
                held = " " + part
            else:
                held += " " + part
        out.append(held)
        return out

    def learn(self, pieces: set[str]) -> None:
        """Count the tokens of the pieces not yet known.

        Pieces that begin with a space and end in no white space are strung together, many to a call: the places
        where they meet are stable.
        """
        if len(self.memo) > REMEMBER or self.held > CHARACTERS:
            self.memo.clear()
            self.held = 0
        new = [p for p in pieces if p not in self.memo]
        self.held += sum(map(len, new))
        joined = [p for p in new if p[:1] == " " and p[-1] not in _BLANK]
        apart = [p for p in new if p[:1] != " " or p[-1] in _BLANK]
        for i in range(0, len(joined), 4096):
            part = joined[i : i + 4096]
            bounds = np.cumsum([len(p) for p in part])
            ends = self.ends("".join(part))
            self.memo.update(zip(part, np.diff(np.searchsorted(ends, bounds, side="right"), prepend=0).tolist(), strict=True))
        for i in range(0, len(apart), 4096):
            self.memo.update(zip(apart[i : i + 4096], self.whole(apart[i : i + 4096]), strict=True))

    def ends(self, text: str) -> list[int]:
        """Where each token of the text ends, by the library."""
        return [b for _, b in self.library.encode(text, add_special_tokens=False).offsets]

    def _places(self, text: str, low: int, high: int) -> Iterator[int]:
        at = text.find(" ", max(low, 1), high)
        while at >= 0:
            if text[at - 1] not in _BLANK:
                yield at
            at = text.find(" ", at + 1, high)

    def count_huge(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        """Tokens of a long text from overlapping chunks.

        Two neighbours are spliced at a stable place inside their overlap at which both end a token; what a chunk
        made left or right of its splices is dropped. If the overlap holds no such place it is doubled, in the end
        to the whole rest of the text, so the count is that of the whole text.
        """
        total, start, n = 0, 0, len(text)
        while n - start > chunk + overlap:
            wide, splice = overlap, -1
            while splice < 0:
                end = min(n, start + chunk + wide)
                if end == n:
                    return total + len(self.ends(text[start:]))
                left = self.ends(text[start:end])
                right_from = max(start + 1, end - 2 * wide)
                right = {right_from + b for b in self.ends(text[right_from : min(n, end + wide)])}
                known = {start + b for b in left}
                splice = next((p for p in self._places(text, right_from + 1, end) if p in known and p in right), -1)
                wide *= 2
            total += sum(start + b <= splice for b in left)
            start = splice
        return total + len(self.ends(text[start:]))

    def counts(self, texts: list[str]) -> list[int]:
        if not self.stable:
            return self.whole(texts)
        cut = [self.pieces(t) if len(t) <= CHUNK + OVERLAP else None for t in texts]
        out, i = [], 0
        while i < len(texts):
            j, need = i, set()
            while j < len(texts) and len(need) < 1 << 17:
                need.update(cut[j] or ())
                j += 1
            self.learn(need)
            memo = self.memo
            counted = [None if c is None else sum([memo[p] for p in c]) for c in cut[i:j]]
            out += [self.count_huge(t) if c is None else c for t, c in zip(texts[i:j], counted, strict=True)]
            i = j
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def blocks(batch: pa.RecordBatch, column: str | int = 1, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with a few MB of text each, so that Python objects of one part at a time are in memory."""
    total = start = 0
    for i, n in enumerate(pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()):
        total += n
        if total >= size:
            yield batch.slice(start, i + 1 - start)
            start, total = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def token_counts(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """One row a document: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Counts are those of the library for the whole text, without added special tokens; strings of special tokens
    inside a text are handled as the library does by default. Null and empty text: 0 bytes, 0 tokens. Repeated rows
    give repeated rows; an empty table gives none; other columns are ignored, and a null doc_id stays null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for whole in batches:
            for batch in blocks(whole):
                texts = batch.column(1).fill_null("")
                tokens = pa.array(tool.counts(texts.to_pylist()), pa.int64())
                size = pa.compute.binary_length(texts).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0), size, tokens, pa.compute.greater(tokens, limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
