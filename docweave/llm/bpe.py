"""Operator 10: byte-level BPE encoding over a trie of distinct words, and decoding."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .tokens import Encoder, blocks, cuts_at_spaces

#: The split pattern of byte-level BPE vocabularies without a pattern of their own (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Distinct pieces, and characters of them, whose encodings a worker remembers before it starts afresh.
REMEMBER, CHARACTERS = 1 << 17, 1 << 22


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable ones as they are, the rest from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Trie:
    """Encodes words by last tokens.

    The encoding of a word's first n bytes ends in one token t, and what stands before t is the encoding of the
    first n - len(t) bytes. So the last token of every prefix tells the whole encoding. It is the one token ending
    there whose pairing with the last token before it no merge across their border would undo. Words are walked in
    sorted order, which is depth first through their trie: a word starts from the states that it shares with the
    word before, and each distinct prefix is computed once.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            form = json.load(f)
        letters, vocab = _byte_letters(), form["model"]["vocab"]
        self.special = {a["content"]: a["id"] for a in form.get("added_tokens", [])}
        raw = lambda s: bytes(letters[c] for c in s)
        self.bytes = {i: raw(s) for s, i in vocab.items() if s not in self.special}
        self.ids = {b: i for i, b in self.bytes.items()}
        self.bytes |= {i: s.encode() for s, i in self.special.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int]] = {}
        for n, pair in enumerate(form["model"]["merges"]):
            a, b = (vocab[x] for x in (pair if isinstance(pair, list) else pair.split(" ")))
            both = self.ids[self.bytes[a] + self.bytes[b]]
            self.rank[a, b] = n
            if both in self.made:
                raise ValueError(f"two merges make the token {both}")
            self.made[both] = a, b
        # Only tokens that merging their own bytes makes can stand in an encoding.
        self.left = {i: self._spine(i, 0) for i in self.ids.values()}
        self.right = {i: self._spine(i, 1) for i in self.ids.values()}
        self.sound = {b: i for b, i in self.ids.items() if i not in self.made or self.pair_fits(*self.made[i], whole=self.rank[self.made[i]])}
        self.fits: dict[int, bool] = {}

    def _spine(self, token: int, side: int) -> tuple[tuple[int, int], ...]:
        """The token and its outermost parts on one side (0 left, 1 right), each with the rank of the merge that ends it."""
        out, ended = [], 1 << 60
        while True:
            out.append((token, ended))
            if token not in self.made:
                return tuple(out)
            ended = self.rank[self.made[token]]
            token = self.made[token][side]

    def pair_fits(self, a: int, b: int, whole: int = -1) -> bool:
        """Whether the bytes of token a followed by those of token b encode to exactly these two.

        They don't if some merge joins a part on the right edge of a with one on the left edge of b before either
        part is taken up by a merge within its own token. At equal rank the pair further left is merged first.
        whole: the rank of a merge of all of a with all of b that is allowed, for judging the token made by it.
        """
        get = self.rank.get
        for x, x_ended in self.right[a]:
            for y, y_ended in self.left[b]:
                q = get((x, y))
                if q is not None and q != whole and q < x_ended and q <= y_ended:
                    return False
        return True

    def encode(self, words: list[bytes]) -> Iterator[list[int]]:
        """Encodings of sorted distinct words, in their order."""
        sound, fits = self.sound.get, self.fits
        if len(fits) > 1 << 18:
            fits.clear()
        last, back, before = [-1], [0], b""  # of each prefix of the word before: its last token and where that begins
        for word in words:
            n, top = 0, min(len(word), len(before))
            while n < top and word[n] == before[n]:
                n += 1
            del last[n + 1 :], back[n + 1 :]
            for end in range(n + 1, len(word) + 1):
                for start in range(end - 1, -1, -1):  # only one token fits, and most are short
                    token = sound(word[start:end])
                    if token is not None:
                        if start:
                            key = last[start] << 32 | token
                            if (good := fits.get(key)) is None:
                                good = fits[key] = self.pair_fits(last[start], token)
                            if not good:
                                continue
                        last.append(token)
                        back.append(start)
                        break
            before, out, end = word, [], len(word)
            while end:
                out.append(last[end])
                end = back[end]
            yield out[::-1]


class Codec:
    """Encodes and decodes texts as the tokenizers library does with the same file (byte-level BPE, no normalizer)."""

    def __init__(self, path: str) -> None:
        if not cuts_at_spaces(path):
            raise ValueError("a byte-level BPE file without normalizer, prefix space or stripping special tokens is needed")
        self.trie, self.split = Trie(path), regex.compile(PATTERN)
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.trie.special, key=len, reverse=True)))) if self.trie.special else None
        self.memo: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.held = 0
        self.token_bytes = [self.trie.bytes.get(i, b"") for i in range(max(self.trie.bytes) + 1)]

    pieces = Encoder.pieces

    def _units(self, piece: str) -> list[str]:
        if self.special is None or not self.special.search(piece):
            return self.split.findall(piece)
        out, at = [], 0
        for m in self.special.finditer(piece):
            out += [*self.split.findall(piece[at : m.start()]), m[0]]
            at = m.end()
        return out + self.split.findall(piece[at:])

    def learn(self, pieces: set[str]) -> None:
        """Encode the pieces not yet known: their distinct words go through the trie together."""
        if len(self.memo) > REMEMBER or self.held > CHARACTERS:
            self.memo.clear()
            self.words.clear()
            self.held = 0
        cut = {p: self._units(p) for p in pieces if p not in self.memo}
        self.held += sum(map(len, cut))
        for s, i in self.trie.special.items():
            self.words[s] = np.uint32(i).tobytes()
        new = sorted((w.encode(), w) for w in {w for units in cut.values() for w in units} if w not in self.words)
        for (_, w), ids in zip(new, self.trie.encode([b for b, _ in new]), strict=True):
            self.words[w] = np.array(ids, dtype="<u4").tobytes()
        known = self.words.__getitem__
        for p, units in cut.items():
            self.memo[p] = known(units[0]) if len(units) == 1 else b"".join(map(known, units))

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        i, cut = 0, [self.pieces(t) if t else [] for t in texts]
        while i < len(texts):
            j, need = i, set()
            while j < len(texts) and len(need) < 1 << 15:
                need.update(cut[j])
                j += 1
            self.learn(need)
            for pieces in cut[i:j]:
                yield b"".join(map(self.memo.__getitem__, pieces))
            i = j

    def forget(self) -> None:
        """Drop what is remembered: a reused worker goes on with other work."""
        self.memo, self.words, self.held = {}, {}, 0
        self.trie.fits.clear()

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.token_bytes.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec a worker process and file."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """One row a document: doc_id and ids array<int>, without added special tokens; whole texts, nothing truncated.

    Null and empty text give an empty array. Strings of special tokens inside a text become that token, the
    library's default. Repeated rows give repeated rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for whole in batches:
            for batch in blocks(whole):
                ids = list(tool.encode(batch.column(1).fill_null("").to_pylist()))
                ends = np.cumsum([0, *[len(x) // 4 for x in ids]])
                flat = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)], names=["doc_id", "ids"])
        tool.forget()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The text of each row of encode(): doc_id, text. A null array gives an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for batch in batches:
            texts = [tool.decode(np.array(x or [], dtype="<u4").tobytes()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Digests of encoding and decoding again in one pass: doc_id, n_tokens, ids_sha256, decoded_sha256, lossless.

    Cases are as in encode() and decode(); lossless says whether the decoded text is the text (null as empty).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for whole in batches:
            for batch in blocks(whole):
                texts = batch.column(1).fill_null("").to_pylist()
                counts, digests, decoded, same = [], [], [], []
                for text, ids in zip(texts, tool.encode(texts), strict=True):
                    back = tool.decode(ids)
                    counts.append(len(ids) // 4)
                    digests.append(hashlib.sha256(ids).hexdigest())
                    decoded.append(hashlib.sha256(back.encode()).hexdigest())
                    same.append(back == text)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(digests), pa.array(decoded), pa.array(same)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "lossless"])
        tool.forget()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, lossless boolean")
