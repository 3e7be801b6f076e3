"""Vectorised words of a batch of texts: where each lies and a 64-bit hash of it, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Texts are handled in slices of about so many bytes, so that the arrays stay in cache; a longer text is a slice of its own.
SLICE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a finaliser in the manner of splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


#: Of a word's eight bytes, those that are its own when it has so many left.
_OWN = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
#: Words longer than this many bytes are rare and hashed one by one.
LONG = 64


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each word: eight at a time, each group mixed with its place before they are summed."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    size = ends - starts
    out = mix(size.astype(np.uint64) + np.uint64(_BASE))
    at = np.flatnonzero(size <= LONG)
    for k in range(0, LONG, 8):
        place = np.uint64((k + 1) * _BASE & (1 << 64) - 1)
        out[at] += mix((eight[starts[at] + k] & _OWN[np.minimum(size[at] - k, 8)]) ^ place)
        at = at[size[at] > k + 8]
        if not len(at):
            break
    for i in np.flatnonzero(size > LONG).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    return mix(out)


@dataclass
class Words:
    """Words of some texts of a batch from its first-th on; bounds[i]:bounds[i+1] are the words of the i-th of them, offsets its bytes."""

    first: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray
    offsets: np.ndarray


def slices(texts: pa.Array, lower: bool) -> Iterator[Words]:
    """Words of every text, slice by slice; null is as empty. lower: A-Z become a-z first, other characters stay."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE, side="right")) - 1)
        own = data[offsets[i] : offsets[j]]
        yield _words(i, _LOWER[own] if lower else own, offsets[i : j + 1] - offsets[i])
        i = j


def spans(space: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end, given which places are white space and where each text begins (and the last one ends)."""
    n = len(space)
    begins, stops = np.zeros(n + 1, dtype=bool), np.zeros(n + 1, dtype=bool)
    begins[1:n] = space[: n - 1]
    begins[offsets[:-1]] = True
    begins[:n] &= ~space
    begins[n] = False
    stops[1:] = ~space
    cut = np.ones(n + 1, dtype=bool)
    cut[:n] = space
    cut[offsets] = True
    return np.flatnonzero(begins), np.flatnonzero(stops & cut)


def _words(first: int, data: np.ndarray, offsets: np.ndarray) -> Words:
    starts, ends = spans(_SPACE[data], offsets)
    return Words(first, data, starts, ends, hashes(data, starts, ends), np.searchsorted(starts, offsets), offsets)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each k consecutive words; the last k-1 words start none."""
    n = len(hashes) - k + 1
    if n <= 0:
        return hashes[:0]
    out, base = hashes[:n].copy(), np.uint64(_BASE)
    for j in range(1, k):
        out *= base
        out += hashes[j : n + j]
    return mix(out)


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out
