"""Vectorised views of a batch of texts as UTF-8 bytes, shared by the operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

_U64 = np.uint64


def release() -> None:
    """Gives the memory that a worker has freed back to the machine, where its C library can; workers live on after a task."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


MIX = (_U64(0x9E3779B97F4A7C15), _U64(0xC2B2AE3D27D4EB4F), _U64(0xD6E8FEB86659FD93), _U64(0xA0761D6478BD642F))
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string or binary column; null is empty."""
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string()).cast(pa.large_binary())
    else:
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def blocks(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges [i, j) of whole texts with about ``most`` bytes each; a longer text is alone in its range."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; the argument is overwritten."""
    x ^= x >> _U64(32)
    x *= MIX[2]
    x ^= x >> _U64(29)
    x *= MIX[1]
    x ^= x >> _U64(32)
    return x


def words8(data: np.ndarray) -> np.ndarray:
    """At each position the eight bytes from there as one number, zeros beyond the end."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.lib.stride_tricks.as_strided(padded, (len(data), 8), (1, 1)).copy().view(np.uint64).ravel() if len(data) else np.zeros(0, np.uint64)


#: Bytes that span_hashes takes eight at a time; longer spans, which are few, go through BLAKE2.
SHORT = 256
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of the bytes data[start:end] of each pair; equal contents have equal hashes wherever they stand.

    Each eight bytes are taken into the hash through a finaliser, so it is linear in nothing: no family of texts
    (repetitive ones, say) has more collisions than others.
    """
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    at8 = np.lib.stride_tricks.as_strided(padded, (len(data) + 1, 8), (1, 1))
    size = end - start
    out = mixed(size.astype(np.uint64) * MIX[0] + _U64(seed))
    live, k = np.flatnonzero(size > 0), 0
    while len(live) and k < SHORT:
        left = size[live] - k
        word = at8[start[live] + k].view(np.uint64).ravel() & _MASK[np.minimum(left, 8)]
        out[live] = mixed((out[live] ^ word) * MIX[3])
        live, k = live[left > 8], k + 8
    for i in live.tolist():
        out[i] = int.from_bytes(blake2b(data[start[i] : end[i]].tobytes(), digest_size=8, key=seed.to_bytes(8, "little")).digest(), "little")
    return out


class Words:
    """Words [^\\x20\\x09-\\x0D]+ of texts, A-Z lower-cased: their places, texts and 64-bit hashes."""

    __slots__ = ("count", "doc", "end", "first", "hash", "start")

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = True):
        n = len(offsets) - 1
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = ~IS_SPACE[data]
        cut = np.diff(inside)
        begins, ends = cut[:-1] == 1, cut[1:] == -1
        inner = offsets[1:-1]
        inner = inner[(inner > 0) & (inner < len(data))]
        inner = inner[(inside[inner + 1] == 1) & (inside[inner] == 1)]  # two texts that touch
        begins[inner] = True
        ends[inner - 1] = True
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        low = LOWER[data] if lower else data
        self.hash = span_hashes(low, self.start, self.end)
        self.first = np.searchsorted(self.start, offsets)  # of each text, and the end
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(n), self.count)


def shingles(words: Words, n: int, keep_short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's n-word sequences and their text; a text of fewer words has its whole sequence as one."""
    total = len(words.hash)
    if not total:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(max(total - n + 1, 0), np.uint64)
    for i in range(n):
        out *= MIX[3]
        out += words.hash[i : i + len(out)]
    out = mixed(out)
    whole = words.doc[: len(out)] == words.doc[n - 1 : n - 1 + len(out)]
    out, doc = out[whole], words.doc[: len(whole)][whole]
    if not keep_short:
        return out, doc
    few = np.flatnonzero((words.count > 0) & (words.count < n))
    if not len(few):
        return out, doc
    short = np.zeros(len(few), np.uint64)
    for i in range(n - 1):
        at = np.minimum(words.first[few] + i, total - 1)
        short = np.where(i < words.count[few], short * MIX[3] + words.hash[at], short)
    short = mixed(short + words.count[few].astype(np.uint64) * MIX[0] + MIX[1])
    doc = np.concatenate([doc, few])
    order = np.argsort(doc, kind="stable")
    return np.concatenate([out, short])[order], doc[order]


def list_column(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and each row's count."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
