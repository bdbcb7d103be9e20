"""Vectorised tokenising and hashing of whole Arrow text columns.

A batch of texts is one UTF-8 buffer with offsets, so word borders, word
hashes and rolling window hashes come from a few numpy passes over the bytes
instead of a Python loop over words.  Word hashes are 64-bit polynomials over
a random byte table, finalised by a mixer; window hashes are polynomials over
word hashes.  Everything is deterministic across processes and machines.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Bytes of text that one vectorised pass handles; a longer single text takes several.
BLOCK_BYTES = 2 << 20

_BYTE_TABLE = np.random.default_rng(20240611).integers(1, 2**63, 256, dtype=np.uint64) | U64(1)
_WORD_BASE = 0x9E3779B97F4A7C15
_LEN_SALT = U64(0xD6E8FEB86659FD93)

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"


def _lut(members) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


#: Bytes of words `[^\x20\x09-\x0D]+`.
BLANK_SEPARATED = ~_lut(SPACES)
#: Bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z.
ALNUM_WORDS = _lut([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, after whose last batch a Python worker (which Spark uses again) gives free memory back."""

    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # only the GNU C library has it
                ctypes.CDLL(None).malloc_trim(0)

    return tidied


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply) over a uint64 array."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@dataclass
class Words:
    """Words of a run of texts: byte spans, the text each word is of, and hashes."""

    data: np.ndarray
    texts: np.ndarray  # byte offsets of the texts, one more than texts
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # index of each text's first word, one more than texts
    hashes: np.ndarray

    @property
    def n_texts(self) -> int:
        return len(self.texts) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_texts), self.counts())


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The column as strings without nulls (null: empty)."""
    col = batch.column(batch.schema.get_field_index(name))
    if not pa.types.is_string(col.type) and not pa.types.is_large_string(col.type):
        col = col.cast(pa.string())
    return pc.fill_null(col, "") if col.null_count else col


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string array, without copying."""
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    at = np.frombuffer(offsets, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(at: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most `limit` bytes together (or one longer text)."""
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def _runs(data: np.ndarray, borders: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the maximal runs of member bytes; none crosses a border."""
    n = len(data)
    inside = members[data]
    borders = borders[(borders > 0) & (borders < n)]
    edge = np.empty(n + 1, bool)
    edge[0], edge[n] = True, True
    edge[1:n] = ~inside[:-1] | ~inside[1:]
    edge[borders] = True
    starts = np.flatnonzero(inside & edge[:-1])
    ends = np.flatnonzero(inside & edge[1:]) + 1
    if not len(starts):
        return starts, ends, np.zeros(0, np.uint64)
    length = ends - starts
    place = np.arange(n) - np.repeat(np.append(0, starts), np.diff(np.concatenate(([0], starts, [n]))))
    place[~inside] = 0
    values = _BYTE_TABLE[data] * powers(_WORD_BASE, int(length.max()))[place]
    values[~inside] = 0
    return starts, ends, mix64(np.add.reduceat(values, starts) + length.astype(np.uint64) * _LEN_SALT)


def word_cuts(data: np.ndarray, members: np.ndarray, limit: int) -> list[int]:
    """Places about `limit` bytes apart at which no word is cut (a longer word stays whole)."""
    cuts, at, n = [0], limit, len(data)
    while at < n:
        while at < n:
            free = np.flatnonzero(~members[data[at : at + 65536]])
            if len(free):
                at += int(free[0])
                break
            at += 65536
        cuts.append(min(at, n))
        at = cuts[-1] + limit
    return cuts if cuts[-1] == n else [*cuts, n]


def tokenise(data: np.ndarray, texts: np.ndarray, members: np.ndarray = BLANK_SEPARATED, lower: bool = False, limit: int = BLOCK_BYTES) -> Words:
    """Words (maximal runs of member bytes inside one text) and their hashes.

    Works through the bytes in pieces cut between words, so that beyond the
    words' places and hashes (some four times the bytes) little grows with them.
    """
    if lower:
        data = _LOWER[data]
    parts = []
    for a, b in zip(cuts := word_cuts(data, members, limit), cuts[1:], strict=False):
        near = texts[np.searchsorted(texts, a) : np.searchsorted(texts, b, "right")]
        starts, ends, hashes = _runs(data[a:b], near - a, members)
        parts.append((starts + a, ends + a, hashes))
    if len(parts) == 1:
        starts, ends, hashes = parts[0]
    else:
        kinds = (np.int64, np.int64, np.uint64)
        starts, ends, hashes = (np.concatenate([np.zeros(0, t), *(p[i] for p in parts)]) for i, t in enumerate(kinds))
    return Words(data, texts, starts, ends, np.searchsorted(starts, texts), hashes)


def words_of(col: pa.Array, members: np.ndarray = BLANK_SEPARATED, lower: bool = False) -> Iterator[tuple[int, Words]]:
    """(index of the first text, Words) for consecutive pieces of a text column."""
    data, at = buffers(col)
    for lo, hi in pieces(at):
        part = at[lo : hi + 1]
        yield lo, tokenise(data[part[0] : part[-1]], part - part[0], members, lower)


def rolling(hashes: np.ndarray, n: int, base: int) -> np.ndarray:
    """Polynomial hash of every run of n values (no mixing, borders ignored)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for j in range(n):
        out *= U64(base)
        out += hashes[j : j + m]
    return out


def window_index(words: Words, n: int) -> np.ndarray:
    """Indexes of words that start a run of n words of one text."""
    count = words.counts()
    k = np.maximum(count - n + 1, 0)
    total = int(k.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(words.first[:-1] - (np.cumsum(k) - k), k)
    return np.arange(total) + shift


def covered(n_words: int, starts: np.ndarray, n: int | np.ndarray) -> np.ndarray:
    """Flags of the words inside any run of n words that begins at one of starts."""
    step = np.zeros(n_words + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + n, -1)
    return np.cumsum(step[:-1]) > 0


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values over [first[i], first[i + 1]) for each i."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[first[1:]] - total[first[:-1]]
