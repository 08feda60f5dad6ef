"""Numpy helpers used inside Arrow tasks: whole texts of a batch as one byte array, words as hash numbers."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_RNG = np.random.RandomState(20240501)
_BYTE = _RNG.randint(1, 1 << 62, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of 256 truth values, true inside the given inclusive ranges."""
    table = np.zeros(256, bool)
    for lo, hi in ranges:
        table[lo : hi + 1] = True
    return table


# The words of the contracts are runs of bytes outside these ranges.
NOT_SPACE = ~byte_set((0x20, 0x20), (0x09, 0x0D))
NOT_NEWLINE = ~byte_set((0x0A, 0x0A))


def per_process(owner: str, key, build: Callable[[], object]):
    """A value of the operator ``owner`` that is built once per worker process.

    Functions sent to workers by value have no module globals that outlive a task, so the value hangs on ``sys``. Worker processes
    serve many operators one after the other, so a task of one operator lets go of the values of all others.
    """
    store = sys.__dict__.setdefault("_corpusmill_values", {})
    release(owner)
    values = store.setdefault(owner, {})
    if key not in values:
        values[key] = build()
    return values[key]


def release(owner: str | None = None) -> None:
    """Let go of the values that earlier tasks of this process built, but for those of ``owner``.

    Tasks of operators that hold none call it too, so that memory does not pile up from one stage of a job to the next.
    """
    store = sys.__dict__.get("_corpusmill_values", {})
    others = [name for name in store if name != owner]
    for other in others:
        del store[other]
    if others:
        trim()


def task(owner: str | None = None):
    """Decorator of a task's generator: values of other operators go before it, and unused memory goes back to the system after it."""

    def wrap(run):
        def tidy(batches):
            release(owner)
            try:
                yield from run(batches)
            finally:
                trim()

        return tidy

    return wrap


def trim() -> None:
    """Give freed memory back to the system: worker processes live on, and the allocators would keep it for their next task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offset of each; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of whole texts of about ``limit`` bytes: (first row, bytes, offsets)."""
    raw, at = texts_of(column)
    row, n = 0, len(at) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(at, at[row] + limit, "right")) - 1)
        yield row, raw[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans(raw: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes that ``inside`` admits, never across texts: starts, ends, index of the text."""
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, none
    word = inside[raw]
    first = np.zeros(len(raw) + 1, bool)
    first[at] = True
    before = np.empty_like(word)
    before[0] = False
    before[1:] = word[:-1]
    before[first[:-1]] = False
    after = np.empty_like(word)
    after[-1] = False
    after[:-1] = word[1:]
    after[first[1:]] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """64-bit hash of each run of bytes; ``fold`` reads A-Z as a-z."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    table = _BYTE.copy()
    if fold:
        table[65:91] = table[97:123]
    sizes = ends - starts
    heads = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    place = np.arange(int(sizes.sum())) - np.repeat(heads, sizes)
    powers = np.full(int(sizes.max()), _BASE, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    values = table[raw[place + np.repeat(starts, sizes)]] * powers[place]
    return mix(np.add.reduceat(values, heads) + sizes.astype(np.uint64))


def shingles(words: np.ndarray, row: np.ndarray, n_rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of ``size`` consecutive words of each text, ordered by text and hash.

    A text of fewer words has its whole sequence as its only shingle, one without words has none.
    """
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    powers = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(size - 1, _STEP, np.uint64))))
    last = n - size + 1
    found, owner = [], []
    if last > 0:
        whole = row[:last] == row[size - 1 :]
        value = np.zeros(last, np.uint64)
        for j in range(size):
            value += words[j : j + last] * powers[j]
        found.append(value[whole])
        owner.append(row[:last][whole])
    counts = np.bincount(row, minlength=n_rows)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        begin = np.searchsorted(row, short)
        value = np.zeros(len(short), np.uint64)
        for j in range(size - 1):
            there = counts[short] > j
            value[there] += words[begin[there] + j] * powers[j]
        found.append(value + counts[short].astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
        owner.append(short)
    value, row = mix(np.concatenate(found)), np.concatenate(owner)
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    return value[new], row[new]
