"""Words and hashes of whole Arrow string columns, vectorised over UTF-8 bytes.

A batch is taken apart in blocks of whole texts of about ``BLOCK_BYTES`` bytes, so
memory is a small multiple of the block (or of the one text larger than it),
whatever the number of rows.  Word separators and A-Z are ASCII and continuation
bytes of UTF-8 are not, so working on bytes gives the same words as working on
code points.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

_POSITIONS = 64
#: one random word for each (position in the word, byte): a word's hash is the sum of its bytes' values
_ZOBRIST = np.random.default_rng(20240611).integers(0, 2**64, size=(_POSITIONS * 256,), dtype=np.uint64)
_MULTIPLIERS = np.random.default_rng(77).integers(0, 2**63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (uint64 -> uint64, a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def release_memory() -> None:
    """Gives freed memory back to the system: Python workers stay, idle, beside the JVM between stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not the GNU C library
        ctypes.CDLL(None).malloc_trim(0)


def releasing(run):
    """The Arrow function ``run``, releasing memory when its task ends."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return wrapped


def releasing_groups(run):
    """The function ``run`` of a key and its group's table, releasing memory after every group."""

    def wrapped(key: tuple, table: pa.Table) -> pa.Table:
        try:
            return run(key, table)
        finally:
            release_memory()

    return wrapped


def text_blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive texts; a null text has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + block_bytes, side="right")) - 1
        last = min(max(last, first + 1), n, first + 60_000)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


class Words:
    """The words of a block: bounds in the (lower-cased) bytes, owner text, counts per text."""

    __slots__ = ("data", "starts", "ends", "doc", "counts", "n_docs")

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> None:
        self.n_docs = len(offsets) - 1
        self.data = _LOWER[data] if lower else data
        space = _SPACE[data]
        before = np.ones(len(data), dtype=bool)
        after = np.ones(len(data), dtype=bool)
        if len(data):
            before[1:] = space[:-1]
            after[:-1] = space[1:]
            inner = offsets[(offsets > 0) & (offsets < len(data))]
            before[inner] = True
            after[inner - 1] = True
        word = ~space
        self.starts = np.flatnonzero(word & before)
        self.ends = np.flatnonzero(word & after) + 1
        bounds = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(bounds)
        self.doc = np.repeat(np.arange(self.n_docs), self.counts)

    def hashes(self) -> np.ndarray:
        """64-bit hash of every word."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        lengths = self.ends - self.starts
        firsts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        position = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(firsts, lengths)
        letters = self.data[position + np.repeat(self.starts, lengths)]
        values = _ZOBRIST[((position & (_POSITIONS - 1)) << 8) | letters]
        if lengths.max() > _POSITIONS:
            turn = (position >> 6).astype(np.uint64)
            values = np.where(turn > 0, mix(values + turn), values)
        return mix(np.add.reduceat(values, firsts))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive word hashes (order matters)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(width):
        total += words[i : i + n] * _MULTIPLIERS[i]
    return mix(total)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, shingle hash) sorted and distinct per text, and the set size of each text.

    A text of fewer words than ``width``, but not none, has its whole sequence as
    its one shingle.
    """
    words = Words(data, offsets)
    h = words.hashes()
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(words.n_docs, np.int64)
    long = window_hashes(h, width)
    same = words.doc[: len(long)] == words.doc[width - 1 : width - 1 + len(long)]
    doc, value = words.doc[: len(long)][same], long[same]
    short = np.flatnonzero((words.counts > 0) & (words.counts < width))
    if len(short):
        first = np.concatenate(([0], np.cumsum(words.counts)[:-1]))
        extra = np.empty(len(short), np.uint64)
        for k, d in enumerate(short):
            run = h[first[d] : first[d] + words.counts[d]]
            extra[k] = mix((run * _MULTIPLIERS[: len(run)]).sum(keepdims=True) + np.uint64(len(run)))[0]
        doc, value = np.concatenate((doc, short)), np.concatenate((value, extra))
    order = np.argsort(value)
    order = order[np.argsort(doc[order].astype(np.uint16), kind="stable")]
    doc, value = doc[order], value[order]
    keep = np.ones(len(doc), dtype=bool)
    keep[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    doc, value = doc[keep], value[keep]
    return doc, value, np.bincount(doc, minlength=words.n_docs)
