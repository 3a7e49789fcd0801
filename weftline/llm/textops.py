"""Words of whole texts as numpy arrays, many documents at once, inside Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from weftline.llm.common import ship

#: Texts are worked on in pieces of about this many bytes; a longer text is its own piece.
PIECE_BYTES = 1 << 20
#: The same for work whose arrays are many times a text's size, several workers an executor.
SMALL_PIECE = 1 << 18

_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finalizer of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * _BASE)
_INVERSES = {int(b): np.uint64(pow(int(b), -1, 1 << 64)) for b in (_BASE, _STEP)}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base ** 0 .. n - 1``; one array of each base is kept, as long as a usual piece needs."""
    if n > 2 * PIECE_BYTES:
        return _powers(base, n)
    kept = _POWERS.get(int(base))
    if kept is None or len(kept) < n:
        kept = _POWERS[int(base)] = _powers(base, 1 << max(16, int(n - 1).bit_length()))
    return kept[:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
    """Hash of ``values[s:e]`` for each span, from one running sum of a polynomial."""
    n = len(values)
    run = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(base, n), out=run[1:])
    raw = (run[ends] - run[starts]) * powers(_INVERSES[int(base)], n + 1)[starts]
    return mix64(raw + (ends - starts).astype(np.uint64) * _STEP)


@dataclass
class Piece:
    """Some documents: ``rows`` of the batch, their bytes, and where their words lie.

    Document i has the bytes ``offsets[i]:offsets[i + 1]`` and the words
    ``first[i]:first[i + 1]``.
    """

    rows: slice
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def word_hashes(self) -> np.ndarray:
        return span_hashes(_BYTE_VALUE[self.data], self.starts, self.ends, _BASE)


def sequence_hashes(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of each document's sequence of words."""
    return span_hashes(words, first[:-1], first[1:], _STEP)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on; the last n - 1 have none."""
    size = max(0, len(words) - n + 1)
    out = np.zeros(size, np.uint64)
    for k in range(n):
        out = out * _STEP + words[k : k + size]
    return mix64(out)


def find_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and each document's first word; words end with a text."""
    inside = ~_IS_BLANK[data]
    begin, finish = inside.copy(), inside.copy()
    if len(data):
        begin[1:] &= ~inside[:-1]
        finish[:-1] &= ~inside[1:]
        at = offsets[:-1][offsets[:-1] < offsets[1:]]
        begin[at] = inside[at]
        last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        finish[last] = inside[last]
    starts = np.flatnonzero(begin)
    ends = np.flatnonzero(finish) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return at, np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)


def release_memory() -> None:
    """Give freed memory back, which Arrow's pool and the C library else keep in every worker."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    if trim:
        trim(0)


def tidy(run):
    """``run`` over the batches of a task; what it kept goes back when the task ends, as idle
    workers stay in an executor."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        _POWERS.clear()
        release_memory()

    return tidied


def pieces(column: pa.Array, lower: bool = False, size: int = PIECE_BYTES) -> Iterator[Piece]:
    """Cut a batch's texts into pieces of about ``size`` bytes and find their words."""
    offsets, data = text_buffers(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1
        j = min(n, max(j, i + 1))
        part = data[offsets[i] : offsets[j]]
        if lower:
            part = LOWER[part]
        local = offsets[i : j + 1] - offsets[i]
        yield Piece(slice(i, j), part, local, *find_words(part, local))
        i = j
    release_memory()


def sums(mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Number of set bytes in each span."""
    run = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=run[1:])
    return run[ends] - run[starts]


def per_document(first: np.ndarray) -> np.ndarray:
    """Document number of each item, from the documents' first items."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def repeated_words(words: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """Per word, whether it is in an n-word window that its document holds twice or more."""
    doc = per_document(first)
    covered = np.zeros(len(words) + 1, np.int64)
    grams = ngram_hashes(words, n)
    at = np.flatnonzero(doc[: len(grams)] == doc[n - 1 : n - 1 + len(grams)])
    if len(at):
        own = grams[at] ^ mix64(doc[at].astype(np.uint64) + np.uint64(1))
        _, inverse, times = np.unique(own, return_inverse=True, return_counts=True)
        again = at[times[inverse] > 1]
        np.add.at(covered, again, 1)
        np.add.at(covered, again + n, -1)
    return np.cumsum(covered)[:-1] > 0


@dataclass
class Lines:
    """The lines of a piece: byte spans without line feeds, each document's first line, and
    each line's first word."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    word: np.ndarray

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.word)


def find_lines(piece: Piece) -> Lines:
    """Every document has one line more than line feeds; an empty one has an empty line."""
    breaks = np.flatnonzero(piece.data == 10)
    before = np.searchsorted(breaks, piece.offsets)
    first = before + np.arange(len(piece) + 1)
    n = len(breaks) + len(piece)
    starts, ends = np.zeros(n, np.int64), np.zeros(n, np.int64)
    of_break = np.arange(len(breaks)) + np.searchsorted(piece.offsets, breaks, "right") - 1
    starts[first[:-1]] = piece.offsets[:-1]
    starts[of_break + 1] = breaks + 1
    ends[first[1:] - 1] = piece.offsets[1:]
    ends[of_break] = breaks
    return Lines(starts, ends, first, np.searchsorted(piece.starts, np.r_[starts, len(piece.data)]))


def repeated_lines(piece: Piece, lines: Lines) -> np.ndarray:
    """Per line, whether it has a word and equals an earlier line of its document."""
    again = np.zeros(len(lines.starts), bool)
    at = np.flatnonzero(lines.n_words > 0)
    if len(at):
        own = span_hashes(_BYTE_VALUE[piece.data], lines.starts[at], lines.ends[at], _BASE)
        own = own ^ mix64(per_document(lines.first)[at].astype(np.uint64) + np.uint64(1))
        _, earliest = np.unique(own, return_index=True)
        again[at] = True
        again[at[earliest]] = False
    return again


def distinct_words(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Number of different words of each span of words."""
    doc = per_document(first)
    _, at = np.unique(words ^ mix64(doc.astype(np.uint64) + np.uint64(1)), return_index=True)
    return np.bincount(doc[at], minlength=len(first) - 1)


ship(__name__)
