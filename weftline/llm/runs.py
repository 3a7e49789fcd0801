"""Periodic runs of words, found by block convolution at dyadic scales.

A run is a stretch of words with smallest period q (words q apart are equal), at least
``max(least, times * q)`` words long (``times`` 3 or more), that no neighbour extends. Its
scale is the power of two L with ``L <= q < 2 * L``. Such a run holds a whole block of L words,
aligned to L, that occurs again q words later. So at each scale every block is held against the
words after it: an exact integer number-theoretic transform gives the sums of squared
differences at the distances L to 2 * L - 1, and a sum of zero is a seed. Seeds of neighbouring
blocks with one distance are one stretch, which is extended both ways word by word.

Two exact tests spare transforms: a block with a word that does not come again within
2 * L - 1 words has no seed, and a block whose whole window lies in a known run of period at
most L has only multiples of that period.

Texts of a batch are worked on together; equal words of different texts are different numbers,
so that nothing crosses a text's end. Everything happens inside one row's text: no shuffle.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import ship
from weftline.llm.textops import Piece, mix64, per_document, pieces

#: Primes with a primitive root; each has roots of unity of order 2 ** 25 at least.
PRIMES = ((2013265921, 31), (469762049, 3), (167772161, 3))
#: Numbers that are transformed together.
AT_ONCE = 1 << 19
_NEVER = np.int64(1) << 62

_ROOTS: dict[tuple[int, int], np.ndarray] = {}


def _roots(prime: int, generator: int, size: int) -> np.ndarray:
    """The first half of the powers of a root of unity of order ``size``."""
    key = (prime, size)
    if key not in _ROOTS:
        root = pow(generator, (prime - 1) // size, prime)
        out = np.ones(max(1, size // 2), np.uint64)
        step = 1
        while step < len(out):
            more = pow(root, step, prime)
            out[step : 2 * step] = out[:step] * np.uint64(more) % np.uint64(prime)
            step *= 2
        if size > 1 << 16:
            return out
        _ROOTS[key] = out
    return _ROOTS[key]


def ntt(rows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Transform of each row modulo ``prime``, in bit-reversed order (a power of two long)."""
    n, size = rows.shape
    p = np.uint64(prime)
    width = size
    while width > 1:
        half = width // 2
        cut = rows.reshape(n, size // width, 2, half)
        a, b = cut[:, :, 0], cut[:, :, 1]
        out = np.empty_like(cut)
        out[:, :, 0] = a + b
        np.subtract(out[:, :, 0], p, out=out[:, :, 0], where=out[:, :, 0] >= p)
        out[:, :, 1] = (a + (p - b)) * _roots(prime, generator, width) % p
        rows = out.reshape(n, size)
        width = half
    return rows


def inverse_ntt(rows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """What :func:`ntt` was given, from bit-reversed order."""
    n, size = rows.shape
    p = np.uint64(prime)
    width = 2
    while width <= size:
        half = width // 2
        cut = rows.reshape(n, size // width, 2, half)
        a = cut[:, :, 0]
        # Powers of the inverse root: r ** -k is -r ** (half - k).
        roots = _roots(prime, generator, width)
        back = np.empty_like(roots)
        back[0] = 1
        back[1:] = p - roots[:0:-1]
        b = cut[:, :, 1] * back % p
        out = np.empty_like(cut)
        out[:, :, 0] = a + b
        np.subtract(out[:, :, 0], p, out=out[:, :, 0], where=out[:, :, 0] >= p)
        out[:, :, 1] = a + (p - b)
        np.subtract(out[:, :, 1], p, out=out[:, :, 1], where=out[:, :, 1] >= p)
        rows = out.reshape(n, size)
        width *= 2
    return rows * np.uint64(pow(size, -1, prime)) % p


def block_seeds(ids: np.ndarray, blocks: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Zero-mismatch occurrences of the blocks ``ids[b:b + size]`` at ``size`` to
    ``2 * size - 1`` words behind them: (begin of the block, distance).

    The sum of squared differences is taken modulo as many primes as it needs to be exact.
    """
    if not len(blocks):
        return blocks, blocks
    least = int(ids.min())
    most = int(ids.max()) - least
    bound, primes = 1, []
    for prime in PRIMES:
        if bound <= size * (most + 1) ** 2:
            primes.append(prime)
            bound *= prime[0]
    if bound <= size * (most + 1) ** 2:
        raise ValueError("a text has too many different words for an exact transform")
    at_once = max(1, AT_ONCE // (2 * size))
    begins, distances = [], []
    lane = np.arange(size)
    for k in range(0, len(blocks), at_once):
        at = blocks[k : k + at_once]
        block = (ids[at[:, None] + lane] - least).astype(np.uint64)
        place = at[:, None] + size + np.arange(2 * size)
        inside = place < len(ids)
        # Numbers behind the end are beyond all others, so nothing there is equal.
        window = np.where(inside, ids[np.minimum(place, len(ids) - 1)] - least, most + 1)
        window = window.astype(np.uint64)
        zero = np.ones((len(at), size), bool)
        for prime, generator in primes:
            p = np.uint64(prime)
            b, w = block % p, window % p
            turned = np.zeros((len(at), 2 * size), np.uint64)
            turned[:, :size] = b[:, ::-1]
            product = ntt(turned, prime, generator) * ntt(w, prime, generator) % p
            cross = inverse_ntt(product, prime, generator)[:, size - 1 : 2 * size - 1]
            squares = np.zeros((len(at), 2 * size + 1), np.uint64)
            np.cumsum(w * w % p, axis=1, out=squares[:, 1:])
            ends = (squares[:, size : 2 * size] - squares[:, :size]) % p
            own = (b * b % p).sum(axis=1, keepdims=True) % p
            zero &= (ends + own) % p == 2 * cross % p
        row, d = np.nonzero(zero)
        begins.append(at[row])
        distances.append(d + size)
    return np.concatenate(begins), np.concatenate(distances)


def _extend(ids: np.ndarray, at: np.ndarray, distance: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``at`` on (``step`` 1 or -1) equal the word ``distance`` later."""
    out = np.zeros(len(at), np.int64)
    active = np.arange(len(at))
    width = 16
    while len(active):
        left = []
        for k in range(0, len(active), max(1, AT_ONCE // width)):
            part = active[k : k + max(1, AT_ONCE // width)]
            place = (at[part] + step * out[part])[:, None] + step * np.arange(width)
            other = place + distance[part][:, None]
            good = (place >= 0) & (other < len(ids))
            place = np.clip(place, 0, len(ids) - 1)
            other = np.minimum(np.maximum(other, 0), len(ids) - 1)
            good &= ids[place] == ids[other]
            whole = good.all(axis=1)
            out[part] += np.where(whole, width, good.argmin(axis=1))
            left.append(part[whole])
        active = np.concatenate(left)
        width = min(2 * width, AT_ONCE)
    return out


def word_numbers(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words, equal only for equal words of one text, and how far on each word
    comes again."""
    doc = per_document(first)
    own = hashes ^ mix64(doc.astype(np.uint64) + np.uint64(1))
    order = np.argsort(own, kind="stable")
    ranked = own[order]
    same = ranked[1:] == ranked[:-1]
    ids = np.empty(len(own), np.int64)
    if len(own):
        ids[order] = np.cumsum(np.r_[0, ~same])
    again = np.full(len(own), _NEVER)
    again[order[:-1][same]] = np.diff(order)[same]
    return ids, again


def find_runs(
    ids: np.ndarray, again: np.ndarray, first: np.ndarray, least: int = 24, times: int = 3
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and smallest period of all runs, by begin, then period."""
    if times < 3:
        raise ValueError("times must be 3 or more")
    n = len(ids)
    longest = int(np.diff(first).max(initial=0))
    found = {}
    size, far = 1, again
    # For each word the furthest end of a known run that holds it.
    cover = np.zeros(n + 1, np.int64)
    text_end = np.repeat(first[1:], np.diff(first))
    while times * size <= longest:
        blocks = np.flatnonzero(far <= 2 * size - 1) * size
        blocks = blocks[blocks + 2 * size <= n]
        if len(blocks):
            window = np.minimum(blocks + 3 * size - 1, text_end[blocks])
            blocks = blocks[cover[blocks] < window]
        begin, d = block_seeds(ids, blocks, size)
        if len(begin):
            order = np.lexsort((begin, d))
            begin, d = begin[order], d[order]
            head = np.r_[True, (d[1:] != d[:-1]) | (begin[1:] != begin[:-1] + size)]
            tail = np.r_[head[1:], True]
            a, b, d = begin[head], begin[tail] + size, d[head]
            a = a - _extend(ids, a - 1, d, -1)
            b = b + _extend(ids, b, d, 1) + d
            good = b - a >= np.maximum(least, times * d)
            for s, e, q in zip(a[good].tolist(), b[good].tolist(), d[good].tolist(), strict=True):
                # A stretch known with a smaller period divides this one.
                if found.setdefault((s, e), q) >= q:
                    found[s, e] = q
                    cover[s:e] = np.maximum(cover[s:e], e)
        # The furthest return of any word in a block of twice the size; a torn one has none.
        far = far[: len(far) // 2 * 2].reshape(-1, 2).max(axis=1)
        size *= 2
    runs = sorted((s, q, e) for (s, e), q in found.items())
    out = np.array(runs, np.int64).reshape(-1, 3)
    return out[:, 0], out[:, 2], out[:, 1]


@dataclass
class DocumentRuns:
    """A piece's words after an own choice of words, and its runs as places among them."""

    piece: Piece
    source: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    period: np.ndarray

    def kept(self) -> np.ndarray:
        """Per word, whether no run has it after its first period."""
        gone = np.zeros(len(self.source) + 1, np.int64)
        np.add.at(gone, self.begin + self.period, 1)
        np.add.at(gone, self.end, -1)
        return np.cumsum(gone)[:-1] == 0

    def joined(self, keep: np.ndarray) -> Iterator[memoryview]:
        """Each text's kept words, joined by one blank."""
        at = self.source[keep]
        starts, sizes = self.piece.starts[at], self.piece.ends[at] - self.piece.starts[at]
        place = np.cumsum(np.r_[0, sizes + 1])
        out = np.full(place[-1], 0x20, np.uint8)
        move = np.repeat(starts - place[:-1], sizes)
        target = np.arange(len(move)) + np.repeat(np.arange(len(at)), sizes)
        out[target] = self.piece.data[target + move]
        edges = place[np.cumsum(np.r_[0, keep])[self.piece.first]]
        view = memoryview(out)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            yield view[a : max(a, b - 1)]


def runs_of_piece(
    piece: Piece, source: np.ndarray | None = None, least: int = 24, times: int = 3
) -> DocumentRuns:
    """Runs of a piece's texts; ``source`` puts another word of the piece in a word's place."""
    hashes = piece.word_hashes()
    if source is None:
        source = np.arange(len(hashes))
    ids, again = word_numbers(hashes[source], piece.first)
    return DocumentRuns(piece, source, *find_runs(ids, again, piece.first, least, times))


def planted(doc_ids: list[int | None], first: np.ndarray) -> np.ndarray:
    """The contract's damage: which word stands in each word's place.

    Every tenth document by its checksum gets a periodic tail; a null id gets none.
    """
    source = np.arange(first[-1])
    for k, doc_id in enumerate(doc_ids):
        n = int(first[k + 1] - first[k])
        if doc_id is None or not n:
            continue
        h = zlib.crc32(str(doc_id).encode())
        if h % 10:
            continue
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        tail = source[first[k] + a : first[k + 1]]
        tail[:] = first[k] + a + np.arange(n - a) % p
    return source


def _found(least: int, times: int):
    """Batches of (place, text) to (place, runs, collapsed text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(1)):
                done = runs_of_piece(piece, None, least, times)
                at = np.searchsorted(done.begin, piece.first)
                doc = np.searchsorted(piece.first, done.begin, "right") - 1
                parts = [done.begin - piece.first[doc], done.end - done.begin, done.period]
                structs = pa.StructArray.from_arrays(
                    [pa.array(x) for x in parts], ["start", "length", "period"]
                )
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), structs)
                texts = pa.array([bytes(x).decode() for x in done.joined(done.kept())], pa.string())
                yield pa.record_batch(
                    [batch.column(0).slice(piece.rows.start, len(piece)), lists, texts],
                    names=["row", "runs", "collapsed"],
                )

    return run


def periodic_runs(
    df: DataFrame, text: str = "text", least: int = 24, times: int = 3
) -> DataFrame:
    """Each row as ``row`` (all input columns, so that no name clashes) with ``runs``, an array
    of (start, length, period) in words by start, then period, and ``collapsed``, its words
    without those that a run repeats, joined by one blank.

    A null, empty or blank text has no runs and collapses to an empty text. Repeated rows are
    rows each. A run has ``max(least, times * period)`` words at least.
    """
    rows = df.select(F.struct("*").alias("row"), F.col(text).cast("string").alias("text"))
    none = F.lit(None).cast("array<struct<start:bigint,length:bigint,period:bigint>>")
    schema = rows.select("row", none.alias("runs"), F.col("text").alias("collapsed")).schema
    return rows.mapInArrow(_found(least, times), schema)


_DIGEST = pa.schema(
    [("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
     ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()),
     ("collapsed_sha256", pa.string())]
)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc_ids = batch.column(0).to_pylist()
        for piece in pieces(batch.column(1)):
            done = runs_of_piece(piece, planted(doc_ids[piece.rows], piece.first))
            at = np.searchsorted(done.begin, piece.first)
            texts = done.joined(done.kept())
            rows = []
            for k, doc_id in enumerate(doc_ids[piece.rows]):
                here = slice(at[k], at[k + 1])
                begin = (done.begin[here] - piece.first[k]).tolist()
                length = (done.end[here] - done.begin[here]).tolist()
                found = list(zip(begin, length, done.period[here].tolist(), strict=True))
                listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
                best = (None, None, None, None)
                if found:
                    s, n, q = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
                    best = (s, n, q, 1000 * n // q)
                rows.append(
                    (doc_id, len(found), *best, hashlib.sha256(listed.encode()).hexdigest(),
                     hashlib.sha256(next(texts)).hexdigest())
                )
            columns = zip(*rows, strict=True)
            yield pa.record_batch(
                [pa.array(c, f.type) for c, f in zip(columns, _DIGEST, strict=True)], schema=_DIGEST
            )


def run_digest(docs: DataFrame) -> DataFrame:
    """The contract's row per document: its runs after the planted damage, as digests.

    ``doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256``;
    the four of the run with the greatest exponent are null where there is no run. Null, empty
    and blank texts have no words; a null doc_id is not damaged; repeated rows are rows each.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    schema = (
        "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
        "runs_sha256 string, collapsed_sha256 string"
    )
    return rows.mapInArrow(_digests, schema)


ship(__name__)
