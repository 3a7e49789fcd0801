"""Line labelling by a linear-chain conditional random field.

Each line of a text is content or boilerplate. Line statistics score both labels, a
transition score joins neighbouring lines, and Viterbi decoding finds the best labelling of
the whole text; all texts of a batch advance together, line by line. A document is kept when
the share of its words in content lines reaches a bound and the base rules hold.

Weights are learned from a bounded sample of documents with quality labels: first a logistic
model says which lines of the poor documents look poor, then the field is fitted to these
line labels by gradient ascent on its log-likelihood.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import ship
from weftline.llm.quality_trees import held_out
from weftline.llm.textops import (
    Lines,
    Piece,
    distinct_words,
    find_lines,
    pieces,
    repeated_lines,
    repeated_words,
    sums,
)

#: Documents the field is fitted on, at most, of each quality; those with the smallest hash.
SAMPLE = 1_000
#: Lines the field is fitted on, at most, of each quality: whole chunks, those with the smallest
#: hash.
SAMPLE_LINES = 128_000
#: Training sequences are cut to this many lines.
CHUNK = 64
#: Least share of words in content lines.
CONTENT_SHARE = 0.5
#: Base rules: fewest words, and the largest percentage of words in repeated 5-word windows.
LEAST_WORDS = 10
REPEATED_PERCENT = 20

LINE_FEATURES = (
    "one", "log_words", "log_word_bytes", "upper", "digit", "symbol", "mark", "marked_words",
    "upper_words", "sentence_end", "upper_start", "distinct", "repeated", "empty",
)


def _bytes(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_UPPER = _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _bytes("0123456789")
_SYMBOL = _bytes("#*$%&|<>")
_MARK = _bytes("!?~^_=+@\\/{}[]()")
_END = _bytes(".!?:;\"'")
_FIRST_BYTE = (np.arange(256) & 0xC0) != 0x80


def line_features(piece: Piece, lines: Lines, again: np.ndarray, words: np.ndarray) -> np.ndarray:
    """A row of statistics per line."""
    data = piece.data
    n_words = lines.n_words
    some = np.maximum(n_words, 1)
    length = sums(~_bytes(" \t\r\n\x0b\x0c")[data], lines.starts, lines.ends)
    size = np.maximum(length, 1)
    word_size = piece.ends - piece.starts
    upper = sums(_UPPER[data], piece.starts, piece.ends)
    marks = sums((_SYMBOL | _MARK)[data], piece.starts, piece.ends)

    def share(table: np.ndarray) -> np.ndarray:
        return sums(table[data], lines.starts, lines.ends) / size

    def of_words(mask: np.ndarray) -> np.ndarray:
        return sums(mask, lines.word[:-1], lines.word[1:]) / some

    full = n_words > 0
    ends, starts = np.zeros(len(full), bool), np.zeros(len(full), bool)
    if len(piece.ends):
        ends[full] = _END[data[piece.ends[lines.word[1:][full] - 1] - 1]]
        starts[full] = _UPPER[data[piece.starts[lines.word[:-1][full]]]]
    return np.column_stack(
        [
            np.ones(len(full)),
            np.log1p(n_words),
            np.log1p(length / some),
            share(_UPPER),
            share(_DIGIT),
            share(_SYMBOL),
            share(_MARK),
            of_words(marks > 0),
            of_words((upper >= 2) & (2 * upper > word_size)),
            ends,
            starts,
            distinct_words(words, lines.word) / some,
            again,
            ~full,
        ]
    )


# ---------------------------------------------------------------- the field


@dataclass
class Field:
    """``emit`` scores content against boilerplate per line; ``move[i, j]`` scores label j
    (1 content) after label i."""

    emit: np.ndarray
    move: np.ndarray

    def decode(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Best labels of the lines ``first[i]:first[i + 1]`` of each text; content wins a tie."""
        score = x @ self.emit
        labels = np.zeros(len(score), bool)
        n = np.diff(first)
        order = np.argsort(-n, kind="stable")
        longest = n[order]
        begin = first[:-1][order]
        # Only the difference of the two labels' best scores decides, now and later.
        ahead = np.zeros(len(n))
        back = np.zeros((len(score), 2), bool)
        (bb, bc), (cb, cc) = self.move
        for t in range(int(longest[0]) if len(n) else 0):
            live = int(np.searchsorted(-longest, -t, "left"))
            at = begin[:live] + t
            if t == 0:
                ahead = score[at]
                continue
            d = ahead[:live]
            # The label before content and before boilerplate, content if it is no worse.
            back[at, 1] = d + cc >= bc
            back[at, 0] = d + cb >= bb
            to_content = np.maximum(d + cc, bc)
            to_boilerplate = np.maximum(d + cb, bb)
            ahead = np.concatenate([score[at] + to_content - to_boilerplate, ahead[live:]])
        current = ahead >= 0
        for t in range(int(longest[0]) - 1 if len(n) else -1, -1, -1):
            live = int(np.searchsorted(-longest, -t, "left"))
            at = begin[:live] + t
            labels[at] = current[:live]
            current[:live] = back[at, current[:live].astype(int)]
        return labels


def _pad(x: np.ndarray, y: np.ndarray, sequences: list[tuple[int, int]]):
    """Sequences as (time, sequence) arrays with a mask."""
    pieces_ = [(a, min(a + CHUNK, b)) for s, b in sequences for a in range(s, b, CHUNK)]
    longest = max((b - a for a, b in pieces_), default=0)
    xs = np.zeros((longest, len(pieces_), x.shape[1]))
    ys = np.zeros((longest, len(pieces_)), int)
    mask = np.zeros((longest, len(pieces_)), bool)
    for k, (a, b) in enumerate(pieces_):
        xs[: b - a, k], ys[: b - a, k], mask[: b - a, k] = x[a:b], y[a:b], True
    return xs, ys, mask


def _soft(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis, keepdims=True))).squeeze(axis)


def _gradient(xs, ys, mask, emit, move):
    """Gradient of the log-likelihood per line, by forward and backward sums."""
    steps, count, _ = xs.shape
    e = np.stack([np.zeros((steps, count)), xs @ emit], 2)
    alpha, beta = np.zeros((steps, count, 2)), np.zeros((steps, count, 2))
    alpha[0] = e[0]
    for t in range(1, steps):
        step = e[t] + _soft(alpha[t - 1][:, :, None] + move, 1)
        alpha[t] = np.where(mask[t][:, None], step, alpha[t - 1])
    for t in range(steps - 2, -1, -1):
        step = _soft(move + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        beta[t] = np.where(mask[t + 1][:, None], step, 0)
    norm = _soft(alpha[-1], 1)
    p = np.exp(alpha[:, :, 1] + beta[:, :, 1] - norm) * mask
    n = max(1, mask.sum())
    d_emit = np.einsum("tsf,ts->f", xs, (ys - p) * mask) / n
    d_move = np.zeros((2, 2))
    if steps > 1:
        both = alpha[:-1, :, :, None] + move + (e[1:] + beta[1:])[:, :, None, :]
        q = np.exp(both - norm[None, :, None, None]) * mask[1:, :, None, None]
        d_move = -q.sum((0, 1))
        np.add.at(d_move, (ys[:-1][mask[1:]], ys[1:][mask[1:]]), 1)
        d_move /= n
    return d_emit, d_move


def fit_field(
    x: np.ndarray, good: np.ndarray, sequences: list[tuple[int, int]], rounds: int = 250
) -> Field:
    """Fit on lines ``x`` whose documents are good (1) or poor (0).

    Without lines of both kinds everything is content.
    """
    n = x.shape[1]
    if len(np.unique(good)) < 2:
        emit = np.zeros(n)
        emit[0] = 1.0
        return Field(emit, np.zeros((2, 2)))
    scale = np.maximum(x.std(0), 1e-3)
    scale[0] = 1.0
    z = x / scale

    def ascend(gradient, size: int, rounds: int) -> np.ndarray:
        """Adam with a small ridge."""
        w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
        for k in range(1, rounds + 1):
            g = gradient(w) - 1e-3 * w
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w += 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
        return w

    each = np.where(good == 1, 0.5 / good.sum(), 0.5 / (len(good) - good.sum()))
    alone = ascend(lambda w: z.T @ (each * (good - 1 / (1 + np.exp(-(z @ w))))), n, rounds)
    y = np.where(good == 1, 1, (z @ alone >= 0).astype(int))
    xs, ys, mask = _pad(z, y, sequences)

    def chain(w: np.ndarray) -> np.ndarray:
        d_emit, d_move = _gradient(xs, ys, mask, w[:n], w[n:].reshape(2, 2))
        return np.concatenate([d_emit, d_move.ravel()])

    w = ascend(chain, n + 4, rounds)
    return Field(w[:n] / scale, w[n:].reshape(2, 2))


# ---------------------------------------------------------------- Spark


def _sample_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, good, chunk, features) of the sample's documents, a row per ``CHUNK`` lines."""
    for batch in batches:
        for piece in pieces(batch.column(2)):
            lines = find_lines(piece)
            x = line_features(piece, lines, repeated_lines(piece, lines), piece.word_hashes())
            size = np.diff(lines.first)
            chunks = -(-size // CHUNK)
            doc = np.repeat(np.arange(len(piece)), chunks)
            chunk = np.arange(len(doc)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
            begin = lines.first[:-1][doc] + chunk * CHUNK
            end = np.minimum(begin + CHUNK, lines.first[1:][doc])
            part = batch.slice(piece.rows.start, len(piece))
            for k in range(0, len(doc), 1_000):
                a, b = begin[k : k + 1_000], end[k : k + 1_000]
                ends = (np.r_[a, b[-1]] - a[0]) * x.shape[1]
                values = pa.array(x[a[0] : b[-1]].ravel())
                take = pa.array(doc[k : k + 1_000])
                yield pa.record_batch(
                    [
                        part.column(0).take(take),
                        part.column(1).take(take),
                        pa.array(chunk[k : k + 1_000].astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values),
                    ],
                    names=["doc_id", "good", "chunk", "features"],
                )


def train(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_lines: int = SAMPLE_LINES
) -> Field:
    """Fit on at most ``sample`` documents of each quality label, and on at most
    ``sample_lines`` of their lines, in whole chunks chosen by hash on the executors.

    Rows whose labels are held out elsewhere are not used. Null labels and ids are no labels.
    """
    known = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("quality").cast("int").alias("good"))
        .where(~held_out(F.col("doc_id")))
    )
    best = [
        known.where(F.col("good") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        for q in (0, 1)
    ]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    chunks = [
        texts.join(ids, "doc_id")
        .select("doc_id", "good", "text")
        .mapInArrow(_sample_chunks, "doc_id long, good int, chunk long, features array<double>")
        .orderBy(F.xxhash64("doc_id", "chunk"), "doc_id", "chunk", "features")
        .limit(sample_lines // CHUNK)
        for ids in best
    ]
    rows = (
        chunks[0]
        .union(chunks[1])
        .orderBy(F.xxhash64("doc_id"), "doc_id", "chunk", "features")
        .toPandas()
    )
    n = len(LINE_FEATURES)
    x = np.concatenate([np.zeros((0, n)), *[np.array(f).reshape(-1, n) for f in rows["features"]]])
    sizes = [len(f) // n for f in rows["features"]]
    ends = np.cumsum([0, *sizes])
    good = np.repeat(rows["good"].to_numpy(int), sizes)
    return fit_field(x, good, list(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)))


OUTPUT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, content_share double"
)


def label_lines(
    docs: DataFrame,
    labels: DataFrame,
    share: float = CONTENT_SHARE,
    sample: int = SAMPLE,
    sample_lines: int = SAMPLE_LINES,
) -> DataFrame:
    """Per document the base counts, ``base_failed``, ``kept`` and ``content_share``.

    A null text counts as empty; a text without words fails the base rules and has share 0.
    Repeated rows get equal results. Without labels all lines are content. ``sample`` and
    ``sample_lines`` bound what the field is fitted on, see :func:`train`; all lines are labelled.
    """
    field = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample, sample_lines))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(1)):
                data, first = piece.data, piece.first
                words = piece.word_hashes()
                n_words = np.diff(first)
                chars = sums(_FIRST_BYTE[data], piece.starts, piece.ends)
                lines = find_lines(piece)
                again = repeated_lines(piece, lines)
                repeated = sums(repeated_words(words, first, 5), first[:-1], first[1:])
                x = line_features(piece, lines, again, words)
                content = field.value.decode(x, lines.first)
                in_content = sums(content * lines.n_words, lines.first[:-1], lines.first[1:])
                part = in_content / np.maximum(n_words, 1)
                failed = (n_words < LEAST_WORDS) | (100 * repeated > REPEATED_PERCENT * n_words)
                columns = [
                    n_words,
                    sums(chars, first[:-1], first[1:]),
                    sums(_SYMBOL[data], piece.offsets[:-1], piece.offsets[1:]),
                    sums(again, lines.first[:-1], lines.first[1:]),
                    repeated,
                    failed,
                    ~failed & (part >= share),
                    part,
                ]
                ids = batch.column(0).slice(piece.rows.start, len(piece))
                names = [c.split()[0] for c in OUTPUT.split(", ")]
                yield pa.record_batch([ids, *map(pa.array, columns)], names=names)

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return ids.mapInArrow(run, OUTPUT)


ship(__name__)
