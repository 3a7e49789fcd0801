"""Document quality by histogram gradient-boosted trees over document statistics.

Statistics come from whole texts, many documents at a time. Trees are grown on the driver
from a bounded sample of labelled rows: features become at most ``BINS`` bins, a tree grows
level by level, and the best split of a node comes from running sums over the bins'
gradients. The forest is a few arrays; scoring walks all documents of a batch down a tree at
once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import ship, stored
from weftline.llm.textops import (
    SMALL_PIECE,
    distinct_words,
    find_lines,
    pieces,
    repeated_lines,
    repeated_words,
    sums,
    tidy,
)

#: Labelled rows that the trees are fitted on, at most; those with the smallest hash of
#: doc_id are taken.
SAMPLE = 20_000
BINS = 64
DEPTH = 4
TREES = 60
RATE = 0.15
#: Ridge on leaf values and least weight (sum of p * (1 - p)) of a leaf.
RIDGE = 1.0
LEAST_WEIGHT = 1.0

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "long_word", "blank_share", "upper_share",
    "digit_share", "symbol_share", "mark_share", "sentence_share", "other_byte_share",
    "upper_words", "marked_words", "log_lines", "line_words", "short_lines", "repeated_lines",
    "distinct_share", "repeated_3", "repeated_5",
)


def _bytes(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_UPPER = _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _bytes("abcdefghijklmnopqrstuvwxyz")
_BLANK = _bytes(" \t\r\n\x0b\x0c")
_DIGIT = _bytes("0123456789")
_SYMBOL = _bytes("#*$%&|<>")
_MARK = _bytes("!?~^_=+@\\/{}[]()")
_SENTENCE = _bytes(".,;:'\"-")
_HIGH = np.arange(256) >= 128


def document_features(column: pa.Array) -> np.ndarray:
    """Statistics of each text of a batch, a row per text; null counts as empty."""
    rows = []
    for piece in pieces(column, size=SMALL_PIECE):
        data, offsets, first = piece.data, piece.offsets, piece.first
        lo, hi = offsets[:-1], offsets[1:]
        size = np.maximum(hi - lo, 1)
        n_words = np.diff(first)
        some = np.maximum(n_words, 1)
        words = piece.word_hashes()
        length = piece.ends - piece.starts
        lines = find_lines(piece)
        n_lines = np.diff(lines.first)

        def share(table: np.ndarray) -> np.ndarray:
            return sums(table[data], lo, hi) / size

        def of_words(values: np.ndarray) -> np.ndarray:
            return sums(values, first[:-1], first[1:]) / some

        upper = sums(_UPPER[data], piece.starts, piece.ends)
        marks = sums((_SYMBOL | _MARK)[data], piece.starts, piece.ends)
        longest = np.zeros(len(piece))
        if len(length):
            full = n_words > 0
            longest[full] = np.maximum.reduceat(length, first[:-1][full])
        rows.append(
            np.column_stack(
                [
                    np.log1p(hi - lo),
                    np.log1p(n_words),
                    of_words(length),
                    np.log1p(longest),
                    share(_BLANK),
                    share(_UPPER),
                    share(_DIGIT),
                    share(_SYMBOL),
                    share(_MARK),
                    share(_SENTENCE),
                    share(_HIGH),
                    of_words((upper >= 2) & (2 * upper > length)),
                    of_words(marks >= 1),
                    np.log1p(n_lines),
                    n_words / n_lines,
                    sums(lines.n_words < 4, lines.first[:-1], lines.first[1:]) / n_lines,
                    sums(repeated_lines(piece, lines), lines.first[:-1], lines.first[1:]) / n_lines,
                    distinct_words(words, first) / some,
                    of_words(repeated_words(words, first, 3)),
                    of_words(repeated_words(words, first, 5)),
                ]
            )
        )
    return np.concatenate(rows) if rows else np.zeros((0, len(FEATURES)))


# ---------------------------------------------------------------- trees


@dataclass
class Forest:
    """Trees of one depth. Node k of a level has the children 2k and 2k + 1.

    ``feature`` and ``bound`` are (trees, inner nodes), ``leaf`` is (trees, leaves). A value
    above the bound goes right; a node that does not split sends all left.
    """

    prior: float
    feature: np.ndarray
    bound: np.ndarray
    leaf: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row."""
        total = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        depth = int(np.log2(self.leaf.shape[1])) if self.leaf.size else 0
        for feature, bound, leaf in zip(self.feature, self.bound, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for level in range(depth):
                inner = node + (1 << level) - 1
                node = 2 * node + (x[rows, feature[inner]] > bound[inner])
            total += leaf[node]
        return 1 / (1 + np.exp(-total))


def bin_bounds(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Inner bin bounds of each feature: quantiles, halfway between different values."""
    out = []
    for column in x.T:
        values = np.unique(column)
        middle = (values[1:] + values[:-1]) / 2
        if len(middle) > bins - 1:
            at = np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])
            middle = np.unique(middle[np.minimum(np.searchsorted(middle, at), len(middle) - 1)])
        out.append(middle)
    return out


def fit_forest(
    x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE
) -> Forest:
    """Boost logistic loss. Without rows of both labels the score is one constant:
    0.5 without rows."""
    inner, leaves = (1 << depth) - 1, 1 << depth
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    prior = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        trees = 0
    bounds = bin_bounds(x) if len(x) else []
    binned = np.column_stack(
        [np.searchsorted(b, c, "left") for b, c in zip(bounds, x.T, strict=True)]
    ) if len(x) else np.zeros((0, 0), np.int64)
    forest = Forest(
        prior, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf),
        np.zeros((trees, leaves)),
    )
    total = np.full(len(y), prior)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            nodes = 1 << level
            best = np.zeros(nodes)
            choice = np.zeros((nodes, 2), np.int64)
            found = np.zeros(nodes, bool)
            for f, bound in enumerate(bounds):
                if not len(bound):
                    continue
                width = len(bound) + 1
                at = node * width + binned[:, f]
                g = np.bincount(at, gradient, nodes * width).reshape(nodes, width).cumsum(1)
                w = np.bincount(at, weight, nodes * width).reshape(nodes, width).cumsum(1)
                gl, wl, ga, wa = g[:, :-1], w[:, :-1], g[:, -1:], w[:, -1:]
                gain = gl**2 / (wl + RIDGE) + (ga - gl) ** 2 / (wa - wl + RIDGE) - ga**2 / (wa + RIDGE)
                gain[(wl < LEAST_WEIGHT) | (wa - wl < LEAST_WEIGHT)] = 0
                top = gain.argmax(1)
                value = gain[np.arange(nodes), top]
                better = value > best + 1e-9
                best[better] = value[better]
                choice[better] = np.column_stack([np.full(nodes, f), top])[better]
                found |= better
            right = np.zeros(len(y), np.int64)
            for k in np.flatnonzero(found):
                f, cut = choice[k]
                forest.feature[t, nodes - 1 + k] = f
                forest.bound[t, nodes - 1 + k] = bounds[f][cut]
                here = node == k
                right[here] = binned[here, f] > cut
            node = 2 * node + right
        g = np.bincount(node, gradient, leaves)
        w = np.bincount(node, weight, leaves)
        forest.leaf[t] = rate * g / (w + RIDGE)
        total += forest.leaf[t][node]
    return forest


# ---------------------------------------------------------------- Spark


def held_out(doc_id: Column) -> Column:
    """Rows that never lend a label: crc32 of doc_id as text leaves 1 when divided by 3."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def feature_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, features) of every document, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = document_features(batch.column(1))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES))
            lists = flat.cast(pa.list_(pa.float64()))
            yield pa.record_batch([batch.column(0), lists], names=["doc_id", "features"])

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return stored(ids.mapInArrow(tidy(run), "doc_id long, features array<double>"), "features")


def train(features: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Forest:
    """Fit on at most ``sample`` labelled rows that are not held out.

    A doc_id with several labels has the largest; null labels and ids are no labels.
    """
    known = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("quality").cast("int").alias("quality"))
        .where(~held_out(F.col("doc_id")))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    rows = features.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = rows.select("features", "quality").toPandas()
    x = np.array(rows["features"].tolist(), dtype=float).reshape(-1, len(FEATURES))
    return fit_forest(x, rows["quality"].to_numpy(float))


def score_rows(features: DataFrame, forest: Forest) -> DataFrame:
    """(doc_id, score) from (doc_id, features)."""
    model = features.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            scores = model.value.scores(x)
            yield pa.record_batch([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    return features.mapInArrow(tidy(run), "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per document ``doc_id, held_out, score, predicted``.

    Only the text makes a score; null and empty texts are scored as empty. Repeated rows are
    scored alike. Without labels all scores are 0.5, which predicts 1.
    """
    features = feature_rows(docs)
    scored = score_rows(features, train(features, labels, sample))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that are predicted 1, with their columns.

    One pass learns the forest, a second scores each row where it is, so no text moves."""
    forest = train(feature_rows(docs), labels, sample)
    model = docs.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.value.scores(document_features(batch.column(place)))
            yield batch.filter(pa.array(scores >= 0.5))

    place = docs.columns.index("text")
    return docs.mapInArrow(tidy(run), docs.schema)


ship(__name__)
