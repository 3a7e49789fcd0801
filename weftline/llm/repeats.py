"""Repeated byte strings across documents, by suffix sorting with a difference cover.

A string of ``length`` bytes that also starts earlier is a repeat, and all bytes that repeats
cover are removed. Sorting every suffix of a corpus would move many times its size, so
what cannot matter is set aside first, exactly:

1. Each window of ``length`` bytes names an anchor: the place of its least hashed gram of
   ``GRAM`` bytes. Equal windows name equal grams. Neighbouring windows mostly share their
   anchor; such a run of windows with its bytes is a span. A gram that occurs once
   in the corpus has no repeats.
2. Spans with equal bytes around equal grams are one class. Its first span (by document,
   then place) leads; all windows of the others repeat it. Copies are settled here, at a
   few numbers per span.
3. What remains are leaders of different classes that share a gram, such as the edges of
   copied passages. Their texts are sorted: a difference cover modulo 3 samples suffixes,
   their triples are sorted and named, the names are sorted recursively, the remaining suffixes
   are merged in, and neighbours in the suffix order whose first ``length`` bytes agree are
   repeats of the earliest. Spans with one gram meet in one task; suffixes of spans with
   different grams never agree that far. A gram with very many classes does not fit a
   task; its windows are compared by hash in a shuffle of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import beside, ship, stored, with_row_id
from weftline.llm.textops import (
    _BASE,
    _BYTE_VALUE,
    _INVERSES,
    mix64,
    per_document,
    powers,
    text_buffers,
)

LENGTH = 100
GRAM = 32
#: Texts hashed together.
PIECE_BYTES = 1 << 20
#: Bytes of spans whose suffixes are sorted together; three of their ranks fit 63 bits.
SORT_BYTES = 1 << 20
#: Classes of one gram that are sorted in one task.
MOST_CLASSES = 4_000

# ---------------------------------------------------------------- suffix sorting


def _names(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Rank of each key among the different ones, from 1, and how many there are."""
    found, inverse = np.unique(keys, return_inverse=True)
    return inverse + 1, len(found)


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array of positive numbers below 2**21, at most 2**21 - 8 of them."""
    n = len(s)
    if n < 2:
        return np.arange(n)
    t = np.zeros(n + 3, np.int64)
    t[:n] = s
    bits = np.int64(21)
    # The cover: places that leave 1 or 2. One dummy place keeps both halves of the names apart.
    ones = np.arange(1, n + (n % 3 == 1), 3)
    twos = np.arange(2, n, 3)
    sample = np.concatenate([ones, twos])
    names, different = _names((((t[sample] << bits) | t[sample + 1]) << bits) | t[sample + 2])
    if different < len(sample):
        order = suffix_array(names)
        names = np.empty(len(sample), np.int64)
        names[order] = np.arange(1, len(sample) + 1)
    rank = np.zeros(n + 3, np.int64)
    rank[sample] = names
    sample = sample[np.argsort(names)]
    sample = sample[sample < n]
    # The others: first number, then the rank of what follows.
    zeros = np.arange(0, n, 3)
    by_next = (t[zeros] << bits) | rank[zeros + 1]
    order = np.argsort(by_next)
    zeros, by_next = zeros[order], by_next[order]
    by_two = (((t[zeros] << bits) | t[zeros + 1]) << bits) | rank[zeros + 2]
    # Merge: each kind compares with the others by one or two numbers and a sample rank.
    one, two = sample[sample % 3 == 1], sample[sample % 3 == 2]
    place = np.arange(len(zeros))
    place += np.searchsorted((t[one] << bits) | rank[one + 1], by_next)
    place += np.searchsorted((((t[two] << bits) | t[two + 1]) << bits) | rank[two + 2], by_two)
    out = np.empty(n, np.int64)
    free = np.ones(n, bool)
    free[place] = False
    out[place] = zeros
    out[free] = sample
    return out


def repeated_windows(spans: list[bytes], rank: np.ndarray, length: int) -> list[np.ndarray]:
    """Per span, which of its windows of ``length`` bytes also start earlier.

    ``rank`` orders the spans. Windows of a span start at its first ``len - length + 1`` bytes.
    """
    sizes = np.fromiter(map(len, spans), np.int64, len(spans))
    starts = np.cumsum(np.r_[0, sizes + 1])[:-1]
    text = np.frombuffer(b"\0".join(spans) + b"\0", np.uint8)
    n_windows = sizes - length + 1
    span = np.repeat(np.arange(len(spans)), n_windows)
    offset = np.arange(len(span)) - np.repeat(np.cumsum(np.r_[0, n_windows])[:-1], n_windows)
    window = np.full(len(text), -1, np.int64)
    window[starts[span] + offset] = np.arange(len(span))
    # A separator is 1 and every byte larger, so that all numbers are positive.
    value = text.astype(np.int64) + 2
    value[starts + sizes] = 1
    order = suffix_array(value)
    order = order[window[order] >= 0]
    same = np.zeros(len(order), bool)
    view = np.lib.stride_tricks.sliding_window_view(text, length) if len(text) >= length else None
    for i in range(1, len(order), 1 << 15):
        a, b = order[i - 1 : i - 1 + (1 << 15)], order[i : i + (1 << 15)]
        same[i : i + len(b)] = (view[a[: len(b)]] == view[b]).all(1)
    ids = window[order]
    key = (rank[span] * (int(sizes.max(initial=0)) + 1) + offset)[ids]
    heads = np.flatnonzero(~same)
    flags = np.zeros(len(span), bool)
    if len(heads):
        least = np.minimum.reduceat(key, heads)
        flags[ids] = key != np.repeat(least, np.diff(np.r_[heads, len(key)]))
    return np.split(flags, np.cumsum(n_windows)[:-1])


# ---------------------------------------------------------------- spans


def _running(data: np.ndarray) -> np.ndarray:
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * powers(_BASE, len(data)), out=run[1:])
    return run


def find_spans(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Spans of the texts: document, first window's place, number of windows, hash of the
    anchor's gram, hash of the span with the anchor's place in it."""
    reach = length - gram + 1
    n_windows = np.maximum(np.diff(offsets) - length + 1, 0)
    doc = np.repeat(np.arange(len(offsets) - 1), n_windows)
    none = np.zeros(0, np.int64)
    if not len(doc):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    start = offsets[:-1][doc] + np.arange(len(doc)) - np.cumsum(np.r_[0, n_windows])[:-1][doc]
    run = _running(data)
    back = powers(_INVERSES[int(_BASE)], len(data) + 1)
    grams = mix64((run[gram:] - run[:-gram]) * back[: len(data) - gram + 1])
    # The hash's upper half and the place: the least one is the first of the least hashes.
    low = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= reach:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < reach:
        low = np.minimum(low[: len(low) - (reach - width)], low[reach - width :])
    anchor = (low[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])]
    at = np.flatnonzero(new)
    count = np.diff(np.r_[at, len(start)])
    first, anchor, doc = start[at], anchor[at], doc[at]
    whole = (run[first + count - 1 + length] - run[first]) * back[first]
    whole = mix64(whole ^ mix64(((anchor - first) * 4096 + count).astype(np.uint64)))
    return doc, first - offsets[doc], count, grams[anchor], whole


def _cut(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and offsets of pieces of a batch's texts."""
    offsets, data = text_buffers(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + PIECE_BYTES, "right")) - 1
        j = min(n, max(j, i + 1))
        yield i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


#: A span's first place and number of windows in one number.
def _pack(place, count):
    return place * 4096 + count


_SPANS = "gram long, whole long, doc long, row_file long, row_no long, place long, again boolean"


def _spans(length: int, gram: int):
    """All spans of a batch. Of equal ones only the earliest has to be compared with other
    tasks'; the others are marked ``again`` and dealt out by a hash of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _SPANS.split(", ")]
        for batch in batches:
            parts = []
            for i, data, offsets in _cut(batch.column(0)):
                doc, place, count, g, whole = find_spans(data, offsets, length, gram)
                parts.append((doc + i, _pack(place, count), g, whole))
            if not parts:
                continue
            row, place, g, whole = (np.concatenate(x) for x in zip(*parts, strict=True))
            keys = [batch.column(k).to_numpy() for k in (1, 2, 3)]
            rank = np.empty(batch.num_rows, np.int64)
            rank[np.lexsort(keys[::-1])] = np.arange(batch.num_rows)
            order = np.lexsort((place, rank[row], whole, g))
            row, place, g, whole = row[order], place[order], g[order], whole[order]
            again = np.zeros(len(row), bool)
            if len(row):
                again[1:] = (g[1:] == g[:-1]) & (whole[1:] == whole[:-1])
            # Small numbers: they deal rows out as well and take less room than hashes.
            own = mix64(mix64(row.astype(np.uint64)) ^ place.astype(np.uint64)) >> np.uint64(40)
            yield pa.record_batch(
                [
                    pa.array(np.where(again, own, g).view(np.int64)),
                    pa.array(np.where(again, 0, whole).view(np.int64)),
                    *[pa.array(k[row]) for k in keys],
                    pa.array(place),
                    pa.array(again),
                ],
                names=names,
            )

    return run


_TEXTS = "gram long, heavy boolean, doc long, row_file long, row_no long, place long, span binary"


def _span_texts(length: int):
    """The bytes of the wanted spans of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _TEXTS.split(", ")]
        for batch in batches:
            offsets, data = text_buffers(batch.column(0))
            wanted = batch.column(4)
            rows = per_document(np.cumsum(np.r_[0, wanted.value_lengths().to_numpy()]))
            fields = wanted.flatten()
            gram, place, heavy = (fields.field(k) for k in range(3))
            at = place.to_numpy()
            begin = offsets[rows] + at // 4096
            end = begin + at % 4096 - 1 + length
            take = pa.array(rows)
            for i in range(0, len(rows), 20_000):
                part = slice(i, i + 20_000)
                texts = [data[a:b].tobytes() for a, b in zip(begin[part], end[part], strict=True)]
                some = take[part]
                yield pa.record_batch(
                    [
                        gram[part],
                        heavy[part],
                        *[batch.column(k).take(some) for k in (1, 2, 3)],
                        place[part],
                        pa.array(texts, pa.binary()),
                    ],
                    names=names,
                )

    return run


_RANGES = "row_file long, row_no long, place long"


def _ranges(rows: list[tuple], flags: list[np.ndarray]) -> pa.RecordBatch:
    """Runs of marked windows as packed places."""
    out: list[tuple[int, int, int]] = []
    for (row_file, row_no, place), marked in zip(rows, flags, strict=True):
        if marked.any():
            edge = np.flatnonzero(np.diff(np.r_[False, marked, False].astype(np.int8)))
            for a, b in edge.reshape(-1, 2).tolist():
                out.append((row_file, row_no, _pack(place // 4096 + a, b - a)))
    columns = list(zip(*out, strict=True)) or [(), (), ()]
    return pa.record_batch(
        [pa.array(c, pa.int64()) for c in columns], names=["row_file", "row_no", "place"]
    )


def _sort_spans(length: int):
    """Spans ordered by gram: sort as many whole groups together as fit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None

        def settle(upto: int) -> pa.RecordBatch:
            rows = held[:upto]
            order = np.lexsort(np.array([r[1:5] for r in rows], np.int64).T[::-1])
            rank = np.empty(len(rows), np.int64)
            rank[order] = np.arange(len(rows))
            flags = repeated_windows([r[5] for r in rows], rank, length)
            return _ranges([r[2:5] for r in rows], flags)

        for batch in batches:
            for row in zip(*[batch.column(k).to_pylist() for k in (0, 2, 3, 4, 5, 6)], strict=True):
                if row[0] != last:
                    if size > SORT_BYTES // 2:
                        yield settle(len(held))
                        held.clear()
                        size = 0
                    last = row[0]
                held.append(row)
                size += len(row[5]) + 1
        if held:
            yield settle(len(held))

    return run


def _windows(length: int):
    """A hash and the place of each window of each span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for span, doc, row_file, row_no, place in zip(
                *[batch.column(k).to_pylist() for k in (6, 2, 3, 4, 5)], strict=True
            ):
                data = np.frombuffer(span, np.uint8)
                total = _running(data)
                n = len(data) - length + 1
                back = powers(_INVERSES[int(_BASE)], len(data) + 1)
                hashes = mix64((total[length:] - total[:-length]) * back[:n])
                yield pa.record_batch(
                    [
                        pa.array(hashes.view(np.int64)),
                        *[pa.array(np.full(n, v, np.int64)) for v in (doc, row_file, row_no)],
                        pa.array(place // 4096 + np.arange(n)),
                    ],
                    names=["hash", "doc", "row_file", "row_no", "start"],
                )

    return run


def _merge(length: int):
    """Packed places of each document to disjoint byte ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for places in batch.column(2):
                at = np.sort(places.values.to_numpy())
                begin, end = at // 4096, at // 4096 + at % 4096 - 1 + length
                new = np.r_[True, begin[1:] > np.maximum.accumulate(end)[:-1]]
                first = np.flatnonzero(new)
                ends = np.maximum.reduceat(end, first)
                out.append(np.column_stack([begin[first], ends]).ravel())
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int64()))],
                names=["row_file", "row_no", "ranges"],
            )

    return run


def repeated_ranges(named: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(row_file, row_no, ranges) of documents (text, doc, row_file, row_no) with repeats:
    disjoint byte ranges as begin, end, begin, end, ..."""
    spans = named.mapInArrow(_spans(length, gram), _SPANS)
    group = Window.partitionBy("gram")
    earlier = group.orderBy("whole", "doc", "row_file", "row_no", "place")
    spans = spans.repartition("gram").withColumn("members", F.count(F.lit(1)).over(group))
    spans = spans.where("members > 1 OR again")
    spans = spans.withColumn("repeat", F.coalesce(F.lag("whole").over(earlier) == F.col("whole"), F.lit(False)) | F.col("again"))
    spans = spans.withColumn("classes", F.sum(F.when(F.col("repeat"), 0).otherwise(1)).over(group))
    spans = stored(
        spans.where("repeat OR classes > 1").select(
            "gram", "doc", "row_file", "row_no", "place", "repeat",
            (F.col("classes") > MOST_CLASSES).alias("heavy"),
        ),
        "repeat-spans",
    )
    leaders = spans.where("NOT repeat")
    wanted = leaders.groupBy("row_file", "row_no").agg(
        F.collect_list(F.struct("gram", "place", "heavy")).alias("wanted")
    )
    # About 24 bytes a span and 64 a document, of which there are no more than spans.
    texts = beside(named, wanted, 24 * leaders.count() + 64 * wanted.count(), "inner")
    texts = texts.select("text", "doc", "row_file", "row_no", "wanted").mapInArrow(
        _span_texts(length), _TEXTS
    )
    texts = stored(texts, "repeat-texts")
    light = texts.where("NOT heavy").repartition("gram").sortWithinPartitions("gram")
    found = light.mapInArrow(_sort_spans(length), _RANGES)
    windows = texts.where("heavy").mapInArrow(
        _windows(length), "hash long, doc long, row_file long, row_no long, start long"
    )
    if texts.where("heavy").head(1):
        windows = stored(windows, "repeat-windows")
        place = F.struct("doc", "row_file", "row_no", "start")
        firsts = windows.groupBy("hash").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        again = windows.join(firsts.where("n > 1"), "hash").where(place != F.col("first"))
        found = found.union(
            again.select("row_file", "row_no", (F.col("start") * 4096 + 1).alias("place"))
        )
    every = spans.where("repeat").select("row_file", "row_no", "place").union(found)
    merged = every.groupBy("row_file", "row_no").agg(F.collect_list("place").alias("places"))
    return stored(
        merged.mapInArrow(_merge(length), "row_file long, row_no long, ranges array<long>"),
        "repeat-ranges",
    )


_OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _OUT.split(", ")]
    for batch in batches:
        offsets, data = text_buffers(batch.column(0))
        removed, spans, digests = [], [], []
        for i, ranges in enumerate(batch.column(2).to_pylist()):
            text = data[offsets[i] : offsets[i + 1]].tobytes()
            kept, at = hashlib.sha256(), 0
            for a, b in zip(ranges[::2], ranges[1::2], strict=True) if ranges else ():
                kept.update(text[at:a])
                at = b
            kept.update(text[at:])
            digests.append(kept.hexdigest())
            removed.append(sum(ranges[1::2]) - sum(ranges[::2]) if ranges else 0)
            spans.append(len(ranges) // 2 if ranges else 0)
        yield pa.record_batch(
            [
                batch.column(1),
                pa.array(np.diff(offsets)),
                pa.array(removed, pa.int64()),
                pa.array(spans, pa.int64()),
                pa.array(digests, pa.string()),
            ],
            names=names,
        )


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    Documents are ordered by doc_id, null last, and rows of one doc_id by file and row. Null
    and empty texts have no bytes. Ties cannot occur, as every place differs.
    """
    named = with_row_id(docs).select(
        F.coalesce(F.col("doc.text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("doc.doc_id").cast("long"), F.lit(2**63 - 1)).alias("doc"),
        "row_file",
        "row_no",
        F.col("doc.doc_id").cast("long").alias("doc_id"),
    )
    ranges = repeated_ranges(named.select("text", "doc", "row_file", "row_no"), length)
    size = ranges.agg(F.coalesce(F.sum(F.size("ranges") * 8 + 40), F.lit(0))).first()[0]
    return (
        beside(named, ranges, size, "left")
        .select("text", "doc_id", "ranges")
        .mapInArrow(_remove, _OUT)
    )


ship(__name__)
