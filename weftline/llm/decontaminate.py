"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. The items' n-grams are found in all documents. A bitmap of fixed size keeps most other
   n-grams of the corpus out of the join; what passes by chance falls away in it.
2. A document's n-grams of an item fall into groups whose places could lie in one alignment.
   A group of two or more n-grams is a seed however frequent they are, so that an item that
   leaked into very many documents, whole, edited or in part, is found in all of them. A lone
   n-gram is a seed if it is rare: alone in few documents, or in not many more than hold the
   item's others.
3. A seed gives the passage around it, and local alignment of the passage's words with the
   item's counts matches, replaced, added and dropped words. The score is the best
   alignment's over that of the item with itself.

Words are compared without the case of Latin-1 letters and without ASCII punctuation, by 64-bit
hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import BROADCAST_BYTES, beside, ship, stored, with_row_id
from weftline.llm.textops import (
    LOWER,
    SMALL_PIECE,
    Piece,
    find_words,
    mix64,
    ngram_hashes,
    per_document,
    release_memory,
    text_buffers,
    tidy,
)

NGRAM = 3
#: A lone n-gram in at most this share of all documents, or in this many, is rare.
RARE_SHARE = 1e-4
LEAST_RARE = 10
#: So is one in at most this many times the documents that hold the item's median n-gram.
OWN_FACTOR = 4
#: Least score of a contaminated document.
LEAST_SCORE = 0.35
MATCH, MISMATCH, GAP = 2, -1, -1
#: Bits of the bitmap over the items' n-grams; the size is the same for any benchmark.
BITMAP_BITS = 1 << 23
#: Places of one n-gram in a document no further apart than this are one row, by first and last.
NEAR = 50

_PLAIN = LOWER.copy()
_PLAIN[[b for b in range(33, 127) if not chr(b).isalnum()]] = 32


def plain_pieces(column: pa.Array) -> Iterator[Piece]:
    """Pieces of a batch whose words have lower-case letters and no punctuation."""
    offsets, data = text_buffers(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + SMALL_PIECE, "right")) - 1
        j = min(n, max(j, i + 1))
        part = _PLAIN[data[offsets[i] : offsets[j]]]
        # Latin-1 capitals: C3 80 to C3 9E, but for the sign C3 97.
        after = np.flatnonzero(part[:-1] == 0xC3) + 1
        capital = after[(part[after] >= 0x80) & (part[after] <= 0x9E) & (part[after] != 0x97)]
        part[capital] += 0x20
        local = offsets[i : j + 1] - offsets[i]
        yield Piece(slice(i, j), part, local, *find_words(part, local))
        i = j
    release_memory()


def grams_of(words: np.ndarray, n: int) -> np.ndarray:
    """The n-grams of one text; shorter texts have one gram of all their words."""
    if 0 < len(words) < n:
        return mix64(ngram_hashes(words, len(words)) + np.uint64(len(words)))
    return ngram_hashes(words, n)


def local_score(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best local alignment of two word sequences: its score, and where it ends in
    ``passage`` (exclusive).

    Rows of the table are computed at once: with gaps of one price, the best way along a row
    is a running maximum.
    """
    along = -GAP * np.arange(len(passage) + 1)
    above = np.zeros(len(passage) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        step = above[:-1] + np.where(passage == word, MATCH, MISMATCH)
        row = np.maximum(0, above + GAP)
        np.maximum(row[1:], step, out=row[1:])
        row = np.maximum.accumulate(row + along) - along
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
        above = row
    return best, end


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """Score between 0 and 1 and the aligned words ``start:end`` of the passage."""
    if not len(item) or not len(passage):
        return 0.0, 0, 0
    best, end = local_score(item, passage)
    _, back = local_score(item[::-1], passage[:end][::-1])
    return best / (MATCH * len(item)), end - back, end


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, item, words): ``item`` stands for id and words together."""
    for batch in batches:
        for piece in plain_pieces(batch.column(1)):
            words = piece.word_hashes().view(np.int64)
            lists = pa.ListArray.from_arrays(
                pa.array(piece.first.astype(np.int32)), pa.array(words)
            )
            ids = batch.column(0).slice(piece.rows.start, len(piece))
            yield pa.record_batch([ids, lists], names=["item_id", "words"])


def _item_grams(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, words = batch.column(0).to_numpy(), batch.column(1)
            out = [grams_of(np.array(w, np.int64).view(np.uint64), n) for w in words.to_pylist()]
            size = [len(g) for g in out]
            yield pa.record_batch(
                [
                    pa.array(np.repeat(items, size)),
                    pa.array(np.concatenate([np.arange(s) for s in size]).astype(np.int64)),
                    pa.array(np.concatenate(out).view(np.int64)),
                ],
                names=["item", "place", "gram"],
            )

    return run


def _document_grams(n: int, sizes: list[int], bitmap):
    """(row_file, row_no, gram, first, last, head): item n-grams and where they stand; ``head``
    is 1 in one row of a document and n-gram. ``sizes`` are n and the lengths of the shorter
    items, whose one gram is all of their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for batch in batches:
            for piece in plain_pieces(batch.column(0)):
                words, first = piece.word_hashes(), piece.first
                owner = per_document(first)
                parts = []
                for k in sizes:
                    grams = ngram_hashes(words, k)
                    at = np.flatnonzero(owner[: len(grams)] == owner[k - 1 :][: len(grams)])
                    grams = grams[at]
                    parts.append((at, grams if k == n else mix64(grams + np.uint64(k))))
                at = np.concatenate([a for a, _ in parts])
                found = np.concatenate([g for _, g in parts])
                slot = found % np.uint64(BITMAP_BITS)
                hit = (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1)
                hit = np.flatnonzero(hit)
                if not len(hit):
                    continue
                at, found = at[hit], found[hit]
                doc = owner[at]
                place = at - first[doc]
                order = np.lexsort((place, found, doc))
                doc, place, found = doc[order], place[order], found[order]
                head = np.r_[True, (doc[1:] != doc[:-1]) | (found[1:] != found[:-1])]
                begin = np.flatnonzero(head | np.r_[True, np.diff(place) > NEAR])
                last = np.r_[begin[1:], len(doc)] - 1
                rows = pa.array(doc[begin] + piece.rows.start)
                yield pa.record_batch(
                    [
                        batch.column(1).take(rows),
                        batch.column(2).take(rows),
                        pa.array(found[begin].view(np.int64)),
                        pa.array(place[begin].astype(np.int64)),
                        pa.array(place[last].astype(np.int64)),
                        pa.array(head[begin].astype(np.int64)),
                    ],
                    names=["row_file", "row_no", "gram", "first", "last", "head"],
                )

    return run


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each wanted passage of a document."""
    for batch in batches:
        wanted = batch.column(4)
        for piece in plain_pieces(batch.column(0)):
            words = piece.word_hashes().view(np.int64)
            rows, items, starts, out = [], [], [], []
            for i in range(len(piece)):
                own = words[piece.first[i] : piece.first[i + 1]]
                for want in wanted[piece.rows.start + i].as_py():
                    a, b = max(0, want["start"]), min(len(own), want["end"])
                    rows.append(piece.rows.start + i)
                    items.append(want["item"])
                    starts.append(a)
                    out.append(own[a:b])
            ends = np.cumsum([0, *map(len, out)]).astype(np.int32)
            take = pa.array(rows, pa.int64())
            yield pa.record_batch(
                [
                    *[batch.column(k).take(take) for k in (1, 2, 3)],
                    pa.array(items, pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *out]))),
                ],
                names=["row_file", "row_no", "doc_id", "item", "start", "passage"],
            )


_FOUND = (
    "row_file long, row_no long, item long, doc_id long, item_id long, "
    "score double, first_word long, last_word long"
)


def _align_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _FOUND.split(", ")]
    for batch in batches:
        passages, items = batch.column("passage"), batch.column("words")
        starts = batch.column("start").to_numpy()
        scores, first, last = [], [], []
        for k in range(batch.num_rows):
            item = items[k].values.to_numpy()
            score, a, b = align(item, passages[k].values.to_numpy())
            scores.append(score)
            first.append(int(starts[k]) + a)
            last.append(int(starts[k]) + b - 1)
        yield pa.record_batch(
            [
                *[batch.column(c) for c in names[:5]],
                pa.array(scores, pa.float64()),
                pa.array(first, pa.int64()),
                pa.array(last, pa.int64()),
            ],
            names=names,
        )


def _seed_spans(
    seen: DataFrame, grams: DataFrame, items: DataFrame, rare: float, least_score: float
) -> DataFrame:
    """(row_file, row_no, item, start, end): the passages of documents to align with an item.

    With ``L`` item words of 2 points each, an alignment that reaches ``least_score`` has at most
    ``2 * (1 - least_score) * L`` added and dropped words. So its n-grams stand within that
    distance of each other, as offsets from their places in the item, and so does all of it.
    """
    near = F.ceil(F.col("length") * max(0.0, 2.0 * (1.0 - least_score)))
    places = grams.groupBy("item", "gram").agg(
        F.min("place").alias("place_first"), F.max("place").alias("place_last")
    )
    hits = (
        seen.join(places, "gram")
        .join(items.select("item", F.size("words").alias("length")), "item")
        .withColumn("low", F.col("first") - F.col("place_last"))
        .withColumn("high", F.col("last") - F.col("place_first"))
    )
    # Hits by offset, cut into groups where the next one is out of reach of all before it.
    by_offset = Window.partitionBy("row_file", "row_no", "item").orderBy("low", "high", "gram")
    upto = by_offset.rowsBetween(Window.unboundedPreceding, -1)
    cut = F.col("low") > F.max("high").over(upto) + near
    groups = (
        hits.withColumn("cut", F.coalesce(cut.cast("long"), F.lit(0)))
        .withColumn("part", F.sum("cut").over(by_offset.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("row_file", "row_no", "item", "length", "part")
        .agg(
            (F.min("low") - near).alias("start"),
            (F.max("high") + F.col("length") + near).alias("end"),
            # Two n-grams of an alignment have two places in the document and two in the item.
            (
                (F.max("last") > F.min("first")) & (F.max("place_last") > F.min("place_first"))
            ).alias("many"),
            F.min("gram").alias("gram"),  # the only one unless ``many``
        )
    )
    groups = stored(groups, "leak-groups")
    lone = groups.where(~F.col("many"))
    alone = (
        lone.select("item", "gram", "row_file", "row_no")
        .distinct()
        .groupBy("item", "gram")
        .agg(F.count(F.lit(1)).alias("alone"))
    )
    holders = seen.groupBy("gram").agg(F.sum("head").alias("holders"))
    usual = (
        grams.join(holders, "gram").groupBy("item").agg(F.percentile("holders", 0.5).alias("usual"))
    )
    limit = max(LEAST_RARE, rare)
    seeds = stored(
        alone.join(usual, "item")
        .where((F.col("alone") <= limit) | (F.col("alone") <= OWN_FACTOR * F.col("usual")))
        .select("item", "gram"),
        "leak-seeds",
    )
    if 40 * seeds.count() <= BROADCAST_BYTES:
        seeds = F.broadcast(seeds)
    span = ["row_file", "row_no", "item", "start", "end"]
    rare_ones = lone.join(seeds, ["item", "gram"], "left_semi").select(span)
    return groups.where("many").select(span).unionByName(rare_ones)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = NGRAM,
    rare_share: float = RARE_SHARE,
    least_score: float = LEAST_SCORE,
) -> DataFrame:
    """(row_file, row_no, doc_id, item_id, score, first_word, last_word) of every document
    and item whose alignment reaches ``least_score``.

    Items without words and null or empty texts match nothing. Items that repeat an id and
    its words count once; a null id is an id. Repeated documents are found each. Places are
    word numbers in the document, from 0. ``docs`` may come from ``with_row_id`` already.
    """
    spark = docs.sparkSession
    named = docs if docs.columns == ["doc", "row_file", "row_no"] else with_row_id(docs)
    named = named.select(
        F.col("doc.text").cast("string").alias("text"),
        "row_file",
        "row_no",
        F.col("doc.doc_id").cast("long").alias("doc_id"),
    )
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string"))
    items = items.mapInArrow(tidy(_item_words), "item_id long, words array<long>").where("size(words) > 0")
    items = stored(
        items.distinct().withColumn("item", F.xxhash64("item_id", "words")), "leak-items"
    )
    grams = stored(
        items.select("item", "words").mapInArrow(
            tidy(_item_grams(n)), "item long, place long, gram long"
        ),
        "leak-grams",
    )
    short = items.select(F.size("words").alias("k")).where(F.col("k") < n).distinct()
    sizes = [n, *sorted(row["k"] for row in short.collect())]  # fewer than n rows
    # One bit per n-gram: at most BITMAP_BITS / 64 numbers come to the driver, for any benchmark.
    slot = F.pmod(F.col("gram"), F.lit(BITMAP_BITS))
    # pmod of a negative long agrees with the unsigned remainder, as the size is a power of 2.
    words = (
        grams.select(slot.alias("slot"))
        .selectExpr("slot div 64 AS word", "shiftleft(1L, CAST(slot % 64 AS int)) AS bit")
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toPandas()
    )
    bits = np.zeros(BITMAP_BITS // 64, np.int64)
    bits[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    bitmap = spark.sparkContext.broadcast(bits.view(np.uint64))

    seen = named.select("text", "row_file", "row_no").mapInArrow(
        tidy(_document_grams(n, sizes, bitmap)),
        "row_file long, row_no long, gram long, first long, last long, head long",
    )
    seen = stored(seen.join(grams.select("gram").distinct(), "gram", "left_semi"), "leak-seen")
    spans = stored(_seed_spans(seen, grams, items, rare_share * docs.count(), least_score), "leak-spans")
    wanted = spans.groupBy("row_file", "row_no").agg(
        F.collect_list(F.struct("item", "start", "end")).alias("wanted")
    )
    passages = (
        beside(named, wanted, 60 * spans.count())
        .select("text", "row_file", "row_no", "doc_id", "wanted")
        .mapInArrow(
            tidy(_passages),
            "row_file long, row_no long, doc_id long, item long, start long, passage array<long>",
        )
    )
    scored = passages.join(items, "item").mapInArrow(tidy(_align_rows), _FOUND)
    # A document may give several passages for an item: the best counts, then the first.
    best = F.max(F.struct("score", -F.col("first_word"), "first_word", "last_word", "doc_id", "item_id"))
    return (
        scored.where(F.col("score") >= least_score)
        .groupBy("row_file", "row_no", "item")
        .agg(best.alias("best"))
        .select(
            "row_file",
            "row_no",
            *[f"best.{c}" for c in ("doc_id", "item_id", "score", "first_word", "last_word")],
        )
    )


def leaked_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``doc_id, item_id, score, first_word, last_word`` of each leak."""
    return find_leaks(docs, benchmark, **options).drop("row_file", "row_no")


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no benchmark item, with their columns."""
    named = with_row_id(docs)
    leaks = find_leaks(named, benchmark, **options).select("row_file", "row_no").distinct()
    leaks = stored(leaks, "leak-rows")
    return beside(named, leaks, 40 * leaks.count(), "left_anti").select("doc.*")


ship(__name__)
