"""Mixing sources to target weights by pivotal dependent rounding, all in native expressions.

A source with target ``T`` and ``S`` words wants ``T / S`` copies of each document. The whole
part is certain. The fractional part is settled by pairwise duels: two documents move word
mass between them at random, each keeping its expected copies, until one of them is settled.
The sum of words is unchanged by a duel, so a source misses its target by less than the one
document that is left at the end. Long documents duel first, which tends to leave a short one,
and what a coin for the last one makes wrong is worked off on others.

Duels run as a reduction tree: buckets of about ``FAN`` documents each fold to one unsettled
document, these again meet in buckets of at most ``FAN``, up to one per source. A source that
holds most rows is only many buckets. Rows of a source with equal doc_id and text are numbered
and the number counts in their hash, so that copies spread over buckets like others. All random
numbers are hashes, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import beside, stored, with_row_id, word_count

FAN = 64
#: Rows that one group of numbered copies holds on average.
COPIES_PER_CHUNK = 1_000
WEIGHTS = (3.0, 1.0, 2.0)
_ITEM = "struct<size:bigint,h:bigint,doc_id:bigint,row_file:bigint,row_no:bigint,p:double>"
_DONE = "array<struct<doc_id:bigint,row_file:bigint,row_no:bigint,size:bigint,up:int>>"
_STATE = f"struct<cur:{_ITEM},done:{_DONE}>"


def unit_hash(*cols: Column) -> Column:
    """A number in (0, 1) from a hash."""
    bits = F.shiftrightunsigned(F.xxhash64(*cols), 11)
    return (bits.cast("double") + 0.5) / float(2**53)


def source_targets(
    sized: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    total_share: float = 1.5,
    cap: float = 2.0,
) -> DataFrame:
    """Per source: ``source, n, source_size, target``.

    Sources by code point, null last, take the weights in turn and share ``total_share`` of
    all words by weight. A target stops at ``cap`` times its source; the excess goes to the
    others by weight. That ends where every target is ``min(cap * size, level * weight)``;
    with sources ordered by ``cap * size / weight``, the level is known once the number of
    capped ones is. The windows see one row per source, never documents.
    """
    every = F.lit(1)
    by_name = Window.partitionBy(every).orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.partitionBy(every).orderBy("ratio", F.col("source").asc_nulls_last())
    upto = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(every)
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))).cast("int")
    per = (
        sized.groupBy("source")
        .agg(F.count(every).alias("n"), F.sum("size").alias("source_size"))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1))
        .withColumn("ceiling", F.col("source_size") * cap)
        .withColumn("ratio", F.col("ceiling") / F.col("weight"))
        .withColumn("capped", F.coalesce(F.sum("ceiling").over(upto), F.lit(0.0)))
        .withColumn(
            "open", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0))
        )
        .withColumn("all_words", F.sum("source_size").over(whole) * total_share)
        .withColumn("level", (F.col("all_words") - F.col("capped")) / F.col("open"))
    )
    # Open sources start where the level first stays below the ratio; later levels are lower.
    level = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(whole)
    target = F.least("ceiling", F.coalesce(level, F.lit(float("inf"))) * F.col("weight"))
    return per.withColumn("target", target).select("source", "n", "source_size", "target")


def _duel(cur: Column, new: Column, level: int, seed: int) -> tuple[Column, Column, Column]:
    """Settled item with its outcome, and the item that goes on."""
    p, q, a, b = cur["p"], new["p"], cur["size"], new["size"]
    up = F.least(1 - p, q * b / a)
    down = F.least(p, (1 - q) * b / a)
    draw = unit_hash(cur["h"], new["h"], F.lit(level), F.lit(seed))
    raised = draw * (up + down) < down
    # Whichever bound was met first tells which of the two is settled.
    cur_settled = F.when(raised, 1 - p <= q * b / a).otherwise(p <= (1 - q) * b / a)
    outcome = (raised == cur_settled).cast("int")
    settled = F.when(cur_settled, cur).otherwise(new)
    left_p = (
        F.when(cur_settled & raised, q - (1 - p) * a / b)
        .when(cur_settled, q + p * a / b)
        .when(raised, p + q * b / a)
        .otherwise(p - (1 - q) * b / a)
    )
    left = F.when(cur_settled, new).otherwise(cur)
    left = F.struct(
        *[left[f].alias(f) for f in ("size", "h", "doc_id", "row_file", "row_no")],
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), left_p)).alias("p"),
    ).cast(_ITEM)
    return settled, outcome, left


def _fold(items: Column, level: int, seed: int) -> Column:
    """Fold an array of items to ``cur`` (unsettled) and ``done`` (settled)."""

    def step(acc: Column, new: Column) -> Column:
        settled, outcome, left = _duel(acc["cur"], new, level, seed)
        row = F.struct(
            *[settled[f].alias(f) for f in ("doc_id", "row_file", "row_no", "size")],
            outcome.alias("up"),
        )
        return F.struct(left, F.concat(acc["done"], F.array(row).cast(_DONE))).cast(_STATE)

    start = F.struct(items[0], F.array().cast(_DONE)).cast(_STATE)
    return F.aggregate(F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0))), start, step)


def _finish(cur: Column, done: Column, seed: int) -> Column:
    """All rows of a source's last fold, its last document settled by a coin.

    The coin's error is worked off on documents of the same fold, the longest first: one is
    turned over where that brings the source's words nearer to the target. Coin errors have
    mean 0, so that documents are turned up and down alike.
    """
    coin = (unit_hash(cur["h"], F.lit(seed)) < cur["p"]).cast("int")
    last = F.struct(
        *[cur[f].alias(f) for f in ("doc_id", "row_file", "row_no", "size")], coin.alias("up")
    )
    kind = f"struct<error:double,rows:{_DONE}>"
    start = F.struct((coin - cur["p"]) * cur["size"], F.array(last).cast(_DONE)).cast(kind)

    def step(acc: Column, x: Column) -> Column:
        sign = F.when(x["up"] == 1, 1).otherwise(-1)
        turn = 2 * acc["error"] * sign > x["size"]
        row = F.struct(
            *[x[f].alias(f) for f in ("doc_id", "row_file", "row_no", "size")],
            F.when(turn, 1 - x["up"]).otherwise(x["up"]).alias("up"),
        )
        error = acc["error"] - F.when(turn, sign * x["size"]).otherwise(0)
        return F.struct(error, F.concat(acc["rows"], F.array(row).cast(_DONE))).cast(kind)

    return F.aggregate(done, start, step, lambda acc: acc["rows"])


def _tell_copies(items: DataFrame, rows: int) -> DataFrame:
    """Make ``h`` of rows of a source with equal ``h`` differ, the first one's stays.

    Copies are numbered from 0 in chunks that a hash of the row's place deals out, moved by the
    counts of the chunks before, so no task sees all copies. Which copy has which number hangs
    on the files, the numbers do not: copies are alike in all that is drawn by.
    """
    chunks = max(1, -(-rows // COPIES_PER_CHUNK))
    items = items.withColumn("chunk", F.pmod(F.xxhash64("row_file", "row_no"), F.lit(chunks)))
    before = Window.partitionBy("source", "h").orderBy("chunk")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        items.groupBy("source", "h", "chunk")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("start", F.sum("copies").over(before))
        .where("start > 0")  # few rows where doc_ids are unique
        .select(F.col("source").alias("s_source"), F.col("h").alias("s_h"), F.col("chunk").alias("s_chunk"), "start")
    )
    inside = Window.partitionBy("source", "h", "chunk").orderBy("row_file", "row_no")
    same = (
        F.col("source").eqNullSafe(F.col("s_source"))
        & (F.col("h") == F.col("s_h"))
        & (F.col("chunk") == F.col("s_chunk"))
    )
    number = F.coalesce("start", F.lit(0)) + F.row_number().over(inside) - 1
    return (
        items.join(starts, same, "left")
        .withColumn("number", number)
        .withColumn("h", F.when(F.col("number") > 0, F.xxhash64("h", "number")).otherwise(F.col("h")))
        .drop("chunk", "number", "start", "s_source", "s_h", "s_chunk")
    )


def mix_rows(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    total_share: float = 1.5,
    cap: float = 2.0,
    seed: int = 7,
) -> DataFrame:
    """Copies of every document: ``doc_id, row_file, row_no, source, size, source_size,
    target, copies``. ``docs`` comes from :func:`with_row_id`.

    Documents without words get 0 copies, as they change no total. Null doc_ids and repeated
    rows are rows like others; the draws depend on doc_ids and texts alone, not on files. An
    empty table gives an empty result.
    """
    sized = stored(
        docs.select(
            F.col("doc.doc_id").cast("long").alias("doc_id"),
            F.col("doc.source").alias("source"),
            "row_file",
            "row_no",
            word_count(F.col("doc.text")).alias("size"),
            F.xxhash64("doc.doc_id", "doc.text").alias("h"),
        ),
        "mix-sizes",
    )
    targets = stored(source_targets(sized, weights, total_share, cap), "mix-targets")
    targets = targets.withColumnRenamed("source", "t_source")
    of_source = F.col("source").eqNullSafe(F.col("t_source"))
    share = F.when(
        F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(cap)))
    ).otherwise(0.0)
    start = (
        sized.join(targets, of_source)
        .withColumn("share", share)
        .withColumn("base", F.floor("share").cast("int"))
        .withColumn("p", F.col("share") - F.col("base"))
        .withColumn("buckets", F.ceil(F.col("n") / FAN))
    )
    plays = (F.col("size") > 0) & (F.col("p") > 0)
    item = F.struct("size", "h", "doc_id", "row_file", "row_no", "p").cast(_ITEM)
    bucket = F.pmod(F.xxhash64(F.lit(seed), "h"), F.col("buckets"))
    largest, every = targets.agg(F.max("n"), F.sum("n")).first()
    largest = largest or 0
    todo = _tell_copies(start.where(plays), every or 0).select(
        "source", "buckets", bucket.alias("bucket"), item.alias("item")
    )
    buckets, level, done = max(1, -(-largest // FAN)), 0, []
    while True:
        folded = stored(
            todo.groupBy("source", "buckets", "bucket")
            .agg(F.sort_array(F.collect_list("item"), asc=False).alias("items"))
            .withColumn("f", _fold(F.col("items"), level, seed))
            .select("source", "buckets", "bucket", "f.cur", "f.done"),
            "mix-level",
        )
        rows = F.when(F.col("buckets") == 1, _finish(F.col("cur"), F.col("done"), seed))
        done.append(folded.select("source", F.inline(rows.otherwise(F.col("done")))))
        if buckets == 1:
            break
        todo = folded.where("buckets > 1").select(
            "source",
            F.ceil(F.col("buckets") / FAN).alias("buckets"),
            F.floor(F.col("bucket") / FAN).cast("long").alias("bucket"),
            F.col("cur").alias("item"),
        )
        buckets, level = -(-buckets // FAN), level + 1
    rows = start.where(~plays).select(
        "source", "doc_id", "row_file", "row_no", "size", F.lit(0).alias("up")
    )
    for part in done:
        rows = rows.unionByName(part)
    copies = F.when(F.col("size") > 0, F.floor("share").cast("int") + F.col("up")).otherwise(0)
    return (
        rows.join(targets, of_source)
        .withColumn("share", share)
        .withColumn("copies", copies)
        .drop("share", "up", "n", "t_source")
    )


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """Digest per document: ``doc_id, size, source_size, target, taken``."""
    return mix_rows(with_row_id(docs), **options).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def mixed_corpus(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it was drawn, with the columns of ``docs``."""
    named = with_row_id(docs)
    drawn = mix_rows(named, **options).where("copies > 0").select("row_file", "row_no", "copies")
    drawn = stored(drawn, "mix-drawn")
    return (
        beside(named, drawn, 40 * drawn.count())
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select("doc.*")
    )
