"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Every shard draws a pseudo-random score for a key and the best score wins, so the key and
the shards' weights alone decide. A new shard takes only the keys on which it scores best;
a removed shard gives away only its own. With score ``-w / ln(u)`` a shard's share of the
keys is proportional to its weight ``w``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import stored

#: Rows that one numbering group holds on average.
ROWS_PER_CHUNK = 50_000


def shard_scores(key: Column, weights: Sequence[float], salt: int = 0) -> Column:
    """Array of the shards' scores for a key; a shard of weight 0 never wins."""
    scores = []
    for shard, weight in enumerate(weights):
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(salt), F.lit(shard)), 11)
        unit = (bits.cast("double") + 0.5) / float(2**53)
        scores.append(-F.lit(float(weight)) / F.log(unit))
    return F.array(*scores)


def best_shard(scores: Column) -> Column:
    """Number of the best score, the lowest one of a tie."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def rendezvous_shards(
    df: DataFrame,
    key: str,
    weights: Sequence[float],
    grown_weights: Sequence[float] | None = None,
    salt: int = 0,
) -> DataFrame:
    """Add ``shard`` and, given ``grown_weights``, ``grown_shard`` under those weights.

    Rows with a null key share one shard, since null is one key. Equal keys share theirs.
    """
    if not any(w > 0 for w in weights) or min(weights) < 0:
        raise ValueError("weights must not be negative, and one must be positive")
    out = df.withColumn("_scores", shard_scores(F.col(key), weights, salt))
    out = out.withColumn("shard", best_shard(F.col("_scores")))
    grown = F.lit(None).cast("int")
    if grown_weights is not None:
        grown = best_shard(shard_scores(F.col(key), grown_weights, salt))
    return out.withColumn("grown_shard", grown).drop("_scores")


def number_slots(
    df: DataFrame, group: str, spread: Sequence[str], rows: int, groups: int
) -> DataFrame:
    """Add ``slot``, gapless from 0 within each ``group``.

    A group is cut into chunks by a hash of the ``spread`` columns. Rows are numbered
    inside a chunk and moved by the counts of the chunks before it, so no task sorts a whole
    group. ``df`` is read twice and should be a stored table.
    """
    chunks = max(1, math.ceil(rows / max(1, groups) / ROWS_PER_CHUNK))
    df = df.withColumn("_chunk", F.pmod(F.xxhash64(*spread), F.lit(chunks)))
    before = Window.partitionBy(group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        df.groupBy(group, "_chunk")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    inside = Window.partitionBy(group, "_chunk").orderBy(*spread)
    return (
        df.withColumn("_at", F.row_number().over(inside))
        .join(starts, [group, "_chunk"])
        .withColumn("slot", (F.col("_start") + F.col("_at") - 1).cast("long"))
        .drop("_chunk", "_at", "_start")
    )


def shard_documents(docs: DataFrame, shards: int) -> DataFrame:
    """Place documents: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    ``size`` is the text's UTF-8 bytes (null: none) plus 16 and ``grown_shard`` the place
    with one shard more. Slots follow doc_id, then text checksum. Repeated rows get slots of
    their own; an empty table gives an empty result.
    """
    text = F.coalesce("text", F.lit(""))
    placed = rendezvous_shards(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 16).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.lit("key").alias("law"),
        ),
        "doc_id",
        [1.0] * shards,
        [1.0] * (shards + 1),
    )
    placed = stored(placed, "shards")
    rows = placed.count()
    return number_slots(placed, "shard", ["doc_id", "text_crc32", "size"], rows, shards).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
