"""Helpers for hot keys, shared intermediate results and expressions computed once.

The package explodes computed arrays with ``explode_outer``: for a plain explode
the optimizer adds a filter on the array's size below, which computes it twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Pairs of rows that one split of a hot join key has to make, about.
PAIRS_PER_SPLIT = 1_000_000


def computed_once(df: DataFrame) -> DataFrame:
    """Keep later filters from moving below (and repeating) costly column expressions."""
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))


def materialize(df: DataFrame, name: str, work_dir: str | None = None) -> DataFrame:
    """Compute ``df`` once for several readers.

    Written as a parquet table below ``work_dir``, else below the session's
    ``spark.checkpoint.dir``: that cuts the lineage, survives lost executors and lets each
    reader prune columns. Where neither is given the result is persisted, and lost blocks are
    computed again; :func:`release` gives it up.
    """
    folder = work_dir or df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if not folder:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(*frames: DataFrame) -> None:
    """Give up results that :func:`materialize` persisted; written tables stay."""
    for df in frames:
        df.unpersist()


def spread_work(df: DataFrame, *keys: str) -> DataFrame:
    """Hash rows evenly over the shuffle partitions, before costly per-row work.

    The fixed number keeps AQE from merging small inputs into one slow task.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *keys)


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread_by: str,
    work_dir: str | None = None,
    pairs_per_split: int | None = None,
) -> DataFrame:
    """Inner join whose hot keys are split by the number of pairs they make.

    Rows of ``left`` with a hot key are dealt over splits by a hash of ``spread_by``; the
    rows of ``right`` are repeated once per split. Any split gives the same pairs.
    """
    keys, pairs_per_split = list(keys), pairs_per_split or PAIRS_PER_SPLIT
    pairs = F.col("nl") * F.col("nr")
    splits = F.least(F.ceil(pairs / pairs_per_split), F.col("nl")).cast("int")
    hot = (
        left.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("nl"))
        .join(right.groupBy(*keys).agg(F.count(F.lit(1)).alias("nr")), keys)
        .where(pairs > pairs_per_split)
        .select(*keys, splits.alias("splits"))
    )
    hot = materialize(hot, "hot-keys", work_dir)
    if not hot.head(1):
        return left.join(right, keys)
    last = F.coalesce("splits", F.lit(1)) - 1
    dealt = left.join(hot, keys, "left").withColumn(
        "split", F.coalesce(F.pmod(F.xxhash64(spread_by), F.col("splits")), F.lit(0)).cast("int")
    )
    repeated = right.join(hot, keys, "left").withColumn(
        "split", F.explode_outer(F.sequence(F.lit(0), last))
    )
    return dealt.drop("splits").join(repeated.drop("splits"), [*keys, "split"]).drop("split")
