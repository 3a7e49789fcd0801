"""The four outputs as one result: readers see all of them or none."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import EDGE_COLUMNS, ROW_ERROR, Profile, get_profile
from ..sources.sinks import OutputPaths, write_lineage
from .lineage import extract_lineage

_MANIFEST = "digest string, profile string, format string, " + ", ".join(
    f"{name} string" for name in OutputPaths._fields
)


def _content(df: DataFrame, columns: list[Column]) -> DataFrame:
    """Row count and digest of a table's rows, whatever their order.

    Two sums of 64-bit hashes: repeated rows count, and no row moves.
    """
    row = F.struct(*columns)
    sums = [F.sum(F.xxhash64(F.lit(seed), row).cast("decimal(38,0)")) for seed in (1, 2)]
    texts = [F.coalesce(x.cast("string"), F.lit("")) for x in [F.count(F.lit(1)), *sums]]
    return df.agg(F.concat_ws(",", *texts).alias("content"))


def input_digest(edges: DataFrame, sql_files: DataFrame, *settings: str) -> str:
    """Digest of what the outputs depend on: edges, texts and settings.

    The order of edges counts where they have a ``row_id``.
    """
    extra = [c for c in ("row_id", "parent_key", ROW_ERROR) if c in edges.columns]
    one = _content(edges, [F.col(c) for c in [*EDGE_COLUMNS, *extra]])
    two = _content(sql_files, [F.col("parent"), F.col("sql_text")])
    both = one.union(two).agg(F.array_join(F.array_sort(F.collect_list("content")), ";").alias("c"))
    return both.select(F.md5(F.concat_ws("|", "c", *map(F.lit, settings)))).head()[0]


def published(spark: SparkSession, output_dir: str, digest: str) -> OutputPaths | None:
    """Where the complete outputs of an input are; None before they are complete."""
    manifest = f"{output_dir.rstrip('/')}/manifest/{digest}"
    try:
        found = spark.read.schema(_MANIFEST).json(manifest).head()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = None
    return found and OutputPaths(*[found[name] for name in OutputPaths._fields])


def publish_lineage(
    edges: DataFrame,
    sql_files: DataFrame,
    output_dir: str,
    profile: str | Profile = "rows",
    fmt: str = "parquet",
    ordered: bool = False,
    work_dir: str | None = None,
) -> OutputPaths:
    """Explain ``edges`` and write fact, dimension, summary and warnings.

    The tables go to a folder named by the input's digest, and a manifest of one row, written
    last, says that they are complete. A run that ended early leaves no manifest; the next one
    of the same input writes its tables over. An input that has a manifest is not worked out
    again. Runs of other inputs never touch these tables.
    """
    spark = edges.sparkSession
    name = get_profile(profile).name
    digest = input_digest(edges, sql_files, name, fmt, str(ordered))
    if done := published(spark, output_dir, digest):
        return done
    root = output_dir.rstrip("/")
    paths = OutputPaths(*[f"{root}/run-{digest}/{part}" for part in OutputPaths._fields])
    result = extract_lineage(edges, sql_files, profile, work_dir)
    write_lineage(result, paths, fmt, ordered, mode="overwrite")
    result.release()
    row = spark.createDataFrame([(digest, name, fmt, *paths)], _MANIFEST)
    row.coalesce(1).write.mode("overwrite").json(f"{root}/manifest/{digest}")
    return paths
