"""From a lineage CSV and a folder of SQL files to written outputs."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..constants import Profile, get_profile
from ..operators.spread import materialize
from ..sources.files import read_edges, read_named_sql_files, resolve_parent
from ..sources.sinks import OutputPaths, output_paths, write_lineage
from .lineage import extract_lineage


def run_pipeline(
    spark: SparkSession,
    input_csv: str,
    output_dir: str,
    sql_base_dir: str,
    profile: str | Profile = "rows",
    fmt: str = "parquet",
    ordered: bool = False,
    work_dir: str | None = None,
) -> OutputPaths:
    """Read, explain, write. ``parent`` is matched by its path below ``sql_base_dir`` or its
    absolute path; the outputs show it as the CSV does. ``concat`` keeps bytes that are not
    UTF-8 as U+FFFD. Shared results go to ``work_dir`` (see ``extract_lineage``)."""
    edges = read_edges(spark, input_csv, profile).withColumn(
        "parent_key", resolve_parent(F.col("parent"), sql_base_dir)
    )
    edges = materialize(edges, "input", work_dir)
    keys = edges.select(F.col("parent_key").alias("parent"))
    files = read_named_sql_files(spark, keys, sql_base_dir, get_profile(profile).multi_row)
    result = extract_lineage(edges, files, profile, work_dir)
    paths = output_paths(input_csv, output_dir, profile)
    write_lineage(result, paths, fmt, ordered)
    result.release()
    return paths
